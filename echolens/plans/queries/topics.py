"""Tokens, phrases, dictionary, tagging, topic model, coherence, scorer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...sources.tables import table as _table
from ...operators import phrases as PH, tokens as TK, topics as TP
from ...schemas import SUBTHEME_CODES
from ...session import cut_lineage
from ._common import (
    _bigrams_appended_sql, _DOC_FEATURES, _doc_features, _docs, _en_docs, _labelled_docs, _lda, _phrase_merge_sql, _phrased_docs,
    _phrases_sql, _rule_sql, _source_coherence_sql, _subtheme_sql, _themed_docs, _top_words, _topic_corpus, register, round_doubles,
    test_topic_rules
)


@register("clean_tokens", f"""
SELECT doc_id, len(tok) AS n_tokens, array_to_string(tok, ' ') AS tokens
FROM (SELECT doc_id, {TK.clean_tokens_sql('text')} AS tok FROM documents WHERE lang = 'en')
""")
def q_clean_tokens(spark, sf):
    """Post token cleaning."""
    return _en_docs(spark, sf).select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"),
                                      F.array_join("tokens", " ").alias("tokens"))


@register("phrases", _phrases_sql())
def q_phrases(spark, sf):
    """Bigram phrase table with scores above the threshold."""
    return round_doubles(PH.learn_phrases(_en_docs(spark, sf), "tokens"))


@register("phrase_merged_tokens", _phrase_merge_sql())
def q_phrase_merged_tokens(spark, sf):
    """Tokens with bigrams, then trigrams, merged left to right."""
    d3 = _phrased_docs(spark, sf)
    return d3.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"),
                     F.array_join("tokens", " ").alias("tokens"))


@register("doc_freq_dictionary", f"""
WITH d AS (SELECT doc_id, {TK.clean_tokens_sql('text')} AS tok FROM documents WHERE lang = 'en'),
n AS (SELECT count(*) AS n_docs FROM d),
df AS (SELECT w AS token, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest(tok) AS w FROM d) GROUP BY w)
SELECT token, df FROM df, n WHERE df >= 0.0005 * n_docs AND df <= 0.33 * n_docs
""")
def q_doc_freq_dictionary(spark, sf):
    """Dictionary with document-frequency limits."""
    return TP.doc_freq_dictionary(_en_docs(spark, sf), "tokens", "doc_id")


@register("subtheme_tags", _subtheme_sql())
def q_subtheme_tags(spark, sf):
    """Subtheme keyword tags within the document's theme, decoded."""
    from ...schemas import SUBTHEME_CODES
    out = TP.subtheme_flags(_themed_docs(spark, sf), "tokens", "theme")
    n = None
    for c in SUBTHEME_CODES:
        v = F.col(f"subtheme{c}").cast("int")
        n = v if n is None else n + v
    return out.select("doc_id", "theme", "subtheme", n.alias("n_flags"))


@register("rule_themes", _rule_sql())
def q_rule_themes(spark, sf):
    """Rule-based themes: last matching keyword rule of the topic wins."""
    rules = spark.createDataFrame(test_topic_rules(),
                                  "topic int, theme_id int, themes string, keywords string, default string, rule_order int")
    docs = _en_docs(spark, sf).withColumn("num_topic", F.substring("source", 4, 10).cast("int"))
    return TP.rule_themes(docs, rules, "tokens", "num_topic").select("doc_id", "num_topic", "theme")


@register("lda_prevalence")
def q_lda_prevalence(spark, sf):
    """LDA (k=20, seed 50) dominant-topic prevalence."""
    model, data, _ = _lda(spark, sf)
    return TP.topic_prevalence(TP.dominant_topic(model, data, "doc_id"))


@register("lda_topic_themes")
def q_lda_topic_themes(spark, sf):
    """Documents with dominant topic, weight, topic keywords, theme and subtheme."""
    model, data, index = _lda(spark, sf, keep=["tokens"])
    dt = TP.dominant_topic(model, data, "doc_id")
    terms = TP.topic_terms(model, index, 10)
    kw = terms.groupBy(F.col("topic").alias("num_topic")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "word"))), lambda s: s["word"]),
                     ", ").alias("topic_keywords"))
    th = TP.topics_to_themes(dt.join(F.broadcast(kw), "num_topic", "left"), spark)
    tagged = TP.subtheme_flags(th.join(data.select("doc_id", "tokens"), "doc_id"), "tokens", "theme")
    return tagged.select("doc_id", "num_topic", F.round("topic_weight", 4).alias("topic_weight"),
                         "topic_keywords", "theme", "subtheme")


@register("theme_words")
def q_theme_words(spark, sf):
    """Top 40 words per theme pooled from its topics."""
    model, _, index = _lda(spark, sf)
    terms = TP.topic_terms(model, index, 40)
    from ...sources.lookups import topic_themes
    tw = TP.theme_words(terms, topic_themes(spark), 40)
    return tw.select("theme", F.size("words").alias("n_words"), F.array_join("words", " ").alias("words"))


@register("top_docs_per_topic")
def q_top_docs_per_topic(spark, sf):
    """Ten highest-weight documents per dominant topic."""
    from ...operators.ranking import top_n_per_group
    model, data, _ = _lda(spark, sf)
    dt = TP.dominant_topic(model, data, "doc_id")
    return top_n_per_group(dt, "num_topic", [F.col("topic_weight").desc(), F.col("doc_id")], 10,
                           rank_col="rank").select("num_topic", "rank", "doc_id",
                                                   F.round("topic_weight", 4).alias("topic_weight"))


@register("coherence")
def q_coherence(spark, sf):
    """C_v coherence per topic and overall."""
    from ...operators.coherence import coherence_cv
    model, data, index = _lda(spark, sf, keep=["tokens"])
    per, overall = coherence_cv(data, _top_words(model, index), "tokens", "doc_id")
    return per.select(F.col("topic").cast("int").alias("topic"), F.round("c_v", 6).alias("c_v")).unionByName(
        overall.select(F.lit(-1).alias("topic"), F.round("c_v", 6).alias("c_v")))


@register("theme_coherence")
def q_theme_coherence(spark, sf):
    """C_v of the themes' word lists, pooled from their topics."""
    from ...operators.coherence import coherence_cv
    from ...sources.lookups import topic_themes
    model, data, index = _lda(spark, sf, keep=["tokens"])
    lists = TP.theme_words(TP.topic_terms(model, index, 40), topic_themes(spark), 40).select(
        F.col("theme").alias("topic"), F.posexplode("words").alias("rank", "word"))
    per, overall = coherence_cv(data, cut_lineage(lists), "tokens", "doc_id")
    return per.select(F.col("topic").cast("int").alias("theme"), F.round("c_v", 6).alias("c_v")).unionByName(
        overall.select(F.lit(-1).alias("theme"), F.round("c_v", 6).alias("c_v")))


@register("source_coherence", _source_coherence_sql())
def q_source_coherence(spark, sf):
    """C_v of each source's eight most widespread dictionary words over the whole corpus."""
    from ...operators.coherence import coherence_cv
    from ...operators.ranking import top_n_per_group
    docs = cut_lineage(_en_docs(spark, sf).select("doc_id", "source", "tokens"), large=True)
    index = TP.term_index(TP.doc_freq_dictionary(docs, "tokens", "doc_id"))
    spread = TP.term_counts(docs.select("doc_id", "tokens"), index).join(docs.select("doc_id", "source"), "doc_id").groupBy(
        "source", F.col("token").alias("word")).agg(F.count(F.lit(1)).alias("n"))
    lists = top_n_per_group(spread, "source", [F.col("n").desc(), F.col("word")], 8, rank_col="rank").select(
        F.col("source").alias("topic"), "rank", "word")
    per, _ = coherence_cv(docs, cut_lineage(lists), "tokens", "doc_id")
    return per.select(F.col("topic").alias("source"), F.round("c_v", 6).alias("c_v"))


@register("term_topics")
def q_term_topics(spark, sf):
    """Topics of every dictionary term in which it weighs a thousandth or more."""
    model, _, index = _lda(spark, sf)
    return TP.term_topics(model, index, 0.001).select("word", "topic", F.round("weight", 6).alias("weight"))


@register("coherence_sweep")
def q_coherence_sweep(spark, sf):
    """C_v over k = 2, 5, ..., 38 (T13, R08): full fits, submitted together, all lists scored in one pass."""
    from ...operators.coherence import sweep
    bow, index = _topic_corpus(spark, sf)
    return sweep(bow, index).select("k", F.round("c_v", 6).alias("c_v"))


@register("emotion_scores")
def q_emotion_scores(spark, sf):
    """Emotion scores of every document from a scorer trained on labels."""
    from ...operators.scoring import score_with_model, train_text_scorer
    model = train_text_scorer(_labelled_docs(spark, sf), "content", "label")
    docs = _table(spark, sf, "documents").select("doc_id", F.col("text").alias("content"))
    return score_with_model(docs, model, "doc_id", "content")


@register("account_classifier")
def q_account_classifier(spark, sf):
    """Classifier over document features trained on quality labels."""
    from ...operators.scoring import predict_classifier, train_classifier
    feats = _doc_features(spark, sf)
    train = feats.join(_table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    model = train_classifier(train, _DOC_FEATURES, "quality")
    return predict_classifier(model, feats, _DOC_FEATURES, "doc_id").select(
        "doc_id", "pred", F.round("p_true", 6).alias("p_true"))


@register("bigrams_appended", _bigrams_appended_sql())
def q_bigrams_appended(spark, sf):
    """Bio tokens with the detected bigrams appended (min count 3)."""
    d = TK.bio_tokens(_docs(spark, sf, "doc_id", "text"), "text", "tokens").select("doc_id", "tokens")
    d = cut_lineage(d, large=True)
    bi = PH.learn_phrases(d, "tokens", min_count=3)
    return PH.append_bigrams(d, bi, "doc_id", "tokens").select("doc_id", F.array_join("tokens", " ").alias("tokens"))


@register("dense_word_counts", f"""
WITH d AS (SELECT doc_id, {TK.clean_tokens_sql('text')} AS tok FROM documents WHERE lang = 'en'),
n AS (SELECT count(*) AS n_docs FROM d),
df AS (SELECT w AS token, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest(tok) AS w FROM d) GROUP BY w),
top AS (SELECT token FROM df, n WHERE df >= 0.0005 * n_docs AND df <= 0.33 * n_docs
        ORDER BY df DESC, token LIMIT 10)
SELECT d.doc_id, top.token AS word, len(list_filter(d.tok, lambda t: t = top.token)) AS n
FROM d CROSS JOIN top
""")
def q_dense_word_counts(spark, sf):
    """Counts over the dictionary; those of its ten most frequent words for every document."""
    docs = cut_lineage(_en_docs(spark, sf).select("doc_id", "tokens"), large=True)
    index = TP.term_index(TP.doc_freq_dictionary(docs, "tokens", "doc_id"))
    return TP.dense_counts(docs, TP.term_counts(docs, index), index, 10)


@register("subtheme_totals", _subtheme_sql().replace(
    "SELECT doc_id, theme, cast(", "SELECT subtheme, count(*) AS n_docs FROM (SELECT doc_id, theme, cast(", 1).rstrip()
    + ") GROUP BY subtheme\n")
def q_subtheme_totals(spark, sf):
    """Documents per decoded subtheme (the subtheme totals of the topic report)."""
    from ...schemas import SUBTHEME_CODES
    out = TP.subtheme_flags(_themed_docs(spark, sf), "tokens", "theme")
    return out.groupBy("subtheme").agg(F.count(F.lit(1)).alias("n_docs"))
