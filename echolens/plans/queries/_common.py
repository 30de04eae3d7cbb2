"""Query registry, compare-contract helpers, shared test bindings and parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F, SparkSession

from ...sources.tables import table as _table
from ...functions import text as TX
from ...operators import lift as L, phrases as PH, tokens as TK, topics as TP
from ...schemas import CONTINENT_OF, EMOTIONS, SUBTHEME_CODES, THEME_DESC
from ...session import scratch_path
from .. import reports as R, views as V


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` (run on a UTC session) with its oracle SQL."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from ...session import ensure_utc
            ensure_utc(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco




def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (the compare contract, not part of the operator)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        cols.append(F.round(c, digits).alias(f.name) if f.dataType.typeName() == "double" else c)
    return df.select(*cols)


def _theme_values_sql() -> str:
    rows = ", ".join(f"({c}, '{d}')" for c, d in THEME_DESC)
    return f"(VALUES {rows}) AS td(theme, theme_desc)"


_EM = EMOTIONS


def _mean_cols_sql(prefix="") -> str:
    return ", ".join(f"avg({m}) AS {prefix}{m}" for m in _EM)


def _cube_sql() -> str:
    all_keys = []
    for ks in L.LIFT_SETS.values():
        for k in ks:
            if k not in all_keys:
                all_keys.append(k)
    parts = []
    for name, ks in L.LIFT_SETS.items():
        sel = ", ".join(k if k in ks else f"NULL AS {k}" for k in all_keys)
        where = " AND ".join(f"{k} IS NOT NULL" for k in ks)
        parts.append(f"SELECT '{name}' AS set_name, {sel}, count(reply_id) AS n, "
                     f"{_mean_cols_sql()} FROM replies WHERE {where} GROUP BY {', '.join(ks)}")
    body = "\nUNION ALL\n".join(parts)
    keys = ", ".join(all_keys)
    return V.VIEWS_SQL + f""",
g AS (SELECT {_mean_cols_sql('g_')} FROM replies),
u AS ({body})
SELECT set_name, {keys}, n, {", ".join(f"round({m}, 6) AS {m}" for m in _EM)},
       {", ".join(f"round({m}/g_{m}, 6) AS lift_{m}" for m in _EM)}
FROM u CROSS JOIN g
"""


def _pivot_sql(src: str, index: str, col: str, val: str, values, names=None) -> str:
    names = names or values
    cells = ", ".join(f"max(CASE WHEN {col} = '{v}' THEN {val} END) AS \"{n}\""
                      for v, n in zip(values, names))
    return f"SELECT {index}, {cells} FROM {src} GROUP BY {index}"


def _row_norm_sql(src: str, index: str, cols) -> str:
    tot = " + ".join(f'coalesce("{c}", 0)' for c in cols)
    cells = ", ".join(f'round(cast("{c}" AS double) / ({tot}), 6) AS "{c}"' for c in cols)
    return f"SELECT {index}, {cells} FROM {src}"


_EMO5 = EMOTIONS + ["undefined"]


_DESCS = [d for _, d in THEME_DESC]


def _subtheme_values_sql() -> str:
    from ...schemas import SUBTHEME_DESC
    rows = ", ".join(f"({c}, '{d}')" for c, d in SUBTHEME_DESC)
    return f"(VALUES {rows}) AS sd(subtheme, subtheme_desc)"


# Test-data cut-offs (accounts here have at most 25 posts and 93 replies;
# the published cut-off of 484 applies to the full collection).
MIN_POSTS, MIN_REPLIES = 15, 60


def _cascade_sql() -> str:
    cols = ", ".join(f"round({m}, 6) AS {m}" for m in EMOTIONS)
    lifts = ", ".join(f"round({m}/g_{m}, 6) AS lift_{m}" for m in EMOTIONS)
    steps, prev = [], []
    for i, m in enumerate(EMOTIONS):
        excl = (" WHERE " + " AND ".join(f"news_id NOT IN (SELECT news_id FROM t{j})" for j in prev)
                if prev else "")
        steps.append(f"""t{i} AS (SELECT *, '{m}' AS main_emotion,
            6 - row_number() OVER (ORDER BY {m} DESC, news_id) AS rank_emotion, {m} AS score_emotion
          FROM cand{excl} ORDER BY {m} DESC, news_id LIMIT 5)""")
        prev.append(i)
    return V.VIEWS_SQL + f""",
g AS (SELECT {_mean_cols_sql('g_')} FROM replies),
acc AS (SELECT continent, country, news_id, count(reply_id) AS n, {_mean_cols_sql()} FROM replies
        WHERE continent IS NOT NULL AND country IS NOT NULL AND news_id IS NOT NULL GROUP BY 1, 2, 3),
eng AS (SELECT account_id FROM posts WHERE account_id IS NOT NULL GROUP BY account_id
        HAVING count(post_id) > {MIN_POSTS}),
cand AS (SELECT acc.*, {lifts.replace('round(', 'round(acc.')} FROM acc CROSS JOIN g
         WHERE news_id IN (SELECT account_id FROM eng) AND n > {MIN_REPLIES}),
{", ".join(steps)},
u AS (SELECT * FROM t0 UNION ALL SELECT * FROM t1 UNION ALL SELECT * FROM t2 UNION ALL SELECT * FROM t3)
SELECT continent, country, news_id, n, {cols}, {", ".join(f"lift_{m}" for m in EMOTIONS)},
       main_emotion, rank_emotion, round(score_emotion, 6) AS score_emotion
FROM u
"""


def _cascade(spark, sf):
    p = V.posts(spark, sf).withColumnRenamed("account_id", "userId")
    return R.top_accounts_cascade(V.replies(spark, sf), p, 5, news_id="news_id",
                                  post_account="userId", reply_id="reply_id", post_id="post_id",
                                  min_posts=MIN_POSTS, min_replies=MIN_REPLIES)


def _mix_sql(group_sql: str, group: str, digits: int) -> str:
    return f"""
sh AS (SELECT {group}, theme, cast(count(*) AS double) / sum(count(*)) OVER (PARTITION BY {group}) AS prop
       FROM ({group_sql}) x WHERE {group} IS NOT NULL AND theme IS NOT NULL GROUP BY 1, 2),
shd AS (SELECT sh.*, td.theme_desc FROM sh JOIN {_theme_values_sql()} ON sh.theme = td.theme),
mix AS (SELECT {group}, {", ".join(f"round_even(max(CASE WHEN theme_desc = '{d}' THEN prop END) * 100, {digits}) AS \"{d}\"" for d in _DESCS)}
        FROM shd GROUP BY {group})"""


SEGMENT = {"continent": "AFRICA", "prevalent_emotion": "anger"}


def nation_coordinates(spark, sf):
    """Per-country coordinates derived from the nation key (the coordinate file is not shipped)."""
    n = _table(spark, sf, "nation")
    return n.select(F.col("n_name").alias("country"),
                    ((F.col("n_nationkey") * 7) % 160 - 80).cast("double").alias("lat"),
                    ((F.col("n_nationkey") * 37) % 360 - 180).cast("double").alias("lng"))


# Frequent words of the test prose stand in for the topical keywords (which
# never occur in it); the operator is the same.
TEST_MAIN_KEYWORDS = ["the", "and", "of", "que", "der", "les"]


TEST_LESS_FREQUENT = ["with", "para", "und", "pour", "that", "dans"]


def _reply_rows(spark, sf):
    li = _table(spark, sf, "lineitem")
    return li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("reply_id"),
                     F.col("l_shipdate").alias("date"), "l_partkey", "l_suppkey", "l_quantity")


_FIRST_SQL = """
WITH r AS (SELECT l_orderkey*10 + l_linenumber AS reply_id, l_shipdate AS date, l_partkey, l_suppkey,
                  l_quantity FROM lineitem),
n AS (SELECT *, row_number() OVER (PARTITION BY reply_id ORDER BY date, l_partkey, l_suppkey,
                                   l_quantity) AS rn FROM r)
SELECT reply_id, date, l_partkey, l_suppkey, l_quantity FROM n WHERE rn = 1
"""


# Threads are bucketed by id range (width 32) so batch numbering runs in
# parallel with a bounded sort per bucket.
PENDING_BUCKET_WIDTH = 32


def _points(spark, sf):
    c = _table(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("point_id"),
                    ((F.col("c_custkey") * 37) % 180 - 90 + F.col("c_nationkey") / 10).alias("latitude"),
                    ((F.col("c_custkey") * 91) % 360 - 180 + F.col("c_nationkey") / 7).alias("longitude"))


def _regions_sql() -> str:
    from ...schemas import SEARCH_REGIONS
    rows = ", ".join(f"('{n}', {la!r}, {lo!r}, {r!r})" for n, la, lo, r in SEARCH_REGIONS)
    return f"(VALUES {rows}) AS rg(region, lat, lng, radius_km)"


def _plain_sql(raw: str) -> str:
    t = raw
    for ent, ch in TX.HTML_ENTITIES:
        t = f"replace({t}, '{ent}', '{ch.replace(chr(39), chr(39) * 2)}')"
    for a, b in TX.TITLE_CHAR_MAP:
        t = f"replace({t}, '{a}', '{b}')"
    return f"regexp_replace(regexp_replace({t}, '[{TX._WS}]+', ' ', 'g'), '^ | $', '', 'g')"


def _title_sql(html: str) -> str:
    raw = f"regexp_extract({html}, '(?is)<title[^>]*>(.*?)</title>', 1)"
    return f"CASE WHEN length({raw}) = 0 THEN '[no-title]' ELSE {_plain_sql(raw)} END"


def _city_rows(spark, sf):
    c = _table(spark, sf, "customer").join(_table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    x = F.floor(F.abs(F.col("c_acctbal")) * 100).cast("long")
    pop = F.concat((x / 1000).cast("long").cast("string"), F.lit("."), F.lpad((x % 1000).cast("string"), 3, "0"))
    return c.select(F.col("c_custkey").cast("int").alias("Rank"),
                    F.concat(F.col("c_name"), F.when(F.col("c_custkey") % 2 == 0, F.lit(" city")).otherwise(F.lit(""))).alias("City"),
                    F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")).alias("State"), pop.alias("2019"))


def _docs(spark, sf, *cols):
    """Documents, spread over the cores when the file gives too few splits."""
    from ...session import spread
    d = _table(spark, sf, "documents")
    return spread(d.select(*cols) if cols else d)


def _en_docs(spark, sf):
    d = _docs(spark, sf, "doc_id", "text", "source", "lang").filter(F.col("lang") == "en").drop("lang")
    return TK.clean_tokens(d, "text", "tokens")


def _phrases_sql(min_count=5, threshold=10.0) -> str:
    return f"""
WITH d AS (SELECT doc_id, {TK.clean_tokens_sql('text')} AS tok FROM documents WHERE lang = 'en'),
u AS (SELECT w, count(*) AS cnt FROM (SELECT unnest(tok) AS w FROM d WHERE len(tok) > 0) GROUP BY w),
p AS (SELECT tok[i] AS word_a, tok[i + 1] AS word_b
      FROM (SELECT tok, unnest(generate_series(1, len(tok) - 1)) AS i FROM d WHERE len(tok) > 1) x),
pc AS (SELECT word_a, word_b, count(*) AS pair_count FROM p GROUP BY 1, 2),
v AS (SELECT (SELECT count(*) FROM u) + (SELECT count(*) FROM pc) AS len_vocab),
s AS (SELECT pc.word_a, pc.word_b, pair_count, ua.cnt AS count_a, ub.cnt AS count_b,
             (pair_count - {min_count}) / ua.cnt / ub.cnt * len_vocab AS score
      FROM pc JOIN u ua ON pc.word_a = ua.w JOIN u ub ON pc.word_b = ub.w CROSS JOIN v
      WHERE pair_count > {min_count})
SELECT word_a, word_b, word_a || '_' || word_b AS phrase, pair_count, count_a, count_b, round(score, 6) AS score
FROM s WHERE score > {threshold}
"""


def _phrased_docs(spark, sf):
    """Cleaned tokens with bigrams merged, then trigrams learned on the merged
    tokens and merged (the corpus the topic model is trained on)."""
    from ...session import cut_lineage
    docs = cut_lineage(_en_docs(spark, sf).select("doc_id", "source", "tokens"), large=True)   # tokenised once
    bi = PH.learn_phrases(docs, "tokens")
    d2 = cut_lineage(PH.apply_phrases(docs, bi, "doc_id", "tokens"), large=True)
    tri = PH.learn_phrases(d2, "tokens")
    return PH.apply_phrases(d2, tri, "doc_id", "tokens")


def _themed_docs(spark, sf):
    """Phrase-merged tokens of each English post with the post's theme (multi-word
    subtheme keywords such as 'death_toll_rise' can then match)."""
    p = V.posts(spark, sf).select(F.col("post_id").alias("doc_id"), "theme")
    return _phrased_docs(spark, sf).join(p, "doc_id")


def _subtheme_sql() -> str:
    from ...schemas import SUBTHEME_CODES, SUBTHEME_RULES
    rules = {code: (th, kws) for th, code, kws in SUBTHEME_RULES}
    flags = []
    for code in SUBTHEME_CODES:
        th, kws = rules[code]
        lst = "[" + ", ".join(f"'{k}'" for k in kws) + "]"
        flags.append(f"(theme = {th} AND list_has_any(tok, {lst}))")
    case = "CASE " + " ".join(f"WHEN {f} THEN {c}" for f, c in zip(flags, SUBTHEME_CODES)) + " ELSE theme * 10 END"
    n = " + ".join(f"cast({f} AS int)" for f in flags)
    return V.VIEWS_SQL + f""",
d0 AS (SELECT doc_id, {TK.clean_tokens_sql('text')} AS tok FROM documents WHERE lang = 'en'),
{_phrase_ctes('d0', 'a_').strip()},
{_merge_ctes('d0', 'a_ph', 'd1').strip()},
{_phrase_ctes('d1', 'b_').strip()},
{_merge_ctes('d1', 'b_ph', 'd').strip()},
t AS (SELECT d.doc_id, d.tok, p.theme FROM d JOIN posts p ON d.doc_id = p.post_id)
SELECT doc_id, theme, cast({case} AS int) AS subtheme, ({n}) AS n_flags FROM t
"""


# Test rules, built from a rule over frequent tokens of the test prose:
# per topic t two ordered keyword rules and a default.
_RULE_POOL = ["ha", "er", "th", "re", "nd", "es", "en", "ed", "ing", "ti",
              "ea", "st", "nt", "ble", "ly", "ther", "tion", "ou", "sh", "thon"]


def test_topic_rules():
    rows = []
    for t in range(20):
        rows.append((t, 1 + t % 8, "rule a", f"{_RULE_POOL[t % 20]}, {_RULE_POOL[(t + 1) % 20]}", "F", 1))
        rows.append((t, 1 + (t + 3) % 8, "rule b", _RULE_POOL[(t + 7) % 20], "F", 2))
        rows.append((t, 1 + (t + 5) % 8, "default", "", "T", 0))
    return rows


def _rule_sql() -> str:
    vals = ", ".join(f"({t}, {th}, '{kw}', '{df}', {o})" for t, th, _, kw, df, o in test_topic_rules())
    return f"""
WITH rules AS (SELECT * FROM (VALUES {vals}) AS r(topic, theme_id, keywords, dflt, rule_order)),
d AS (SELECT doc_id, cast(substr(source, 4) AS int) AS num_topic, {TK.clean_tokens_sql('text')} AS tok
      FROM documents WHERE lang = 'en'),
hits AS (SELECT d.doc_id, r.theme_id, r.rule_order FROM d JOIN rules r ON d.num_topic = r.topic
         WHERE r.dflt = 'F' AND list_has_any(d.tok, string_split(replace(r.keywords, ' ', ''), ','))),
last AS (SELECT doc_id, arg_max(theme_id, rule_order) AS theme FROM hits GROUP BY doc_id)
SELECT d.doc_id, d.num_topic, coalesce(last.theme, df.theme_id) AS theme
FROM d LEFT JOIN last ON d.doc_id = last.doc_id
       LEFT JOIN (SELECT topic, theme_id FROM rules WHERE dflt = 'T') df ON d.num_topic = df.topic
"""


def _topic_corpus(spark, sf, keep=("tokens",)):
    """(documents with sparse counts and ``keep``, term index) of the phrase-merged tokens, each written once."""
    from ...session import cut_lineage
    docs = cut_lineage(_phrased_docs(spark, sf).select("doc_id", "tokens"), large=True)
    index = TP.term_index(TP.doc_freq_dictionary(docs, "tokens", "doc_id"))
    return TP.bag_of_words(docs, index, "tokens", "doc_id", keep=keep), index


def _lda(spark, sf, k: int = 20, keep=()):
    """(model, documents with sparse counts and ``keep``, term index)."""
    from ...schemas import LDA_SEED
    bow, index = _topic_corpus(spark, sf, keep)
    model, _ = TP.fit_lda(bow, k=k, seed=LDA_SEED, materialize=False)
    return model, bow, index


def _top_words(model, index, topn=20):
    return TP.topic_terms(model, index, topn).select("topic", "rank", "word")


def _labelled_docs(spark, sf):
    d = _table(spark, sf, "documents").select("doc_id", "text")
    lab = _table(spark, sf, "labels")
    from ...operators.scoring import MODEL_LABELS
    label = F.element_at(F.array(*[F.lit(x) for x in MODEL_LABELS]),
                         (F.col("quality") * 2 + F.col("toxic") + 1).cast("int"))
    return d.join(lab, "doc_id").select("doc_id", F.col("text").alias("content"), label.alias("label"))


_DOC_FEATURES = ["n_chars", "n_symbols", "n_tokens", "has_mention", "log_chars"]


def _doc_features(spark, sf):
    d = _docs(spark, sf, "doc_id", "text", "n_chars")
    from ...session import cut_lineage
    toks = TK.clean_tokens(d, "text", "tokens")
    # stored: a fit reads its rows twice and every prediction once more, the texts are tokenised once
    return cut_lineage(toks.select("doc_id", F.col("n_chars").cast("double").alias("n_chars"),
                       TX.symbol_count("text").cast("double").alias("n_symbols"),
                       F.size("tokens").cast("double").alias("n_tokens"),
                       (F.size(TX.mentions("text")) > 0).alias("has_mention"),
                       F.log10(F.col("n_chars") + 1).alias("log_chars")), large=True)


def _schema_of(spark, sf, name):
    return _table(spark, sf, name).schema


AS_OF = "2002-01-01 00:00:00"


def _bio_sql() -> str:
    from ...schemas import BIO_EXTRA_STOPWORDS
    stop = TK.default_stopwords() + BIO_EXTRA_STOPWORDS
    lst = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in stop) + "]"
    return f"""
SELECT doc_id, array_to_string(list_filter(string_split(lower(regexp_replace(coalesce(text, ''), '[^a-zA-Z0-9]+', ' ', 'g')), ' '),
         lambda t: length(t) > 2 AND NOT regexp_full_match(t, '[0-9]+') AND NOT list_contains({lst}, t)), ' ') AS bio_tokens
FROM documents
"""


def _fresh(spark, name):
    import uuid
    return scratch_path(spark, f"sinks/{name}/{uuid.uuid4().hex[:12]}")


_CODES = [c for c, _ in CONTINENT_OF]


def _landed(spark, sf):
    o = _table(spark, sf, "orders")
    posts = o.select(F.col("o_orderkey").alias("tweetId"), F.floor(F.col("o_orderkey") / 2).alias("conversationId"),
                     F.col("o_custkey").alias("userId"), F.col("o_orderdate").cast("timestamp").alias("date"),
                     F.when(F.col("o_orderkey") % 10 == 3, F.lit("fr")).otherwise(F.lit("en")).alias("lang"))
    c = _table(spark, sf, "customer")
    accounts = c.select(F.col("c_custkey").alias("userId"), F.col("c_name").alias("username"))
    codes = F.array(*[F.lit(x) for x in _CODES])
    media = c.filter(F.col("c_mktsegment") != "HOUSEHOLD").select(
        F.col("c_name").alias("username"),
        F.element_at(codes, (F.col("c_nationkey") % 12 + 1).cast("int")).alias("country"),
        F.col("c_mktsegment").alias("media_outlet"), F.lit("Television").alias("media_category"))
    pv = V.posts(spark, sf)
    k = F.col("post_id") % 50
    scores = pv.select(F.col("post_id").alias("tweetId"), *[
        F.when(k == 7, F.lit(-1.0)).when(k == 13, F.lit(None).cast("double")).otherwise(F.col(m)).alias(m)
        for m in ["anger", "joy", "optimism", "sadness"]])
    topics = pv.select(F.col("post_id").alias("tweetId"), "theme",
                       *[(F.col("subtheme") == c).alias(f"subtheme{c}") for c in SUBTHEME_CODES])
    li = _table(spark, sf, "lineitem")
    rid = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    replies = li.select(rid.alias("tweetId"), F.floor(F.col("l_orderkey") / 2).alias("conversationId"),
                        F.col("l_suppkey").alias("userId"), F.col("l_shipdate").cast("timestamp").alias("date"),
                        F.lit("en").alias("lang"))
    xs = [(F.col("tweetId") * m) % q + 1 for m, q in [(7, 97), (13, 89), (17, 83), (19, 79)]]
    cubes = [x.cast("double") * x * x for x in xs]
    tot = cubes[0] + cubes[1] + cubes[2] + cubes[3]
    rscores = replies.select("tweetId").distinct().select(
        "tweetId", *[(cb / tot).alias(m) for cb, m in zip(cubes, ["anger", "joy", "optimism", "sadness"])])
    # landed inputs are stored tables in the real pipeline: write the derived
    # ones to the shared checkpoint folder so the consolidation plans over
    # plain columns (as it would over the landed files)
    from ...session import cut_lineage
    scores, topics, rscores = (cut_lineage(x, large=True) for x in (scores, topics, rscores))
    return posts, accounts, media, scores, topics, replies, rscores


def _landed_sql() -> str:
    codes = "[" + ", ".join(f"'{c}'" for c in _CODES) + "]"
    flags = ", ".join(f"subtheme = {c} AS subtheme{c}" for c in SUBTHEME_CODES)
    case = "CASE " + " ".join(f"WHEN subtheme{c} THEN {c}" for c in SUBTHEME_CODES) + " ELSE theme * 10 END"
    cont = ", ".join(f"('{c}', '{n}')" for c, n in CONTINENT_OF)
    def cube(m, q):
        x = f"((tweetId * {m}) % {q} + 1)"
        return f"cast({x} AS double) * {x} * {x}"
    c1, c2, c3, c4 = cube(7, 97), cube(13, 89), cube(17, 83), cube(19, 79)
    tot = f"({c1} + {c2} + {c3} + {c4})"
    return V.VIEWS_SQL + f""",
np AS (SELECT o_orderkey AS tweetId, o_orderkey // 2 AS conversationId, o_custkey AS userId, o_orderdate AS date,
              CASE WHEN o_orderkey % 10 = 3 THEN 'fr' ELSE 'en' END AS lang FROM orders),
media AS (SELECT c_name AS username, {codes}[c_nationkey % 12 + 1] AS country FROM customer
          WHERE c_mktsegment <> 'HOUSEHOLD'),
acc AS (SELECT c_custkey AS userId, media.country FROM customer JOIN media ON c_name = media.username),
ps AS (SELECT post_id AS tweetId,
              CASE WHEN post_id % 50 = 7 THEN -1.0 WHEN post_id % 50 = 13 THEN NULL ELSE anger END AS anger,
              CASE WHEN post_id % 50 = 7 THEN -1.0 WHEN post_id % 50 = 13 THEN NULL ELSE joy END AS joy,
              CASE WHEN post_id % 50 = 7 THEN -1.0 WHEN post_id % 50 = 13 THEN NULL ELSE optimism END AS optimism,
              CASE WHEN post_id % 50 = 7 THEN -1.0 WHEN post_id % 50 = 13 THEN NULL ELSE sadness END AS sadness
       FROM posts),
tp AS (SELECT post_id AS tweetId, theme, {flags} FROM posts),
n1 AS (SELECT np.*, acc.country, ps.anger, ps.joy, ps.optimism, ps.sadness
       FROM np JOIN acc ON np.userId = acc.userId JOIN ps ON np.tweetId = ps.tweetId
       WHERE np.lang = 'en' AND np.conversationId IS NOT NULL),
n2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conversationId ORDER BY date, tweetId) AS rn FROM n1)
       WHERE rn = 1),
news AS (SELECT n2.*, {_argmax_plain()} AS prevalent_emotion, greatest(anger, joy, optimism, sadness) AS emotion_score,
                tp.theme, cast({case} AS int) AS subtheme
         FROM n2 JOIN tp ON n2.tweetId = tp.tweetId WHERE n2.anger IS NOT NULL AND n2.anger <> -1.0),
rp AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS tweetId, l_orderkey // 2 AS conversationId,
              l_shipdate AS date FROM lineitem),
rs AS (SELECT DISTINCT tweetId, {c1} / {tot} AS anger, {c2} / {tot} AS joy, {c3} / {tot} AS optimism,
              {c4} / {tot} AS sadness FROM (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS tweetId FROM lineitem)),
r1 AS (SELECT * FROM (SELECT rp.*, rs.anger, rs.joy, rs.optimism, rs.sadness,
                             row_number() OVER (PARTITION BY rp.tweetId ORDER BY rp.date, rp.conversationId) AS rn
                      FROM rp JOIN rs ON rp.tweetId = rs.tweetId) WHERE rn = 1),
cont AS (SELECT * FROM (VALUES {cont}) AS c(country, continent))
SELECT r1.tweetId, r1.conversationId, news.userId AS news_id, news.country, cont.continent, news.theme,
       news.subtheme, news.prevalent_emotion AS news_prevalent_emotion,
       {_argmax_plain('r1.')} AS prevalent_emotion,
       round(r1.anger, 6) AS anger, round(r1.joy, 6) AS joy, round(r1.optimism, 6) AS optimism,
       round(r1.sadness, 6) AS sadness, cast(news.date AS date) AS ds,
       {V._dsw('cast(news.date as date)')} AS dsw, cast(date_trunc('month', news.date) AS date) AS dsm
FROM r1 JOIN news ON r1.conversationId = news.conversationId JOIN cont ON news.country = cont.country
"""


def _argmax_plain(p: str = "") -> str:
    a, j, o, s = (p + "anger", p + "joy", p + "optimism", p + "sadness")
    m = f"greatest({a},{j},{o},{s})"
    return (f"CASE WHEN {m} > 0.5 THEN (CASE WHEN {a}={m} THEN 'anger' WHEN {j}={m} THEN 'joy' "
            f"WHEN {o}={m} THEN 'optimism' ELSE 'sadness' END) ELSE 'undefined' END")


def _phrase_ctes(src: str, p: str, min_count: int = 5, threshold: float = 10.0) -> str:
    """CTEs learning the phrase pairs ``{p}ph(word_a, word_b)`` from ``src(doc_id, tok)``."""
    return f"""
{p}u AS (SELECT w, count(*) AS cnt FROM (SELECT unnest(tok) AS w FROM {src} WHERE len(tok) > 0) GROUP BY w),
{p}p AS (SELECT tok[i] AS word_a, tok[i + 1] AS word_b
         FROM (SELECT tok, unnest(generate_series(1, len(tok) - 1)) AS i FROM {src} WHERE len(tok) > 1) x),
{p}pc AS (SELECT word_a, word_b, count(*) AS pair_count FROM {p}p GROUP BY 1, 2),
{p}v AS (SELECT (SELECT count(*) FROM {p}u) + (SELECT count(*) FROM {p}pc) AS len_vocab),
{p}ph AS (SELECT pc.word_a, pc.word_b
          FROM {p}pc pc JOIN {p}u ua ON pc.word_a = ua.w JOIN {p}u ub ON pc.word_b = ub.w CROSS JOIN {p}v
          WHERE pair_count > {min_count}
            AND (pair_count - {min_count}) / ua.cnt / ub.cnt * len_vocab > {threshold})"""


def _merge_ctes(src: str, ph: str, out: str) -> str:
    """CTEs merging phrase pairs left to right: ``out(doc_id, tok)``.

    A hit at i merges unless position i-1 merged; inside a run of consecutive
    hits that means every second hit from the run's start (gaps and islands).
    """
    q = out + "_"
    return f"""
{q}u AS (SELECT doc_id, i, tok[i] AS w, CASE WHEN i < len(tok) THEN tok[i + 1] END AS nx
         FROM (SELECT doc_id, tok, unnest(generate_series(1, len(tok))) AS i FROM {src} WHERE len(tok) > 0) x),
{q}h AS (SELECT u.*, ph.word_a IS NOT NULL AS hit FROM {q}u u LEFT JOIN {ph} ph ON u.w = ph.word_a AND u.nx = ph.word_b),
{q}g AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, hit ORDER BY i) AS grp FROM {q}h),
{q}r AS (SELECT *, CASE WHEN hit THEN (i - min(i) OVER (PARTITION BY doc_id, hit, grp)) % 2 = 0 ELSE false END AS merged
         FROM {q}g),
{q}c AS (SELECT *, coalesce(lag(merged) OVER (PARTITION BY doc_id ORDER BY i), false) AS consumed FROM {q}r),
{q}o AS (SELECT doc_id, list(CASE WHEN merged THEN w || '_' || nx ELSE w END ORDER BY i) FILTER (WHERE NOT consumed) AS tok
         FROM {q}c GROUP BY doc_id),
{out} AS (SELECT s.doc_id, coalesce(o.tok, []) AS tok FROM {src} s LEFT JOIN {q}o o ON s.doc_id = o.doc_id)"""


def _phrase_merge_sql() -> str:
    return f"""
WITH d0 AS (SELECT doc_id, {TK.clean_tokens_sql('text')} AS tok FROM documents WHERE lang = 'en'),
{_phrase_ctes('d0', 'a_').strip()},
{_merge_ctes('d0', 'a_ph', 'd1').strip()},
{_phrase_ctes('d1', 'b_').strip()},
{_merge_ctes('d1', 'b_ph', 'd2').strip()}
SELECT doc_id, len(tok) AS n_tokens, array_to_string(tok, ' ') AS tokens FROM d2
"""


def _bio_list_sql(text: str) -> str:
    """The bio-token list of ``text`` in SQL (same rules as ``tokens.bio_tokens``)."""
    from ...schemas import BIO_EXTRA_STOPWORDS
    stop = TK.default_stopwords() + BIO_EXTRA_STOPWORDS
    lst = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in stop) + "]"
    return (f"list_filter(string_split(lower(regexp_replace(coalesce({text}, ''), '[^a-zA-Z0-9]+', ' ', 'g')), ' '), "
            f"lambda t: length(t) > 2 AND NOT regexp_full_match(t, '[0-9]+') AND NOT list_contains({lst}, t))")


def _bigrams_appended_sql() -> str:
    return f"""
WITH d0 AS (SELECT doc_id, {_bio_list_sql('text')} AS tok FROM documents),
{_phrase_ctes('d0', 'a_', min_count=3).strip()},
{_merge_ctes('d0', 'a_ph', 'd1').strip()}
SELECT d0.doc_id, array_to_string(list_concat(d0.tok, list_filter(d1.tok, lambda t: contains(t, '_'))), ' ') AS tokens
FROM d0 JOIN d1 ON d0.doc_id = d1.doc_id
"""


def _source_coherence_sql(window: int = 110) -> str:
    """C_v from the sliding windows themselves: one row per window and word in it."""
    return f"""
WITH d AS (SELECT doc_id, source, {TK.clean_tokens_sql('text')} AS tok FROM documents WHERE lang = 'en'),
n_docs AS (SELECT count(*) AS n_docs FROM d),
u AS (SELECT DISTINCT doc_id, source, unnest(tok) AS w FROM d),
dic AS (SELECT w FROM u, n_docs GROUP BY w, n_docs HAVING count(*) >= 0.0005 * n_docs AND count(*) <= 0.33 * n_docs),
top AS (SELECT source AS topic, w FROM (SELECT source, w, count(*) AS n FROM u JOIN dic USING (w) WHERE source IS NOT NULL GROUP BY 1, 2)
        QUALIFY row_number() OVER (PARTITION BY source ORDER BY n DESC, w) <= 8),
p AS (SELECT doc_id, len(tok) AS l, unnest(tok) AS w, unnest(range(len(tok))) AS p FROM d),
win AS (SELECT DISTINCT doc_id, w, unnest(CASE WHEN l < {window} THEN [0] ELSE range(greatest(0, p - {window - 1}), least(p, l - {window}) + 1) END) AS s
        FROM p WHERE w IN (SELECT w FROM top)),
nw AS (SELECT sum(greatest(1, len(tok) - {window - 1}))::DOUBLE AS n FROM d),
c1 AS (SELECT w, count(*)::DOUBLE AS c FROM win GROUP BY w),
pr AS (SELECT DISTINCT a.w AS wi, b.w AS wj FROM top a JOIN top b USING (topic)),
c2 AS (SELECT x.w AS wi, y.w AS wj, count(*)::DOUBLE AS c FROM win x JOIN win y USING (doc_id, s) JOIN pr ON pr.wi = x.w AND pr.wj = y.w GROUP BY 1, 2),
m AS (SELECT a.topic, a.w AS wi, b.w AS wj,
             ln((coalesce(c2.c, 0) / n + 1e-12) / ((ci.c / n) * (cj.c / n))) / -ln(coalesce(c2.c, 0) / n + 1e-12) AS npmi
      FROM top a JOIN top b USING (topic) CROSS JOIN nw JOIN c1 ci ON ci.w = a.w JOIN c1 cj ON cj.w = b.w
           LEFT JOIN c2 ON c2.wi = a.w AND c2.wj = b.w),
v AS (SELECT topic, wj, sum(npmi) AS vs FROM m GROUP BY 1, 2),
cs AS (SELECT topic, wi, sum(npmi * vs) / (sqrt(sum(npmi * npmi)) * sqrt(sum(vs * vs))) AS sim FROM m JOIN v USING (topic, wj) GROUP BY 1, 2)
SELECT topic AS source, round(avg(sim), 6) AS c_v FROM cs GROUP BY topic
"""
