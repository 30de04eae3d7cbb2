"""Text functions, page titles, top-n and the city union."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...sources.tables import table as _table
from ...functions import text as TX
from ...operators import tokens as TK
from .. import reports as R
from ._common import (
    _bio_sql, _city_rows, _docs, _title_sql, register, TEST_LESS_FREQUENT, TEST_MAIN_KEYWORDS
)


@register("masked_text", """
SELECT doc_id, array_to_string(list_transform(string_split(text, ' '), lambda t:
         CASE WHEN starts_with(t, '@') AND length(t) > 1 THEN '@user'
              WHEN starts_with(t, 'http') THEN 'http' ELSE t END), ' ') AS masked
FROM documents
""")
def q_masked_text(spark, sf):
    """Handles and links masked as the scorer expects."""
    d = _docs(spark, sf, "doc_id", "text")
    return d.select("doc_id", TX.mask_handles_and_links("text").alias("masked"))


@register("symbol_guard", f"""
SELECT doc_id, len(regexp_extract_all(text, '{TX.SYMBOL_PATTERN}')) AS n_symbols,
       len(regexp_extract_all(text, '{TX.SYMBOL_PATTERN}')) > 150 AS over_limit
FROM documents
""")
def q_symbol_guard(spark, sf):
    """Symbol count and the >150 guard (P25)."""
    d = _docs(spark, sf, "doc_id", "text")
    n = TX.symbol_count("text")
    return d.select("doc_id", n.cast("bigint").alias("n_symbols"), (n > 150).alias("over_limit"))


@register("keyword_flags", f"""
SELECT doc_id, {", ".join(f"cast(instr(lower(text), '{k}') > 0 AS int) AS \"{TX.keyword_col_name(k)}\"" for k in dict.fromkeys(TEST_MAIN_KEYWORDS + TEST_LESS_FREQUENT))},
       ({" OR ".join(f"instr(lower(text), '{k}') > 0" for k in dict.fromkeys(TEST_MAIN_KEYWORDS + TEST_LESS_FREQUENT))}) AS any_keyword
FROM documents
""")
def q_keyword_flags(spark, sf):
    """One substring flag per keyword plus any-keyword."""
    kws = list(dict.fromkeys(TEST_MAIN_KEYWORDS + TEST_LESS_FREQUENT))
    d = _docs(spark, sf, "doc_id", "text")
    return TX.keyword_flags(d, "text", kws).withColumn("any_keyword", TX.any_keyword("text", kws)).drop("text")


@register("link_posts", """
WITH u AS (SELECT 'doc' AS kind, doc_id AS id, text AS content FROM documents
           UNION ALL SELECT 'page' AS kind, page_id AS id, url AS content FROM pages)
SELECT kind, id, len(string_split(content, ' ')) = 1 AND starts_with(content, 'http') AS link_only FROM u
""")
def q_link_posts(spark, sf):
    """Link-only post test over documents and page urls."""
    d = _table(spark, sf, "documents").select(F.lit("doc").alias("kind"), F.col("doc_id").alias("id"),
                                             F.col("text").alias("content"))
    p = _table(spark, sf, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"),
                                         F.col("url").alias("content"))
    return d.unionByName(p).select("kind", "id", TX.is_link_only("content").alias("link_only"))


@register("page_titles", f"""
SELECT page_id, {_title_sql('html')} AS title FROM pages
""")
def q_page_titles(spark, sf):
    """Page title extraction with entity decoding."""
    return _table(spark, sf, "pages").select("page_id", TX.html_title("html").alias("title"))


@register("headline_enrichment", f"""
WITH posts AS (SELECT page_id AS post_id, url AS content FROM pages),
heads AS (SELECT url, {_title_sql('html')} AS full_title FROM pages),
links AS (SELECT * FROM posts WHERE len(string_split(content, ' ')) = 1 AND starts_with(content, 'http')),
j AS (SELECT links.post_id, heads.full_title AS content FROM links JOIN heads ON links.content = heads.url)
SELECT post_id, content FROM j WHERE content IS NOT NULL
  AND ({" OR ".join(f"instr(lower(content), '{k}') > 0" for k in TEST_MAIN_KEYWORDS)})
""")
def q_headline_enrichment(spark, sf):
    """Link-only posts replaced by their page headline, keyword filter."""
    pg = _table(spark, sf, "pages")
    posts = pg.select(F.col("page_id").alias("post_id"), F.col("url").alias("content"))
    heads = pg.select("url", TX.html_title("html").alias("full_title"))
    return R.headline_enrichment(posts, heads, keywords=TEST_MAIN_KEYWORDS).select("post_id", "content")


@register("top_n_per_group", """
WITH c AS (SELECT c_custkey, c_name, n_name, c_acctbal,
                  row_number() OVER (PARTITION BY n_name ORDER BY c_acctbal DESC, c_custkey) AS rn
           FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT n_name, c_custkey, c_name, c_acctbal, rn FROM c WHERE rn <= 3
""")
def q_top_n_per_group(spark, sf):
    """Top 3 customers per nation by balance, skew-safe."""
    from ...operators.ranking import top_n_per_group
    c = _table(spark, sf, "customer").join(_table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    out = top_n_per_group(c, "n_name", [F.col("c_acctbal").desc(), F.col("c_custkey")], 3, rank_col="rn")
    return out.select("n_name", "c_custkey", "c_name", "c_acctbal", F.col("rn").cast("bigint").alias("rn"))


@register("city_style_union", """
WITH raw AS (SELECT cast(c_custkey AS int) AS Rank,
                    c_name || CASE WHEN c_custkey % 2 = 0 THEN ' city' ELSE '' END AS City,
                    trim(' ' || n_name || ' ') AS State,
                    cast(floor(abs(c_acctbal) * 100) AS BIGINT) AS Population
             FROM customer JOIN nation ON c_nationkey = n_nationkey),
top3 AS (SELECT Rank, City, State, Population FROM
           (SELECT *, row_number() OVER (PARTITION BY State ORDER BY Rank) AS rn FROM raw) WHERE rn <= 3),
u AS (SELECT Rank, City, State, Population FROM raw WHERE Population > 800000
      UNION SELECT * FROM top3)
SELECT Rank, City, State, Population, replace(City, ' city', '') || ', ' || State AS loctag
FROM u WHERE Population > 50000
""")
def q_city_style_union(spark, sf):
    """Top 3 per state union large cities, filter, label."""
    return R.city_selection(_city_rows(spark, sf), big=800000, min_pop=50000, per_state=3)


@register("softmax_scores", """
WITH l AS (SELECT l_orderkey*10 + l_linenumber AS reply_id, l_linenumber,
                  [l_quantity / 10, l_discount * 20, l_tax * 25, l_extendedprice / 20000] AS logits FROM lineitem),
m AS (SELECT *, list_max(logits) AS mx FROM l),
e AS (SELECT reply_id, l_linenumber, list_transform(logits, lambda x: exp(x - mx)) AS ex FROM m)
SELECT reply_id, l_linenumber,
       round_even(ex[1] / list_sum(ex), 3) AS anger, round_even(ex[2] / list_sum(ex), 3) AS joy,
       round_even(ex[3] / list_sum(ex), 3) AS optimism, round_even(ex[4] / list_sum(ex), 3) AS sadness
FROM e
""")
def q_softmax_scores(spark, sf):
    """Softmax of four logits, half-even to 3 places."""
    from ...functions.emotions import softmax_rounded
    li = _table(spark, sf, "lineitem")
    logits = F.array(F.col("l_quantity") / 10, F.col("l_discount") * 20, F.col("l_tax") * 25,
                     F.col("l_extendedprice") / 20000)
    p = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("reply_id"), "l_linenumber",
                  softmax_rounded(logits).alias("p"))
    return p.select("reply_id", "l_linenumber", *[F.col("p")[i].alias(n) for i, n in
                                                  enumerate(["anger", "joy", "optimism", "sadness"])])


@register("bio_tokens", _bio_sql())
def q_bio_tokens(spark, sf):
    """Account-bio token cleaning."""
    d = _docs(spark, sf, "doc_id", "text")
    return TK.bio_tokens(d, "text", "bio_tokens").select("doc_id", F.array_join("bio_tokens", " ").alias("bio_tokens"))
