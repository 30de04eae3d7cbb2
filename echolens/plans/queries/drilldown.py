"""Drill-down concentration, polarity, weekly series, stored-post search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...sources.tables import table as _table
from ...operators import search as SR
from ...schemas import EMOTIONS
from .. import reports as R, views as V
from ._common import (
    nation_coordinates, register, round_doubles, SEGMENT, TEST_LESS_FREQUENT, TEST_MAIN_KEYWORDS
)


@register("concentration_top25", V.VIEWS_SQL + """,
c AS (SELECT conversation_id, count(*) AS cnt FROM replies
      WHERE continent = 'AFRICA' AND prevalent_emotion = 'anger' AND conversation_id IS NOT NULL
      GROUP BY conversation_id),
t AS (SELECT sum(cnt) AS tot FROM c),
top AS (SELECT * FROM c ORDER BY cnt DESC, conversation_id LIMIT 25)
SELECT conversation_id, cnt, round(cnt / tot, 6) AS share,
       round(sum(cnt / tot) OVER (ORDER BY cnt DESC, conversation_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS cum_share,
       row_number() OVER (ORDER BY cnt DESC, conversation_id) AS position
FROM top CROSS JOIN t
""")
def q_concentration_top25(spark, sf):
    """Top 25 posts by share of a segment's anger replies, with running share."""
    out = R.concentration(V.replies(spark, sf), SEGMENT, "conversation_id", 25)
    return round_doubles(out.withColumn("position", F.col("position").cast("bigint")))


@register("country_polarity", V.VIEWS_SQL + """,
a AS (SELECT country, avg(joy + optimism) AS positive, avg(anger + sadness) AS negative,
             count(reply_id) AS n FROM replies WHERE country IS NOT NULL GROUP BY country),
co AS (SELECT n_name AS country, cast((n_nationkey * 7) % 160 - 80 AS double) AS lat,
              cast((n_nationkey * 37) % 360 - 180 AS double) AS lng FROM nation)
SELECT a.country, round(positive, 6) AS positive, round(negative, 6) AS negative, n,
       round(positive - negative, 6) AS mean_emotion, round(n / 1000, 6) AS n_thousands, lat, lng
FROM a JOIN co ON a.country = co.country
""")
def q_country_polarity(spark, sf):
    """Mean positive/negative polarity per country with coordinates."""
    return round_doubles(R.country_polarity(V.replies(spark, sf), nation_coordinates(spark, sf),
                                            id_col="reply_id"))


@register("weekly_reply_means", V.VIEWS_SQL + f"""
SELECT dsw, {", ".join(f"round(avg({m}), 6) AS {m}" for m in EMOTIONS)}
FROM replies WHERE dsw IS NOT NULL GROUP BY dsw
""")
def q_weekly_reply_means(spark, sf):
    """Weekly (Sunday-ending) mean reply emotions."""
    return round_doubles(R.weekly_means(V.replies(spark, sf)))


@register("weekly_event_means", f"""
WITH e AS (SELECT {V._dsw('cast(ts as date)')} AS dsw, value,
                  cast(json_extract_string(props, '$.k') AS double) AS k FROM events)
SELECT dsw, round(avg(value), 6) AS value, round(avg(k), 6) AS k, count(*) AS n
FROM e WHERE dsw IS NOT NULL GROUP BY dsw
""")
def q_weekly_event_means(spark, sf):
    """Weekly means of event values and a JSON field (R02 on events)."""
    from ...functions.calendar import week_ending_sunday
    ev = _table(spark, sf, "events").select(
        week_ending_sunday("ts").alias("dsw"), "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"))
    means = [F.avg(c).alias(c) for c in ("value", "k")]
    return round_doubles(ev.filter(F.col("dsw").isNotNull()).groupBy("dsw").agg(*means, F.count(F.lit(1)).alias("n")))


@register("weekly_keyword_counts", V.VIEWS_SQL + f""",
pc AS (SELECT p.dsw, d.text AS content FROM posts p JOIN documents d ON p.post_id = d.doc_id),
f AS (SELECT dsw, {", ".join(f"cast(instr(lower(content), '{k}') > 0 AS BIGINT) AS \"{k}\"" for k in dict.fromkeys(TEST_MAIN_KEYWORDS + TEST_LESS_FREQUENT))} FROM pc),
s AS (SELECT dsw, {", ".join(f"sum(\"{k}\")::BIGINT AS \"{k}\"" for k in dict.fromkeys(TEST_MAIN_KEYWORDS + TEST_LESS_FREQUENT))}
      FROM f WHERE dsw IS NOT NULL GROUP BY dsw)
SELECT dsw, {", ".join(f'"{k}"' for k in TEST_MAIN_KEYWORDS)}, {" + ".join(f'"{k}"' for k in TEST_LESS_FREQUENT)} AS other FROM s
""")
def q_weekly_keyword_counts(spark, sf):
    """Weekly keyword volumes with an 'other' fold."""
    return R.weekly_keyword_volumes(V.posts_with_content(spark, sf), "content", "dsw",
                                    TEST_MAIN_KEYWORDS + TEST_LESS_FREQUENT, TEST_MAIN_KEYWORDS,
                                    TEST_LESS_FREQUENT)


@register("search_posts", V.VIEWS_SQL + """
SELECT p.post_id, d.source AS author, p.date
FROM posts p JOIN documents d ON p.post_id = d.doc_id
WHERE (instr(lower(d.text), 'the') > 0 OR instr(lower(d.text), 'que') > 0)
  AND d.source = 'src3' AND p.date >= TIMESTAMP '1996-01-01' AND p.date < TIMESTAMP '2000-01-01'
  AND d.lang IN ('en', 'es')
""")
def q_search_posts(spark, sf):
    """Stored-post search: any keyword AND author AND since <= date < until AND language."""
    p = V.posts_with_content(spark, sf).filter(F.col("lang").isin("en", "es"))
    out = SR.search_posts(p, keywords=["the", "que"], author="src3", since="1996-01-01",
                          until="2000-01-01", author_col="author")
    return out.select("post_id", "author", "date")
