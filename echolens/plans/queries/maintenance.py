"""Dedupe, merges, work queue, sets, chunks, sorting, summaries and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...sources.tables import table as _table
from ...operators import dedupe as D, search as SR
from ...sources import sinks as SK
from .. import views as V
from ._common import _FIRST_SQL, _fresh, _reply_rows, PENDING_BUCKET_WIDTH, register, round_doubles


@register("first_per_key", _FIRST_SQL)
def q_first_per_key(spark, sf):
    """Earliest reply per reply id by a window, deterministic ties."""
    return D.first_per_key(_reply_rows(spark, sf), "reply_id", [
        F.col(c).asc_nulls_last() for c in ("date", "l_partkey", "l_suppkey", "l_quantity")])


@register("first_per_key_agg", _FIRST_SQL)
def q_first_per_key_agg(spark, sf):
    """Earliest reply per reply id via the combinable min_by aggregate."""
    return D.first_per_key_agg(_reply_rows(spark, sf), "reply_id",
                               ["date", "l_partkey", "l_suppkey", "l_quantity"])


@register("upsert_first_wins", """
WITH ex AS (SELECT event_id, ts, user_id, event_type, value FROM events WHERE ts < TIMESTAMP '2024-01-20'),
inc AS (SELECT event_id, ts, user_id, event_type, value + 1000 AS value FROM events
        WHERE ts >= TIMESTAMP '2024-01-10'
        UNION ALL
        SELECT event_id, ts, user_id, event_type, value + 2000 AS value FROM events
        WHERE ts >= TIMESTAMP '2024-01-25'),
fresh AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY value) AS rn FROM inc
          WHERE event_id NOT IN (SELECT event_id FROM ex))
SELECT event_id, ts, user_id, event_type, round(value, 6) AS value FROM ex
UNION ALL
SELECT event_id, ts, user_id, event_type, round(value, 6) AS value FROM fresh WHERE rn = 1
""")
def q_upsert_first_wins(spark, sf):
    """Incremental merge where a stored row wins."""
    ev = _table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    ex = ev.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    inc = (ev.filter(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz"))
             .withColumn("value", F.col("value") + 1000)
             .unionByName(ev.filter(F.col("ts") >= F.lit("2024-01-25").cast("timestamp_ntz"))
                            .withColumn("value", F.col("value") + 2000)))
    return round_doubles(D.upsert_first_wins(ex, inc, "event_id", order_by=["value"]))


@register("pending_batches", f"""
WITH posts AS (SELECT conv_id FROM conversations WHERE turn = 0),
rc AS (SELECT conv_id, count(*) AS reply_count FROM conversations WHERE turn > 0 GROUP BY conv_id),
collected AS (SELECT DISTINCT conv_id FROM conversations WHERE turn > 0 AND role = 'user'),
todo AS (SELECT DISTINCT p.conv_id, p.conv_id // {PENDING_BUCKET_WIDTH} AS bucket FROM posts p JOIN rc ON p.conv_id = rc.conv_id
         WHERE rc.reply_count > 0 AND p.conv_id NOT IN (SELECT conv_id FROM collected)),
nb AS (SELECT *, floor((row_number() OVER (PARTITION BY bucket ORDER BY conv_id) - 1) / 12)::BIGINT AS batch
       FROM todo)
SELECT bucket, batch, count(*) AS n_ids,
       'conversation_id:' || string_agg(cast(conv_id AS varchar), ' OR ' ORDER BY conv_id) AS query
FROM nb GROUP BY bucket, batch
""")
def q_pending_batches(spark, sf):
    """Work queue: uncollected threads with replies, batches of 12 and search strings."""
    conv = _table(spark, sf, "conversations")
    rc = conv.filter(F.col("turn") > 0).groupBy("conv_id").agg(F.count(F.lit(1)).alias("replyCount"))
    posts = conv.filter(F.col("turn") == 0).select("conv_id").join(rc, "conv_id")
    collected = conv.filter((F.col("turn") > 0) & (F.col("role") == "user")).select("conv_id")
    return SR.pending_batches(posts, collected, "conv_id", "replyCount", 12,
                              F.floor(F.col("conv_id") / PENDING_BUCKET_WIDTH))


@register("pending_batches_per_account", """
WITH todo AS (SELECT DISTINCT o_custkey, o_orderkey FROM orders
              WHERE o_orderstatus <> 'F' AND o_orderkey IN (SELECT l_orderkey FROM lineitem)),
nb AS (SELECT *, floor((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) / 12)::BIGINT AS batch FROM todo)
SELECT o_custkey AS account_id, batch, count(*) AS n_ids,
       'conversation_id:' || string_agg(cast(o_orderkey AS varchar), ' OR ' ORDER BY o_orderkey) AS query
FROM nb GROUP BY o_custkey, batch
""")
def q_pending_batches_per_account(spark, sf):
    """Work queue per account: its uncollected posts with replies, batches of 12 and search strings."""
    from ...functions.text import id_query
    from ...operators.ranking import fixed_size_batches
    o = _table(spark, sf, "orders")
    replied = _table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    todo = o.filter(F.col("o_orderstatus") != "F").select("o_custkey", "o_orderkey").distinct().join(
        replied, "o_orderkey", "left_semi")
    numbered = fixed_size_batches(todo, "o_orderkey", 12, "o_custkey")
    return numbered.groupBy(F.col("o_custkey").alias("account_id"), "batch").agg(
        F.count(F.lit(1)).alias("n_ids"), id_query(F.collect_list("o_orderkey"), "conversation_id:").alias("query"))


@register("reply_to_post_join", """
WITH p AS (SELECT conv_id, role AS news_role, length(text) AS news_chars FROM conversations WHERE turn = 0),
r AS (SELECT conv_id, turn, role, length(text) AS chars FROM conversations WHERE turn > 0)
SELECT r.conv_id, r.turn, r.role, r.chars, p.news_role, p.news_chars FROM r JOIN p ON r.conv_id = p.conv_id
""")
def q_reply_to_post_join(spark, sf):
    """Replies joined to their post with renamed post columns."""
    conv = _table(spark, sf, "conversations")
    p = conv.filter(F.col("turn") == 0).select(
        "conv_id", F.col("role").alias("news_role"), F.length("text").cast("bigint").alias("news_chars"))
    r = conv.filter(F.col("turn") > 0).select("conv_id", "turn", "role", F.length("text").cast("bigint").alias("chars"))
    return r.join(p, "conv_id")


@register("summary_stats", """
SELECT min(o_orderdate) AS first_date, max(o_orderdate) AS last_date,
       sum(cast(round(o_totalprice * 100) AS BIGINT))::BIGINT AS total_cents, round(avg(o_totalprice), 6) AS mean_price,
       round(max(o_totalprice), 6) AS max_price,
       count(*) AS n_rows, count(DISTINCT o_custkey) AS n_accounts,
       count_if(o_orderpriority IS NULL)::BIGINT AS null_priority
FROM orders
""")
def q_summary_stats(spark, sf):
    """Min/max/sum/mean and distinct/null/row counts."""
    o = _table(spark, sf, "orders")
    return round_doubles(o.agg(
        F.min("o_orderdate").alias("first_date"), F.max("o_orderdate").alias("last_date"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("total_cents"),
        F.avg("o_totalprice").alias("mean_price"), F.max("o_totalprice").alias("max_price"),
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("o_custkey").alias("n_accounts"),
        F.count_if(F.col("o_orderpriority").isNull()).alias("null_priority")))


@register("posts_without_replies", """
SELECT o_orderkey AS post_id, o_custkey AS account_id FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
""")
def q_posts_without_replies(spark, sf):
    """Posts with no reply (anti join, F05, U03)."""
    o = _table(spark, sf, "orders").select(F.col("o_orderkey").alias("post_id"),
                                          F.col("o_custkey").alias("account_id"))
    li = _table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("post_id"))
    return D.difference(o, li, "post_id")


@register("near_equal_chunks", """
SELECT c_nationkey, c_custkey, ntile(4) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS chunk
FROM customer
""")
def q_near_equal_chunks(spark, sf):
    """Near-equal chunks per group by ascending id, SQL ntile numbering."""
    from ...operators.ranking import near_equal_chunks
    c = _table(spark, sf, "customer").select("c_nationkey", "c_custkey")
    return near_equal_chunks(c, "c_custkey", 4, "c_nationkey").withColumn("chunk", F.col("chunk").cast("bigint"))


@register("head_and_tail", """
(SELECT 'head' AS side, o_orderkey, round(o_totalprice, 6) AS o_totalprice FROM orders
 ORDER BY o_totalprice DESC, o_orderkey LIMIT 10)
UNION ALL
(SELECT 'tail' AS side, o_orderkey, round(o_totalprice, 6) AS o_totalprice FROM orders
 ORDER BY o_totalprice ASC, o_orderkey LIMIT 10)
""")
def q_head_and_tail(spark, sf):
    """Ten highest and ten lowest posts by engagement."""
    from ...operators.ranking import top_n
    o = _table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    h = top_n(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10).select(F.lit("head").alias("side"), "*")
    t = top_n(o, [F.col("o_totalprice").asc(), F.col("o_orderkey")], 10).select(F.lit("tail").alias("side"), "*")
    return round_doubles(h.unionByName(t))


@register("repeatable_sample", V.VIEWS_SQL + """
SELECT post_id, account_id, country FROM posts
ORDER BY md5('99:' || cast(post_id AS varchar)), post_id LIMIT 25
""")
def q_repeatable_sample(spark, sf):
    """25 posts by a seeded hash of the id, same at any partitioning."""
    from ...operators.ranking import repeatable_sample
    return repeatable_sample(V.posts(spark, sf).select("post_id", "account_id", "country"), "post_id", 25, 99)


@register("monthly_export", V.VIEWS_SQL + """
SELECT post_id, account_id, date, country, round(engagement, 6) AS engagement,
       round(anger, 6) AS anger, round(sadness, 6) AS sadness, round(optimism, 6) AS optimism, round(joy, 6) AS joy,
       strftime(date, '%Y-%m') AS month_year
FROM posts
""")
def q_monthly_export(spark, sf):
    """Text-free export partitioned by month, read back."""
    cols = ["post_id", "account_id", "date", "country", "engagement", "anger", "sadness", "optimism", "joy"]
    p = V.posts(spark, sf)
    path = _fresh(spark, "export")
    SK.export_monthly(p, path, "date", cols)
    schema = round_doubles(p.select(*cols)).schema
    from pyspark.sql import types as T
    back = (spark.read.schema(T.StructType(schema.fields + [T.StructField("month_year", T.StringType())]))
            .option("header", True).csv(path))
    return round_doubles(back)


@register("incremental_append", """
SELECT event_id, ts, user_id, event_type, round(value, 6) AS value FROM events
""")
def q_incremental_append(spark, sf):
    """Schema-enforced gzip appends in chunks, read back."""
    from pyspark.sql import types as T
    ev = _table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                           T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
                           T.StructField("value", T.DoubleType())])
    path = _fresh(spark, "append")
    bounds = ["2024-01-10", "2024-01-20"]
    ts = F.col("ts")
    chunks = [ev.filter(ts < F.lit(bounds[0]).cast("timestamp_ntz")),
              ev.filter((ts >= F.lit(bounds[0]).cast("timestamp_ntz")) & (ts < F.lit(bounds[1]).cast("timestamp_ntz"))),
              ev.filter(ts >= F.lit(bounds[1]).cast("timestamp_ntz")),
              ev.filter(ts.isNull())]
    for c in chunks:
        SK.append_parquet(c, path, schema)
    return round_doubles(spark.read.schema(schema).parquet(path))
