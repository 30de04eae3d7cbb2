"""Landed nested results, discovery, sinks read back, stored models."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...functions import text as TX
from ...operators import ranking as RK, search as SR
from ...schemas import EMOTIONS, POST_SCHEMA, RAW_POST_SCHEMA
from ...sources import sinks, tables
from ...sources.models import load_model, save_model
from ...sources.tables import table as _table
from .. import consolidate as CN, reports as R, views as V
from ._common import _DOC_FEATURES, _doc_features, _fresh, _plain_sql, _title_sql, register, round_doubles

def _raw_posts(spark, sf):
    """Search results as landed: orders as posts, customers as their nested users; null users, null and half-empty
    coordinates, null, empty and partly null mention lists, and every 13th result twice."""
    k, cust = F.col("o_orderkey"), F.col("c_custkey")
    o, c = _table(spark, sf, "orders"), _table(spark, sf, "customer")
    n = _table(spark, sf, "nation").select("n_nationkey", "n_name")
    j = o.join(c, F.col("o_custkey") == cust, "left").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    price = F.floor("o_totalprice")
    user = F.struct(
        F.concat(F.lit("user"), cust).alias("username"), F.col("c_name").alias("displayname"),
        F.when(cust % 3 == 0, "World news desk").when(cust % 3 == 1, "News and more").otherwise(F.col("c_mktsegment")).alias("description"),
        (F.col("c_acctbal") > 0).alias("verified"), F.floor(F.abs("c_acctbal")).cast("int").alias("followersCount"), cust.alias("id"))
    handle = T.StructType([T.StructField("username", T.StringType())])

    def mention(c):
        return F.struct(c.alias("username"))

    names = F.array(mention(F.concat(F.lit("user"), F.col("o_custkey") % 50)), mention(F.when(k % 11 != 0, F.concat(F.lit("user"), k % 30))))
    rows = j.select(
        k.alias("id"), F.floor(k / 2).alias("conversationId"), F.col("o_orderdate").alias("date"),
        F.concat_ws(" ", "o_orderpriority", "c_name").alias("content"), F.when(k % 10 == 3, "fr").otherwise("en").alias("lang"),
        F.col("c_mktsegment").alias("sourceLabel"), (price % 100).cast("int").alias("replyCount"), (price % 37).cast("int").alias("retweetCount"),
        (price % 1000).cast("int").alias("likeCount"), F.when(k % 10 != 9, price % 7).cast("int").alias("quoteCount"), F.col("n_name").alias("place"),
        F.when((k % 17 != 0) & cust.isNotNull(), user).alias("user"),
        F.when(k % 5 != 0, F.struct((k * 91 % 360 - 180).cast("float").alias("longitude"),
                                     F.when(k % 7 != 0, k * 37 % 180 - 90).cast("float").alias("latitude"))).alias("coordinates"),
        F.when(k % 4 > 1, names).when(k % 4 == 1, F.array().cast(T.ArrayType(handle))).alias("mentionedUsers"))
    users = RAW_POST_SCHEMA["user"].dataType
    full = rows.withColumn("user", F.when(F.col("user").isNotNull(), F.struct(*[
        (F.col(f"user.{f.name}") if f.name in {"username", "displayname", "description", "verified", "followersCount", "id"}
         else F.lit(None).cast(f.dataType)).alias(f.name) for f in users.fields])))
    return full.union(full.filter(F.col("id") % 13 == 0))


def _landed_raw(spark, sf, fmt="parquet"):
    path = _fresh(spark, "raw")
    _raw_posts(spark, sf).write.format(fmt).save(path)
    return tables.read_raw_posts(spark, path, fmt)


_RAW_SQL = """
WITH raw AS (
  SELECT o_orderkey AS id, o_orderkey // 2 AS conversationId, o_orderdate AS date, concat_ws(' ', o_orderpriority, c_name) AS content,
         CASE WHEN o_orderkey % 10 = 3 THEN 'fr' ELSE 'en' END AS lang, c_mktsegment AS sourceLabel,
         (floor(o_totalprice)::BIGINT % 100)::INT AS replyCount, (floor(o_totalprice)::BIGINT % 37)::INT AS retweetCount,
         (floor(o_totalprice)::BIGINT % 1000)::INT AS likeCount, CASE WHEN o_orderkey % 10 <> 9 THEN (floor(o_totalprice)::BIGINT % 7)::INT END AS quoteCount,
         n_name AS place, o_orderkey % 17 <> 0 AND c_custkey IS NOT NULL AS has_user, c_custkey,
         CASE WHEN o_orderkey % 5 <> 0 THEN (o_orderkey * 91 % 360 - 180)::FLOAT END AS longitude,
         CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 THEN (o_orderkey * 37 % 180 - 90)::FLOAT END AS latitude,
         CASE WHEN o_orderkey % 4 > 1 THEN ['user' || (o_custkey % 50), CASE WHEN o_orderkey % 11 <> 0 THEN 'user' || (o_orderkey % 30) END] ELSE [] END AS mentioned
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey),
acc AS (
  SELECT c_custkey AS userId, 'user' || c_custkey AS username, c_name AS displayname,
         CASE c_custkey % 3 WHEN 0 THEN 'World news desk' WHEN 1 THEN 'News and more' ELSE c_mktsegment END AS description,
         c_acctbal > 0 AS verified, floor(abs(c_acctbal))::INT AS followersCount
  FROM customer WHERE c_custkey IN (SELECT c_custkey FROM raw WHERE has_user)),
twice AS (SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE id % 13 = 0)"""


@register("landed_posts", _RAW_SQL + """
SELECT id AS tweetId, conversationId, CASE WHEN has_user THEN c_custkey END AS userId, date, content, lang, sourceLabel,
       replyCount, retweetCount, likeCount, quoteCount, longitude, latitude, place
FROM raw
""")
def q_landed_posts(spark, sf):
    """Nested landed results to the posts table, one row per id."""
    return CN.normalise_posts(_landed_raw(spark, sf)).select(*POST_SCHEMA.names)


@register("landed_accounts", _RAW_SQL + """
SELECT userId, username, displayname, description, verified, followersCount FROM acc
""")
def q_landed_accounts(spark, sf):
    """Nested users to the accounts table, one row per account; results without a user give none."""
    return CN.normalise_accounts(_landed_raw(spark, sf)).select(
        "userId", "username", "displayname", "description", "verified", "followersCount")


@register("landed_mentions", _RAW_SQL + """
SELECT account, count(*) AS count FROM (SELECT unnest(mentioned) AS account FROM twice) WHERE account IS NOT NULL GROUP BY account
""")
def q_landed_mentions(spark, sf):
    """Mentions exploded from arrays of structs in landed JSON lines; null and empty lists and null names give none."""
    m = CN.mentioned_accounts(_landed_raw(spark, sf, "json"))
    return m.groupBy("account").agg(F.count(F.lit(1)).alias("count"))


@register("account_discovery", _RAW_SQL + """,
m AS (SELECT place, account, count(*) AS count FROM (SELECT place, unnest(mentioned) AS account FROM twice WHERE place IS NOT NULL)
      WHERE account IS NOT NULL GROUP BY 1, 2),
n AS (SELECT place, count(*) AS posts FROM twice GROUP BY place)
SELECT m.place, account, count, acc.userId, (instr(description, 'news') > 0 OR instr(description, 'News') > 0) AND verified AS news_like
FROM m JOIN n ON m.place = n.place LEFT JOIN acc ON m.account = acc.username WHERE count > ceil(posts / 200)
""")
def q_account_discovery(spark, sf):
    """Accounts mentioned above a region's threshold with their profiles and news flag, per region, in one plan."""
    raw = _landed_raw(spark, sf)
    return R.discover_accounts(raw, CN.normalise_accounts(raw), "place", 200)


@register("search_flags", _RAW_SQL + """
SELECT id AS tweetId, acc.userId FROM raw JOIN acc ON has_user AND c_custkey = acc.userId
WHERE lang = 'en' AND verified AND (instr(description, 'news') > 0 OR instr(description, 'News') > 0)
  AND replyCount >= 20 AND retweetCount >= 5 AND likeCount >= 100
""")
def q_search_flags(spark, sf):
    """Stored search with the news, verified and engagement flags."""
    raw = _landed_raw(spark, sf)
    accounts = CN.normalise_accounts(raw).select("userId", "verified", R.news_like().alias("news_like"))
    posts = CN.normalise_posts(raw).join(accounts, "userId")
    return SR.search_posts(posts, lang="en", verified=True, news=True, min_replies=20, min_retweets=5, min_likes=100).select("tweetId", "userId")


@register("engagement_counters", _RAW_SQL.replace("WITH raw", V.VIEWS_SQL + ",\nraw") + """
SELECT prevalent_emotion, round_even(avg(replyCount), 1) AS replyCount, round_even(avg(retweetCount), 1) AS retweetCount,
       round_even(avg(likeCount), 1) AS likeCount, round_even(avg(quoteCount), 1) AS quoteCount
FROM raw JOIN posts ON raw.id = posts.post_id WHERE prevalent_emotion IS NOT NULL GROUP BY prevalent_emotion
""")
def q_engagement_counters(spark, sf):
    """Mean replies, retweets, likes and quotes per prevalent emotion, one decimal."""
    posts = CN.normalise_posts(_landed_raw(spark, sf)).join(
        V.posts(spark, sf).select(F.col("post_id").alias("tweetId"), "prevalent_emotion"), "tweetId")
    return R.engagement_by_label(posts, ["replyCount", "retweetCount", "likeCount", "quoteCount"])


@register("weekly_post_means", V.VIEWS_SQL + f"""
SELECT dsw, {", ".join(f"round(avg({m}), 6) AS {m}" for m in EMOTIONS)} FROM posts WHERE dsw IS NOT NULL GROUP BY dsw
""")
def q_weekly_post_means(spark, sf):
    """Weekly (Sunday-ending) mean emotions of the posts."""
    return round_doubles(R.weekly_means(V.posts(spark, sf)))


@register("outlet_rollup_renamed", V.VIEWS_SQL + """,
per AS (SELECT news_id, count(reply_id) AS n FROM replies WHERE news_id IS NOT NULL GROUP BY news_id)
SELECT CASE a.media_outlet WHEN 'AUTOMOBILE' THEN 'MACHINERY' ELSE a.media_outlet END AS media_outlet, sum(per.n)::BIGINT AS replies
FROM per JOIN accounts a ON per.news_id = a.userId GROUP BY 1
""")
def q_outlet_rollup_renamed(spark, sf):
    """Replies per outlet where one outlet is renamed into another and both are summed."""
    return R.outlet_rollup(V.replies(spark, sf), V.accounts(spark, sf), "news_id", "userId", "media_outlet", "reply_id",
                           renames={"AUTOMOBILE": "MACHINERY"})


def _short_title_sql() -> str:
    return f"""
WITH t AS (SELECT page_id, url, {_title_sql('html')} AS full_title,
                  list_transform(regexp_extract_all(html, '(?is)<h[1-3][^>]*>(.*?)</h[1-3]>', 1), lambda h: {_plain_sql("regexp_replace(h, '<[^>]*>', '', 'g')")}) AS heads FROM pages),
h AS (SELECT *, list_filter(heads, lambda h: len(string_split(h, ' ')) >= 2 AND length(h) >= 15
             AND contains(replace(full_title, '"', ''), replace(h, '"', ''))) AS inside FROM t),
s AS (SELECT *, coalesce(list_reverse_sort(list_transform(inside, lambda h: {{'n': length(h), 'h': h}}))[1].h,
             {", ".join(f"CASE WHEN contains(full_title, '{d}') THEN CASE WHEN len(string_split(split_part(full_title, '{d}', 1), ' ')) >= 4 THEN split_part(full_title, '{d}', 1) WHEN len(string_split(split_part(full_title, '{d}', -1), ' ')) >= 4 THEN split_part(full_title, '{d}', -1) END END" for d in TX.TITLE_DELIMITERS)},
             CASE WHEN contains(full_title, ': ') THEN CASE WHEN len(string_split(split_part(full_title, ': ', -1), ' ')) >= 4 THEN split_part(full_title, ': ', -1)
                  ELSE substr(full_title, instr(full_title, ': ') + 2) END END, full_title) AS short FROM h)
SELECT page_id, CASE WHEN length(short) > 15 AND length(short) < 150 THEN short ELSE full_title END AS short_title, full_title, url FROM s
"""


@register("page_headlines", _short_title_sql())
def q_page_headlines(spark, sf):
    """Short and full title with the address of every page."""
    return _table(spark, sf, "pages").select(
        "page_id", TX.short_title("html").alias("short_title"), TX.html_title("html").alias("full_title"), "url")


@register("delimited_round_trip", "SELECT doc_id, source, text FROM documents")
def q_delimited_round_trip(spark, sf):
    """Whole texts through a pipe-separated sink and back: quotes, separators, line ends, null and empty kept apart."""
    docs, path = _table(spark, sf, "documents").select("doc_id", "source", "text"), _fresh(spark, "delimited")
    sinks.write_delimited(docs, path, sep="|", compression="gzip")
    return tables.read_delimited(spark, path, docs.schema, sep="|")


@register("overwritten_sink", "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_returnflag <> 'N' GROUP BY l_returnflag")
def q_overwritten_sink(spark, sf):
    """A gzip Parquet sink written twice holds the second content alone."""
    li, path = _table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"), _fresh(spark, "overwrite")
    sinks.overwrite_parquet(li, path, "l_returnflag")
    sinks.overwrite_parquet(li.filter("l_returnflag <> 'N'"), path, "l_returnflag")
    return tables.read_parquet(spark, path).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@register("per_key_sink", """
SELECT o_orderstatus, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM orders GROUP BY o_orderstatus
""")
def q_per_key_sink(spark, sf):
    """One folder per key, appended in two batches and read back."""
    o, path = _table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), _fresh(spark, "per_key")
    for part in (F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") % 2 == 1):
        sinks.write_per_key(o.filter(part), path, "o_orderstatus")
    return tables.read_parquet(spark, path).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@register("row_ids", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id FROM orders")
def q_row_ids(spark, sf):
    """Consecutive row ids by range slices."""
    return RK.row_numbers(_table(spark, sf, "orders").select("o_orderkey"), "o_orderkey").select("o_orderkey", F.col("row_id").cast("long").alias("row_id"))


@register("positional_picks", """
SELECT o_orderkey, o_custkey, position FROM (SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS position, count(*) OVER () AS n FROM orders)
WHERE position IN (0, 5, 100, n - 1, n - 7)
""")
def q_positional_picks(spark, sf):
    """Rows at given places from the front and the end."""
    o = _table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return RK.pick_positions(o, "o_orderkey", [0, 5, 100, -1, -7]).select("o_orderkey", "o_custkey", F.col("position").cast("long").alias("position"))


@register("model_round_trip")
def q_model_round_trip(spark, sf):
    """Every document scored by a fitted classifier and by the same one saved and loaded again."""
    from ...operators.scoring import predict_classifier, train_classifier
    feats = _doc_features(spark, sf)
    model = train_classifier(feats.join(_table(spark, sf, "labels").select("doc_id", "quality"), "doc_id"), _DOC_FEATURES, "quality")
    path = _fresh(spark, "model")
    save_model(model, path)
    before, after = (predict_classifier(m, feats, _DOC_FEATURES, "doc_id") for m in (model, load_model(path)))
    return before.select("doc_id", F.col("p_true").alias("p_fitted")).join(after.select("doc_id", F.col("p_true").alias("p_loaded")), "doc_id")
