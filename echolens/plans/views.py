"""Bind the operators to the driver's test tables.

``posts``: one row per order (the post), with its account (customer),
country (nation), continent (region), theme (first digit of the priority),
a subtheme, four post-level emotion measures and the prevalent emotion.

``replies``: one row per line item (the reply) joined to its post; four
reply-level measures normalised to sum to 1 (they behave like softmax
scores), so every branch of the > 0.5 prevalent-emotion rule is hit.

Each builder is DataFrame code; ``POSTS_SQL`` / ``REPLIES_SQL`` restate
the same bindings as plain SQL for the DuckDB oracle.

Plan notes: orders -> customer is a shuffle (or AQE broadcast) join on the
customer key; nation and region are tiny and the planner broadcasts them
from their file-size estimate.  lineitem -> posts is the one large-large
join (on the order key); both sides shuffle on that key once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import month_start, week_ending_sunday
from ..functions.emotions import max_score, prevalent_emotion
from ..session import ensure_utc
from ..sources.tables import table


def _sq(x: Column) -> Column:
    return x * x


def _cube(x: Column) -> Column:
    return x * x * x


def _subtheme(theme: Column, key: Column) -> Column:
    extra = (F.when(theme == 1, key % 3).when(theme == 2, key % 3).when(theme == 4, key % 5)
              .when(theme == 5, key % 4).otherwise(F.lit(0)))
    return (theme * 10 + extra).cast("int")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region")
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(n, c.c_nationkey == n.n_nationkey)
          .join(r, n.n_regionkey == r.r_regionkey))
    theme = F.substring("o_orderpriority", 1, 1).cast("int")
    pa = _sq(F.col("o_orderkey") % 7 / F.lit(6).cast("double"))
    pb = _sq(F.col("o_custkey") % 5 / F.lit(4).cast("double"))
    pd = _sq(F.col("o_totalprice") / 500000)
    pe = _sq((F.col("o_orderkey") + F.col("o_custkey")) % 11 / F.lit(10).cast("double")) + 0.001
    base = j.select(
        F.col("o_orderkey").alias("post_id"),
        F.col("o_custkey").alias("account_id"),
        F.col("o_orderdate").alias("date"),
        F.to_date("o_orderdate").alias("ds"),
        week_ending_sunday("o_orderdate").alias("dsw"),
        month_start("o_orderdate").alias("dsm"),
        F.col("c_mktsegment").alias("outlet"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("continent"),
        theme.alias("theme"),
        _subtheme(theme, F.col("o_orderkey")).alias("subtheme"),
        F.col("o_orderstatus").alias("post_label"),
        F.col("o_totalprice").alias("engagement"),
        pa.alias("_a"), pb.alias("_b"), pd.alias("_d"), pe.alias("_e"))
    t = F.col("_a") + F.col("_b") + F.col("_d") + F.col("_e")
    scored = base.select(
        "*", (F.col("_a") / t).alias("anger"), (F.col("_b") / t).alias("sadness"),
        (F.col("_d") / t).alias("optimism"), (F.col("_e") / t).alias("joy")).drop(
        "_a", "_b", "_d", "_e")
    return scored.select("*", max_score().alias("emotion_score"),
                         prevalent_emotion().alias("prevalent_emotion"))


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice")
    p = posts(spark, sf_dir).select(
        "post_id", "account_id", "ds", "dsw", "dsm", "country", "continent", "theme", "subtheme",
        "post_label",
        *[F.col(m).alias("news_" + m) for m in ["anger", "sadness", "optimism", "joy"]],
        F.col("emotion_score").alias("news_emotion_score"),
        F.col("prevalent_emotion").alias("news_prevalent_emotion"))
    j = li.join(p, li.l_orderkey == p.post_id)
    a = _cube(F.col("l_quantity") / 50)
    b = _cube(F.col("l_discount") * 10)
    d = _cube(F.col("l_tax") * 12.5)
    e = _cube(F.col("l_extendedprice") / 100000) + 0.001
    base = j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("reply_id"),
        "post_id", F.col("post_id").alias("conversation_id"),
        F.col("account_id").alias("news_id"), "ds", "dsw", "dsm", "country", "continent", "theme",
        "subtheme", "post_label", "news_anger", "news_sadness", "news_optimism", "news_joy",
        "news_emotion_score", "news_prevalent_emotion",
        a.alias("_a"), b.alias("_b"), d.alias("_d"), e.alias("_e"))
    t = F.col("_a") + F.col("_b") + F.col("_d") + F.col("_e")
    scored = base.select(
        "*", (F.col("_a") / t).alias("anger"), (F.col("_b") / t).alias("sadness"),
        (F.col("_d") / t).alias("optimism"), (F.col("_e") / t).alias("joy")).drop(
        "_a", "_b", "_d", "_e")
    return scored.select("*", max_score().alias("emotion_score"),
                         prevalent_emotion().alias("prevalent_emotion"))


def posts_with_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts that carry a text: documents attached to the post with the same id."""
    d = table(spark, sf_dir, "documents").select(
        F.col("doc_id"), F.col("text").alias("content"), "lang", F.col("source").alias("author"))
    return posts(spark, sf_dir).join(d, F.col("post_id") == F.col("doc_id")).drop("doc_id")


# --------------------------------------------------------------------------
# The same bindings in SQL for the DuckDB oracle (no engine-specific syntax
# beyond the week label, spelled out with dayofweek).
# --------------------------------------------------------------------------

def _dsw(d: str) -> str:
    return (f"cast({d} + cast(case when dayofweek({d})=0 then 7 else 7-dayofweek({d}) end "
            f"as integer) as date)")


def _argmax_sql(p: str = "") -> str:
    a, j, o, s = (p + "anger", p + "joy", p + "optimism", p + "sadness")
    m = f"greatest({a},{j},{o},{s})"
    return (f"case when {m} > 0.5 then (case when {a}={m} then 'anger' when {j}={m} then 'joy' "
            f"when {o}={m} then 'optimism' else 'sadness' end) else 'undefined' end")


POSTS_SQL = f"""
posts_base AS (
  SELECT o_orderkey AS post_id, o_custkey AS account_id, o_orderdate AS date,
         cast(o_orderdate AS date) AS ds,
         {_dsw('cast(o_orderdate as date)')} AS dsw,
         cast(date_trunc('month', cast(o_orderdate AS date)) AS date) AS dsm,
         c_mktsegment AS outlet, n_name AS country, r_name AS continent,
         cast(substr(o_orderpriority,1,1) AS int) AS theme,
         cast(cast(substr(o_orderpriority,1,1) AS int)*10 + case cast(substr(o_orderpriority,1,1) AS int)
              when 1 then o_orderkey % 3 when 2 then o_orderkey % 3 when 4 then o_orderkey % 5
              when 5 then o_orderkey % 4 else 0 end AS int) AS subtheme,
         o_orderstatus AS post_label, o_totalprice AS engagement,
         (cast(o_orderkey % 7 AS double)/6)*(cast(o_orderkey % 7 AS double)/6) AS _a,
         (cast(o_custkey % 5 AS double)/4)*(cast(o_custkey % 5 AS double)/4) AS _b,
         (o_totalprice/500000)*(o_totalprice/500000) AS _d,
         (cast((o_orderkey + o_custkey) % 11 AS double)/10)*(cast((o_orderkey + o_custkey) % 11 AS double)/10) + 0.001 AS _e
  FROM orders JOIN customer ON o_custkey = c_custkey
              JOIN nation ON c_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey),
posts_scored AS (
  SELECT * EXCLUDE (_a, _b, _d, _e), _a/(_a+_b+_d+_e) AS anger, _b/(_a+_b+_d+_e) AS sadness,
         _d/(_a+_b+_d+_e) AS optimism, _e/(_a+_b+_d+_e) AS joy
  FROM posts_base),
posts AS (
  SELECT *, greatest(anger, joy, optimism, sadness) AS emotion_score,
         {_argmax_sql()} AS prevalent_emotion
  FROM posts_scored)"""

REPLIES_SQL = f"""
replies_base AS (
  SELECT l_orderkey*10 + l_linenumber AS reply_id, post_id, post_id AS conversation_id,
         account_id AS news_id, ds, dsw, dsm, country, continent, theme, subtheme, post_label,
         anger AS news_anger, sadness AS news_sadness, optimism AS news_optimism, joy AS news_joy,
         emotion_score AS news_emotion_score, prevalent_emotion AS news_prevalent_emotion,
         (l_quantity/50)*(l_quantity/50)*(l_quantity/50) AS _a,
         (l_discount*10)*(l_discount*10)*(l_discount*10) AS _b,
         (l_tax*12.5)*(l_tax*12.5)*(l_tax*12.5) AS _d,
         (l_extendedprice/100000)*(l_extendedprice/100000)*(l_extendedprice/100000) + 0.001 AS _e
  FROM lineitem JOIN posts ON l_orderkey = post_id),
replies_scored AS (
  SELECT * EXCLUDE (_a, _b, _d, _e), _a/(_a+_b+_d+_e) AS anger, _b/(_a+_b+_d+_e) AS sadness,
         _d/(_a+_b+_d+_e) AS optimism, _e/(_a+_b+_d+_e) AS joy
  FROM replies_base),
replies AS (
  SELECT *, greatest(anger, joy, optimism, sadness) AS emotion_score,
         {_argmax_sql()} AS prevalent_emotion
  FROM replies_scored)"""

VIEWS_SQL = "WITH " + POSTS_SQL.strip() + ",\n" + REPLIES_SQL.strip()


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account profiles: one row per customer with its country and outlet."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("userId"), F.col("c_name").alias("displayname"),
        F.col("n_name").alias("country"), F.col("c_acctbal").alias("followersCount"),
        F.col("c_mktsegment").alias("description"), F.col("c_mktsegment").alias("media_outlet"))


ACCOUNTS_SQL = """
accounts AS (
  SELECT c_custkey AS userId, c_name AS displayname, n_name AS country, c_acctbal AS followersCount,
         c_mktsegment AS description, c_mktsegment AS media_outlet
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

VIEWS_SQL = VIEWS_SQL + ",\n" + ACCOUNTS_SQL.strip()


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account profiles with counters, derived from customers and their orders."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("created"), F.count(F.lit(1)).alias("statusesCount"),
        F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("mediaCount"),
        F.count_distinct("o_orderpriority").alias("listedCount"))
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(o, c.c_custkey == o.o_custkey, "left")
    return j.select(
        F.col("c_custkey").alias("userId"), F.lower(F.replace("c_name", F.lit("#"), F.lit(""))).alias("username"),
        F.col("created"), F.coalesce("statusesCount", F.lit(0)).cast("int").alias("statusesCount"),
        F.coalesce("mediaCount", F.lit(0)).cast("int").alias("mediaCount"),
        F.coalesce("listedCount", F.lit(0)).cast("int").alias("listedCount"),
        F.floor(F.abs("c_acctbal")).cast("int").alias("followersCount"),
        (F.col("c_custkey") % 100).cast("int").alias("favouritesCount"),
        (F.col("c_acctbal") > 0).alias("verified"),
        F.when(F.col("c_custkey") % 3 != 0, F.col("n_name")).alias("location"),
        F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("https://www."), F.lower(F.replace("c_name", F.lit("#"), F.lit(""))), F.lit(".com")))
         .when(F.col("c_custkey") % 4 == 1, F.lit("https://sputnik.com")).alias("linkUrl"),
        F.when(F.col("c_acctbal") < 0, F.lit("banner")).alias("profileBannerUrl"))


PROFILES_SQL = """
profiles AS (
  SELECT c_custkey AS userId, lower(replace(c_name, '#', '')) AS username, o.created,
         cast(coalesce(o.statusesCount, 0) AS int) AS statusesCount, cast(coalesce(o.mediaCount, 0) AS int) AS mediaCount,
         cast(coalesce(o.listedCount, 0) AS int) AS listedCount, cast(floor(abs(c_acctbal)) AS int) AS followersCount,
         cast(c_custkey % 100 AS int) AS favouritesCount, c_acctbal > 0 AS verified,
         CASE WHEN c_custkey % 3 != 0 THEN n_name END AS location,
         CASE WHEN c_custkey % 4 = 0 THEN 'https://www.' || lower(replace(c_name, '#', '')) || '.com'
              WHEN c_custkey % 4 = 1 THEN 'https://sputnik.com' END AS linkUrl,
         CASE WHEN c_acctbal < 0 THEN 'banner' END AS profileBannerUrl
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS created, count(*) AS statusesCount,
                    sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS mediaCount,
                    count(DISTINCT o_orderpriority) AS listedCount
             FROM orders GROUP BY o_custkey) o ON c_custkey = o.o_custkey)"""
