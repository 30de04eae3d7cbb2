"""Post search on stored tables, radius search, and the collection work queue.

Scale notes
-----------
* ``search_posts`` builds one Column predicate; date, author and language
  parts are pushed into the Parquet scan, the keyword part runs in the
  same whole-stage-codegen filter.
* ``radius_filter`` is a range join done as an equi-join: each point gets
  its grid cell, each region is expanded to the cells its bounding box
  covers (bounded by the grid size, independent of the data), the two
  meet on the cell key and the exact haversine test runs on the matches.
  No cross product with the points is formed.
* ``pending_batches`` numbers ids inside a bucket key, never with one
  global window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import KM_PER_DEGREE, haversine_km
from ..functions.text import any_keyword, id_query


def search_predicate(keywords=None, author: str | None = None, since: str | None = None,
                     until: str | None = None, lang: str | None = None, replies_only: bool | None = None,
                     min_replies: int | None = None, verified: bool | None = None, news: bool | None = None,
                     min_retweets: int | None = None, min_likes: int | None = None, text: str = "content", author_col: str = "username",
                     date: str = "date", lang_col: str = "lang", reply_flag: str = "is_reply",
                     reply_count: str = "replyCount", retweet_count: str = "retweetCount", like_count: str = "likeCount",
                     verified_flag: str = "verified", news_flag: str = "news_like") -> Column:
    """AND of the given search parts (``until`` is exclusive; a null flag or counter never matches)."""
    parts = []
    if keywords:
        parts.append(any_keyword(text, keywords))
    if author:
        parts.append(F.col(author_col) == F.lit(author))
    if since:
        parts.append(F.col(date) >= F.to_timestamp(F.lit(since)))
    if until:
        parts.append(F.col(date) < F.to_timestamp(F.lit(until)))
    if lang:
        parts.append(F.col(lang_col) == F.lit(lang))
    if replies_only is not None:
        parts.append(F.col(reply_flag) == F.lit(replies_only))
    for flag, want in ((verified_flag, verified), (news_flag, news)):
        if want is not None:
            parts.append(F.col(flag) == F.lit(want))
    for counter, least in ((reply_count, min_replies), (retweet_count, min_retweets), (like_count, min_likes)):
        if least is not None:
            parts.append(F.col(counter) >= F.lit(least))
    pred = F.lit(True)
    for p in parts:
        pred = pred & p
    return pred


def search_posts(df: DataFrame, **kw) -> DataFrame:
    return df.filter(search_predicate(**kw))


def _region_cells(regions: DataFrame, cell_deg: float, lat: str, lng: str, radius: str) -> DataFrame:
    n_lng = int(round(360 / cell_deg))
    dlat = F.col(radius) / F.lit(KM_PER_DEGREE)
    lat_lo = F.greatest(F.lit(-90.0), F.col(lat) - dlat)
    lat_hi = F.least(F.lit(90.0), F.col(lat) + dlat)
    edge = F.greatest(F.abs(lat_lo), F.abs(lat_hi))
    full = (edge >= F.lit(89.0)) | (dlat >= F.lit(90.0))
    dlng = F.when(full, F.lit(180.0)).otherwise(
        F.least(F.lit(180.0), dlat / F.cos(F.radians(edge))))
    lng_lo = F.floor((F.col(lng) - dlng + 180) / cell_deg)
    lng_hi = F.floor((F.col(lng) + dlng + 180) / cell_deg)
    r = regions.select(
        "*",
        F.sequence(F.floor((lat_lo + 90) / cell_deg), F.floor((lat_hi + 90) / cell_deg)).alias("_lat_cells"),
        F.when(full | (lng_hi - lng_lo + 1 >= n_lng), F.sequence(F.lit(0).cast("long"), F.lit(n_lng - 1).cast("long")))
         .otherwise(F.transform(F.sequence(lng_lo, lng_hi), lambda x: F.pmod(x, F.lit(n_lng))))
         .alias("_lng_cells"))
    return (r.select("*", F.explode("_lat_cells").alias("_cell_lat"))
             .select("*", F.explode("_lng_cells").alias("_cell_lng"))
             .drop("_lat_cells", "_lng_cells").dropDuplicates())


def radius_filter(points: DataFrame, regions: DataFrame, lat: str = "latitude", lng: str = "longitude",
                  region_lat: str = "lat", region_lng: str = "lng", radius: str = "radius_km",
                  cell_deg: float = 2.0, distance_col: str = "distance_km") -> DataFrame:
    """Points within each region's radius (a point may match several regions)."""
    n_lng = int(round(360 / cell_deg))
    pts = points.filter(F.col(lat).isNotNull() & F.col(lng).isNotNull()).select(
        "*", F.floor((F.col(lat) + 90) / cell_deg).cast("long").alias("_cell_lat"),
        F.pmod(F.floor((F.col(lng) + 180) / cell_deg).cast("long"), F.lit(n_lng)).alias("_cell_lng"))
    cells = _region_cells(regions, cell_deg, region_lat, region_lng, radius).select(
        *[F.col(c).alias(f"_r_{c}") if c in points.columns else F.col(c) for c in regions.columns],
        F.col("_cell_lat").cast("long").alias("_cell_lat"), F.col("_cell_lng").cast("long").alias("_cell_lng"))
    rl = f"_r_{region_lat}" if region_lat in points.columns else region_lat
    rg = f"_r_{region_lng}" if region_lng in points.columns else region_lng
    j = pts.join(cells, on=["_cell_lat", "_cell_lng"])
    d = haversine_km(F.col(lat), F.col(lng), F.col(rl), F.col(rg))
    return j.withColumn(distance_col, d).filter(F.col(distance_col) <= F.col(radius)).drop(
        "_cell_lat", "_cell_lng")


def pending_batches(posts: DataFrame, collected: DataFrame, key: str = "conversationId",
                    reply_count: str = "replyCount", size: int = 12, group: str | Column | None = None,
                    prefix: str = "conversation_id:", bucket_width: int = 1024) -> DataFrame:
    """Work queue: posts with replies whose conversation has nothing collected yet,
    numbered into batches of ``size`` (ascending id) inside ``group``; one
    search string per batch.  Without a group the ids are bucketed by id
    range (``bucket_width``), so each numbering sort is bounded."""
    grp = (group if isinstance(group, Column) else F.col(group) if group
           else F.floor(F.col(key) / bucket_width))
    todo = (posts.filter(F.col(reply_count) > 0).select(key, grp.alias("_grp"))
        .join(collected.select(key).filter(F.col(key).isNotNull()), on=key, how="left_anti")
        .dropDuplicates([key]))
    w = Window.partitionBy("_grp").orderBy(F.col(key))
    numbered = todo.withColumn("batch", F.floor((F.row_number().over(w) - 1) / size).cast("long"))
    return numbered.groupBy(F.col("_grp").alias("bucket"), "batch").agg(
        F.count(F.lit(1)).alias("n_ids"), id_query(F.collect_list(key), prefix).alias("query"))

