"""The consolidation pipeline over landed-style bindings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...plans import consolidate as CN
from ._common import _landed, _landed_sql, register, round_doubles


@register("consolidated_replies", _landed_sql())
def q_consolidated_replies(spark, sf):
    """The whole consolidation pipeline over landed-style inputs."""
    posts, accounts, media, scores, topics, replies, rscores = _landed(spark, sf)
    news = CN.consolidate_posts(posts, accounts, media, scores, topics)
    rep = CN.consolidate_replies(replies, rscores, news)
    return round_doubles(rep.select(
        "tweetId", F.col("conversationId").cast("bigint").alias("conversationId"), "news_id", "country",
        "continent", "theme", "subtheme", "news_prevalent_emotion", "prevalent_emotion",
        "anger", "joy", "optimism", "sadness", "ds", "dsw", "dsm"))
