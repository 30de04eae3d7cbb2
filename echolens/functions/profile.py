"""Account profile features used by the news-account classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .calendar import age_in_days
from .text import link_stem

PROFILE_FEATURES = [
    "verified", "usernameLink", "age_in_days", "tweets_per_day", "media_per_tweet",
    "listed_per_followers", "favourites_per_tweet", "logFollowers", "logListed",
    "hasLocation", "hasLink", "hasBanner",
]


def with_profile_features(accounts: DataFrame, as_of: str, link_mode: str = "charset") -> DataFrame:
    """Ratios with 1+ denominators, log10(1+x) counts, presence flags, link==username.

    ``as_of`` is an explicit timestamp string so results are repeatable.
    A null link compares false.
    """
    d = accounts.withColumn("age_in_days", age_in_days("created", as_of))
    return d.select(
        "*",
        F.coalesce(link_stem("linkUrl", link_mode) == F.col("username"), F.lit(False)).alias("usernameLink"),
        (F.col("statusesCount") / (1 + F.col("age_in_days"))).alias("tweets_per_day"),
        (F.col("mediaCount") / (1 + F.col("statusesCount"))).alias("media_per_tweet"),
        (F.col("listedCount") / (1 + F.col("followersCount"))).alias("listed_per_followers"),
        (F.col("favouritesCount") / (1 + F.col("statusesCount"))).alias("favourites_per_tweet"),
        F.log10(1 + F.col("followersCount")).alias("logFollowers"),
        F.log10(1 + F.col("listedCount")).alias("logListed"),
        F.col("location").isNotNull().alias("hasLocation"),
        F.col("linkUrl").isNotNull().alias("hasLink"),
        F.col("profileBannerUrl").isNotNull().alias("hasBanner"),
    )
