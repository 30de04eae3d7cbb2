"""Landed data -> normalised tables -> consolidated posts and replies.

This is the pipeline every report reads:

1. ``normalise_posts`` / ``normalise_accounts``: flatten the raw nested
   search results (``user`` struct, ``coordinates`` struct), rename
   ``id`` -> ``tweetId`` / ``userId``, keep ids as longs (never floats),
   one row per id.
2. ``consolidate_posts``: posts of listed news accounts (inner join on the
   account), English only, joined to their emotion scores (deduped first),
   first post per conversation, complete scores only, prevalent emotion,
   theme and decoded subtheme, calendar keys.
3. ``consolidate_replies``: replies in English with scores, first per
   reply id, joined to their post's columns (renamed ``news_*``; inner, as
   the continent join makes it), prevalent emotion, continent, calendar
   keys from the post date.

Plan notes: the media list, theme and continent tables are tiny and
broadcast.  The two large joins (replies -> scores, replies -> posts) are
shuffle joins on ``tweetId`` / ``conversationId``; AQE's skew-join split
handles viral conversations.  ``first per key`` uses the combinable
``min_by`` aggregate, so a hot conversation never gathers in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import month_start, week_ending_sunday
from ..functions.emotions import decode_subtheme, with_prevalent
from ..operators.dedupe import first_per_key_agg
from ..schemas import ACCOUNT_SCHEMA, EMOTIONS, ERROR_SCORE, POST_SCHEMA, SUBTHEME_CODES
from ..sources import lookups
from ..sources.sinks import conform


def normalise_posts(raw: DataFrame) -> DataFrame:
    """Raw nested results -> posts table (POST_SCHEMA), one row per tweetId: its first in column order."""
    flat = raw.select(
        F.col("id").cast("long").alias("tweetId"), F.col("conversationId").cast("long").alias("conversationId"),
        F.col("user.id").cast("long").alias("userId"), F.col("date"), F.col("content"), F.col("lang"),
        F.col("sourceLabel"), "replyCount", "retweetCount", "likeCount", "quoteCount",
        F.col("coordinates.longitude").alias("longitude"), F.col("coordinates.latitude").alias("latitude"),
        "place")
    return _one_per_id(conform(flat, POST_SCHEMA), "tweetId")


def normalise_accounts(raw: DataFrame) -> DataFrame:
    """Raw nested results -> accounts table (ACCOUNT_SCHEMA), one row per userId."""
    users = raw.select("user.*").withColumnRenamed("id", "userId")
    return _one_per_id(conform(users, ACCOUNT_SCHEMA).filter(F.col("userId").isNotNull()), "userId")


def _one_per_id(rows: DataFrame, key: str) -> DataFrame:
    """The same row per id in every run, also where the repeated rows differ."""
    return first_per_key_agg(rows, key, [c for c in rows.columns if c != key])


def mentioned_accounts(raw: DataFrame) -> DataFrame:
    """One row per (post, mentioned handle); a null or empty list gives no rows."""
    return raw.select(F.col("id").alias("tweetId"),
                      F.explode(F.col("mentionedUsers.username")).alias("account")).filter(
        F.col("account").isNotNull())


def news_accounts(accounts: DataFrame, media_list: DataFrame) -> DataFrame:
    """Accounts that appear in the media list (inner on the case-sensitive username)."""
    return accounts.join(media_list, "username", "inner")


def score_rows(scores: DataFrame) -> DataFrame:
    """One score row per tweetId (the smallest one where they differ) with a ``score_status`` (ok / skipped / error)."""
    s = scores.filter(F.col("tweetId").isNotNull()).select("tweetId", *EMOTIONS)
    status = (F.when(F.col("anger").isNull(), F.lit("skipped"))
               .when(F.col("anger") == F.lit(ERROR_SCORE), F.lit("error")).otherwise(F.lit("ok")))
    return first_per_key_agg(s, "tweetId", EMOTIONS).withColumn("score_status", status)


def usable_scores(scored: DataFrame, include_error_rows: bool = False) -> DataFrame:
    """Rows whose scores reach the means.

    Skipped rows (null scores) never do.  Error rows (-1) are dropped unless
    ``include_error_rows`` (which reproduces the published means, where they
    pass the null filter).
    """
    keep = ["ok", "error"] if include_error_rows else ["ok"]
    return scored.filter(F.col("score_status").isin(keep)).dropna(how="any", subset=EMOTIONS)


def clean_scores(scores: DataFrame, include_error_rows: bool = False) -> DataFrame:
    """The usable score rows, one per tweetId."""
    return usable_scores(score_rows(scores), include_error_rows)


def consolidate_posts(posts: DataFrame, accounts: DataFrame, media_list: DataFrame, scores: DataFrame,
                      topics: DataFrame, include_error_rows: bool = False,
                      subtheme_codes=SUBTHEME_CODES) -> DataFrame:
    """Consolidated news posts (one per conversation, scored, themed, dated).

    The first post stands for its conversation: if its scores are not usable, the conversation is dropped."""
    acc = news_accounts(accounts, media_list).select("userId", "country")
    p = posts.filter(F.col("lang") == "en").join(acc, "userId", "inner")
    p = p.join(score_rows(scores), "tweetId", "inner")
    p = p.filter(F.col("conversationId").isNotNull())
    p = first_per_key_agg(p, "conversationId", ["date", "tweetId"])
    p = with_prevalent(usable_scores(p, include_error_rows))
    flags = [f"subtheme{c}" for c in subtheme_codes]
    t = topics.select("tweetId", "theme", *flags)
    p = p.join(t, "tweetId", "inner").dropna(how="any", subset=flags)
    p = p.withColumn("subtheme", decode_subtheme("theme", subtheme_codes)).drop(*flags)
    return (p.withColumn("ds", F.to_date("date")).withColumn("dsw", week_ending_sunday("date"))
             .withColumn("dsm", month_start("date")))


def consolidate_replies(replies: DataFrame, scores: DataFrame, news: DataFrame,
                        include_error_rows: bool = False) -> DataFrame:
    """Consolidated replies joined to their consolidated post."""
    spark = replies.sparkSession
    r = replies.filter((F.col("lang") == "en") & F.col("tweetId").isNotNull())
    r = first_per_key_agg(r, "tweetId", ["date", "conversationId"])
    r = usable_scores(r.join(score_rows(scores), "tweetId"), include_error_rows)
    n = news.select(
        "conversationId", F.col("date").alias("news_date"), F.col("userId").alias("news_id"),
        F.col("prevalent_emotion").alias("news_prevalent_emotion"),
        F.col("emotion_score").alias("news_emotion_score"),
        *[F.col(m).alias("news_" + m) for m in EMOTIONS], "theme", "subtheme", "country")
    r = r.join(n, "conversationId", "inner")
    r = with_prevalent(r).join(lookups.continents(spark), "country", "inner")
    return (r.withColumn("ds", F.to_date("news_date")).withColumn("dsw", week_ending_sunday("news_date"))
             .withColumn("dsm", month_start("news_date")))
