"""Edge rows the fixtures call for: zero counters, renamed outlets, zero baselines,
equal dates inside one conversation, null join keys."""

import datetime as dt

from pyspark.sql import functions as F

from echolens.functions.profile import with_profile_features
from echolens.operators import lift as L
from echolens.operators.dedupe import first_per_key
from echolens.plans.reports import outlet_rollup
from echolens.schemas import ACCOUNT_SCHEMA


def test_profile_features_zero_counters(spark):
    row = {f.name: None for f in ACCOUNT_SCHEMA.fields}
    row.update(username="abc", userId=1, verified=False, created=dt.datetime(2020, 1, 1), followersCount=0,
               friendsCount=0, statusesCount=0, favouritesCount=0, listedCount=0, mediaCount=0,
               linkUrl=None, location=None, profileBannerUrl=None)
    df = spark.createDataFrame([tuple(row[f.name] for f in ACCOUNT_SCHEMA.fields)], ACCOUNT_SCHEMA)
    r = with_profile_features(df, "2020-01-11 00:00:00").first()
    assert r.age_in_days == 10 and r.tweets_per_day == 0.0 and r.media_per_tweet == 0.0
    assert r.logFollowers == 0.0 and r.usernameLink is False and r.hasLink is False and r.hasBanner is False


def test_outlet_renamed_onto_another_is_summed(spark):
    replies = spark.createDataFrame([(1, 10), (2, 10), (3, 11), (4, 12)], "tweetId long, news_id long")
    accounts = spark.createDataFrame(
        [(10, "ABC (American Broadcasting Company)"), (11, "ABC (Australian Broadcasting Corporation)"),
         (12, "BBC")], "userId long, media_outlet string")
    got = {r.media_outlet: r.replies for r in outlet_rollup(replies, accounts).collect()}
    assert got == {"ABC": 3, "BBC": 1}


def test_zero_baseline_gives_null_lift(spark):
    df = spark.createDataFrame([(1, "a", 0.0), (2, "b", 0.0)], "tweetId long, k string, anger double")
    got = L.emotion_lift(df, ["k"], ["anger"]).collect()
    assert all(r.lift_anger is None for r in got)


def test_equal_dates_in_one_conversation_pick_lowest_id(spark):
    t = dt.datetime(2021, 2, 6, 8, 16, 17)
    df = spark.createDataFrame([(1357966331036004400, 7, t), (1357966331036004401, 7, t)],
                               "tweetId long, conversationId long, date timestamp")
    got = first_per_key(df, "conversationId", ["date", "tweetId"]).collect()
    assert [r.tweetId for r in got] == [1357966331036004400]


def test_null_keys_never_match(spark):
    a = spark.createDataFrame([(None, "x"), (1, "y")], "k long, a string")
    b = spark.createDataFrame([(None, "p"), (1, "q")], "k long, b string")
    assert [(r.a, r.b) for r in a.join(b, "k").collect()] == [("y", "q")]
