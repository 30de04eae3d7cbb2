import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from echolens.plans import consolidate as CN
from echolens.schemas import RAW_POST_SCHEMA, SUBTHEME_CODES
from echolens.streaming import jobs as SJ

T0 = dt.datetime(2020, 10, 4, 10, 0)


def _user(uid, name):
    return (name, name.upper(), "news about covid", None, True, T0, 10, 1, 100, 1, 2, 3, "X", False,
            None, None, None, None, uid)


def _raw(spark):
    rows = [
        # id, conversationId, date, content, lang, source, counters..., place, user, coords, mentions
        (1, 1, T0, "post one", "en", "web", 2, 0, 1, 0, None, _user(10, "ng_news"), (3.0, 6.0), [("bob",)]),
        (2, 2, T0, "post two", "en", "web", 1, 0, 1, 0, None, _user(11, "us_news"), None, None),
        (3, 2, T0 + dt.timedelta(hours=1), "later post same conv", "en", "web", 1, 0, 1, 0, None,
         _user(11, "us_news"), None, []),
        (4, 4, T0, "ignored language", "fr", "web", 1, 0, 1, 0, None, _user(10, "ng_news"), None, None),
        (5, 5, T0, "unlisted account", "en", "web", 1, 0, 1, 0, None, _user(12, "other"), None, None),
        (1, 1, T0, "post one dup", "en", "web", 2, 0, 1, 0, None, _user(10, "ng_news"), None, None),
    ]
    return spark.createDataFrame(rows, RAW_POST_SCHEMA)


def test_normalise_and_mentions(spark):
    raw = _raw(spark)
    posts = CN.normalise_posts(raw)
    assert posts.count() == 5 and "tweetId" in posts.columns and dict(posts.dtypes)["tweetId"] == "bigint"
    acc = CN.normalise_accounts(raw)
    assert sorted(r.userId for r in acc.collect()) == [10, 11, 12]
    m = CN.mentioned_accounts(raw).collect()
    assert [(r.tweetId, r.account) for r in m] == [(1, "bob")]


def test_consolidation_edges(spark):
    raw = _raw(spark)
    posts, accounts = CN.normalise_posts(raw), CN.normalise_accounts(raw)
    media = spark.createDataFrame([("ng_news", "NG", "Chan", "Television"), ("us_news", "XX", "Paper", "Newspaper")],
                                  "username string, country string, media_outlet string, media_category string")
    scores = spark.createDataFrame([(1, 0.7, 0.1, 0.1, 0.1), (2, 0.1, 0.6, 0.2, 0.1), (3, 0.2, 0.2, 0.2, 0.4),
                                    (5, 0.9, 0.0, 0.0, 0.1), (1, 0.7, 0.1, 0.1, 0.1)],
                                   "tweetId long, anger double, joy double, optimism double, sadness double")
    flags = {c: False for c in SUBTHEME_CODES}
    topics = spark.createDataFrame(
        [(1, 6, *{**flags, 61: True, 64: True}.values()), (2, 7, *flags.values())],
        "tweetId long, theme int, " + ", ".join(f"subtheme{c} boolean" for c in SUBTHEME_CODES))
    news = CN.consolidate_posts(posts, accounts, media, scores, topics)
    got = {r.conversationId: (r.tweetId, r.prevalent_emotion, r.subtheme, r.dsw) for r in news.collect()}
    assert got == {1: (1, "anger", 61, dt.date(2020, 10, 11)), 2: (2, "joy", 70, dt.date(2020, 10, 11))}
    replies = spark.createDataFrame(
        [(100, 1, 20, T0, "reply", "en"), (101, 2, 21, T0, "reply", "en"), (102, 9, 22, T0, "orphan", "en"),
         (None, 1, 23, T0, "null id", "en")],
        "tweetId long, conversationId long, userId long, date timestamp, content string, lang string")
    rs = spark.createDataFrame([(100, 0.1, 0.1, 0.1, 0.7), (101, 0.5, 0.2, 0.2, 0.1), (102, 0.9, 0.0, 0.0, 0.1),
                                (None, 0.9, 0.0, 0.0, 0.1)],
                               "tweetId long, anger double, joy double, optimism double, sadness double")
    out = {r.tweetId: (r.continent, r.prevalent_emotion, r.news_prevalent_emotion)
           for r in CN.consolidate_replies(replies, rs, news).collect()}
    # conversation 2's country (XX) has no continent: dropped by the inner continent join
    assert out == {100: ("Africa", "sadness", "anger")}


def test_unusable_first_post_drops_its_conversation(spark):
    """The first post of a conversation stands for it, also when its scores are skipped or in error."""
    media = spark.createDataFrame([("us_news", "US", "Paper", "Newspaper")],
                                  "username string, country string, media_outlet string, media_category string")
    accounts = spark.createDataFrame([(11, "us_news")], "userId long, username string")
    posts = spark.createDataFrame(
        [(i, c, 11, T0 + dt.timedelta(hours=i), "en") for i, c in [(1, 1), (2, 1), (3, 3), (4, 3), (5, 5), (6, 5)]],
        "tweetId long, conversationId long, userId long, date timestamp, lang string")
    good, none, error = (0.7, 0.1, 0.1, 0.1), (None,) * 4, (-1.0,) * 4
    scores = spark.createDataFrame([(1, *none), (2, *good), (3, *error), (4, *good), (5, *good), (6, *none)],
                                   "tweetId long, anger double, joy double, optimism double, sadness double")
    topics = spark.createDataFrame([(i, 7, *[False for _ in SUBTHEME_CODES]) for i in range(1, 7)], "tweetId long, theme int, "
                                   + ", ".join(f"subtheme{c} boolean" for c in SUBTHEME_CODES))
    news = CN.consolidate_posts(posts, accounts, media, scores, topics)
    assert [r.tweetId for r in news.collect()] == [5]
    kept = CN.consolidate_posts(posts, accounts, media, scores, topics, include_error_rows=True)
    assert sorted(r.tweetId for r in kept.collect()) == [3, 5]


def test_repeated_ids_keep_the_same_row(spark):
    s = [(1, 0.5, 0.2, 0.2, 0.1), (1, 0.4, 0.2, 0.2, 0.2)]
    schema = "tweetId long, anger double, joy double, optimism double, sadness double"
    for rows in (s, s[::-1]):
        assert [r.anger for r in CN.score_rows(spark.createDataFrame(rows, schema)).collect()] == [0.4]


def test_error_rows_excluded_by_default(spark):
    s = spark.createDataFrame([(1, -1.0, -1.0, -1.0, -1.0), (2, None, None, None, None), (3, 0.1, 0.2, 0.3, 0.4)],
                              "tweetId long, anger double, joy double, optimism double, sadness double")
    assert [r.tweetId for r in CN.clean_scores(s).collect()] == [3]
    assert sorted(r.tweetId for r in CN.clean_scores(s, include_error_rows=True).collect()) == [1, 3]


def test_stream_weekly_windows_match_batch(spark, tmp_path):
    from echolens.functions.calendar import week_ending_sunday
    rows = [(dt.datetime(2020, 10, d, h), float(d * h)) for d in range(1, 28) for h in (0, 12, 23)]
    src = tmp_path / "src"
    import time
    for lo in (1, 10, 19):   # three files arriving in time order (in-order data: nothing is late)
        part = [r for r in rows if lo <= r[0].day < lo + 9]
        spark.createDataFrame(part, "ts timestamp, value double").coalesce(1).write.mode("append").parquet(str(src))
        time.sleep(1.1)
    st = SJ.file_stream(spark, str(src), spark.read.parquet(str(src)).schema, max_files=1)
    got = {r.dsw: (r.n, round(r.value, 9)) for r in SJ.weekly_window_stream(st, "ts", ["value"]).collect()}
    b = spark.read.parquet(str(src)).groupBy(week_ending_sunday("ts").alias("dsw")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("value"))
    want = {r.dsw: (r.n, round(r.value, 9)) for r in b.collect()}
    assert got == want


def test_stream_dedupe_and_score_append(spark, tmp_path):
    import time
    src = tmp_path / "replies"
    t0 = dt.datetime(2021, 1, 1)
    batches = [[(1, t0), (2, t0), (1, t0)], [(2, t0 + dt.timedelta(hours=1)), (3, t0 + dt.timedelta(hours=2))]]
    for b in batches:
        spark.createDataFrame(b, "tweetId long, date timestamp").coalesce(1).write.mode("append").parquet(str(src))
        time.sleep(1.1)
    schema = spark.read.parquet(str(src)).schema
    st = SJ.file_stream(spark, str(src), schema, max_files=1)
    out = SJ.run_append_to_parquet(SJ.dedupe_stream(st, "tweetId", "date", "1 day"), "test_dedupe")
    assert sorted(r.tweetId for r in out.collect()) == [1, 2, 3]
    st2 = SJ.file_stream(spark, str(src), schema, max_files=1)
    scored = SJ.score_stream(st2, lambda b: b.withColumn("score", F.col("tweetId") * 2), "test_scores")
    assert sorted((r.tweetId, r.score) for r in scored.collect()) == [(1, 2), (1, 2), (2, 4), (2, 4), (3, 6)]


def test_stream_without_data(spark, tmp_path):
    src = tmp_path / "empty"
    src.mkdir()
    schema = "ts timestamp, value double"
    from pyspark.sql import types as T
    st = SJ.file_stream(spark, str(src), T._parse_datatype_string(schema))
    out = SJ.weekly_window_stream(st, "ts", ["value"], "empty_weekly")
    assert out.count() == 0 and out.columns == ["dsw", "n", "value"]


def test_update_log_is_bounded_and_keeps_the_latest_row(spark, tmp_path):
    import os
    schema = T._parse_datatype_string("k long, g string, n long")
    log = SJ.UpdateLog(spark, str(tmp_path / "log"), ["k", "g"], schema, compact=3)
    want = {}
    for b in range(10):
        rows = [(k, None if k % 2 else "x", 100 * b + k) for k in range(b % 4, 6)]
        want |= {(k, g): n for k, g, n in rows}
        batch = spark.createDataFrame(rows, schema)
        log.write(batch, b)
        if b in (2, 4):
            log.write(batch, b)                      # a retried batch replaces itself, also after it was folded
        assert {(r.k, r.g): r.n for r in log.read().collect()} == want
        assert len(log._parts()) <= 3 and len(os.listdir(tmp_path / "log" / "batch")) <= 3
    assert sorted(os.listdir(tmp_path / "log" / "snapshot")) == ["8"]
    assert SJ.UpdateLog(spark, str(tmp_path / "none"), ["k"], schema).read().count() == 0


def test_dedupe_arrivals_late_rows_and_expired_state(spark):
    schema = T._parse_datatype_string("id long, at timestamp")

    def arrival(*rows):
        return spark.createDataFrame([(i, dt.datetime(2021, 1, d)) for i, d in rows], schema)

    progress = []
    out = SJ.run_arrivals([
        arrival((1, 1), (2, 2), (2, 2), (3, 10)),    # mark after it: day 8
        arrival((1, 1), (2, 9), (4, 8), (5, 9), (3, 10), (6, 20)),      # 1 late, 2 forgotten, 4 late (on the mark), 3 held
        arrival((3, 21), (6, 22), (7, 18)),      # mark 18: 3 forgotten, 6 held (until 22), 7 late
        arrival((8, 30)),
    ], schema, lambda st: SJ.dedupe_stream(st, "id", "at", "2 days"), "test_arrivals", progress)
    got = sorted((r.id, r["at"].day) for r in out.collect())
    assert got == [(1, 1), (2, 2), (2, 9), (3, 10), (3, 21), (5, 9), (6, 20), (8, 30)]
    assert [p["stateOperators"][0]["numRowsTotal"] for p in progress][-1] <= 2
