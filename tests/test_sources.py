import json
import os

from pyspark.sql import functions as F

from echolens.plans.reports import city_selection, clean_coordinates
from echolens.sources import tables as TB
from echolens.schemas import RAW_POST_SCHEMA


def test_semicolon_and_headerless_csv(spark, tmp_path):
    media = tmp_path / "media.csv"
    media.write_text("username;country;media_outlet;media_category\n9News;AU;Channel 9;Television\nabc;US;ABC;TV\n")
    m = TB.read_media_list(spark, str(media)).collect()
    assert [(r.username, r.country) for r in m] == [("9News", "AU"), ("abc", "US")]
    ids = tmp_path / "ids.csv"
    ids.write_text("bbc\ncnn\nbbc\n")
    assert sorted(r.value for r in TB.read_id_list(spark, str(ids)).collect()) == ["bbc", "cnn"]


def test_cities(spark, tmp_path):
    p = tmp_path / "cities.csv"
    p.write_text("Rank;City;State;2019\n1;New York city; New York ;8.336.817\n2;Buffalo city;New York;255.284\n"
                 "3;Albany city;New York;96.460\n4;Ithaca city;New York;30.837\n5;Yonkers city;New York;201.000\n"
                 "6;Tiny;Vermont;1.200\n")
    out = {r.City: (r.Population, r.loctag) for r in city_selection(TB.read_cities(spark, str(p))).collect()}
    assert out == {"New York city": (8336817, "New York, New York"), "Buffalo city": (255284, "Buffalo, New York"),
                   "Albany city": (96460, "Albany, New York"), "Yonkers city": (201000, "Yonkers, New York")}


def test_coordinates(spark):
    raw = spark.createDataFrame([('"GB"', '" 54.0"', '"-2.0"'), ('"NG"', '"10"', '"8"')],
                                "`Alpha-2 code` string, `Latitude (average)` string, `Longitude (average)` string")
    got = {r.country: (r.lat, r.lng) for r in clean_coordinates(raw).collect()}
    assert got == {"UK": (54.0, -2.0), "NG": (10.0, 8.0)}


def test_json_lines_raw(spark, tmp_path):
    p = tmp_path / "raw.jsonl"
    rec = {"id": 1355061541931012000, "conversationId": 1, "content": "hi", "lang": "en",
           "user": {"id": 7, "username": "bbc"}, "mentionedUsers": [{"username": "x"}]}
    p.write_text(json.dumps(rec) + "\n")
    r = TB.read_raw_posts(spark, str(p), fmt="json").first()
    assert r.id == 1355061541931012000 and r.user.username == "bbc" and r.mentionedUsers[0].username == "x"


def test_model_save_load(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from echolens.operators import scoring as SC
    rows = [(i, f"{['anger', 'joy', 'optimism', 'sadness'][i % 4]} t", ['anger', 'joy', 'optimism', 'sadness'][i % 4])
            for i in range(40)]
    df = spark.createDataFrame(rows, "tweetId long, content string, label string")
    m = SC.train_text_scorer(df, num_features=256)
    m.write().overwrite().save(str(tmp_path / "model"))
    m2 = PipelineModel.load(str(tmp_path / "model"))
    a = SC.score_with_model(df, m).orderBy("tweetId").collect()
    b = SC.score_with_model(df, m2).orderBy("tweetId").collect()
    assert a == b


def test_cli_list(capsys):
    from echolens.__main__ import main
    assert main(["list"]) == 0
    out = capsys.readouterr().out.splitlines()
    assert any(line.startswith("lift_cube17") and "oracle" in line for line in out)
    assert len(out) >= 70


def test_sinks_round_trip(spark, tmp_path):
    import datetime as dt
    from echolens.functions.calendar import with_calendar
    from echolens.functions.text import keyword_query
    from echolens.operators.dedupe import union_distinct
    from echolens.schemas import POST_SCHEMA, SCORE_SCHEMA
    from echolens.sources import lookups, sinks

    rows = [(1, 1, 7, dt.datetime(2020, 10, 4), "covid", "en", "web", 0, 0, 0, 0, None, None, None)]
    posts = spark.createDataFrame(rows, POST_SCHEMA)
    sinks.overwrite_parquet(posts, str(tmp_path / "posts"))
    back = TB.read_posts(spark, str(tmp_path / "posts"))
    assert back.schema == POST_SCHEMA and back.count() == 1
    cal = with_calendar(back, "date").first()
    assert str(cal.dsw) == "2020-10-11" and str(cal.dsm) == "2020-10-01"
    new = spark.createDataFrame(rows + [(2, 1, 7, dt.datetime(2020, 10, 5), "x", "en", "web", 0, 0, 0, 0, None,
                                         None, None)], POST_SCHEMA)
    sinks.merge_first_wins(back, new, "tweetId", str(tmp_path / "merged"))
    assert sorted(r.tweetId for r in TB.read_posts(spark, str(tmp_path / "merged")).collect()) == [1, 2]
    sc = spark.createDataFrame([(1, 0.1, 0.2, 0.3, 0.4)], SCORE_SCHEMA)
    sinks.write_delimited(sc, str(tmp_path / "scores"), sep=",")
    assert TB.read_scores(spark, str(tmp_path / "scores")).first().sadness == 0.4
    sinks.write_per_key(new.withColumn("batch", F.col("tweetId") % 2), str(tmp_path / "per"), "batch")
    assert [d for d in sorted(os.listdir(tmp_path / "per")) if d.startswith("batch=")] == ["batch=0", "batch=1"]
    assert union_distinct(back, back).count() == 1
    assert keyword_query(["covid", "lockdown"], "2020-06-01", "2020-12-31", "bbc") == \
        '("covid" OR "lockdown") from:bbc since:2020-06-01 until:2020-12-31'
    assert lookups.country_names(spark).count() == 12
