"""Sinks with any text, short titles, stored models, discovery and picks on awkward rows."""

from pyspark.sql import functions as F

from echolens.functions import text as TX
from echolens.operators import ranking as RK
from echolens.plans import catalog, reports as R
from echolens.sources import sinks, tables

from conftest import SF_SMALL


def test_delimited_files_hold_any_text(spark, tmp_path):
    rows = [(1, "a|b"), (2, 'say "x"'), (3, "two\nlines"), (4, "cr\r\nlf"), (5, ""), (6, None), (7, "  spaces  "), (8, '"'),
            (9, "back\\slash"), (10, "\\N?"), (11, "|"), (12, "long " * 20_000)]
    df = spark.createDataFrame(rows, "id int, text string")
    for sep, header in (("|", True), (",", False), (";", True)):
        path = str(tmp_path / f"out{ord(sep)}")
        sinks.write_delimited(df, path, sep=sep, header=header)
        back = tables.read_delimited(spark, path, df.schema, sep=sep, header=header)
        assert {r.id: r.text for r in back.collect()} == dict(rows)


def test_short_titles(spark):
    cases = {
        "<title>Five new words are here | The Site</title>": "Five new words are here",
        "<title>Site - Five new words are here</title>": "Five new words are here",
        "<title>Breaking: seven people found after long search</title>": "seven people found after long search",
        "<title>Short | Site</title>": "Short | Site",
        "<title>What the council said - and did not say | Daily</title><h1>What the council said</h1>": "What the council said",
        "<title>A &quot;big&quot; day for the town - Paper</title><h2>A <b>big</b> day for the town</h2>": "A big day for the town",
        "<p>no title</p>": "[no-title]",
        "<title>No delimiter in this one</title>": "No delimiter in this one",
    }
    df = spark.createDataFrame(list(cases.items()), "html string, want string")
    for r in df.select("want", TX.short_title("html").alias("got")).collect():
        assert r.got == r.want


def test_discovery_per_region(spark):
    m = "array<struct<username:string>>"
    raw = spark.createDataFrame([
        ("x", [("a",), ("a",), (None,)]), ("x", []), ("x", None), ("x", [("b",)]), ("y", [("a",)]), (None, [("a",)] * 9)],
        f"place string, mentionedUsers {m}")
    acc = spark.createDataFrame([("a", 1, "World news", True), ("c", 2, "news", True)],
                                "username string, userId long, description string, verified boolean")
    got = {(r.place, r.account): (r["count"], r.userId, r.news_like) for r in R.discover_accounts(raw, acc, "place", 5).collect()}
    assert got == {("x", "a"): (2, 1, True)}
    got = R.discover_accounts(raw.withColumn("mentionedUsers", F.concat("mentionedUsers", "mentionedUsers")), acc, "place", 5)
    assert {(r.place, r.account, r.news_like) for r in got.collect()} == {("x", "a", True), ("x", "b", None), ("y", "a", True)}


def test_positions_and_row_ids(spark):
    df = spark.range(5, 1005).withColumn("v", F.col("id") * 2)
    got = {r.position: r.id for r in RK.pick_positions(df, "id", [0, 3, -1, 5_000]).collect()}
    assert got == {0: 5, 3: 8, 999: 1004}
    assert RK.row_numbers(df, "id").filter("row_id <> id - 5").count() == 0
    assert RK.pick_positions(df.limit(0), "id", [0, -1]).count() == 0


def test_model_scores_alike_after_loading(spark):
    out = catalog.QUERIES["model_round_trip"](spark, SF_SMALL)
    assert out.count() == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert out.filter(~F.col("p_fitted").eqNullSafe(F.col("p_loaded"))).count() == 0
