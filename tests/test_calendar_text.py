import datetime as dt

from pyspark.sql import functions as F

from echolens.functions import calendar as C
from echolens.functions import text as TX


def test_week_month(spark):
    rows = [(dt.datetime(2020, 10, 4, 23, 59),),   # a Sunday -> next Sunday
            (dt.datetime(2020, 10, 5, 0, 1),),     # Monday
            (dt.datetime(2020, 10, 10, 12, 0),)]   # Saturday
    df = spark.createDataFrame(rows, "ts timestamp")
    got = df.select(C.week_ending_sunday("ts").alias("w"), C.month_start("ts").alias("m"),
                    C.month_label("ts").alias("l")).collect()
    assert [r.w for r in got] == [dt.date(2020, 10, 11)] * 3
    assert got[0].m == dt.date(2020, 10, 1) and got[0].l == "2020-10"


def test_age_in_days(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 12),)], "created timestamp")
    assert df.select(C.age_in_days("created", "2020-01-11 11:00:00").alias("a")).first().a == 9


def test_keywords_substring_and_any(spark):
    df = spark.createDataFrame([("Covidiot says hi",), ("Social Distancing now",), ("nothing",)], "t string")
    out = TX.keyword_flags(df, "t", ["covid", "social distancing"]).collect()
    assert [(r.covid, r.social_distancing) for r in out] == [(1, 0), (0, 1), (0, 0)]
    anyk = [r.a for r in df.select(TX.any_keyword("t", ["covid", "distancing"]).alias("a")).collect()]
    assert anyk == [True, True, False]


def test_masking_edge_cases(spark):
    rows = [("hi @bob  see http://x.y and @ alone",), ("http is a word",), ("",)]
    df = spark.createDataFrame(rows, "t string")
    got = [r.m for r in df.select(TX.mask_handles_and_links("t").alias("m")).collect()]
    assert got == ["hi @user  see http and @ alone", "http is a word", ""]


def test_symbol_count_unicode(spark):
    df = spark.createDataFrame([("Émilie, ça va? 😀😀 ñ_1",), ("!" * 151,)], "t string")
    got = [r.n for r in df.select(TX.symbol_count("t").alias("n")).collect()]
    # '?' and two emoji are symbols; letters with accents, '_', digits, ',' and spaces are not
    assert got == [3, 151]


def test_link_stem_modes(spark):
    df = spark.createDataFrame([("https://sputnik.com/x",), ("http://www.bbc.co.uk",), (None,)], "u string")
    got = df.select(TX.link_stem("u", "charset").alias("c"), TX.link_stem("u", "prefix").alias("p")).collect()
    assert got[0].c == "utnik" and got[0].p == "sputnik"
    assert got[1].p == "bbc"
    assert got[2].c is None


def test_link_only_title_numbers(spark):
    df = spark.createDataFrame([("https://a.b/c",), ("https://a.b/c more",), ("see https://a.b",)], "t string")
    assert [r.x for r in df.select(TX.is_link_only("t").alias("x")).collect()] == [True, False, False]
    html = spark.createDataFrame([("<html><TITLE lang=x>A &amp; B &quot;q&quot;\n  x</TITLE></html>",),
                                  ("<html><body>no title</body></html>",)], "h string")
    assert [r.t for r in html.select(TX.html_title("h").alias("t")).collect()] == ['A & B "q" x', "[no-title]"]
    nums = spark.createDataFrame([("1.234.567",), ("950",)], "s string")
    assert [r.n for r in nums.select(TX.parse_dotted_int("s").alias("n")).collect()] == [1234567, 950]
    m = spark.createDataFrame([("ask @bob_1 and @ann, mail x@y.org",)], "t string")
    assert m.select(TX.mentions("t").alias("m")).first().m == ["bob_1", "ann", "y"]
