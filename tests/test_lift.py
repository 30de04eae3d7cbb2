import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from echolens.operators import lift as L

EM = ["anger", "sadness", "optimism", "joy"]


def _frame(spark, n=400, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        country = rnd.choice(["NG", "US", "UK", None])
        theme = rnd.choice([1, 2, 5])
        dsm = rnd.choice(["2020-10-01", "2020-11-01"])
        dsw = rnd.choice(["2020-10-04", "2020-10-11", "2020-11-08"])
        v = [rnd.random() for _ in EM]
        rows.append((i, country, theme, theme * 10 + rnd.choice([0, 1]), rnd.choice(["anger", "joy", "undefined"]),
                     "Africa" if country == "NG" else ("America" if country == "US" else "Europe"),
                     dsm, dsw, rnd.choice([10, 11, 12]), *v))
    schema = ("tweetId long, country string, theme int, subtheme int, news_prevalent_emotion string, "
              "continent string, dsm string, dsw string, news_id long, " + ", ".join(f"{m} double" for m in EM))
    return spark.createDataFrame(rows, schema), pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])


def test_lift_matches_pandas_and_drops_null_keys(spark):
    df, pdf = _frame(spark)
    got = L.emotion_lift(df, ["country"]).toPandas().set_index("country").sort_index()
    g = pdf[EM].mean()
    want = pdf.groupby("country").agg({**{m: "mean" for m in EM}, "tweetId": "count"})
    assert list(got.index) == sorted(want.index)          # null country dropped
    for m in EM:
        assert got[f"lift_{m}"].round(9).tolist() == (want[m] / g[m]).round(9).tolist()
    assert got["n"].tolist() == want["tweetId"].tolist()


def test_weighted_lift_mean_is_one(spark):
    df, pdf = _frame(spark)
    got = L.emotion_lift(df, ["theme"]).toPandas()
    for m in EM:
        assert abs((got[f"lift_{m}"] * got["n"]).sum() / got["n"].sum() - 1) < 1e-9


def test_period_baseline_is_row_weighted(spark):
    df, pdf = _frame(spark)
    got = L.lift_vs_period(df, ["continent", "dsm"], ["dsm"]).toPandas()
    gen = pdf.groupby("dsm")[EM].mean()
    for _, r in got.iterrows():
        assert abs(r["anger_general"] - gen.loc[r["dsm"], "anger"]) < 1e-12


def test_cube_equals_separate_groupbys(spark):
    df, pdf = _frame(spark)
    cube = L.lift_cube(df).toPandas()
    for name, keys in L.LIFT_SETS.items():
        part = cube[cube.set_name == name]
        single = L.emotion_lift(df, keys).toPandas()
        assert len(part) == len(single), name
        merged = part.merge(single, on=keys, suffixes=("", "_s"))
        assert len(merged) == len(single)
        for m in EM:
            assert ((merged[f"lift_{m}"] - merged[f"lift_{m}_s"]).abs() < 1e-9).all()
        assert (merged["n"] == merged["n_s"]).all()


def test_cube_families(spark):
    sets = {frozenset(ks) for ks in L.LIFT_SETS.values()}
    heads = L._families(sets)
    assert len(heads) == 4 and all(any(ks <= h for h in heads) for ks in sets)
    df, _ = _frame(spark)
    cube = L.lift_cube(df, {"a": ["theme", "country"], "b": ["country", "theme"], "c": ["theme"], "d": ["continent"]})
    got = {r.set_name: r["count"] for r in cube.groupBy("set_name").count().collect()}
    assert got["a"] == got["b"] and set(got) == set("abcd")
    assert L.lift_cube(df.limit(0), {"a": ["theme", "country"], "c": ["theme"]}).count() == 0
