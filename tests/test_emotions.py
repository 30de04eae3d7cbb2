import math

from pyspark.sql import functions as F

from echolens.functions.emotions import (argmax_label, decode_subtheme, max_score, prevalent_emotion,
                                         softmax_rounded)
from echolens.schemas import SUBTHEME_CODES


def test_prevalent_tie_threshold_null(spark):
    rows = [
        (1, 0.6, 0.1, 0.2, 0.1),      # anger
        (2, 0.3, 0.3, 0.3, 0.1),      # max not > 0.5 -> undefined
        (3, 0.5, 0.2, 0.2, 0.1),      # exactly 0.5 -> undefined
        (4, 0.55, 0.55, 0.0, 0.0),    # tie anger/joy -> anger (first in argmax order)
        (5, 0.0, 0.7, 0.7, 0.0),      # tie joy/optimism -> joy
        (6, None, None, None, None),  # skipped row
        (7, 0.1, 0.1, 0.2, 0.6),      # sadness
        (8, float("nan"), 0.6, 0.1, 0.1),  # NaN ignored
    ]
    df = spark.createDataFrame(rows, "id int, anger double, joy double, optimism double, sadness double")
    out = {r.id: (r.p, r.m, r.a) for r in df.select(
        "id", prevalent_emotion().alias("p"), max_score().alias("m"), argmax_label().alias("a")).collect()}
    assert out[1][0] == "anger"
    assert out[2][0] == "undefined" and out[2][2] == "anger"
    assert out[3][0] == "undefined"
    assert out[4][0] == "anger"
    assert out[5][0] == "joy"
    assert out[6][0] == "undefined" and out[6][1] is None and out[6][2] is None
    assert out[7][0] == "sadness"
    assert out[8][0] == "joy" and math.isclose(out[8][1], 0.6)


def test_subtheme_decode(spark):
    cols = ", ".join(f"subtheme{c} boolean" for c in SUBTHEME_CODES)
    base = {c: False for c in SUBTHEME_CODES}
    none = dict(base)
    two = {**base, 61: True, 64: True}
    one = {**base, 73: True}
    rows = [(1, 6, *none.values()), (2, 6, *two.values()), (3, 7, *one.values())]
    df = spark.createDataFrame(rows, f"id int, theme int, {cols}")
    got = {r.id: r.s for r in df.select("id", decode_subtheme().alias("s")).collect()}
    assert got == {1: 60, 2: 61, 3: 73}


def test_softmax_rounded(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 0.5],)], "l array<double>")
    got = df.select(softmax_rounded("l").alias("p")).first().p
    ex = [math.exp(x - 3.0) for x in [1.0, 2.0, 3.0, 0.5]]
    want = [round(x / sum(ex), 3) for x in ex]
    assert got == want
    assert abs(sum(got) - 1) < 0.005
