from hypothesis import given, settings, strategies as st

from pyspark.sql import functions as F

from echolens.operators import shares as S


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["NG", "US", None]), st.sampled_from(["anger", "joy", "undefined", None])),
                min_size=1, max_size=60))
def test_shares_sum_to_one(spark, rows):
    df = spark.createDataFrame([(i, c, l) for i, (c, l) in enumerate(rows)], "id long, country string, label string")
    within = S.share_within(df, "country", "label").groupBy("country").agg(F.sum("prop").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-9 for r in within)
    assert all(r.country is not None for r in within)
    glob = S.share(df, "label").agg(F.sum("prop").alias("s")).first().s
    if any(l is not None for _, l in rows):
        assert abs(glob - 1) < 1e-9
    counts = df.filter(F.col("country").isNotNull() & F.col("label").isNotNull()).groupBy("country", "label").count()
    wide = S.row_normalise(S.pivot_wide(counts, "country", "label", "count", ["anger", "joy", "undefined"]),
                           ["anger", "joy", "undefined"])
    for r in wide.collect():
        vals = [r[c] for c in ["anger", "joy", "undefined"] if r[c] is not None]
        assert abs(sum(vals) - 1) < 1e-9
