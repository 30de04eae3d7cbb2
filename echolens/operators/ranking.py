"""Top-k, cascades, cumulative shares, batching and repeatable samples.

Scale notes: global top-k is ``orderBy(...).limit(k)``, which Spark plans
as TakeOrderedAndProject (each task keeps k rows; k rows per task reach
the final merge).  Per-group top-k is a window partitioned by the group.
Cumulative shares run the window on the k rows already selected, never
on the full table.  Batching numbers rows inside a partition key, so no
global single-task window is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def top_n_per_group(df: DataFrame, group: str | list, order_by, n: int,
                    rank_col: str | None = None, salt_buckets: int = 32, salt_key=None) -> DataFrame:
    """First ``n`` rows per group in ``order_by`` order (row_number, so exactly n when available).

    Skew-safe two-phase top-k: rows are first ranked inside (group, salt)
    slices and only each slice's top ``n`` survive, then the survivors
    (at most n x salt_buckets per group) are ranked per group.  A group
    holding a third of the table is thus sorted by ``salt_buckets`` tasks.
    ``order_by`` must be a total order (end it with a unique key) for the
    two phases to agree; ``salt_key`` (default: the whole row) picks the
    slice.
    """
    groups = [group] if isinstance(group, str) else list(group)
    order = _cols(order_by)
    src = df
    if salt_buckets and salt_buckets > 1:
        salt_src = _cols(salt_key) if salt_key is not None else [F.struct(*df.columns)]
        salt = F.pmod(F.xxhash64(*salt_src), F.lit(salt_buckets))
        src = (df.withColumn("_salt", salt)
                 .withColumn("_rn1", F.row_number().over(Window.partitionBy(*groups, "_salt").orderBy(*order)))
                 .filter(F.col("_rn1") <= n).drop("_rn1", "_salt"))
    w = Window.partitionBy(*groups).orderBy(*order)
    out = src.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    return out.withColumnRenamed("_rn", rank_col) if rank_col else out.drop("_rn")


def top_n(df: DataFrame, order_by, n: int) -> DataFrame:
    """Global top-n (TakeOrderedAndProject)."""
    return df.orderBy(*_cols(order_by)).limit(n)


def cascade_top(df: DataFrame, id_col: str, measures, k: int = 5,
                label_col: str = "main_emotion", rank_col: str = "rank_emotion",
                score_col: str = "score_emotion", materialize: bool = True) -> DataFrame:
    """Exclusive cascaded top-k: for each measure in order, the ``k`` highest rows
    whose id was not already picked by an earlier measure.

    ``rank_col`` counts up to the highest value (k = highest); ties broken by
    id ascending.  With fewer than k candidates, fewer rows are returned.
    """
    if materialize:
        # the cascade re-reads its input once per measure: cut the lineage so
        # the (one row per candidate) input is computed once
        from ..session import cut_lineage
        df = cut_lineage(df)
    picked = None
    parts = []
    for m in measures:
        cand = df if picked is None else df.join(picked, on=id_col, how="left_anti")
        top = cand.orderBy(F.col(m).desc(), F.col(id_col)).limit(k)
        w = Window.orderBy(F.col(m).desc(), F.col(id_col))
        top = top.select("*", F.lit(m).alias(label_col),
                         (F.lit(k + 1) - F.row_number().over(w)).alias(rank_col),
                         F.col(m).alias(score_col))
        parts.append(top)
        ids = top.select(id_col)
        picked = ids if picked is None else picked.unionByName(ids)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cumulative_share_top(df: DataFrame, key: str, n: int, share_col: str = "share",
                         cum_col: str = "cum_share") -> DataFrame:
    """Top ``n`` keys by row share with the running share (value_counts(normalize).cumsum().head(n)).

    Ties in count are broken by the key ascending.
    """
    src = df.filter(F.col(key).isNotNull())
    counts = src.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))
    total = counts.agg(F.sum("cnt")).scalar()
    top = counts.orderBy(F.col("cnt").desc(), F.col(key)).limit(n)
    w = Window.orderBy(F.col("cnt").desc(), F.col(key)).rowsBetween(Window.unboundedPreceding, 0)
    return (top.select(key, "cnt", (F.col("cnt") / total).alias(share_col))
               .withColumn(cum_col, F.sum(share_col).over(w))
               .withColumn("position", F.row_number().over(Window.orderBy(F.col("cnt").desc(), F.col(key)))))


def rank_in_group(df: DataFrame, id_col: str, group: str | list | None = None,
                  slices: int | None = None) -> DataFrame:
    """Add ``_rank`` (0-based position by ascending id inside the group) and ``_total``.

    Skew-safe global numbering: rows are range-partitioned by (group, id)
    into ``slices`` slices (a hot group spans many), ranked inside their
    slice, and shifted by the slice offsets taken from a per-(group, slice)
    count table (one row per slice).  No task ever holds a whole group and
    no single-task global window is used.  Ids must be unique in a group.
    """
    from ..session import cut_lineage
    groups = ([group] if isinstance(group, str) else list(group)) if group else []
    spark = df.sparkSession
    slices = slices or max(spark.sparkContext.defaultParallelism,
                           int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    # written once: the slice ids must be the same for the counts and the ranks
    ranged = cut_lineage(df.repartitionByRange(slices, *groups, id_col)
                           .withColumn("_slice", F.spark_partition_id()), large=True)
    counts = ranged.groupBy(*groups, "_slice").agg(F.count(F.lit(1)).alias("_cnt"))
    wg = (Window.partitionBy(*groups) if groups else Window).orderBy("_slice")
    wt = Window.partitionBy(*groups) if groups else Window.partitionBy()
    offsets = counts.select(
        *groups, "_slice",
        (F.sum("_cnt").over(wg.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_cnt")).alias("_off"),
        F.sum("_cnt").over(wt).alias("_total"))
    local = ranged.withColumn("_rk", F.row_number().over(
        Window.partitionBy(*groups, "_slice").orderBy(F.col(id_col))) - 1)
    j = local.join(offsets, [*groups, "_slice"])
    return j.withColumn("_rank", F.col("_off") + F.col("_rk")).drop("_slice", "_cnt", "_off", "_rk")


def row_numbers(df: DataFrame, id_col: str, name: str = "row_id") -> DataFrame:
    """Consecutive numbers from 0 in order of a unique ``id_col``, by range slices."""
    return rank_in_group(df, id_col).withColumnRenamed("_rank", name).drop("_total")


def pick_positions(df: DataFrame, id_col: str, positions, name: str = "position") -> DataFrame:
    """The rows at the given places (from 0; negative ones count from the end) in order of a unique ``id_col``."""
    r = rank_in_group(df, id_col)
    wanted = [F.lit(p) if p >= 0 else F.col("_total") + p for p in positions]
    return r.filter(F.array_contains(F.array(*[w.cast("long") for w in wanted]), F.col("_rank").cast("long"))).withColumnRenamed(
        "_rank", name).drop("_total")


def fixed_size_batches(df: DataFrame, id_col: str, size: int, group: str | list | None = None,
                       batch_col: str = "batch", slices: int | None = None) -> DataFrame:
    """Number consecutive ids (ascending) into batches of ``size`` inside each group
    (the last batch of a group may be shorter)."""
    r = rank_in_group(df, id_col, group, slices)
    return r.withColumn(batch_col, F.floor(F.col("_rank") / size).cast("long")).drop("_rank", "_total")


def near_equal_chunks(df: DataFrame, id_col: str, n: int, group: str | list,
                      chunk_col: str = "chunk", slices: int | None = None) -> DataFrame:
    """Split each group into ``n`` near-equal chunks by ascending id; the first
    chunks get one extra row (the numbering of SQL ``ntile``).  Skew-safe
    (see ``rank_in_group``)."""
    r = rank_in_group(df, id_col, group, slices)
    k = F.col("_rank")
    q = F.floor(F.col("_total") / n)
    rem = F.col("_total") % n
    big = rem * (q + 1)
    chunk = F.when(k < big, F.floor(k / (q + 1))).otherwise(rem + F.floor((k - big) / F.greatest(q, F.lit(1))))
    return r.withColumn(chunk_col, chunk.cast("int")).drop("_rank", "_total")


def repeatable_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows chosen by a seeded hash of the key: the same rows at any
    partitioning, on any engine (MD5 of 'seed:key', a standard digest any SQL
    engine can recompute).  A top-n, so each task keeps only n rows."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.orderBy(h, F.col(key)).limit(n)
