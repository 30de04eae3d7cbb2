"""Dedupe, union and incremental-merge operators.

Scale notes: ``first_per_key`` is a window partitioned by the key, so each
task sorts only the rows of its own keys (one shuffle on the key; a hot
key is still one sort group, which spills rather than failing — and the
key is the natural dedupe grain, so there is no way to split it without
changing the answer).  When only the earliest row is needed,
``first_per_key_agg`` does the same with ``min_by(struct)``, a sort
aggregate that combines map-side and never gathers a group: that is the
variant to use for skewed keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: str | list, order_by, drop_null_key: bool = False) -> DataFrame:
    """Keep the first row per key by ``order_by``; ties broken by the order columns.

    With plain ascending column names this is the combinable ``min_by``
    aggregate (skew-safe); arbitrary order expressions use a window.
    """
    keys = [key] if isinstance(key, str) else list(key)
    src = df
    if drop_null_key:
        for k in keys:
            src = src.filter(F.col(k).isNotNull())
    if all(isinstance(o, str) for o in order_by):
        return first_per_key_agg(src, keys, list(order_by))
    order = [F.col(o).asc_nulls_last() if isinstance(o, str) else o for o in order_by]
    w = Window.partitionBy(*keys).orderBy(*order)
    return src.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def first_per_key_agg(df: DataFrame, key: str | list, order_cols) -> DataFrame:
    """Earliest row per key via a combinable aggregate (skew-safe).

    ``order_cols`` are column names, compared in order (nulls last).
    """
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in df.columns if c not in keys]
    order_struct = F.struct(*[x for c in order_cols for x in (F.col(c).isNull().alias(f"{c}_null"), F.col(c))])
    payload = F.struct(*[F.col(c) for c in others])
    agg = df.groupBy(*keys).agg(F.min_by(payload, order_struct).alias("_row"))
    return agg.select(*keys, *[F.col("_row")[c].alias(c) for c in others]).select(*df.columns)


def one_per_key(df: DataFrame, key: str | list) -> DataFrame:
    """Any one row per key (use ``first_per_key`` when other columns differ)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.dropDuplicates(keys)


def union_all(*dfs: DataFrame) -> DataFrame:
    """Union by column name; columns missing on one side become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """Union and whole-row distinct."""
    return union_all(*dfs).distinct()


def difference(left: DataFrame, right: DataFrame, key: str | list) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right`` (null-safe, unlike NOT IN)."""
    keys = [key] if isinstance(key, str) else list(key)
    return left.join(right.select(*keys).distinct(), on=keys, how="left_anti")


def upsert_first_wins(existing: DataFrame, incoming: DataFrame, key: str | list,
                      order_by=None) -> DataFrame:
    """Merge where a stored row always wins over a new row with the same key.

    New rows that are not stored yet are deduped among themselves (first
    by ``order_by`` when given, else any one).  Null keys match null keys.  Idempotent: merging the
    result with the same ``incoming`` again gives the same table.
    """
    keys = [key] if isinstance(key, str) else list(key)
    stored = existing.select(*[F.col(k).alias(f"_stored_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [incoming[k].eqNullSafe(stored[f"_stored_{k}"]) for k in keys])
    fresh = incoming.join(stored, same, "left_anti")
    fresh = first_per_key(fresh, keys, order_by) if order_by else fresh.dropDuplicates(keys)
    return existing.unionByName(fresh.select(*existing.columns))
