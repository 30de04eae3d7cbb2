"""Frequency shares, within-group shares and wide pivots.

Scale notes: counts are hash aggregates with map-side combine.  Totals
are scalar subqueries over the aggregated counts (no join) or a window over
the already aggregated counts (one row per group value, not per input row).  Pivots always list their values, so the wide schema is
fixed and no extra job is run to discover the values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """Count per non-null value, largest first."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))
              .orderBy(F.col(name).desc(), F.col(col)))


def share(df: DataFrame, col: str, name: str = "prop") -> DataFrame:
    """Share of each non-null value among the non-null rows."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()   # scalar subquery over the counts: no join
    return counts.select(col, (F.col("_n") / total).alias(name))


def share_within(df: DataFrame, group: str | list, col: str, name: str = "prop",
                 distinct_id: str | None = None) -> DataFrame:
    """Share of each ``col`` value inside each ``group`` (null keys dropped).

    ``distinct_id`` counts distinct ids instead of rows.
    """
    groups = [group] if isinstance(group, str) else list(group)
    src = df
    for k in groups + [col]:
        src = src.filter(F.col(k).isNotNull())
    cnt = F.count_distinct(distinct_id) if distinct_id else F.count(F.lit(1))
    counts = src.groupBy(*groups, col).agg(cnt.alias("_n"))
    w = Window.partitionBy(*groups)
    return counts.select(*groups, col, (F.col("_n") / F.sum("_n").over(w)).alias(name))


def pivot_wide(df: DataFrame, index: str | list, pivot_col: str, value_col: str, values,
               names=None) -> DataFrame:
    """Long -> wide with an explicit value list; a missing cell is null."""
    idx = [index] if isinstance(index, str) else list(index)
    wide = df.groupBy(*idx).pivot(pivot_col, list(values)).agg(F.first(value_col))
    if names:
        for v, n in zip(values, names):
            wide = wide.withColumnRenamed(str(v), n)
    return wide


def row_normalise(df: DataFrame, cols) -> DataFrame:
    """Divide each of ``cols`` by the row sum (nulls count as 0; a null cell stays null)."""
    tot = None
    for c in cols:
        v = F.coalesce(F.col(f"`{c}`"), F.lit(0))
        tot = v if tot is None else tot + v
    others = [F.col(f"`{c}`") for c in df.columns if c not in cols]
    return df.select(*others, *[F.try_divide(F.col(f"`{c}`").cast("double"), tot).alias(c) for c in cols])


def order_columns_by_total(df: DataFrame, lead, cols, descending: bool = True) -> DataFrame:
    """Reorder ``cols`` by their column sums (a tiny driver-side collect of len(cols) numbers)."""
    sums = df.agg(*[F.sum(F.col(f"`{c}`")).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    order = sorted(range(len(cols)), key=lambda i: (sums[i] is None, -(sums[i] or 0) if descending
                                                    else (sums[i] or 0)))
    lead = [lead] if isinstance(lead, str) else list(lead)
    return df.select(*[F.col(f"`{c}`") for c in lead], *[F.col(f"`{cols[i]}`") for i in order])
