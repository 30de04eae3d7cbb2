"""Emotion lift: group mean of each measure divided by a baseline mean.

Two baselines exist: (a) the global mean over all rows, (b) the mean over
all rows of the same period (e.g. the month).  Both are row-weighted means
built from sums and counts, never an average of averages.

Scale notes
-----------
* Every group-by is a hash aggregate with a map-side partial step, so the
  shuffle carries one row per (task, group), not one per input row.
* The global baseline is a one-row aggregate used as scalar subqueries
  (no join at all).
* ``lift_cube`` answers all key sets in ONE pass over the facts: the few
  sets that no other contains are aggregated together (sums and counts, map
  side first), the rest are rolled up from the smallest of those.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import EMOTIONS
from ..session import cut_lineage


def _sums(measures, id_col):
    aggs = [F.count(F.col(id_col)).alias("n")]
    for m in measures:
        aggs += [F.sum(m).alias(f"_s_{m}"), F.count(m).alias(f"_c_{m}")]
    return aggs


def _resum(measures):
    aggs = [F.sum("n").alias("n")]
    for m in measures:
        aggs += [F.sum(f"_s_{m}").alias(f"_s_{m}"), F.sum(f"_c_{m}").alias(f"_c_{m}")]
    return aggs


def _means(df: DataFrame, measures, prefix: str = "") -> DataFrame:
    cols = [c for c in df.columns if not c.startswith("_s_") and not c.startswith("_c_")]
    return df.select(*cols, *[F.try_divide(F.col(f"_s_{m}"), F.col(f"_c_{m}")).alias(prefix + m)
                              for m in measures])


def global_means(df: DataFrame, measures=EMOTIONS) -> DataFrame:
    """One row: the mean of each measure over all rows (nulls skipped)."""
    return df.agg(*[F.avg(m).alias(m) for m in measures])


def group_means(df: DataFrame, keys, measures=EMOTIONS, id_col: str = "tweetId",
                drop_null_keys: bool = True) -> DataFrame:
    """Per group: mean of each measure and the non-null count of ``id_col`` as ``n``."""
    src = df
    if drop_null_keys:
        for k in keys:
            src = src.filter(F.col(k).isNotNull())
    g = src.groupBy(*keys).agg(*_sums(measures, id_col))
    return _means(g, measures)


def _not_null(keys):
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def _once(agg: DataFrame, materialize: bool) -> DataFrame:
    """The group aggregate feeds both the groups and their baseline; with
    ``materialize`` it is written once to the shared checkpoint folder (it
    has one row per group, far smaller than the facts) instead of the facts
    being scanned and joined once per consumer."""
    return cut_lineage(agg) if materialize else agg


def _null_flag(keys, name: str):
    """Per-group flag 'some key is null', computed inside the aggregate.

    Filtering on it (instead of on the keys) keeps the optimizer from pushing
    the null filter below the aggregate, so the aggregate's exchange stays
    identical for all its consumers and is computed once.
    """
    return F.max(~_not_null(keys)).alias(name)


def _base_from(agg: DataFrame, measures, prefix: str) -> DataFrame:
    """Row-weighted means from an aggregate of sums and counts (one row)."""
    return agg.agg(*[F.try_divide(F.sum(f"_s_{m}"), F.sum(f"_c_{m}")).alias(f"{prefix}{m}")
                     for m in measures])


def emotion_lift(df: DataFrame, keys, measures=EMOTIONS, id_col: str = "tweetId",
                 baseline_keys=None, keep_means: bool = True, digits: int | None = None,
                 materialize: bool = True) -> DataFrame:
    """Lift of each measure for the groups ``keys``.

    ``baseline_keys`` None -> global mean; else the mean over all rows that
    share the baseline keys (e.g. ``['dsm']`` for the same month).  Output:
    keys, n, the group means (``keep_means``), and ``lift_<m>`` for each
    measure, rounded half-even to ``digits`` when given.

    One pass over ``df``: groups are aggregated with their null-key groups
    kept, the baseline is rolled up from that aggregate (so it still covers
    every row), and only then are null-key groups dropped.
    """
    flags = [_null_flag(keys, "_nk")] + ([_null_flag(baseline_keys, "_nb")] if baseline_keys else [])
    agg = _once(df.groupBy(*keys).agg(*_sums(measures, id_col), *flags), materialize)
    grp = _means(agg.filter(~F.col("_nk")).drop("_nk", "_nb"), measures)
    if not baseline_keys:
        # the global means enter as ONE scalar subquery (a struct) over the aggregate
        base = _base_from(agg, measures, "_g_").select(F.struct("*").alias("b")).scalar()
        joined = grp.select("*", *[base.getField(f"_g_{m}").alias(f"_g_{m}") for m in measures])
    elif set(baseline_keys) <= set(keys):
        b = _means(agg.filter(~F.col("_nb")).groupBy(*baseline_keys).agg(*_resum(measures)),
                   measures).select(*baseline_keys, *[F.col(m).alias(f"_g_{m}") for m in measures])
        joined = grp.join(b, on=list(baseline_keys), how="inner")
    else:
        b = group_means(df, baseline_keys, measures, id_col).select(
            *baseline_keys, *[F.col(m).alias(f"_g_{m}") for m in measures])
        joined = grp.join(b, on=list(baseline_keys), how="inner")
    lifts = []
    for m in measures:
        v = F.try_divide(F.col(m), F.col(f"_g_{m}"))
        lifts.append((F.bround(v, digits) if digits is not None else v).alias(f"lift_{m}"))
    keep = list(keys) + ["n"] + (list(measures) if keep_means else [])
    return joined.select(*keep, *lifts)


def lift_vs_period(df: DataFrame, keys, period_keys, measures=EMOTIONS,
                   id_col: str = "tweetId", materialize: bool = True,
                   group_suffix: str = "_group") -> DataFrame:
    """Group means next to the period-wide means (suffixes _group / _general) and their ratio.

    When the period keys are among the group keys, both come from one
    aggregate (null keys kept until the roll-up), i.e. one pass over ``df``.
    """
    if set(period_keys) <= set(keys):
        agg = _once(df.groupBy(*keys).agg(*_sums(measures, id_col), _null_flag(keys, "_nk"),
                                          _null_flag(period_keys, "_nb")), materialize)
        grp = _means(agg.filter(~F.col("_nk")).drop("_nk", "_nb"), measures)
        gen = _means(agg.filter(~F.col("_nb")).groupBy(*period_keys).agg(*_resum(measures)),
                     measures).drop("n")
    else:
        grp = group_means(df, keys, measures, id_col)
        gen = group_means(df, period_keys, measures, id_col).drop("n")
    j = grp.select(*keys, "n", *[F.col(m).alias(f"{m}{group_suffix}") for m in measures]).join(
        gen.select(*period_keys, *[F.col(m).alias(f"{m}_general") for m in measures]),
        on=list(period_keys), how="inner")
    return j.select("*", *[F.try_divide(F.col(f"{m}{group_suffix}"), F.col(f"{m}_general")).alias(f"lift_{m}")
                           for m in measures])


# The published key sets of the lift cube.
LIFT_SETS = {
    "c0": ["country", "theme", "subtheme", "news_prevalent_emotion"],
    "c1": ["country", "theme", "subtheme"],
    "c2": ["country", "theme"],
    "c3": ["country"],
    "c31": ["continent", "country", "dsm"],
    "c4": ["theme"],
    "c41": ["theme", "country"],
    "c42": ["theme", "dsw"],
    "c5": ["subtheme"],
    "c51": ["subtheme", "country"],
    "c52": ["subtheme", "news_prevalent_emotion"],
    "c6": ["news_prevalent_emotion"],
    "c61": ["news_prevalent_emotion", "country"],
    "c7": ["dsw"],
    "c8": ["continent"],
    "c81": ["continent", "dsm"],
    "c9": ["continent", "country", "news_id"],
}


def _families(sets) -> list[frozenset]:
    """The key sets that no other set contains: every set can be rolled up from one of them."""
    return [ks for ks in sets if not any(ks < other for other in sets)]


def _grouping_sets(df: DataFrame, sets, keys, aggs, name: str) -> DataFrame:
    """``aggs`` for every key set of ``sets`` in one pass; ``name`` numbers the set of each row."""
    out = df.groupingSets([[F.col(k) for k in keys if k in ks] for ks in sets], *[F.col(k) for k in keys]).agg(
        *aggs, *[F.grouping(k).alias(f"_g_{k}") for k in keys])
    number = F.lit(None).cast("int")
    for i, ks in enumerate(sets):
        here = reduce(lambda a, b: a & b, [F.col(f"_g_{k}") == (0 if k in ks else 1) for k in keys])
        number = F.when(here, F.lit(i)).otherwise(number)
    return out.withColumn(name, number).drop(*[f"_g_{k}" for k in keys])


def lift_cube(df: DataFrame, sets: dict | None = None, measures=EMOTIONS,
              id_col: str = "tweetId", materialize: bool = True) -> DataFrame:
    """All lift key sets from one pass over ``df``, rolled up along the lattice of the sets.

    The sets that no other set contains head a family each and are
    aggregated together from the rows; every other set is rolled up from
    the smallest head that contains it, by measured size.  So no aggregate
    combines keys that no set combines (account, week and month, say), and
    the roll-ups read group tables, not facts.

    Output: ``set_name``, the union of all key columns (null where a key is
    not part of the set), ``n``, the means and ``lift_<m>`` against the
    global means.  Per set, groups whose key is null are dropped, as a
    plain group-by over that set would drop them.
    """
    sets = sets or LIFT_SETS
    all_keys = list(dict.fromkeys(k for ks in sets.values() for k in ks))
    by_keys: dict[frozenset, list[str]] = {}      # sets with the same keys (c2 and c41) are computed once
    for nm, ks in sets.items():
        by_keys.setdefault(frozenset(ks), []).append(nm)
    heads = _families(by_keys)
    groups = _once(_grouping_sets(df, heads, all_keys, _sums(measures, id_col), "_head"), materialize)
    rows = {r["_head"]: r["count"] for r in groups.groupBy("_head").count().collect()}    # one row per head
    size = {i: rows.get(i, 0) for i in range(len(heads))}
    children: dict[int, list[frozenset]] = {}
    for ks in by_keys:
        if ks not in heads:
            children.setdefault(min((i for i, h in enumerate(heads) if ks < h), key=size.get), []).append(ks)

    parts = []
    for i, head in enumerate(heads):
        keys, members = [k for k in all_keys if k in head], [head, *children.get(i, [])]
        rolled = groups.filter(F.col("_head") == i)
        if len(members) > 1:
            rolled = _grouping_sets(rolled, members, keys, _resum(measures), "_set")
        else:
            rolled = rolled.withColumn("_set", F.lit(0))
        names = F.array(*[F.array(*[F.lit(n) for n in by_keys[ks]]) for ks in members])
        whole = F.get(F.array(*[_not_null(sorted(ks)) for ks in members]), F.col("_set"))
        parts.append(rolled.filter(whole).select(
            F.explode(F.get(names, F.col("_set"))).alias("set_name"),
            *[F.col(k) if k in head else F.lit(None).cast(df.schema[k].dataType).alias(k) for k in all_keys], "n",
            *[c for c in groups.columns if c.startswith(("_s_", "_c_"))]))
    means = _means(reduce(DataFrame.unionByName, parts), measures)
    # every head covers all rows, so the smallest one gives the global baseline
    base = _base_from(groups.filter(F.col("_head") == min(size, key=size.get)), measures, "_b_").select(
        F.struct("*").alias("b")).scalar()
    return means.select("*", *[base.getField(f"_b_{m}").alias(f"_b_{m}") for m in measures]).select(
        "set_name", *all_keys, "n", *measures,
        *[F.try_divide(F.col(m), F.col(f"_b_{m}")).alias(f"lift_{m}") for m in measures])
