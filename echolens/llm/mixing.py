"""Mixing sources to target weights by pivotal dependent rounding.

Each source has a target in words.  A document's expected number of copies
is its source's target divided by the source's size; the whole part is
taken, the fraction is settled by pivotal rounding: two open fractions are
paired, words move at random from one to the other until one of them is a
whole copy, and the other carries on.  The move keeps the pair's words and
each document's expectation.  It runs as a reduction tree: documents of a
source are dealt into groups of about ``GROUP`` by a hash, each group ends
with at most one open fraction, and these meet in the next level until one
per source is left; that last one is rounded to the nearest whole copy.  So
a source's words differ from its target by half a document at most, and no
task holds more than a few groups.

Draws are seeded by source, level and group and a group is worked in the
order of falling size (then doc_id), so that the fraction left open tends to
be a short document's; reruns agree, however the rows are partitioned.

Defined results: null text has size 0 and takes 0 words; a null source is a
source, the last; sources without words have target 0; rows that repeat
(doc_id, source, size) are one unit whose copies are settled together and
dealt evenly over them, however many they are; an empty table gives an empty
result; other columns are not read by :func:`mix`, and
:func:`mixed_documents` returns all of them untouched.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import rank_in_group
from .base import WORD, write_table

GROUP = 4096
WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2.0
CHUNK = 1 << 16     # rows of a unit that are written out at a time


def sizes(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def units(sized: DataFrame) -> DataFrame:
    """(doc_id, source, size, rows): equal rows folded into one, stored."""
    return write_table(sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows")), "units")


def targets(folded: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """(source, source_size, n_docs, target): shares by weight, stopped at ``limit`` times the size.

    The level of words per unit of weight is raised until the excess of the
    stopped sources is reshared; each step is one aggregate over the sources.
    """
    by_source = write_table(folded.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"),
                                                         F.count(F.lit(1)).alias("n_docs")), "sources")
    # One row per source: sorted in one task, as their weights follow from their places.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place % len(weights) + 1)
    s = write_table(by_source.withColumn("weight", weight), "weights")
    cap = F.col("source_size") * limit
    total = share * (s.agg(F.sum("source_size")).first()[0] or 0)
    level = -1.0
    while True:
        full = F.col("weight") * level >= cap if level >= 0 else F.lit(False)
        w, held = s.agg(F.sum(F.when(~full, F.col("weight"))), F.sum(F.when(full, cap))).first()
        new = (total - (held or 0.0)) / w if w else level
        if new <= level:
            break
        level = new
    return s.select("source", "source_size", "n_docs", F.least(cap, F.col("weight") * max(level, 0.0)).alias("target"))


def pivot(size: np.ndarray, part: np.ndarray, draw: np.random.Generator) -> tuple[np.ndarray, int]:
    """Settle the fractions ``part`` of copies of ``size`` words pair by pair; returns (fractions, the open one or -1)."""
    part = part.astype(float).copy()
    at = -1
    u = draw.random(len(part))
    for i in range(len(part)):
        if part[i] <= 0.0 or part[i] >= 1.0:
            continue
        if at < 0:
            at = i
            continue
        up = min((1 - part[at]) * size[at], part[i] * size[i])        # words that may move from i to the open one
        down = min(part[at] * size[at], (1 - part[i]) * size[i])      # ... and back
        if u[i] * (up + down) < down:
            move, whole_open, whole_i = up, (1 - part[at]) * size[at] <= part[i] * size[i], part[i] * size[i] <= up
        else:
            move, whole_open, whole_i = -down, part[at] * size[at] <= (1 - part[i]) * size[i], (1 - part[i]) * size[i] <= down
        part[at] += move / size[at]
        part[i] -= move / size[i]
        if whole_open:
            part[at] = round(part[at])
        if whole_i:
            part[i] = round(part[i])
        if whole_open and whole_i:
            at = -1
        elif whole_open:
            at = i
    return part, at


def _level(level: int, last: bool, seed: int):
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["size", "doc_id"], ascending=[False, True], kind="stable").reset_index(drop=True)
        name = f"{seed}|{level}|{g['source'].iloc[0]!r}|{g['bucket'].iloc[0]}"
        part, at = pivot(g["size"].to_numpy(float), g["part"].to_numpy(), np.random.default_rng(zlib.crc32(name.encode())))
        if last and at >= 0:
            part[at], at = float(part[at] >= 0.5), -1
        return g.assign(part=part, open=np.arange(len(g)) == at)
    return run


def drawn(folded: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT, seed: int = 7,
          group: int = GROUP) -> DataFrame:
    """Per unit: doc_id, source, size, rows, source_size, target and ``copies``, those of all its rows together."""
    t = write_table(targets(folded, weights, share, limit), "targets")
    levels, n = 1, t.agg(F.max("n_docs")).first()[0] or 0
    while n > group:
        n, levels = -(-n // group), levels + 1
    d = folded.join(t, folded["source"].eqNullSafe(t["source"])).drop(t["source"])
    ratio = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)) * F.col("rows")
    open_rows = d.select("doc_id", "source", "size", "rows", "source_size", "target", F.floor(ratio).alias("whole"),
                         (ratio - F.floor(ratio)).alias("part"), F.lit(True).alias("open"), F.col("n_docs").alias("left"))
    schema = ("doc_id long, source string, size long, rows long, source_size long, target double, whole long, part double, "
              "open boolean, left long, bucket long")
    done = None
    for level in range(levels):
        groups = F.ceil(F.col("left") / group)
        last = level == levels - 1
        dealt = open_rows.withColumn("bucket", F.when(F.lit(last), F.lit(0)).otherwise(
            F.pmod(F.xxhash64("doc_id", "size", F.lit(level)), F.greatest(groups, F.lit(1)))).cast("long")).withColumn("left", groups)
        worked = write_table(dealt.groupBy("source", "bucket").applyInPandas(_level(level, last, seed), schema), "level")
        settled = worked.filter("NOT open")
        done = settled if done is None else done.union(settled)
        open_rows = worked.filter("open").drop("bucket")
    return done.select("doc_id", "source", "size", "rows", "source_size", "target",
                       (F.col("whole") + F.round("part").cast("long")).alias("copies"))


def _dealt(i):
    """Copies of row ``i`` (from 0) of a unit: its ``copies`` spread evenly over its ``rows``."""
    return F.floor((i + 1) * F.col("copies") / F.col("rows")) - F.floor(i * F.col("copies") / F.col("rows"))


def mix(sized: DataFrame, **settings) -> DataFrame:
    """Per row of ``sized`` (doc_id, source, size): source_size, target, copies, taken."""
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / CHUNK)))
    d = drawn(units(sized), **settings).withColumn("chunk", chunk)
    d = d.withColumn("i", F.explode(F.sequence(F.col("chunk") * CHUNK, F.least(F.col("rows"), (F.col("chunk") + 1) * CHUNK) - 1)))
    return d.select("doc_id", "source", "size", "source_size", "target", _dealt(F.col("i")).cast("long").alias("copies")).withColumn(
        "taken", F.col("copies") * F.col("size"))


def mixed_documents(docs: DataFrame, text: str = "text", **settings) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken."""
    m = drawn(units(sizes(docs, text)), **settings).filter("copies > 0")
    m = write_table(m.select(F.struct("doc_id", "source", "size").alias("k"), "rows", "copies"), "copies")
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.struct(F.col("doc_id").cast("long").alias("doc_id"),
                                 F.col("source").cast("string").alias("source"),
                                 F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size")).alias("key"))

    def met(part):
        """Rows with their unit; joined in one way at every size of the table."""
        return boxed.join(part.hint("merge"), F.col("key").eqNullSafe(F.col("k"))).select("row", "k", "rows", "copies")

    def repeated(rows, n):
        return rows.withColumn("n", F.explode(F.sequence(F.lit(1).cast("long"), n))).select("row.*")

    out = repeated(met(m.filter("rows = 1")), F.col("copies"))
    many = m.filter("rows > 1")
    if not many.isEmpty():
        numbered = write_table(met(many).withColumn("id", F.monotonically_increasing_id()).withColumn("unit", F.to_json("k")), "repeated")
        placed = rank_in_group(numbered, "id", "unit").withColumn("n", _dealt(F.col("_rank")).cast("long")).filter("n > 0")
        out = out.unionByName(repeated(placed, F.col("n")))
    return out


def query(spark, sf_dir):
    from .base import table
    return mix(sizes(table(spark, sf_dir, "documents"))).select("doc_id", "size", "source_size", "target", "taken")
