"""Nearest neighbours by inner product with cross-polytope hashing.

Vectors are scaled by the largest norm and given one more coordinate that
makes them unit vectors, so the largest inner product is the smallest angle
(unit input keeps its own angles).  A table rotates them by three rounds of
random signs and a fast Hadamard transform and takes the nearest of ``axes``
signed axes as the bucket.  Every vector is indexed in ``tables`` tables;
a query probes its ``probes`` nearest signed axes in each (multiprobe).

Buckets are worked in blocks: candidates of a bucket are dealt by a hash
into blocks of about ``BLOCK``, queries likewise, and each pair of blocks
returns only its queries' best ``k``, reranked in double precision on the
original vectors.  So a bucket that holds a third of all vectors is many
tasks, and no bucket is capped.  Bucket counts are the only thing joined to
both sides; there are at most tables * 2 * axes of them per dimension.

Defined results: vectors that are null, empty, zero or hold null or
non-finite components take no part; vectors of different lengths are never
compared; a repeated vec_id counts once, by its best score; ties go to the
smaller vec_id; a null vec_id takes no part; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import write_table

TABLES = 8
PROBES = 16
AXES = 64
BLOCK = 4096


def _rotate(x: np.ndarray, table: int, axes: int) -> np.ndarray:
    """Rows of ``x`` after a pseudo-rotation, as coordinates on ``axes`` axes."""
    n = max(axes, 1 << max(0, x.shape[1] - 1).bit_length())
    y = np.zeros((len(x), n))
    y[:, :x.shape[1]] = x
    draw = np.random.default_rng([table, n])
    for _ in range(3):
        y *= draw.choice([-1.0, 1.0], n)
        h = 1
        while h < n:
            y = y.reshape(len(x), n // (2 * h), 2, h)
            y = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
            h *= 2
        y /= np.sqrt(n)
    return y[:, :axes]


def _buckets(x: np.ndarray, table: int, axes: int, probes: int) -> np.ndarray:
    """The ``probes`` nearest signed axes of each row, nearest first."""
    y = _rotate(x, table, axes)
    return np.argsort(-np.hstack([y, -y]), axis=1, kind="stable")[:, :probes]


def _hashed(vectors: DataFrame, kind: str, norm: float, tables: int, axes: int, probes: int, lift: bool) -> DataFrame:
    def run(batches):
        for b in batches:
            dims = b["v"].map(len)
            for d in sorted(dims.unique()):
                ids = b["id"].to_numpy()[dims == d]
                x = np.stack(b["v"][dims == d].to_numpy()).astype(kind)
                raw = pd.Series([r.tobytes() for r in x])
                y = x.astype(float) / norm
                more = np.sqrt(np.maximum(0, 1 - (y * y).sum(1, keepdims=True)))
                y = np.hstack([y, more if lift else 0 * more])
                for t in range(tables):
                    at = _buckets(y, t, axes, probes)
                    for k in range(probes):
                        yield pd.DataFrame({"dims": int(d), "t": t, "bucket": at[:, k], "id": ids, "v": raw})

    return vectors.mapInPandas(run, "dims int, t int, bucket int, id long, v binary")


def _best(k: int, kind: str):
    def run(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        c = c.drop_duplicates(["id", "v"])
        a, v = (np.stack([np.frombuffer(r, kind) for r in x["v"]]).astype(float) for x in (q, c))
        qid, vid = q["id"].to_numpy(), c["id"].to_numpy()
        out = []
        for i in range(0, len(a), 256):
            s = a[i:i + 256] @ v.T
            s[qid[i:i + 256, None] == vid] = -np.inf
            n = min(k, len(v))
            low = np.partition(s, len(v) - n, axis=1)[:, len(v) - n] - 1e-9
            r, j = np.nonzero((s >= low[:, None]) & np.isfinite(s))
            exact = (a[i + r] * v[j]).sum(1)
            order = np.lexsort((vid[j], -exact, r))
            r, j, exact = r[order], j[order], exact[order]
            place = np.arange(len(r)) - np.searchsorted(r, r)
            top = place < k
            out.append(pd.DataFrame({"query_id": qid[i + r[top]], "vec_id": vid[j[top]], "score": exact[top]}))
        return pd.concat(out)
    return run


def _in_blocks(index: DataFrame, probed: DataFrame, k: int, kind: str, block: int) -> DataFrame:
    """Per pair of a query block and a candidate block of one bucket: each query's best ``k``."""
    place = ["dims", "t", "bucket"]
    counts = index.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / block).alias("cbs")).join(
        probed.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / 1024).alias("qbs")), place)
    counts = write_table(counts, "counts")

    def dealt(side, own, other):
        d = side.join(counts, place).withColumn(own, F.pmod(F.xxhash64("id"), F.col(own + "s")))
        return d.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other + "s") - 1))).select(
            *place, "cb", "qb", "id", "v")

    key = [*place, "cb", "qb"]
    return dealt(probed, "qb", "cb").groupBy(*key).cogroup(dealt(index, "cb", "qb").groupBy(*key)).applyInPandas(
        _best(k, kind), "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, tables: int = TABLES, probes: int = PROBES, axes: int = AXES,
            block: int = BLOCK) -> DataFrame:
    """``queries`` and ``vectors`` are (id, v): per query its ``k`` nearest vectors of another id."""
    element = dict(vectors.dtypes)["v"]
    kind = "<f4" if element == "array<float>" else "<f8"

    def usable(d):
        bad = F.exists("v", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
        return d.select(F.col("id").cast("long").alias("id"), F.col("v") if kind == "<f4" else F.col("v").cast("array<double>").alias("v")) \
            .filter(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).filter(~bad) \
            .filter(F.exists("v", lambda x: x != 0)).dropDuplicates(["id", "v"])

    every = write_table(usable(vectors), "vectors")
    asked = usable(queries)
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    norm = float(np.sqrt(every.agg(F.max(square)).first()[0] or 1.0)) * (1 + 1e-12)
    index = write_table(_hashed(every, kind, norm, tables, axes, 1, True), "index")
    probed = write_table(_hashed(asked, kind, norm, tables, axes, min(probes, 2 * axes), False), "probes")
    best = ["query_id", "vec_id"]
    found = write_table(_in_blocks(index, probed, k, kind, block).groupBy(*best).agg(F.max("score").alias("score")), "found")
    # Queries that met fewer than k vectors are held against every vector of their length, in blocks too.
    full = found.groupBy("query_id").count().filter(F.col("count") >= k).select(F.col("query_id").alias("id"))
    short = probed.filter("t = 0").join(full, "id", "left_anti").select("dims", "t", F.lit(-1).alias("bucket"), "id", "v").distinct()
    short = write_table(short, "short")
    if not short.isEmpty():
        every_one = index.filter("t = 0").withColumn("bucket", F.lit(-1))
        found = found.union(_in_blocks(every_one, short, k, kind, block)).groupBy(*best).agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def query(spark, sf_dir):
    from .base import table
    v = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    return nearest(v, v.filter(F.col("id") % 20 == 0))
