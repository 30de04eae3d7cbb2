"""Quality by attention-based multiple-instance learning.

A document is a bag of passages, ``PASSAGE`` characters each, over its whole
text.  Every passage is encoded by hashed byte trigrams and a few shape
measures, a layer turns that into a vector, and a gated attention (a tanh
and a sigmoid branch) weighs the vectors; the weighted sum is the document,
and a logistic unit scores it.  Only document labels are known in training:
the attention finds the passages that carry them.

The model is fitted on the driver on a bounded sample of labelled rows:
the first ``SAMPLE_ROWS`` of the training rows in hash order, as far as
they have at most ``SAMPLE_PASSAGES`` passages altogether.  Scoring runs over
every whole text inside tasks.  Scores depend on the text alone.

Defined results: null or empty text is one empty passage and is scored like
any other; very long texts are read whole, passage by passage; repeated rows
get equal scores; a null doc_id counts as training row by no means, since
it has no label; without labelled rows (or with rows of one class only) the
score is the smoothed share of label 1, (ones + 1) / (rows + 2); an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import write_table

PASSAGE = 1200
HASHED = 256
CLASSES = 8
WIDTH = HASHED + CLASSES + 3
SAMPLE_ROWS = 4000
SAMPLE_PASSAGES = 24_000
STEP = 128                                   # passages encoded, and texts unpacked, at a time
_CLASS = np.full(256, 6, np.uint8)           # other punctuation
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58] = 0, 1, 2
_CLASS[[32, 9, 11, 12, 13]], _CLASS[10], _CLASS[128:] = 3, 4, 7
_CLASS[[ord(c) for c in "#*$%&|<>"]] = 5


def passages(text: str | None) -> list[str]:
    t = text or ""
    return [t[i:i + PASSAGE] for i in range(0, len(t), PASSAGE)] or [""]


def encode(parts: list[str]) -> np.ndarray:
    """One row of ``WIDTH`` features per passage, each from its own characters only, ``STEP`` passages at a time."""
    x = np.empty((len(parts), WIDTH), np.float32)
    for i in range(0, len(parts), STEP):
        x[i:i + STEP] = _encode(parts[i:i + STEP])
    return x


def _encode(parts: list[str]) -> np.ndarray:
    raw = [p.encode("utf-8", "surrogatepass") for p in parts]
    n = np.array([len(r) for r in raw])
    b = np.frombuffer(b"\0\0".join(raw) + b"\0\0", np.uint8)
    owner = np.repeat(np.arange(len(parts)), n + 2)
    kind = np.bincount(owner * CLASSES + _CLASS[b], minlength=len(parts) * CLASSES).reshape(-1, CLASSES).astype(np.float32)
    kind[:, 6] -= 2                                                  # the two separators
    w = b.astype(np.uint32)
    tri = (w[:-2] * np.uint32(0x9E3779B1) ^ w[1:-1] * np.uint32(0x85EBCA77) ^ w[2:] * np.uint32(0xC2B2AE3D))
    tri ^= tri >> np.uint32(15)
    inside = np.concatenate(([0], np.cumsum(n + 2)))[:-1][owner[:-2]] + n[owner[:-2]] > np.arange(len(tri)) + 2
    at = owner[:-2][inside] * HASHED + (tri[inside] % np.uint32(HASHED))
    grams = np.bincount(at, minlength=len(parts) * HASHED).reshape(-1, HASHED).astype(np.float32)
    grams = np.sqrt(grams / np.maximum(grams.sum(1, keepdims=True), 1))
    shape = np.zeros((len(parts), 3), np.float32)
    for i, (p, r) in enumerate(zip(parts, raw)):
        words = p.split()
        shape[i] = (len(set(words)) / max(len(words), 1), len(zlib.compress(r, 1)) / max(len(r), 40),
                    np.log1p(len(r)) / 7)
    return np.hstack([grams * 4, kind / np.maximum(n, 1)[:, None] * 3, shape * 3]).astype(np.float32)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class GatedAttention:
    """The bag model; ``fit`` is full-batch Adam on the cross-entropy of the document labels."""

    def __init__(self, hidden: int = 32, gate: int = 16, seed: int = 3):
        r = np.random.default_rng(seed)
        def init(*shape):
            return (r.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {"W": init(WIDTH, hidden), "b": np.zeros(hidden, np.float32), "V": init(hidden, gate), "U": init(hidden, gate),
                  "w": init(gate), "c": init(hidden), "d": np.zeros(1, np.float32)}
        self.mean, self.prior = np.zeros(WIDTH, np.float32), None

    def _forward(self, x, starts, sizes):
        p = self.p
        h = np.tanh((x - self.mean) @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * g) @ p["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        a = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return h, t, g, a, z, _sigmoid(z @ p["c"] + p["d"])

    def scores(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(sizes), self.prior)
        starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        return self._forward(x, starts, sizes)[-1].astype(float)

    def fit(self, x: np.ndarray, sizes: np.ndarray, y: np.ndarray, steps: int = 150, rate: float = 0.02, decay: float = 1e-4):
        if len(set(y.tolist())) < 2:
            self.prior = (float(y.sum()) + 1) / (len(y) + 2)
            return self
        self.mean = x.mean(0)
        starts, p = np.concatenate(([0], np.cumsum(sizes)))[:-1], self.p
        m1, m2 = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
        for step in range(1, steps + 1):
            h, t, g, a, z, q = self._forward(x, starts, sizes)
            dl = ((q - y) / len(y)).astype(np.float32)
            dz = np.repeat(dl[:, None] * p["c"], sizes, axis=0)
            da = (dz * h).sum(1)
            de = a * (da - np.repeat(np.add.reduceat(a * da, starts), sizes))
            dt, dg = de[:, None] * p["w"] * g * (1 - t * t), de[:, None] * p["w"] * t * g * (1 - g)
            dh = (a[:, None] * dz + dt @ p["V"].T + dg @ p["U"].T) * (1 - h * h)
            grad = {"W": (x - self.mean).T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ de,
                    "c": z.T @ dl, "d": dl.sum(keepdims=True)}
            for k in p:
                d = grad[k] + decay * p[k]
                m1[k] = 0.9 * m1[k] + 0.1 * d
                m2[k] = 0.999 * m2[k] + 0.001 * d * d
                p[k] = (p[k] - rate * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        return self


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", rows: int = SAMPLE_ROWS,
          most: int = SAMPLE_PASSAGES) -> GatedAttention:
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("int").alias("y")).filter(
        F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("id")))
    order = [F.xxhash64("id"), F.col("id"), F.col("y")]
    sample = write_table(known.orderBy(*order).limit(rows), "sample")
    # The join keeps a bounded number of rows, also where a doc_id repeats; whole texts, none cut.
    found = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t")).join(sample, "id")
    found = write_table(found.orderBy(*order, F.xxhash64("t")).limit(rows), "sample")
    sizes = found.select("id", "y", F.xxhash64("t").alias("h"), F.greatest(F.lit(1), F.ceil(F.length("t") / PASSAGE)).alias("n")) \
        .orderBy(*order, "h").toPandas()
    fits, total = [], 0
    for n in sizes["n"]:
        fits.append(total + n <= most)
        total += n * fits[-1]
    sizes = sizes[fits]
    if not len(sizes):
        return GatedAttention().fit(np.zeros((0, WIDTH), np.float32), np.zeros(0, int), np.zeros(0, int))

    def run(batches):
        for b in batches:
            for i, y, h, t in zip(b["id"], b["y"], b["h"], b["t"]):
                parts = passages(t)
                yield pd.DataFrame({"id": [i], "y": [y], "h": [h], "n": [len(parts)], "x": [encode(parts).tobytes()]})

    # As an Arrow table it takes no Python workers on the executors.
    chosen = docs.sparkSession.createDataFrame(pa.Table.from_pandas(sizes[["id", "h"]].drop_duplicates(), preserve_index=False))
    bags = found.withColumn("h", F.xxhash64("t")).join(chosen, ["id", "h"], "left_semi").mapInPandas(
        run, "id long, y int, h long, n long, x binary").toPandas().sort_values(["id", "h", "y"])
    x = np.concatenate([np.frombuffer(v, np.float32).reshape(-1, WIDTH) for v in bags["x"]])
    return GatedAttention().fit(x, bags["n"].to_numpy(), (bags["y"] > 0).to_numpy().astype(int))


def scored(docs: DataFrame, model: GatedAttention, text="t", out: str = "score", batch: int = 500_000) -> DataFrame:
    """``docs`` with its score; several texts are encoded at once, up to ``batch`` characters (or one text).

    Texts stay in their Arrow batch until their turn, so that a task holds them once and not also as Python strings.
    """
    def score(texts) -> np.ndarray:
        parts, sizes, made, held = [], [], [], 0
        for t in texts:
            own = passages(t)
            parts += own
            held += len(t or "")
            sizes.append(len(own))
            if held > batch:
                made.append(model.scores(encode(parts), np.array(sizes)))
                parts, sizes, held = [], [], 0
        if sizes:
            made.append(model.scores(encode(parts), np.array(sizes)))
        return np.concatenate(made) if made else np.zeros(0)

    @F.arrow_udf("double")
    def udf(s: pa.Array) -> pa.Array:
        return pa.array(np.round(score(t for i in range(0, len(s), STEP) for t in s.slice(i, STEP).to_pylist()), 6))

    return docs.withColumn(out, udf(F.col(text) if isinstance(text, str) else text))


def classify(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    model = train(docs, labels, text)
    d = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("t"))
    return scored(d, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                   (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` predicted to be good, with their own columns."""
    model = train(docs, labels, text)
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    # The text is read inside the row: a second column of it would wait beside the row for its score.
    return scored(boxed, model, F.col("row")[text]).filter("score >= 0.5").select("row.*")


def query(spark, sf_dir):
    from .base import table
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
