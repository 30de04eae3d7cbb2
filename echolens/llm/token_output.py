"""Packed token ids as fixed-width binary rows.

Texts are tokenised whole, overlong ones cut losslessly, the pieces packed
best-fit decreasing (see ``packing``) and written as a matrix, one row per
sequence: ``input_ids`` is ``length`` little-endian ids (two bytes each if
the vocabulary allows, else four), zero-padded; ``cu_seqlens`` are the
cumulative segment lengths from 0; ``position_resets`` the offsets at which
positions restart.  ``uids``, ``doc_ids`` and ``starts`` name each segment's
row, document and place in it, so that :func:`read_documents` gives every
document's ids back.

Defined results: as for packing; null or empty text is the end id alone.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import scratch_path
from .packing import SHARD, best_fit_decreasing, in_shards
from .tokens import LENGTH, encoder, pieces

SCHEMA = ("sequence_id long, n_tokens int, n_segments int, input_ids binary, cu_seqlens array<int>, "
          "position_resets array<int>, uids array<long>, doc_ids array<long>, starts array<long>")


def id_type(path: str) -> str:
    return "<u2" if encoder(path).tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


def packed(docs: DataFrame, path: str, text: str = "text", length: int = LENGTH, shard: int = SHARD // 4) -> DataFrame:
    kind = id_type(path)
    width = length * np.dtype(kind).itemsize

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["uid", "piece"]).reset_index(drop=True)
        bins, offset = best_fit_decreasing(g["length"].to_numpy(), length)
        order = np.lexsort((offset, bins))
        rows, base = [], int(g["shard"].iloc[0]) << 32
        uid, doc, start, size, ids = (g[c].tolist() for c in ("uid", "doc_id", "start", "length", "ids"))
        for part in np.split(order, np.flatnonzero(np.diff(bins[order])) + 1):
            cu = [0, *np.cumsum([size[i] for i in part]).tolist()]
            rows.append((base + int(bins[part[0]]), cu[-1], len(part), b"".join([ids[i] for i in part]).ljust(width, b"\0"), cu,
                         cu[:-1], [uid[i] for i in part], [None if pd.isna(doc[i]) else int(doc[i]) for i in part],
                         [start[i] for i in part]))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    cut = in_shards(docs, pieces(docs, path, text, length, kind), text, length, shard)
    return cut.groupBy("shard").applyInPandas(run, SCHEMA)


def write_packed(docs: DataFrame, path: str, out: str, **settings) -> DataFrame:
    """Write the matrix to ``out`` and return the stored table."""
    p = packed(docs, path, **settings)
    p.write.parquet(out)
    return docs.sparkSession.read.schema(p.schema).parquet(out)


def read_documents(spark: SparkSession, out: str, kind: str) -> DataFrame:
    """(uid, doc_id, ids): every document's ids, put together again from its pieces."""
    size = np.dtype(kind).itemsize

    def cut(batches):
        for b in batches:
            for ids, cu, uid, doc, start in zip(b["input_ids"], b["cu_seqlens"], b["uids"], b["doc_ids"], b["starts"]):
                yield pd.DataFrame({"uid": uid, "doc_id": pd.array(doc, "Int64"), "start": start,
                                    "part": [ids[size * s:size * e] for s, e in zip(cu[:-1], cu[1:])]})

    def join(batches):
        for b in batches:
            yield pd.DataFrame({"uid": b["uid"], "doc_id": b["doc_id"],
                                "ids": [b"".join(p["part"] for p in parts) for parts in b["parts"]]})

    parts = spark.read.parquet(out).mapInPandas(cut, "uid long, doc_id long, start long, part binary")
    one = parts.groupBy("uid", "doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "part"))).alias("parts"))
    return one.mapInPandas(join, "uid long, doc_id long, ids binary")


def query(spark, sf_dir):
    import uuid

    import public_tokenizers

    from .base import table
    stored = write_packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                          scratch_path(spark, f"packed/{uuid.uuid4().hex}"))
    return stored.select("sequence_id", "n_tokens", "n_segments", F.crc32("input_ids").alias("ids_crc32"),
                         F.array_join("cu_seqlens", ",").alias("cu_seqlens"), F.size("position_resets").alias("n_resets"))
