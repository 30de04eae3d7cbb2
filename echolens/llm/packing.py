"""Best-fit decreasing packing of document pieces into fixed-length sequences.

Pieces are dealt by a hash into shards of about ``SHARD`` pieces.  A shard
takes its pieces from long to short and puts each into the tightest open
sequence, found in logarithmic time by a segment tree over the remaining
capacities; without one it opens a sequence.  A shard leaves at most a few
sequences half full, so many independent shards cost a small fraction of a
per cent of the sequences and no task holds more than one shard.

Defined results: null or empty text is one piece, the end id alone; long
texts are cut into full pieces, nothing is dropped; rows that repeat a
doc_id are packed each; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import LENGTH, pieces

SHARD = 20_000


class OpenBins:
    """Open sequences by remaining capacity: a segment tree that counts, and a stack of bins per leaf."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, bin_: int) -> None:
        self.bins[room].append(bin_)
        i = room + self.leaves
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, size: int) -> tuple[int, int]:
        """Remove and return (room, bin) with the least room >= size; room -1 if there is none."""
        i, count = size + self.leaves, self.count
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):
                i >>= 1
            if i <= 1:
                return -1, -1
            i += 1
            while i < self.leaves:
                i *= 2
                if not count[i]:
                    i += 1
        room = i - self.leaves
        while i:
            count[i] -= 1
            i >>= 1
        return room, self.bins[room].pop()


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every size, longest first."""
    open_, n = OpenBins(capacity), 0
    where, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for k in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[k])
        room, b = open_.take(size)
        if room < 0:
            room, b, n = capacity, n, n + 1
        where[k], offset[k] = b, capacity - room
        if room > size:
            open_.add(room - size, b)
    return where, offset


def in_shards(docs: DataFrame, cut: DataFrame, text: str, length: int, shard: int) -> DataFrame:
    """``cut`` with its shard; their number follows from the characters of all texts (about three to a token)."""
    rows, chars = docs.agg(F.count(F.lit(1)), F.sum(F.length(text))).first()
    n = max(1, round((rows + (chars or 0) / (3 * length)) / shard))
    return cut.withColumn("shard", F.pmod(F.xxhash64("uid", "piece"), F.lit(n)))


def pack(docs: DataFrame, path: str, text: str = "text", length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["uid", "piece"])
        bins, offset = best_fit_decreasing(g["length"].to_numpy(), length)
        return g.assign(sequence_id=g["shard"] * (1 << 32) + bins, offset=offset).drop(columns=["uid", "shard"])

    cut = in_shards(docs, pieces(docs, path, text, length), text, length, shard)
    return cut.groupBy("shard").applyInPandas(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def query(spark, sf_dir):
    import public_tokenizers

    from .base import table
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
