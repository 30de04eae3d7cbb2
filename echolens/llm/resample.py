"""Target-distribution importance resampling with an Aho-Corasick word dictionary.

A text's features are its runs of ``lo`` to ``hi`` consecutive words, joined by one space; a feature's bucket is its
CRC-32 modulo ``buckets``.  Words stand between delimiters, so the dictionary holds each distinct word with a space
on both sides, and its payload is the word's checksum and length.  One scan of the automaton emits the payloads of a
text's words in order; the checksum of a run of words is composed from the payloads of its neighbours
(:mod:`echolens.llm.crc`), and no feature is ever built as a string.

The dictionary is learnt by each worker process from the texts it scans: words met twice join it until it holds
``WORDS`` of at most ``LONGEST`` bytes, which bounds its memory.  Words outside it stand in the gaps between matches
and get their payload there, so its contents change the cost and no result.

Steps: the scan writes one row per text with its buckets as fixed-width binary; bucket counts are summed per task
before they are shuffled; gains (one per bucket, a parameter's number of them) go to all tasks; weights are sums of
gains; scores add Gumbel noise that a seeded digest of the id fixes, so reruns agree; and the highest are numbered by
range slices, so that no task holds all of them.

Defined results: null or empty texts have no features and weight 0; repeated rows each count, score alike and are
numbered one after the other; a null id is hashed as the empty text and comes last among ties; an empty target makes
every gain depend on the source alone; an empty source gives an empty result; texts of any length are scanned whole,
in segments cut at delimiters; other columns are not read, so their names can't clash.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import rank_in_group
from .base import table, write_table
from .crc import SPACE, combine, crc_sql

BUCKETS = 10_000
WORDS = 50_000          # words of a worker's dictionary
LONGEST = 64            # bytes of the longest word in it
SEGMENT = 1 << 20       # bytes scanned at a time
_DELIMIT = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_DICTIONARY: list = []


class Dictionary:
    """Delimiter-bounded words with ``length << 32 | checksum`` as payload."""

    def __init__(self, words: int = WORDS):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        self.limit, self.met = words, Counter()

    def learn(self) -> None:
        """Take up the words met twice since the last time."""
        known = len(self.automaton)
        for w, n in self.met.most_common(self.limit - known):
            if n < 2:
                break
            self.automaton.add_word(f" {w.decode('latin-1')} ", len(w) << 32 | zlib.crc32(w))
        self.met = Counter()
        if len(self.automaton) > known:
            self.automaton.make_automaton()

    def payloads(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(starts, payloads) of the words of ``text``, lower-cased, every delimiter a space, a space at both ends."""
        gap = np.frombuffer(text, np.uint8) == 32
        starts = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
        out = np.zeros(len(starts), np.int64)
        if len(self.automaton):
            found = list(self.automaton.iter(text.decode("latin-1")))
            if found:
                end, value = np.array(found, np.int64).T
                out[np.searchsorted(starts, end - (value >> 32))] = value
        missed = np.flatnonzero(out == 0)
        if len(missed):
            ends = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
            words = [text[s:e] for s, e in zip(starts[missed].tolist(), ends[missed].tolist())]
            out[missed] = [len(w) << 32 | zlib.crc32(w) for w in words]
            if len(self.automaton) < self.limit:
                self.met.update(w for w in words if len(w) <= LONGEST)
                if len(self.met) > max(1 << 14, len(self.automaton)):
                    self.learn()
        return starts, out


def dictionary() -> Dictionary:
    if not _DICTIONARY:
        _DICTIONARY.append(Dictionary())
    return _DICTIONARY[0]


def delimited(text: str | None) -> bytes:
    return b" " + (text or "").encode("utf-8", "surrogatepass").translate(_DELIMIT) + b" "


def segments(text: bytes) -> Iterator[bytes]:
    """Parts of about ``SEGMENT`` bytes, cut at spaces, with a space at both ends."""
    at = 0
    while at < len(text) - 1:
        end = len(text) if len(text) - at <= SEGMENT else text.find(b" ", at + SEGMENT) + 1
        yield text[at:end]
        at = end - 1


def scanned(texts: list, scan: Dictionary) -> tuple[np.ndarray, np.ndarray]:
    """(number of words of each text, payloads of all words in order)."""
    counts, parts, held, size = np.zeros(len(texts), np.int64), [], [], 0

    def flush():
        if held:
            starts, values = scan.payloads(b"".join(b for _, b in held))
            edges = np.cumsum([len(b) for _, b in held])
            counts[[i for i, _ in held]] += np.diff(np.searchsorted(starts, edges), prepend=0)
            parts.append(values)
            held.clear()

    for i, t in enumerate(texts):
        b = delimited(t)
        if len(b) > SEGMENT:
            flush()
            size = 0
            for part in segments(b):
                _, values = scan.payloads(part)
                counts[i] += len(values)
                parts.append(values)
            continue
        if size + len(b) > SEGMENT:
            flush()
            size = 0
        held.append((i, b))
        size += len(b)
    flush()
    return counts, np.concatenate(parts) if parts else np.zeros(0, np.int64)


def run_buckets(counts: np.ndarray, payloads: np.ndarray, lo: int, hi: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(features of each text, buckets of all features, text by text) of the runs of ``lo`` to ``hi`` words."""
    text = np.repeat(np.arange(len(counts)), counts)
    crc, length = (payloads & 0xFFFFFFFF).astype(np.uint32), payloads >> 32
    run, owner, out, whose = crc, text, [], []
    spaced = combine(np.full(len(crc), SPACE), crc, length) if hi > 1 else crc
    for n in range(1, hi + 1):
        if n > 1:
            same = text[n - 1:] == text[:max(0, len(text) - n + 1)]
            run = combine(run[:len(same)], spaced[n - 1:], length[n - 1:] + 1)
            owner = np.where(same, text[n - 1:], -1)
        if n >= lo:
            keep = owner >= 0
            out.append(run[keep] % np.uint32(buckets))
            whose.append(owner[keep])
    all_out, all_whose = np.concatenate(out), np.concatenate(whose)
    if len(out) > 1:
        all_out = all_out[np.argsort(all_whose, kind="stable")]
    return np.bincount(all_whose, minlength=len(counts)), all_out


def _width(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def features(docs: DataFrame, key: str, text: str = "text", lo: int = 1, hi: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(uid, key, n_words, n_features, buckets): one row per row of ``docs``; ``uid`` is the row's own number and holds
    once the result is stored."""
    kind = _width(buckets)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        scan, uid = dictionary(), TaskContext.get().partitionId() << 40
        for whole in batches:
            size = whole["t"].str.len().fillna(0).to_numpy().cumsum() // (4 * SEGMENT)
            for _, b in whole.groupby(size, sort=False):
                counts, payloads = scanned([None if t is None or t is pd.NA else t for t in b["t"]], scan)
                n, found = run_buckets(counts, payloads, lo, hi, buckets)
                ends, raw = (np.cumsum(n) * int(kind[2])).tolist(), found.astype(kind).tobytes()
                yield pd.DataFrame({"uid": np.arange(uid, uid + len(b)), key: b["k"], "n_words": counts, "n_features": n,
                                    "buckets": [raw[s:e] for s, e in zip([0, *ends], ends)]})
                uid += len(b)

    return docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).mapInPandas(
        run, f"uid long, {key} long, n_words long, n_features long, buckets binary")


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of a stored table of :func:`features`; each task sums its own rows first."""
    kind = _width(buckets)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            total += np.bincount(np.frombuffer(b"".join(b["buckets"]), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at, "n": total[at]})

    return found.select("buckets").mapInPandas(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """One whole-number gain per bucket, from the two tables of bucket counts (at most ``buckets`` rows each)."""
    n = {name: np.zeros(buckets, np.int64) for name in ("s", "t")}
    for name, counts in (("s", source), ("t", target)):
        for r in counts.collect():
            n[name][r["bucket"]] = r["n"]
    s_all, t_all = float(n["s"].sum()), float(n["t"].sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets))))
                     for s, t in zip(n["s"].tolist(), n["t"].tolist())], np.int64)


def weights(found: DataFrame, gain: np.ndarray, key: str) -> DataFrame:
    """Every row of :func:`features` with its weight instead of its buckets."""
    kind = _width(len(gain))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            total = np.concatenate(([0], np.cumsum(gain[np.frombuffer(b"".join(b["buckets"]), kind)])))
            ends = np.cumsum(b["n_features"].to_numpy())
            yield b.drop(columns="buckets").assign(weight=total[ends] - total[ends - b["n_features"].to_numpy()])

    return found.mapInPandas(run, f"uid long, {key} long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, key: str, target_key: str, text: str = "text", lo: int = 1, hi: int = 1,
             buckets: int = BUCKETS, percent: int = 10, min_words: int = 20, seed: int = 2024) -> DataFrame:
    """(key, n_features, weight, score, rank) of every document; ``rank`` of the drawn ones, from 1."""
    found = write_table(features(docs, key, text, lo, hi, buckets), "features")
    wanted = write_table(features(target, target_key, text, lo, hi, buckets), "features")
    gain = gains(bucket_counts(found, buckets), bucket_counts(wanted, buckets), buckets)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = write_table(weights(found, gain, key).withColumn("score", F.col("weight") + noise), "scores")
    able = scored.filter(F.col("n_words") >= min_words)
    place = F.struct(-F.col("score"), F.col(key).isNull(), F.col(key), F.col("uid"))
    ranked = rank_in_group(able.withColumn("place", place), "place")
    rank = F.when(F.col("_rank") < F.floor(F.col("_total") * percent / 100), F.col("_rank") + 1)
    cols = [key, "n_features", "weight", "score"]
    return ranked.select(*cols, rank.cast("long").alias("rank")).unionByName(
        scored.filter(F.col("n_words") < min_words).select(*cols, F.lit(None).cast("long").alias("rank")))


def query(spark, sf_dir):
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "doc_id", "item_id")


_WORDS_SQL = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

ORACLE = f"""
WITH f AS (SELECT doc_id, unnest({_WORDS_SQL}) AS w FROM documents),
g AS (SELECT unnest({_WORDS_SQL}) AS w FROM benchmark),
v AS (SELECT w, hex(encode(w)) AS x FROM (SELECT DISTINCT w FROM f UNION SELECT DISTINCT w FROM g)),
b AS (SELECT w, {crc_sql('x')} % {BUCKETS} AS bucket FROM v),
s AS (SELECT bucket, count(*) AS s FROM f JOIN b USING (w) GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM g JOIN b USING (w) GROUP BY 1),
n AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS s_all, (SELECT coalesce(sum(t), 0) FROM t) AS t_all),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + {BUCKETS})::DOUBLE
                / ((s + 1)::DOUBLE * (t_all + {BUCKETS})::DOUBLE)))::BIGINT AS gain
         FROM s LEFT JOIN t USING (bucket), n),
w AS (SELECT doc_id, count(*) AS n_features, sum(gain) AS weight FROM f JOIN b USING (w) JOIN gain USING (bucket) GROUP BY 1),
h AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0)::BIGINT AS weight,
             ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h
      FROM documents LEFT JOIN w USING (doc_id)),
sc AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM h),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able FROM sc WHERE n_features >= 20)
SELECT sc.doc_id, n_features, weight, score, CASE WHEN place <= (10 * able) // 100 THEN place END AS rank
FROM sc LEFT JOIN r USING (doc_id)
"""
