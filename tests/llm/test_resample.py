"""Importance resampling against a brute-force version and awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from echolens.llm import crc, resample

DOCS = "doc_id long, text string, lang string, source string, n_chars long, uid long, buckets string, rank string"
LONG = " ".join(f"W{i % 977}x{i % 31}é" for i in range(150_000))       # over a segment
TEXTS = [
    (1, None), (2, ""), (None, "no id " * 12), (3, "One"), (4, LONG), (5, "alpha beta gamma " * 9), (5, "alpha beta gamma " * 9),
    (5, "alpha beta gamma " * 9), (6, "ALPHA, beta; gamma - 12 été ÉTÉ\n" * 7), (7, " \n\t ,.;"), (8, "x" * 3_000_000),
    *((100 + i, " ".join(f"w{i * j % 23}" for j in range(5 + 3 * i))) for i in range(30)),
]
TARGET = [(1, "alpha beta beta w1 w2 w3"), (2, None), (3, "été w5 w5 w7")]


def words(t):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, target, lo, hi, buckets, percent, min_words, seed):
    def found(t):
        w = words(t)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(lo, hi + 1) for i in range(len(w) - n + 1)]

    s, t = (Counter(b for _, x in rows for b in found(x)) for rows in (docs, target))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in s}
    rows = []
    for k, x in docs:
        h = int(hashlib.sha256(f"{seed}:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        f = found(x)
        w = sum(gain[b] for b in f)
        rows.append((k, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(x)) >= min_words))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = percent * len(able) // 100
    out = [(*r[:4], i + 1 if i < drawn else None) for i, r in enumerate(able)]
    return out + [(*r[:4], None) for r in rows if not r[4]]


def rows(spark, texts, schema=DOCS):
    return spark.createDataFrame([(k, t, "en", "a", 1, 5, "x", "y")[:len(schema.split(", "))] for k, t in texts], schema)


def key(r):
    return tuple(-1 if x is None else x for x in r)


@pytest.mark.parametrize("lo,hi,buckets", [(1, 1, 10_000), (1, 3, 997), (2, 2, 70_000)])
def test_resample(spark, lo, hi, buckets):
    docs, target = rows(spark, TEXTS).repartition(3), spark.createDataFrame(TARGET, "item_id long, text string")
    got = resample.resample(docs, target, "doc_id", "item_id", lo=lo, hi=hi, buckets=buckets, percent=40)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(key, got.collect())) == sorted(map(key, brute(TEXTS, TARGET, lo, hi, buckets, 40, 20, 2024)))


def test_resample_empty(spark):
    none, target = rows(spark, []), spark.createDataFrame(TARGET, "item_id long, text string")
    assert resample.resample(none, target, "doc_id", "item_id").collect() == []
    got = resample.resample(rows(spark, TEXTS), target.limit(0), "doc_id", "item_id")
    assert sorted(map(key, got.collect())) == sorted(map(key, brute(TEXTS, [], 1, 1, 10_000, 10, 20, 2024)))


@pytest.mark.parametrize("size", [0, 3, 50_000])
def test_dictionary_size_changes_no_payload(size):
    scan = resample.Dictionary(size)
    for _ in range(3):
        counts, payloads = resample.scanned([t for _, t in TEXTS], scan)
        scan.learn()
    want = [w.encode() for _, t in TEXTS for w in words(t)]
    assert counts.tolist() == [len(words(t)) for _, t in TEXTS] and len(scan.automaton) <= size
    assert payloads.tolist() == [len(w) << 32 | zlib.crc32(w) for w in want]


def test_crc_composition():
    parts = [(b"", b"x"), (b"a", b""), (b"abc", b"d" * 255), (b"\xff" * 9, b"e" * 70_001)]
    a, b = (np.array([zlib.crc32(p[i]) for p in parts], np.uint32) for i in (0, 1))
    got = crc.combine(a, b, np.array([len(p[1]) for p in parts]))
    assert got.tolist() == [zlib.crc32(x + y) for x, y in parts]
