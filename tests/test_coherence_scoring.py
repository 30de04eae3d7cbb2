import math
import random

import numpy as np

from echolens.operators.coherence import coherence_cv, window_counts
from echolens.operators import scoring as SC


def _windows(doc, w):
    if len(doc) < w:
        return [set(doc)]
    return [set(doc[s:s + w]) for s in range(len(doc) - w + 1)]


def _cv_brute(docs, topics, w, eps=1e-12):
    wins = [x for d in docs for x in _windows(d, w)]
    n = len(wins)
    def cnt(*ws):
        return sum(1 for x in wins if all(v in x for v in ws))
    res = {}
    for t, words in topics.items():
        def npmi(a, b):
            co = cnt(a) if a == b else cnt(a, b)
            pa, pb = cnt(a) / n, cnt(b) / n
            return math.log((co / n + eps) / (pa * pb)) / -math.log(co / n + eps)
        m = np.array([[npmi(a, b) for b in words] for a in words])
        vs = m.sum(axis=0)
        sims = [float(m[i] @ vs / (np.linalg.norm(m[i]) * np.linalg.norm(vs))) for i in range(len(words))]
        res[t] = sum(sims) / len(sims)
    return res


def test_cv_matches_brute_force(spark):
    rnd = random.Random(5)
    vocab = list("abcdefghij")
    docs = [[rnd.choice(vocab) for _ in range(rnd.randint(0, 25))] for _ in range(60)]
    topics = {0: ["a", "b", "c"], 1: ["d", "e", "f", "a"]}
    w = 6
    d = spark.createDataFrame([(i, x) for i, x in enumerate(docs)], "doc_id long, tokens array<string>")
    tw = spark.createDataFrame([(t, r, x) for t, ws in topics.items() for r, x in enumerate(ws)],
                               "topic int, rank int, word string")
    n, wc, pc = window_counts(d, tw, window=w)
    wins = [x for doc in docs for x in _windows(doc, w)]
    assert n.first().n_windows == len(wins)
    for r in wc.collect():
        assert r.cnt == sum(1 for x in wins if r.word in x)
    for r in pc.collect():
        assert r.cnt == sum(1 for x in wins if r.word_a in x and r.word_b in x)
    per, overall = coherence_cv(d, tw, window=w)
    want = _cv_brute(docs, topics, w)
    got = {r.topic: r.c_v for r in per.collect()}
    for t in topics:
        assert abs(got[t] - want[t]) < 1e-9
    assert abs(overall.first().c_v - sum(want.values()) / 2) < 1e-9


def test_cv_of_theme_lists_on_long_texts_with_disjoint_runs(spark):
    rnd = random.Random(8)
    filler = ["x", "y", "z"]
    docs = []
    for i in range(12):      # words far apart: many runs that never overlap
        d = []
        for _ in range(60):
            d += [rnd.choice("abcd")] * rnd.randint(1, 2) + [rnd.choice(filler) for _ in range(rnd.randint(0, 30))]
        docs.append(d)
    docs += [[], ["a"], ["b", "c", "d", "a"]]
    lists = {10: ["a", "b"], 20: ["b", "c", "d"], 30: ["a", "d"]}
    d = spark.createDataFrame([(i, x) for i, x in enumerate(docs)], "doc_id long, tokens array<string>")
    tw = spark.createDataFrame([(t, r, x) for t, ws in lists.items() for r, x in enumerate(ws)], "topic int, rank int, word string")
    n, wc, pc = window_counts(d, tw, window=8)
    wins = [x for doc in docs for x in _windows(doc, 8)]
    assert n.first().n_windows == len(wins)
    assert {r.word: r.cnt for r in wc.collect()} == {w: sum(w in x for x in wins) for w in "abcd"}
    got = {(r.word_a, r.word_b): r.cnt for r in pc.collect()}
    assert got == {p: sum(p[0] in x and p[1] in x for x in wins) for p in [("a", "b"), ("b", "c"), ("b", "d"), ("c", "d"), ("a", "d")]}
    per, _ = coherence_cv(d, tw, window=8)
    want = _cv_brute(docs, lists, 8)
    assert all(abs(r.c_v - want[r.topic]) < 1e-9 for r in per.collect())


def test_python_scorer_guard_errors_softmax(spark):
    rows = [(1, "fine text @bob"), (2, "!" * 151), (3, "BOOM please"), (4, None)]
    df = spark.createDataFrame(rows, "tweetId long, content string")

    def make():
        def scorer(texts):
            if any("BOOM" in t for t in texts):
                raise ValueError("model failure")
            return np.array([[1.0, 2.0, 3.0, 4.0] for _ in texts])
        return scorer

    out = {r.tweetId: r for r in SC.score_with_python(df, make).collect()}
    assert out[2].score_status == "skipped" and out[2].anger is None
    assert out[3].score_status == "error" and out[3].anger == -1.0
    assert out[1].score_status == "ok"
    assert abs(out[1].anger + out[1].joy + out[1].optimism + out[1].sadness - 1) < 0.005
    assert out[1].sadness == round(math.exp(0) / sum(math.exp(x) for x in [-3, -2, -1, 0]), 3)


def test_spark_ml_scorer(spark):
    labels = ["anger", "joy", "optimism", "sadness"]
    rows = [(i, f"{labels[i % 4]} word{i % 4} text", labels[i % 4]) for i in range(80)]
    df = spark.createDataFrame(rows, "tweetId long, content string, label string")
    model = SC.train_text_scorer(df, num_features=1 << 10)
    out = SC.score_with_model(df.select("tweetId", "content"), model).toPandas()
    s = out[labels].sum(axis=1)
    assert ((s - 1).abs() < 0.005).all()
    pred = out[labels].idxmax(axis=1)
    assert (pred == [labels[i % 4] for i in out.tweetId]).mean() > 0.9


def test_window_counts_are_no_rows_of_document_pairs(spark):
    """Pairs are added up inside the tasks; nothing is joined on the documents, rows of one key are one document."""
    rnd = random.Random(11)
    rows = [(i // 2 if i < 20 else i, [rnd.choice("abcdefg") for _ in range(rnd.randint(0, 40))]) for i in range(60)]
    rows += [(900, None), (901, []), (None, ["a", "b"]), (None, ["b"])]
    rows.append((902, [rnd.choice("abcdefgxyz") for _ in range(9000)]))     # more than one block of windows
    d = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    tw = spark.createDataFrame([(t, r, x) for t, ws in {1: "abc", 2: "cdz", 3: "fg"}.items() for r, x in enumerate(ws)],
                               "topic int, rank int, word string")
    _, wc, pc = window_counts(d, tw, window=7)
    assert "Join" not in pc._jdf.queryExecution().optimizedPlan().toString()
    wins = {}
    for k, x in rows:
        for s in range(max(1, len(x or []) - 6)):
            wins.setdefault((k, s), set()).update((x or [])[s:s + 7])
    assert {r.word: r.cnt for r in wc.collect()} == {w: n for w in "abcdfgz" if (n := sum(w in x for x in wins.values()))}
    want = {p: sum(set(p) <= x for (k, _), x in wins.items() if k is not None)
            for p in [("a", "b"), ("a", "c"), ("b", "c"), ("c", "d"), ("c", "z"), ("d", "z"), ("f", "g")]}
    assert {(r.word_a, r.word_b): r.cnt for r in pc.collect()} == {p: n for p, n in want.items() if n}
