"""The training-data operators against brute force, round trips, held-out accuracy and awkward rows."""

import html
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest

import corpus_pipeline
from echolens.llm import (ann, html_extract, license_scan, mixing, near_dedup, packing, quality_classifier, quality_rules,
                          queries, token_counts, token_output, tokens)

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
WORD = r"[^\x20\x09-\x0D]+"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words long, t string, row string"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
AWKWARD = [
    (1, None, None, None, None, 5, "x", "y"), (2, "", "en", "a", 0, None, None, None), (None, "no id at all", "en", "a", 1, 1, "", ""),
    (3, "one", "en", "b", 3, 1, "t", "r"), (4, LONG, "en", "b", 1, 1, "t", "r"), (5, "a b c d e f g h i j k", "en", "b", 1, 1, "t", "r"),
    (5, "a b c d e f g h i j k", "en", "b", 1, 1, "t", "r"), (6, "A B C D e f g h i j k", "de", "b", 1, 1, "t", "r"),
    (7, " \n\t ", "fr", None, 1, 1, "t", "r"), (8, "same\nsame\nsame words x y z", "fr", "c", 1, 1, "t", "r"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOCS)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(t):
    return re.findall(WORD, t or "")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    res = con.execute(queries.ORACLES[name])
    at = [[d[0] for d in res.description].index(c) for c in got.columns]
    want = [tuple(r[i] for i in at) for r in res.fetchall()]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def repeat_words(w):
    at = {}
    for i in range(len(w) - 4):
        at.setdefault(tuple(w[i:i + 5]), []).append(i)
    return len({p for v in at.values() if len(v) > 1 for i in v for p in range(i, i + 5)})


def test_rules_brute_force(awkward):
    for r in quality_rules.judge(awkward.select("doc_id", "text"), keep=("doc_id", "text")).collect():
        w = words(r.text)
        lines = [x for x in (r.text or "").split("\n") if words(x)]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(lines) - len(set(lines)), repeat_words(w))
        assert r.base_failed == (len(w) < 10 or 100 * repeat_words(w) > 20 * len(w)) and (not r.kept or not r.base_failed)
    out = quality_rules.filter_documents(awkward)
    assert out.columns == awkward.columns


def true_components(rows, n, percent=80):
    sets = {}
    for i, t in rows:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    comp = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(comp[a], comp[b])
            changed |= comp[a] != m or comp[b] != m
            comp[a] = comp[b] = m
    return {i: (len(sets[i]), comp[i]) for i in ids}


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates_brute_force(spark, documents, n):
    got = near_dedup.near_duplicates(documents, words=n).collect()
    want = true_components([(r.doc_id, r.text) for r in documents.collect()], n)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_in_crowds(spark):
    """400 texts 0.77 alike, 120 of them with a partner at 0.81, ids far apart: every partner is found, nothing else is linked."""
    base, rows = [f"c{i}" for i in range(770)], []
    for i in range(400):
        shared = [f"p{i % 200}x{k}" for k in range(24)] if i % 200 < 120 else []
        rows.append((i, " ".join(base + shared + [f"u{i}x{k}" for k in range(115 - len(shared))])))
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=1).collect()}
    assert got == {i: i % 200 if i % 200 < 120 else i for i in range(400)}


def test_near_duplicates_one_member_of_a_component(spark):
    """Texts that are like one outlying version of a component only join it if they met any of its texts."""
    width, rows, sets = 2, [], {}
    for g in range(40):
        hub = [f"g{g}h{k}" for k in range(1000)]
        texts = [hub[:-1] + [f"g{g}v{i}"] for i in range(12)]
        own = [f"g{g}o{k}" for k in range(100)]
        texts += [hub[:900] + own, hub[:830] + own[:60] + hub[900:940] + [f"g{g}x{k}" for k in range(70)]]
        for i, t in enumerate(texts):
            rows.append((100 * g + i, " ".join(t)))
            sets[100 * g + i] = near_dedup.shingle_set(rows[-1][1], 1)
    xor, mul = near_dedup._hashers(width * 4)
    sig = {i: near_dedup._signature(h, xor, mul).reshape(width, 4) for i, h in sets.items()}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    comp = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, words=1, trees=width).collect()}
    far = 0
    for g in range(0, 4000, 100):
        share = {i: (sig[g + 13] == sig[g + i]).all(1).any() for i in range(13)}
        if comp[g + 12] == g and any(share[i] and comp[g + i] == g for i in range(13)):
            assert comp[g + 13] == g
            far += not share[12]
    assert far


@pytest.mark.parametrize("within", [True, False])
def test_blocks_join_what_all_pairs_join(spark, within):
    """Groups cut into many blocks give links that join the texts as all pairs would, no more of them than texts per block
    pair, and each text with the larger components that it was held against without a link."""
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.choice(60, 40).astype(np.uint64)) for _ in range(10)]
    sets = [np.union1d(np.delete(s, rng.choice(len(s), 2)), np.uint64(1000 + i)) for i, s in enumerate(sets * 4)]
    comp = [0 if i < 15 else i // 2 * 2 for i in range(40)]
    classes = spark.createDataFrame([(i, len(s), bytes(32)) for i, s in enumerate(sets)], "doc long, n_shingles long, sig binary")
    full = spark.createDataFrame([(i, s.tobytes()) for i, s in enumerate(sets)], "doc long, hashes binary")
    rows = spark.createDataFrame([(g, int(i >= 15), i, comp[i], True) for g in (1, 2) for i in range(40)],
                                 "grp long, side int, doc long, comp long, many boolean")
    got = near_dedup.in_blocks(rows, classes, full, 80, 2, 4, within, block=200, text=0).collect()
    pairs = [(i, j) for i in range(40) for j in range(max(i + 1, 15), 40) if (i < 15 or within) and comp[i] != comp[j]]

    def alike(i, j):
        return 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))

    def joined(links):
        root = list(comp)
        for i, j in links:
            root = [root[i] if r == root[j] else r for r in root]
        return [root.index(r) for r in root]

    want = [p for p in pairs if alike(*p)]
    links = {(r.a, r.b) for r in got if r.linked}
    assert want and all(alike(*p) for p in links) and joined(links) == joined(want)
    met = {(r.a, r.b) for r in got if not r.linked}
    after = joined(want)
    assert {(i, c) for i, j in pairs for i, j in ((i, j), (j, i)) for c in [comp[j]] if after[i] != after[c]
            and 100 * min(len(sets[i]), len(sets[j])) >= 80 * max(len(sets[i]), len(sets[j]))} <= met
    assert all(comp[i] != c for i, c in met)


def test_blocks_join_each_text_once(spark):
    """Joins on texts have a row per text, however many regions it is in."""
    def most(node):
        name = node.nodeName()
        below = [node.executedPlan()] if name == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in name else \
            [node.children().apply(i) for i in range(node.children().size())]
        own = node.metrics().apply("numOutputRows").value() if "Join" in name and "doc#" in node.simpleString(25).split("]")[0] else 0
        return max([own, *map(most, below)])

    classes = spark.createDataFrame([(i, 3, bytes(32)) for i in range(40)], "doc long, n_shingles long, sig binary")
    full = spark.createDataFrame([(i, np.arange(3 * i, 3 * i + 3, dtype=np.uint64).tobytes()) for i in range(40)], "doc long, hashes binary")
    rows = spark.createDataFrame([(g, 1, i, i, False) for g in range(8) for i in range(40)], "grp long, side int, doc long, comp long, many boolean")
    found = near_dedup.in_blocks(rows, classes, full, 80, 2, 4, True)
    assert found.collect() == [] and most(found._jdf.queryExecution().executedPlan()) == 40


def test_signature_bound():
    n = near_dedup.least_equal(80, 80)
    draws = np.random.default_rng(5).binomial(80, 0.8, 1_000_000)
    assert n == 43 and draws.min() >= n
    assert near_dedup.least_equal(80, 100) == 80 and near_dedup.least_equal(4, 80) == 0


@pytest.mark.parametrize("n,partitions", [(1, 8), (2, 1), (3, 64), (4, 8), (5, 2), (8, 16)])
def test_near_duplicates_few_texts(spark, n, partitions):
    """Sorted partitions of any number of rows, fewer than the reach included."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = [(i, " ".join(f"w{(i // 2) * 100 + j}" for j in range(30 + i % 2))) for i in range(n)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, words=2).collect()}
        assert got == {i: i - i % 2 for i in range(n)}
        sizes = [list(near_dedup._neighbours(near_dedup.REACH)(iter([pd.DataFrame(
            {"region": [1] * k, "d1": 0, "d2": 0, "doc": range(k), "comp": range(k)})]))) for k in range(1, 9)]
        pairs = [sum((f["apart"] > 0).sum() for f in x) for x in sizes]
        assert pairs == [sum(max(0, k - d) for d in range(1, near_dedup.REACH + 1)) for k in range(1, 9)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_near_duplicates_awkward(awkward):
    got = near_dedup.near_duplicates(awkward, words=2).collect()
    assert len(got) == len(AWKWARD)
    by = {r.doc_id: r for r in got}
    assert by[6].component_id == 5 and not by[6].kept and by[5].kept
    assert by[1].n_shingles == by[2].n_shingles == by[7].n_shingles == 0 and by[None].kept and by[None].component_id is None
    assert near_dedup.near_duplicates(awkward.limit(0)).count() == 0


def test_components_chain(spark):
    from echolens.llm.components import components
    chain = spark.range(200).selectExpr("id * 7 AS a", "(id + 1) * 7 AS b")
    got = components(chain.union(spark.createDataFrame([(5, 5), (3, 4), (4, 3)], "a long, b long")))
    assert {r.node: r.component for r in got.collect()} == {**{7 * i: 0 for i in range(1, 201)}, 4: 3}


def test_classifier_held_out(spark):
    got = quality_classifier.query(spark, "/root/testdata/sf0.01").toPandas()
    j = got.merge(spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas(), on="doc_id")
    assert (j.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in j.doc_id]).all()
    assert (j.predicted == j.quality)[j.held_out].mean() > 0.95


def test_classifier_awkward(spark, awkward):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality_classifier.classify(awkward, none).collect()
    assert len(got) == len(AWKWARD) and all(r.score == 0.5 and r.predicted == 1 for r in got)
    assert quality_classifier.keep_good(awkward, none).columns == awkward.columns
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (5, 0, None), (6, None, 0), (None, 1, 1), (8, 1, 0)], none.schema)
    assert all(0 <= r.score <= 1 for r in quality_classifier.classify(awkward, labels).collect())
    assert quality_classifier.classify(awkward.limit(0), labels).count() == 0


def test_classifier_memory(spark, awkward, capsys):
    import tracemalloc
    parts = quality_classifier.passages("The quick brown fox; 17 $ über den Zaun.\n" * 150_000)
    tracemalloc.start()
    x = quality_classifier.encode(parts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(parts) == 5125 and peak < 30e6                        # 5.5 MB of features, 6 MB of text
    assert all((x[i] == quality_classifier.encode([parts[i]])[0]).all() for i in (0, 127, 128, 5124))
    assert quality_classifier.encode([]).shape == (0, quality_classifier.WIDTH)
    # The text waits for its score in its row only.
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (5, 0, 0), (8, 1, 0)], "doc_id long, quality int, toxic int")
    good = quality_classifier.keep_good(awkward, labels)
    good.explain()
    assert "ArrowEvalPython" in (plan := capsys.readouterr().out) and "coalesce(text" not in plan
    whole = {r.doc_id: r.score for r in quality_classifier.classify(awkward, labels).collect()}
    assert sorted(r.doc_id for r in good.filter("doc_id is not null").collect()) == sorted(
        r.doc_id for r in awkward.filter("doc_id is not null").collect() if whole[r.doc_id] >= 0.5)


def test_mixing(spark, documents, awkward):
    d = mixing.mix(mixing.sizes(documents)).toPandas()
    again = mixing.mix(mixing.sizes(documents.repartition(5))).toPandas()
    assert sorted(d.values.tolist(), key=str) == sorted(again.values.tolist(), key=str)
    assert (d.taken <= 2 * d["size"]).all() and (d.taken % d["size"].clip(lower=1) == 0).all()
    s = d.groupby("source").agg(size=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"), most=("size", "max"))
    assert abs(s.target.sum() - 1.5 * s["size"].sum()) < 1e-6 * s["size"].sum() and (s.target <= 2 * s["size"] + 1e-9).all()
    assert ((s.taken - s.target).abs() <= s.most / 2 + 1e-6).all()
    weight = pd.Series([(5, 2, 1)[i % 3] for i in range(len(s))], index=s.sort_index().index)
    free = s.target < 2 * s["size"] - 1e-6
    assert np.ptp((s.target / weight)[free]) < 1e-6 * s.target.max()
    assert mixing.mix(mixing.sizes(awkward)).count() == len(AWKWARD) and mixing.mix(mixing.sizes(awkward.limit(0))).count() == 0
    assert mixing.mixed_documents(awkward).columns == awkward.columns


def test_pivot_keeps_words_and_settles():
    r = np.random.default_rng(1)
    size, part = r.integers(1, 900, 500).astype(float), r.random(500)
    out, at = mixing.pivot(size, part, r)
    assert abs((out * size).sum() - (part * size).sum()) < 1e-6
    assert all(out[i] in (0, 1) for i in range(500) if i != at)


def test_mixing_repeated_rows(spark):
    rows = [(1, "words of ten in every one of the same rows", "a", 5, "x")] * 1000 + [(None, "no id has three words", None, 1, "y")] * 7
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, rows long, copies string").repartition(4)
    d = mixing.mix(mixing.sizes(docs)).toPandas()
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and len(d) == 1007
    for source, size in (("a", 10), (None, 5)):
        part = d[d["source"] == source] if source else d[d["source"].isna()]
        target = part["target"].iloc[0]
        words_taken = mixed.filter("source = 'a'" if source else "source IS NULL").count() * size
        assert abs(part["taken"].sum() - target) <= size / 2 and words_taken == part["taken"].sum()
        assert part["copies"].max() <= 2 and part["copies"].max() - part["copies"].min() <= 1


def test_dedup_stage_goes_by_row(spark):
    same, other = "one two three four five six seven eight", "nine ten eleven twelve thirteen fourteen fifteen"
    rows = [(1, same, 0, "p"), (1, same, 1, "p"), (1, other, 2, "p"), (None, other, 3, None), (None, other + "!", 4, "q"), (None, None, 5, "r"),
            (None, None, 6, "r"), (2, "", 7, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _gone long, row string").coalesce(1)
    got = sorted(r._gone for r in near_dedup.keep_one_per_group(docs).collect())
    assert got == [0, 2, 4, 5, 6, 7]
    assert near_dedup.keep_one_per_group(docs).columns == docs.columns


def test_encoder_equals_tokenizer():
    from tokenizers import Tokenizer
    tk, e, r = Tokenizer.from_file(PATH), tokens.Encoder(PATH), np.random.default_rng(0)
    texts = ["a  b", "a \nb", "x\t \ty", " a", "a ", "", "don't 's  x", "a  b", "x\0 y", "<|endoftext|> a", LONG[:5000]]
    texts += ["".join(r.choice(list("ab' \n\t\x1c\x85,.1é"), 30)) for _ in range(200)]
    assert [np.frombuffer(e(t), "<u4").tolist() for t in texts] == [tk.encode(t, add_special_tokens=False).ids for t in texts]


def test_quick_encoding_equals_the_library(documents):
    e = tokens.Encoder(PATH)
    assert e.quick
    r = np.random.default_rng(3)
    points = [c for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000] + [0xFF10, 0x1F600, 0x20000, 0x10FFFD]
    texts = [chr(c).join(["a", "b 1", "2 ", ".", " '"]) for c in points]
    texts += ["".join(map(chr, r.choice(points, 400))) for _ in range(100)]
    texts += ["x" * n for n in (127, 128, 511, 512, 513, 5000)] + [" " * 3000, "\n \n" * 900, "a <|endoftext|> b", "don't we'll I'd 'S", " \u3000 " * 400, "é" * 400]
    texts += [x.text for x in documents.select("text").collect() if x.text]
    assert all(e(t) == e.whole(t) for t in texts)
    assert not tokens._unbroken("word " * 1000) and tokens._unbroken("y" * 600) and tokens._unbroken("a" + " \n" * 600)


def test_pair_ranks_only_for_consistent_merges():
    letters = {b: c for c, b in tokens._byte_letters().items()}
    base = {letters[b]: b for b in range(256)}

    def spec(merges, **model):
        vocab = base | {a + b: 256 + i for i, (a, b) in enumerate(merges)}
        return {"model": {"type": "BPE", "vocab": vocab, "merges": merges, **model}, "pre_tokenizer": {"type": "ByteLevel"}}

    assert tokens.pair_ranks(spec([("a", "b"), ("ab", "c")]))[b"abc"] == 257
    assert tokens.pair_ranks(spec([("b", "c"), ("a", "b"), ("ab", "c")])) is None      # "abc" is built as a + bc
    assert tokens.pair_ranks(spec([("a", "b")], dropout=0.1)) is None
    assert tokens.pair_ranks(spec([("a", "b")]) | {"normalizer": {"type": "Lowercase"}}) is None
    assert tokens.pair_ranks({"model": {"type": "WordPiece", "vocab": {}, "merges": []}}) is None


def test_packing(documents, awkward):
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(PATH)
    for d in (documents, awkward):
        p = packing.pack(d, PATH).toPandas()
        assert p.length.max() <= 2048 and p.sequence_id.nunique() <= -(-p.length.sum() // 2048) + 2
        for _, g in p.sort_values("offset").groupby("sequence_id"):
            assert g.offset.tolist() == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= 2048
        want = []
        for r in d.collect():
            ids = np.array(tk.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
            want += [(r.doc_id, k, s, n, zlib.crc32(ids[s:s + n].tobytes())) for k, (s, n) in enumerate(tokens.cuts(len(ids)))]
        got = [(None if pd.isna(a) else int(a), *b) for a, *b in p[["doc_id", "piece", "start", "length", "ids_crc32"]].values.tolist()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert packing.pack(awkward.limit(0), PATH).count() == 0


def test_best_fit_takes_the_tightest():
    r = np.random.default_rng(2)
    sizes = r.integers(1, 101, 400)
    where, offset = packing.best_fit_decreasing(sizes, 100)
    room, want = [], np.zeros(400, int)
    for k in np.argsort(-sizes, kind="stable"):
        fit = [b for b in range(len(room)) if room[b] >= sizes[k]]
        if not fit:
            room.append(100)
            fit = [len(room) - 1]
        b = min(fit, key=lambda b: room[b])
        room[b] -= sizes[k]
    assert sorted(100 - np.bincount(where, sizes).astype(int)) == sorted(room) and want.sum() == 0


def test_token_output_round_trip(spark, awkward, tmp_path):
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(PATH)
    t = token_output.write_packed(awkward, PATH, str(tmp_path / "m"))
    assert all(len(r.input_ids) == 4096 and r.cu_seqlens[-1] == r.n_tokens and r.position_resets == r.cu_seqlens[:-1] for r in t.collect())
    got = sorted(np.frombuffer(r.ids, "<u2").tolist() for r in token_output.read_documents(spark, str(tmp_path / "m"), "<u2").collect())
    assert got == sorted(tk.encode(r[1] or "", add_special_tokens=False).ids + [0] for r in AWKWARD)


def test_token_totals_idempotent(spark, tmp_path):
    store = token_counts.TokenTotals(spark, str(tmp_path / "t"))
    assert store.totals().count() == 0
    schema = "source string, lang string, tokenizer string, before long, after long"
    one = spark.createDataFrame([("a", None, "v", None, 5), ("a", None, "v", None, 7), (None, "en", "v", None, 2)], schema)
    assert store.commit("1", one) and not store.commit("1", one)
    assert store.commit("2", spark.createDataFrame([("a", None, "v", 5, 9), ("a", None, "v", 7, None), (None, "en", "v", 2, None)], schema))
    store.commit("3", spark.createDataFrame([], schema))
    assert [tuple(r) for r in store.totals().collect()] == [("a", None, "v", 1, 9)]


def test_neighbours(spark):
    got = ann.query(spark, SF).toPandas()
    e = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas().sort_values("vec_id")
    v, ids, hit = np.stack(e.embedding).astype(float), e.vec_id.to_numpy(), 0
    for q, g in got.groupby("query_id"):
        s = v @ v[ids == q][0]
        s[ids == q] = -np.inf
        hit += len(set(ids[np.lexsort((ids, -s))[:20]]) & set(g.vec_id))
        assert g.sort_values("rank").score.is_monotonic_decreasing and np.allclose(s[np.searchsorted(ids, g.vec_id)], g.score)
    assert hit / len(got) >= 0.9


def test_neighbours_awkward(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, []), (6, [nan, 1.0]),
            (7, [None, 1.0]), (8, [1.0, 1.0, 1.0]), (None, [1.0, 0.0]), (9, [-1.0, 0.5])]
    v = spark.createDataFrame(rows, "id long, v array<double>")
    got = [tuple(r) for r in ann.nearest(v, v.filter("id % 5 = 0")).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 9, -1.0)]
    assert ann.nearest(v.limit(0), v.limit(0)).count() == 0


def test_html(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in html_extract.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        a = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.S).group(1).replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", a)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_html_awkward(spark):
    page = ("<html><body><div class='site-menu menu'>Home</div><header>Site</header><div id=c><p>Welcome to us</p><p>Body {} one &amp; two"
            "<p>three<br>four</div><form>q</form><div class=comments>bad</div><script>var a='<p>x</p>'</script></body>")
    rows = [(i, f"http://h.example/{i}", page.format(i)) for i in range(6)]
    rows += [(10, None, None), (11, "x", ""), (12, "http://h.example/z", "<article><header><h1>T</h1></header>a &lt; b<aside>n</aside></article>"),
             (13, "http://h.example/y", "plain < text <b>bold")]
    d = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, host string")
    got = {r.page_id: r.text for r in html_extract.extract(d).collect()}
    assert got[3] == "Body 3 one & two\n\nthree four"
    assert got[10] == got[11] == "" and got[12] == "T\n\na < b" and got[13] == "plain < text bold"
    assert html_extract.extract(d.limit(0)).count() == 0


def test_license(spark, awkward):
    d = spark.createDataFrame([(1, "MIT License\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                                   "associated documentation files (the \"Software\"), to deal in the Software without restriction.\nThe above copyright "
                                   "notice and this permission notice shall be included in all copies or substantial portions of the Software."),
                               (2, "text. Licensed under the Apache License, Version 2.0."), (3, None)], "doc_id long, text string")
    assert {r.doc_id: r.licenses for r in license_scan.scan(d).collect()} == {1: "MIT", 2: "Apache-2.0", 3: ""}
    assert license_scan.scan(awkward).filter("n_sentences > 0").count() == 0
    assert all(re.search(license_scan.STEMS, s) for _, s in license_scan.SENTENCES)


def test_html_slugs_inside_the_article(spark):
    page = ("<html><body class='has-sidebar' id=search-page><div id=sidebar-left>out</div><article id=login-guide>"
            "<section id='search-results'><h2 id='related-work'>Related work</h2><p id='comments-on-method'>Method</p></section>"
            "<div class='share-price big'>Price</div><section id=login-flow>Flow</section><h2 id=search>Search</h2>"
            "<div class='x comments'>bad</div><div id=comments class=comments-area>bad</div><div role=navigation>bad</div></article></body>")
    d = spark.createDataFrame([(1, "http://h.example/1", page)], "page_id long, url string, html string")
    assert html_extract.extract(d).first().text.split("\n\n") == ["Related work", "Method", "Price", "Flow", "Search"]


MIT = """The MIT License (MIT)

Copyright (c) 2014-2020 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in
all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
"""
GPL = """This program is free software{} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version {} of the License, or
(at your option) any later version.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.
"""


def test_license_wrapped(spark):
    texts = [MIT, "/*\n" + "".join(f" * {x}\n" for x in MIT.split("\n")) + " */\nint x;", "".join(f"; {x}\r\n" for x in BSD.split("\n")),
             "\n".join(f"# {x}" for x in GPL.format(":", 3).split("\n")), GPL.format(";", 2), "dnl " + GPL.format(":", 3).replace("\n", "\ndnl "),
             "Some text\nLicensed under CC BY 4.0\nmore text", "x\nCopyright (c) 2001, 2004 Example\nand Sons. All rights reserved.\ny",
             "A licence is\nno MIT License here", "Licensed under the\n\nMIT License and more",
             "Copyright 1994 The Holders. All rights reserved.\n\n" + BSD]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.sentence_ids, r.licenses) for r in license_scan.scan(d).collect()}
    mit = ("mit-name,mit-grant,mit-notice,as-is", "MIT")
    assert got == {0: mit, 1: mit, 2: ("bsd-redist,bsd-source", "BSD"), 3: ("gpl-free", "GPL"), 4: ("gpl-free", "GPL"), 5: ("gpl-free", "GPL"),
                   6: ("cc-by-line", "CC-BY-4.0"), 7: ("reserved-notice", "proprietary"), 8: ("", ""), 9: ("", ""), 10: ("reserved-notice,bsd-redist,bsd-source", "BSD")}
    assert all(re.search(license_scan.STEMS, s) for _, s in license_scan.PUBLISHED)


def test_native_plans(spark):
    for q in (license_scan.query, quality_rules.query):
        plan = q(spark, SF)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Exchange" not in plan


def test_pipeline(spark, tmp_path):
    docs, sizes = spark.read.parquet(f"{SF}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(i)))
        sizes.append(docs.count())
        if i < 4:
            assert docs.columns == before.columns
    assert sizes[0] >= sizes[1] >= sizes[2] > 0
    assert corpus_pipeline.run(spark, SF).count() == sizes[4]
