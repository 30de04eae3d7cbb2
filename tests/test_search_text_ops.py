import math
import random
import datetime as dt

from pyspark.sql import functions as F

from echolens.functions.geo import EARTH_RADIUS_KM
from echolens.operators import phrases as PH
from echolens.operators import search as SR
from echolens.operators import tokens as TK
from echolens.operators import topics as TP


def _hav(lat1, lng1, lat2, lng2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lng2 - lng1) / 2) ** 2
    return 2 * EARTH_RADIUS_KM * math.asin(min(1.0, math.sqrt(a)))


def test_radius_filter_matches_brute_force(spark):
    rnd = random.Random(3)
    pts = [(i, rnd.uniform(-89, 89), rnd.uniform(-180, 180)) for i in range(3000)]
    regions = [("a", 10.0, 179.0, 900.0), ("b", -60.0, 0.0, 2500.0), ("c", 88.0, 40.0, 700.0),
               ("d", 0.0, 0.0, 30000.0), ("e", 5.0, 100.0, 1.0)]
    p = spark.createDataFrame(pts, "id long, latitude double, longitude double")
    r = spark.createDataFrame(regions, "region string, lat double, lng double, radius_km double")
    got = {(x.region, x.id) for x in SR.radius_filter(p, r).collect()}
    want = {(n, i) for n, la, lo, rad in regions for i, y, x in pts if _hav(y, x, la, lo) <= rad}
    assert got == want


def test_search_predicate_until_exclusive(spark):
    rows = [(1, "covid cases", "bbc", dt.datetime(2020, 6, 1), "en"),
            (2, "covid cases", "bbc", dt.datetime(2020, 12, 31), "en"),
            (3, "weather", "bbc", dt.datetime(2020, 7, 1), "en"),
            (4, "Covid", "cnn", dt.datetime(2020, 7, 1), "en")]
    df = spark.createDataFrame(rows, "id int, content string, username string, date timestamp, lang string")
    got = SR.search_posts(df, keywords=["covid"], author="bbc", since="2020-06-01", until="2020-12-31", lang="en")
    assert [r.id for r in got.collect()] == [1]


def test_pending_batches(spark):
    posts = spark.createDataFrame([(i, 1 if i != 5 else 0) for i in range(30)], "conversationId long, replyCount int")
    done = spark.createDataFrame([(3,), (4,)], "conversationId long")
    out = SR.pending_batches(posts, done, size=12).collect()
    ids = sorted(int(x) for r in out for x in r.query.replace("conversation_id:", "").split(" OR "))
    assert ids == [i for i in range(30) if i not in (3, 4, 5)]
    assert sorted(r.n_ids for r in out) == [3, 12, 12]


def test_clean_tokens(spark):
    df = spark.createDataFrame([("The @bob said: Lockdowns, http://x.co 2020 a b covid-19's rules!!",)], "t string")
    toks = TK.clean_tokens(df, "t").first().tokens
    assert toks == ["said", "lockdowns", "covids", "rules"]


def _phrases_brute(docs, min_count, threshold):
    from collections import Counter
    uni, bi = Counter(), Counter()
    for d in docs:
        uni.update(d)
        bi.update(zip(d, d[1:]))
    nv = len(uni) + len(bi)
    out = {}
    for (a, b), c in bi.items():
        s = (c - min_count) / uni[a] / uni[b] * nv
        if s > threshold:
            out[(a, b)] = s
    return out


def test_phrases_vs_brute_force_and_greedy_merge(spark):
    rnd = random.Random(1)
    vocab = ["new", "york", "city", "covid", "cases", "rise", "the", "x", "y", "z"]
    docs = []
    for i in range(300):
        d = [rnd.choice(vocab) for _ in range(rnd.randint(0, 12))]
        if i % 3 == 0:
            d += ["new", "york", "city"]
        docs.append(d)
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "doc_id long, tokens array<string>")
    got = {(r.word_a, r.word_b): r.score for r in PH.learn_phrases(df, "tokens", 5, 1.0).collect()}
    want = _phrases_brute(docs, 5, 1.0)
    assert set(got) == set(want)
    for k in want:
        assert abs(got[k] - want[k]) < 1e-9
    ph = spark.createDataFrame([("new", "york"), ("york", "city")], "word_a string, word_b string")
    t = spark.createDataFrame([(1, ["new", "york", "city", "x", "york", "city"])], "doc_id long, tokens array<string>")
    assert PH.apply_phrases(t, ph, "doc_id").first().tokens == ["new_york", "city", "x", "york_city"]


def test_dictionary_bounds(spark):
    docs = [(i, ["a"] + (["b"] if i < 3 else []) + (["c"] if i == 0 else [])) for i in range(10)]
    df = spark.createDataFrame(docs, "doc_id long, tokens array<string>")
    got = {r.token: r.df for r in TP.doc_freq_dictionary(df, min_fraction=0.2, max_fraction=0.5).collect()}
    assert got == {"b": 3}


def test_subtheme_and_rule_themes(spark):
    df = spark.createDataFrame([(1, 6, ["mask", "lockdown"]), (2, 6, ["nothing"]), (3, 1, ["mask"])],
                               "doc_id long, theme int, tokens array<string>")
    got = {r.doc_id: r.subtheme for r in TP.subtheme_flags(df).collect()}
    assert got == {1: 61, 2: 60, 3: 10}
    rules = spark.createDataFrame([(0, 5, "r1", "a, b", "F", 1), (0, 7, "r2", "c", "F", 2), (0, 2, "d", "", "T", 0)],
                                  "topic int, theme_id int, themes string, keywords string, default string, rule_order int")
    docs = spark.createDataFrame([(1, 0, ["b", "c"]), (2, 0, ["a"]), (3, 0, ["z"])],
                                 "doc_id long, num_topic int, tokens array<string>")
    got = {r.doc_id: r.theme for r in TP.rule_themes(docs, rules).collect()}
    assert got == {1: 7, 2: 5, 3: 2}


def test_native_phrase_walk_equals_the_greedy_walk(spark):
    rnd = random.Random(11)
    docs = [(i, None if i == 5 else [rnd.choice("abcd") for _ in range(rnd.choice([0, 1, 2, 3, 9, 40, 300]))]) for i in range(120)]
    phrases = {("a", "a"), ("a", "b"), ("b", "c"), ("c", "a"), ("d", "d")}

    def walk(toks):
        out, merged, i = [], [], 0
        while i < len(toks):
            if i + 1 < len(toks) and (toks[i], toks[i + 1]) in phrases:
                merged.append(f"{toks[i]}+{toks[i + 1]}")
                out.append(merged[-1])
                i += 2
            else:
                out.append(toks[i])
                i += 1
        return out, merged

    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, tokens array<string>, _pos string")
    ph = spark.createDataFrame(sorted(phrases) * 2, "word_a string, word_b string")
    got = {r.doc_id: r.tokens for r in PH.apply_phrases(df, ph, "doc_id", delimiter="+").collect()}
    assert got == {i: None if t is None else walk(t)[0] for i, t in docs}
    got = {r.doc_id: r.tokens for r in PH.append_bigrams(df, ph, "doc_id", delimiter="+").collect()}
    assert got == {i: None if t is None else t + walk(t)[1] for i, t in docs}
    none = PH.apply_phrases(df, ph.limit(0), "doc_id")
    assert {r.doc_id: r.tokens for r in none.collect()} == dict(docs) and none.columns == df.columns
    plan = none._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_clean_tokens_by_patterns_over_the_whole_text(spark):
    """No pattern is run word by word; every step as the word-by-word rules have it."""
    import re
    rnd = random.Random(4)
    words = ["http", "HTTP://a", "www.", "WWW.x", "@", "@a", '"@a', "the", "Don't", "can't", "x", "-", "--ab--", "1.2", "1a2", "..12",
             "a1", "A-b_c", "ÉTÉ.", "(word),", "a@b", "\u0660x", "ha\u2028"]
    rows = [(i, "".join(rnd.choice(words) + rnd.choice([" ", "", "\t", "\x0b", "  ", "\r\n"]) for _ in range(rnd.randint(0, 14))))
            for i in range(400)]
    out = TK.clean_tokens(spark.createDataFrame(rows + [(-1, None), (-2, "")], "i long, t string"), "t")
    assert "lambdafunction(regexp_replace" not in out._jdf.queryExecution().optimizedPlan().toString()
    stop = set(TK.default_stopwords())

    def want(text):
        got = []
        for t in re.split("[ \t\n\r\f\x0b]+", text):
            t = t.lower()
            if t.startswith(("@", "http", "www.")):
                continue
            t = re.sub(r"^[\W_]+|[\W_]+$", "", t)
            if len(t) > 1 and t not in stop and (t := re.sub(r"[\W\d_]", "", t)):
                got.append(t)
        return got

    texts = dict(rows)
    for r in out.collect():
        assert r.tokens == want(texts.get(r.i) or ""), texts.get(r.i)


def test_phrases_by_a_map_before_the_join(spark):
    """Pairs that are no phrase go by a map of fixed size before the join; no word-by-word lambda makes the pairs."""
    rnd = random.Random(12)
    rows = [(i, [rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 30))]) for i in range(50)] + [(100, []), (101, None)]
    d = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    ph = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "c"), ("a", "b")], "word_a string, word_b string")
    out = PH.apply_phrases(d, ph, "doc_id")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.index("Join LeftSemi, ((word_a") < plan.index("shiftleft")     # the map's join is below the phrases'
    pairs, texts = {("a", "b"), ("b", "c"), ("c", "c")}, dict(rows)
    for r in out.collect():
        t, want, i = texts[r.doc_id], [], 0
        while t and i < len(t):
            two = tuple(t[i:i + 2]) in pairs
            want.append("_".join(t[i:i + 1 + two]))
            i += 1 + two
        assert r.tokens == (None if t is None else want)
    learned = PH.learn_phrases(d, "tokens", min_count=1, threshold=0.0, materialize=False)
    assert "lambdafunction" not in learned._jdf.queryExecution().optimizedPlan().toString()
    n, two, one = {}, {}, {}
    for _, t in rows:
        for w in t or []:
            one[w] = one.get(w, 0) + 1
        for p in zip(t or [], (t or [])[1:]):
            two[p] = two.get(p, 0) + 1
    for r in learned.collect():
        p = (r.word_a, r.word_b)
        assert (r.pair_count, r.count_a, r.count_b) == (two[p], one[p[0]], one[p[1]])
        assert abs(r.score - (two[p] - 1) / one[p[0]] / one[p[1]] * (len(one) + len(two))) < 1e-9
        n[p] = 1
    assert len(n) == sum(v > 1 for v in two.values())


def test_rare_pairs_are_not_stored(spark):
    """Learning stores frequent pairs and one row per word for its others; the walk makes no row of a token and its kind."""
    from echolens.operators import phrases
    rnd = random.Random(13)
    docs = [[rnd.choice("abcdefghijkl") for _ in range(rnd.randint(0, 12))] for _ in range(40)] + [["a", "b"] * 9, [], None, ["z"], [None, "a", None]]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id long, tokens array<string>")
    stored, keep = [], phrases.cut_lineage
    phrases.cut_lineage = lambda x, large=False: (stored.append(keep(x, large)), stored[-1])[1]
    try:
        got = phrases.learn_phrases(d, min_count=3, threshold=0.0).collect()
    finally:
        phrases.cut_lineage = keep
    one, two = {}, {}
    for t in docs:
        for i, w in enumerate(t or []):
            one[w] = one.get(w, 0) + 1
            if i + 1 < len(t) and t[i + 1] is not None:
                two[w, t[i + 1]] = two.get((w, t[i + 1]), 0) + 1
    often = {p: n for p, n in two.items() if n > 3}
    assert 0 < len(often) < len(two) and stored[0].count() <= len(often) + len(one)
    assert {(r.word_a, r.word_b): r.pair_count for r in got} == often
    for r in got:
        assert (r.count_a, r.count_b) == (one[r.word_a], one[r.word_b])
        assert abs(r.score - (r.pair_count - 3) / r.count_a / r.count_b * (len(one) + len(two))) < 1e-9
    out = phrases.apply_phrases(d, spark.createDataFrame(got), "doc_id")
    assert "named_struct" not in out._jdf.queryExecution().optimizedPlan().toString()
