"""MinHash near-duplicates with an LSH forest.

A signature of ``trees * depth`` minhashes is cut into ``trees`` orders.  In
each order the texts are sorted by their signature values; texts that share
the first ``depth`` values form a region, and inside a region the following
values go on sorting, so that a text lies beside those with which it shares
the longest prefix, however crowded the region is: the depth adapts to the
region.  The neighbours within ``reach`` places are candidates.  A region
with more texts than that, of more than one component, is then held against
itself whole: its texts are dealt into salted blocks, and each pair of blocks
compares all its texts of different components, first their signatures, then
their full sets.  So every two texts that share a region in some order are
compared.  A pair of blocks returns as many links as join its components, so
a crowd never becomes a table of its pairs.

Copies are folded first (one class per distinct shingle set), so a group of
a million copies is one entry of the forest.  Candidates are confirmed on
full shingle sets, in rounds: the nearest neighbours in the first ``FIRST``
orders; then all neighbours in all orders, which are sorted with each text's
component, so that a crowd of linked texts forms no pairs; then the crowded
regions, whole; then, at least once and as long as that finds links, texts
that met a component in some region without a link are held against all of
its texts, in salted blocks too.  Each round writes its links to
the shared folder; pairs within a component are never formed again, and
later links join whole components.

No task gets a whole region or group: the sorted orders are dealt by range,
and the pairs by their ids.

Before full sets are shuffled, a pair's whole signatures are compared: a pair
whose equal minhashes are so few that a link of the required similarity has
them with a chance below ``MISS`` isn't held against full sets (with 80
minhashes and 0.8: fewer than 43).  The forest's own chance of a miss is far
larger; no link is taken from signatures alone.

Defined results: null or empty text has an empty set and is linked with
nothing; a null ``doc_id`` can't be named by a link, so such a row is its
own (null) component and is kept; a repeated row gets the same answer each
time; a very long text is hashed in segments; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import mix64, write_table
from .components import components
from .shingles import shingle_set

TREES = 20
DEPTH = 4
REACH = 6
FIRST = 4
BLOCK = 1 << 20   # shingles of a block, each text counted with TEXT more
TEXT = 256
MISS = 1e-7
BITS = 1 << 23


def _hashers(n: int):
    k = mix64(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return k[:n], k[n:] | np.uint64(1)


def _signature(h: np.ndarray, xor: np.ndarray, mul: np.ndarray) -> np.ndarray:
    best = np.full(len(xor), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(h), 512):
        m = (h[i:i + 512, None] ^ xor) * mul
        np.minimum(best, m.min(axis=0), out=best)
    return (best >> np.uint64(32)).astype(np.uint32)


def signatures(docs: DataFrame, text: str = "text", words: int = 5, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """Per row: doc_id, n_shingles, a 128-bit print of its shingle set, and its minhash signature."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        xor, mul = _hashers(trees * depth)
        for b in batches:
            rows = []
            for t in b["t"]:
                h = shingle_set(t, words)
                rows.append((len(h), int(h.sum(dtype=np.uint64).astype(np.int64)),
                             int(mix64(h).sum(dtype=np.uint64).astype(np.int64)),
                             _signature(h, xor, mul).tobytes() if len(h) else None))
            out = pd.DataFrame(rows, columns=["n_shingles", "p1", "p2", "sig"])
            out.insert(0, "doc_id", b["doc_id"])
            yield out.astype({"n_shingles": "int64", "p1": "int64", "p2": "int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("t")).mapInPandas(
        run, "doc_id long, n_shingles long, p1 long, p2 long, sig binary")


def _forest(classes: DataFrame, trees: int, depth: int) -> DataFrame:
    """(region, d1, d2, doc, comp): one row per text and order; sorting by it is the forest."""
    def run(batches):
        for b in batches:
            if not len(b):
                continue
            s = np.stack([np.frombuffer(x, np.uint32) for x in b["sig"]]).astype(np.uint64)
            width = s.shape[1]
            for t in range(trees):
                at = [(t * depth + i) % width for i in range(depth + 4)]
                key = np.full(len(s), t + 1, np.uint64)
                for i in at[:depth]:
                    key = mix64(key * np.uint64(0xD6E8FEB86659FD93) + s[:, i])
                d = [((s[:, at[depth + i]] << np.uint64(32)) | s[:, at[depth + i + 1]]).view(np.int64) for i in (0, 2)]
                yield pd.DataFrame({"region": key.view(np.int64), "d1": d[0], "d2": d[1], "doc": b["doc"].to_numpy(),
                                    "comp": b["comp"].to_numpy()})

    return classes.select("doc", "comp", "sig").mapInPandas(
        run, "region long, d1 long, d2 long, doc long, comp long")


def _neighbours(reach: int, crowds: bool = True):
    """Over sorted rows: pairs of one region and two components at most ``reach`` places apart (``apart`` > 0); with
    ``crowds`` the rows of regions of more than ``reach + 1`` texts (``apart`` -1, some twice); and the first and last
    ``reach + 1`` rows of the partition (``apart`` 0), whose partners may lie in the next one."""
    edge = reach + 1

    def run(batches):
        tail, seen = None, 0
        for b in batches:
            if not len(b):
                continue
            if seen < edge:
                yield b.iloc[:edge - seen].assign(a=0, b=0, apart=0)
            seen += len(b)
            old = 0 if tail is None else len(tail)
            x = b if tail is None else pd.concat([tail, b])
            region, doc, comp = (x[c].to_numpy() for c in ("region", "doc", "comp"))
            for d in range(1, min(reach + 1, len(x))):
                lo = max(0, old - d)
                same = np.flatnonzero((region[lo:len(x) - d] == region[lo + d:]) & (comp[lo:len(x) - d] != comp[lo + d:])) + lo
                if len(same):
                    a, c = doc[same], doc[same + d]
                    yield pd.DataFrame({"region": 0, "d1": 0, "d2": 0, "doc": 0, "comp": 0,
                                        "a": np.minimum(a, c), "b": np.maximum(a, c), "apart": d})
            if crowds and len(x) > edge:
                from_here = np.flatnonzero(region[:-edge] == region[edge:])
                step = np.zeros(len(x) + 1, np.int64)
                step[from_here] += 1
                step[from_here + edge + 1] -= 1
                crowd = np.cumsum(step[:-1]) > 0
                if crowd.any():
                    yield x[crowd].assign(d1=0, d2=0, a=0, b=0, apart=-1)
            tail = x.iloc[-edge:]
        if tail is not None:
            yield tail.assign(a=0, b=0, apart=0)
    return run


def candidates(classes: DataFrame, trees: int = TREES, depth: int = DEPTH, reach: int = REACH,
               crowds: bool = True) -> tuple[DataFrame, DataFrame]:
    """(a, b): texts of different ``comp`` that are neighbours in some order; and with ``crowds`` (grp, doc): the texts of
    regions that have more than ``reach + 1``."""
    order = ["region", "d1", "d2", "doc"]
    schema = "region long, d1 long, d2 long, doc long, comp long, a long, b long, apart int"
    forest = _forest(classes, trees, depth)
    n = max(1, int(forest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = forest.repartitionByRange(n, *order).sortWithinPartitions(*order)
    found = write_table(ranged.mapInPandas(_neighbours(reach, crowds), schema), "neighbours")
    # At most 2 * (reach + 1) rows per partition meet in one task: a number of partitions, not of texts.
    edges = found.filter("apart = 0").select(*order, "comp").distinct().repartition(1).sortWithinPartitions(*order)
    found = found.union(edges.mapInPandas(_neighbours(reach, crowds), schema))
    return (found.filter("apart > 0 AND a <> b").select("a", "b").distinct(),
            found.filter("apart < 0").select(F.col("region").alias("grp"), "doc").distinct())


def least_equal(width: int, percent: int, miss: float = MISS) -> int:
    """The most equal minhashes of ``width`` that a pair of similarity ``percent`` undercuts with a chance below ``miss``."""
    p, tail, n = percent / 100, 0.0, 0
    while n < width and tail + comb(width, n) * p**n * (1 - p)**(width - n) < miss:
        tail += comb(width, n) * p**n * (1 - p)**(width - n)
        n += 1
    return n


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).distinct()


def plausible(pairs: DataFrame, classes: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs whose signatures agree often enough for a link."""
    least = least_equal(width, percent)

    def run(batches):
        for b in batches:
            if not len(b):
                continue
            x, y = (np.stack([np.frombuffer(v, np.uint32) for v in b[c]]) for c in ("sa", "sb"))
            yield b.loc[(x == y).sum(1) >= least, ["a", "b"]]

    sigs = classes.select("doc", "sig").join(_ends(pairs), "doc", "left_semi")
    j = pairs.select("a", "b").join(sigs.select(F.col("doc").alias("a"), F.col("sig").alias("sa")), "a")
    j = j.join(sigs.select(F.col("doc").alias("b"), F.col("sig").alias("sb")), "b").select("a", "b", "sa", "sb")
    return j.mapInPandas(run, "a long, b long")


def _linked(percent: int, trees: int, depth: int, members: bool):
    """Over one pair of blocks (``half`` 0 and 1; 2: a block with itself): links (a, b) of full sets, as many as join the
    components that its texts' links join; and, not ``linked``, each text with the components of more than one text
    (``many``) that it was held against without a link.

    The texts of a region agree in one order; a pair that also shares an earlier one is left to that one's region.
    ``members``: the texts are a component's and those that met it; a pair that shares any region was held there.
    """
    least = least_equal(trees * depth, percent)

    def run(g: pd.DataFrame) -> pd.DataFrame:
        half, doc, many = g["half"].to_numpy(), g["doc"].to_numpy(), g["many"].to_numpy()
        names, comp = np.unique(g["comp"].to_numpy(), return_inverse=True)
        s = np.stack([np.frombuffer(v, np.uint32) for v in g["sig"]])
        ids = np.unique(np.frombuffer(b"".join(g["hashes"]), np.uint64), return_inverse=True)[1]
        size = np.array([len(v) >> 3 for v in g["hashes"]])
        start = np.cumsum(size) - size
        own = bool((half == 2).any())
        x, y = (np.arange(len(g)),) * 2 if own else (np.flatnonzero(half == 0), np.flatnonzero(half == 1))
        across = np.ascontiguousarray(s[y].T)
        alike = (s == s[0]).reshape(-1, trees, depth).all((0, 2))
        before = trees if members else int(alike.argmax()) if alike.any() else 0
        root, mark = np.arange(len(names)), np.zeros(int(ids.max()) + 1, np.int32)
        out, met = [], [np.zeros(0, np.int64)]
        for k, i in enumerate(x):
            equal = across == s[i][:, None]
            enough = equal.sum(0, dtype=np.uint16) >= least
            at = np.flatnonzero(enough & (root[comp[y]] != root[comp[i]])
                                & (100 * np.minimum(size[y], size[i]) >= percent * np.maximum(size[y], size[i])))
            at = at[at > k] if own else at
            at = at[~equal[:, at].reshape(trees, depth, -1).all(1)[:before].any(0)]
            if not len(at):
                continue
            j = y[at]
            n, mine = size[j], ids[start[i]:start[i] + size[i]]
            first = np.cumsum(n) - n
            mark[mine] = 1
            both = np.add.reduceat(mark[ids[np.repeat(start[j] - first, n) + np.arange(n.sum())]], first)
            mark[mine] = 0
            link = 100 * both >= percent * (size[i] + n - both)
            for r, q in zip(*np.unique(root[comp[j[link]]], return_index=True)):
                out.append((doc[i], doc[j[link][q]]))
                root[root == r] = root[comp[i]]
            j = j[~link]
            met.append(np.concatenate([i * len(names) + np.unique(comp[j[many[j]]]), (j * len(names) + comp[i])[many[[i]].repeat(len(j))]]))
            if len(met) > 1000:
                met = [np.unique(np.concatenate(met))]
        met = np.unique(np.concatenate(met)) if not members else met[0][:0]
        row, other = met // len(names), met % len(names)
        apart = root[comp[row]] != root[other]
        links = pd.DataFrame(np.array(out, np.int64).reshape(-1, 2), columns=["a", "b"]).assign(linked=True)
        return pd.concat([links, pd.DataFrame({"a": doc[row[apart]], "b": names[other[apart]], "linked": False})])
    return run


def by_text(rows: DataFrame, *places: str) -> DataFrame:
    """(doc, places): each text with the ``places`` columns of all its rows, in a list."""
    return rows.groupBy("doc").agg(F.collect_list(F.struct(*places)).alias("places"))


def in_blocks(rows: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, trees: int, depth: int, within: bool,
              members: bool = False, block: int = BLOCK, text: int = TEXT) -> DataFrame:
    """(a, b, linked) of ``rows`` (grp, side, doc, comp, many): in each group the texts of side 1 against those of side 0,
    and with ``within`` against each other, in pairs of salted blocks of about ``block`` shingles; see :func:`_linked`.
    ``b`` of a row that isn't linked is the name of a component."""
    def size(side):
        return F.sum(F.when(F.col("side") == side, F.col("n_shingles") + text).otherwise(0))

    # A text's places go beside it, so that the joins on texts have a row per text and not one per text and group.
    sized = by_text(rows, "grp", "side").join(classes.select("doc", "n_shingles"), "doc").select("n_shingles", F.inline("places"))
    blocks = sized.groupBy("grp").agg(F.ceil(size(0) / block).alias("n0"), F.ceil(size(1) / block).alias("n1"))
    placed = by_text(rows.join(blocks, "grp"), "grp", "side", "comp", "many", "n0", "n1")

    def copies(n, make):
        return F.transform(F.when(F.col(n) > 0, F.sequence(F.lit(0).cast("long"), F.col(n) - 1)).otherwise(
            F.array().cast("array<bigint>")), make)

    def copy(kind, i, j, half):
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), half.alias("half"))

    own = F.col("own")
    left = copies("n1", lambda k: copy(0, own, k, F.lit(0)))
    right = copies("n0", lambda k: copy(0, k, own, F.lit(1)))
    if within:
        right = F.concat(right, copies("n1", lambda k: copy(1, F.least(own, k), F.greatest(own, k), F.when(
            own == k, F.lit(2)).when(own < k, F.lit(0)).otherwise(F.lit(1)))))
    d = placed.join(classes.select("doc", "sig"), "doc").join(sets, "doc").select("doc", "sig", "hashes", F.inline("places"))
    d = d.withColumn("own", F.pmod(F.xxhash64("doc"), F.when(F.col("side") == 0, F.col("n0")).otherwise(F.col("n1"))))
    d = d.select("grp", "doc", "comp", "many", "sig", "hashes", F.inline(F.when(F.col("side") == 0, left).otherwise(right)))
    return d.groupBy("grp", "kind", "i", "j").applyInPandas(
        _linked(percent, trees, depth, members), "a long, b long, linked boolean")


def crowded(crowd: DataFrame, comps: DataFrame) -> DataFrame:
    """(grp, side, doc, comp, many): the texts of ``crowd`` (grp, doc) whose regions aren't all of one component; side 0 is
    the region's largest component, none of whose texts need be compared with each other."""
    sizes = comps.groupBy("component").agg(F.lit(True).alias("many")).withColumnRenamed("component", "comp")
    texts = by_text(crowd, "grp").join(comps.withColumnRenamed("node", "doc"), "doc", "left").withColumn("comp", F.coalesce("component", "doc"))
    texts = texts.join(sizes, "comp", "left").select("doc", "comp", F.coalesce("many", F.lit(False)).alias("many"), "places")
    rows = write_table(texts, "texts").select(F.inline("places"), "doc", "comp", "many")
    mixed = rows.groupBy("grp").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
    rows = rows.join(mixed, "grp", "left_semi")
    rows = write_table(rows, "crowded")
    largest = rows.groupBy("grp", "comp").agg(F.count(F.lit(1)).alias("n")).groupBy("grp").agg(
        F.max(F.struct("n", "comp"))["comp"].alias("most"))
    return rows.join(largest, "grp").select("grp", (F.col("comp") != F.col("most")).cast("int").alias("side"), "doc", "comp", "many")


def _confirm(percent: int):
    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b["sa"], b["sb"]):
                n, m = len(x) >> 3, len(y) >> 3
                both = len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)) \
                    if 100 * min(n, m) >= percent * max(n, m) else 0
                keep.append(100 * both >= percent * (n + m - both))
            yield b.loc[keep, ["a", "b"]]
    return run


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full shingle sets overlap by ``percent`` of their union or more."""
    j = pairs.select("a", "b").join(sets.select(F.col("doc").alias("a"), F.col("hashes").alias("sa")), "a")
    j = j.join(sets.select(F.col("doc").alias("b"), F.col("hashes").alias("sb")), "b").select("a", "b", "sa", "sb")
    return j.mapInPandas(_confirm(percent), "a long, b long")


def _full_sets(docs: DataFrame, text: str, ids: DataFrame, words: int) -> DataFrame:
    def run(batches):
        for b in batches:
            yield pd.DataFrame({"doc": b["doc"], "hashes": [shingle_set(t, words).tobytes() for t in b["t"]]})

    # Texts whose id meets no bit of a map of the wanted ids (BITS / 64 rows at most) go before the join shuffles texts.
    place = F.pmod(F.xxhash64("doc"), F.lit(BITS))
    word, bit = F.shiftright(place, 6).alias("word"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc), {BITS}) & 63 AS int))")
    bits = write_table(ids.groupBy(word).agg(F.bit_or(bit).alias("bits")), "bits")
    d = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col(text).alias("t"))
    d = d.join(F.broadcast(bits), word == bits["word"]).filter(F.col("bits").bitwiseAND(bit) != 0).select("doc", "t")
    # An inner join: a semi join would be moved before the one with the map.
    return d.join(ids.distinct(), "doc").mapInPandas(run, "doc long, hashes binary")


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """``pairs`` whose ends are in different components, with these (``ca``, ``cb``)."""
    for end in ("a", "b"):
        c = comps.select(F.col("node").alias(end), F.col("component").alias("c" + end))
        pairs = pairs.join(c, end, "left").withColumn("c" + end, F.coalesce("c" + end, end))
    return pairs.filter("ca <> cb")


def _joined(comps: DataFrame, links: DataFrame) -> DataFrame:
    """``comps`` after more links: only the components that these touch are worked on."""
    to = components(_apart(links, comps).select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    moved = comps.join(to.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
    return write_table(moved.select("node", F.coalesce("to", "component").alias("component")).union(to), "components")


def met(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """(doc, comp, grp, n): the texts of pairs that no link joined yet, with their own component and the other text's,
    if that has ``n`` > 1 texts."""
    large = comps.groupBy("component").agg((F.count(F.lit(1)) + 1).alias("n")).withColumnRenamed("component", "grp")
    two = _apart(pairs, comps).select(F.inline(F.array(
        F.struct(F.col("a").alias("doc"), F.col("ca").alias("comp"), F.col("cb").alias("grp")),
        F.struct(F.col("b").alias("doc"), F.col("cb").alias("comp"), F.col("ca").alias("grp"))))).distinct()
    return two.join(large, "grp").select("doc", "comp", "grp", "n")


def with_members(meetings: DataFrame, comps: DataFrame) -> DataFrame:
    """Rows for :func:`in_blocks`: each text of ``meetings`` (side 1) with every text of the component that it met (side 0)."""
    members = comps.select("node", "component").union(comps.select("component", "component").distinct())
    rows = members.join(meetings.select("grp").distinct(), F.col("component") == F.col("grp")).select(
        "grp", F.lit(0).alias("side"), F.col("node").alias("doc"), F.col("component").alias("comp"))
    return rows.union(meetings.select("grp", F.lit(1), "doc", "comp")).withColumn("many", F.lit(False))


def near_duplicates(docs: DataFrame, text: str = "text", words: int = 5, percent: int = 80, trees: int = TREES,
                    depth: int = DEPTH, reach: int = REACH) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept, n_links
    (confirmed links found between its class and others)."""
    sigs = write_table(signatures(docs, text, words, trees, depth), "signatures")
    named = sigs.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = write_table(named.groupBy("p1", "p2", "n_shingles").agg(
        F.min("doc_id").alias("doc"), F.first("sig").alias("sig")), "classes")

    def likely(pairs):
        return write_table(plausible(pairs, classes, percent, trees * depth), "likely")

    tested = write_table(candidates(classes.withColumn("comp", F.col("doc")), min(FIRST, trees), depth, 1, False)[0], "pairs")
    held = likely(tested)
    sets = write_table(_full_sets(docs, text, _ends(held), words), "sets")
    links = write_table(confirmed(held, sets, percent), "links")
    comps = components(links)
    placed = classes.select("doc", "sig").join(comps.withColumnRenamed("node", "doc"), "doc", "left").withColumn(
        "comp", F.coalesce("component", "doc"))

    def with_sets(ids):
        nonlocal sets
        missing = ids.join(sets.select("doc"), "doc", "left_anti")
        sets = sets.union(write_table(_full_sets(docs, text, missing, words), "sets"))
        return sets.join(ids, "doc", "left_semi")

    def blocks(rows, within, members=False):
        rows = write_table(rows, "rows")
        return write_table(in_blocks(rows, classes, with_sets(rows.select("doc").distinct()), percent, trees, depth, within, members), "blocks")

    def add(more):
        nonlocal links, comps
        links, comps = links.union(more), _joined(comps, more)

    pairs, crowd = candidates(placed, trees, depth, reach)
    pairs, crowd = write_table(pairs, "pairs"), write_table(crowd, "crowd")
    held = likely(write_table(pairs.join(tested, ["a", "b"], "left_anti"), "new"))
    add(write_table(confirmed(held, with_sets(_ends(held)), percent), "links"))
    single = comps
    found = blocks(crowded(crowd, comps), True)
    more = found.filter("linked").select("a", "b")
    pairs = pairs.union(found.filter("NOT linked").select("a", "b"))
    if not more.isEmpty():
        add(more)
        # Texts that were no component of many before are held against their regions once more, for who met them.
        known = single.select(F.col("node").alias("doc")).union(single.select("component"))
        fresh = write_table(_ends(more).join(known, "doc", "left_anti"), "fresh")
        rows = crowded(crowd, comps).drop("side")
        new = rows.join(fresh, "doc", "left_semi")
        again = rows.join(new.select("grp").distinct(), "grp", "left_semi").withColumn("side", F.lit(1))
        found = blocks(new.withColumn("side", F.lit(0)).unionByName(again), False)
        pairs = pairs.union(found.filter("NOT linked").select("a", "b"))
    done = None
    while True:
        meetings = met(pairs, comps)
        if done is not None:   # a component that has as many texts as before has the same ones
            meetings = meetings.join(done, ["doc", "grp", "n"], "left_anti")
        meetings = write_table(meetings.select("doc", "comp", "grp", "n"), "met")
        more = blocks(with_members(meetings, comps), False, True).select("a", "b")
        if more.isEmpty():
            break
        add(more)
        now = meetings.select("doc", "grp", "n")
        done = now if done is None else done.union(now)
    degree = links.select(F.col("a").alias("rep")).union(links.select("b")).groupBy("rep").agg(F.count(F.lit(1)).alias("n"))
    found = classes.select("p1", "p2", "n_shingles", F.col("doc").alias("rep")).join(
        comps.withColumnRenamed("node", "rep"), "rep", "left").join(degree, "rep", "left").select(
        "p1", "p2", "n_shingles", F.coalesce("component", "rep").alias("c"), F.coalesce("n", F.lit(0)).alias("n_links"))
    full = sigs.select("doc_id", "n_shingles", "p1", "p2").join(found, ["p1", "p2", "n_shingles"], "left")
    own = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("c")).otherwise(F.col("doc_id"))
    return full.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")) \
        .select("doc_id", "n_shingles", "component_id",
                F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), "n_links")


def keep_one_per_group(docs: DataFrame, text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near-duplicate texts; rows without words all stay.

    Rows are told apart by a stored number of their own, so repeated and null
    ids need no care, and a row never goes for another one's text.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("doc_id"))
    rows = write_table(rows, "numbered")
    texts = rows.select("doc_id", F.col(f"row.`{text}`").alias("text"))
    gone = write_table(near_duplicates(texts, "text", words, percent).filter("NOT kept").select("doc_id"), "gone")
    return rows.join(gone, "doc_id", "left_anti").select("row.*")


def query(spark, sf_dir):
    from .base import table
    return near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)
