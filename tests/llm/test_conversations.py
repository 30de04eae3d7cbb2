"""Conversation repair against a brute-force version of the damage, the faults and the cheapest edits."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from echolens.llm import conversations as C

ROWS = "conv_id long, turn long, role string, text string, gone_by string, copy long, blank boolean"


def brute_repair(rows):
    """Least (cost, audit, digest) over the whole lattice, row by row; rows are (role, text, must_go, truncated)."""
    nxt = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    name = {"u": "user", "a": "assistant"}
    best = {"": (0, "", [])}

    def spread(best):
        for _ in range(3):
            for q, (c, a, out) in list(best.items()):
                for x in "ua":
                    if (q, x) in nxt:
                        new = (c + 2, a + "I", out + [f"{name[x]}:"])
                        if nxt[q, x] not in best or new[:2] < best[nxt[q, x]][:2]:
                            best[nxt[q, x]] = new
        return best

    for role, text, must_go, truncated in rows:
        new = {}
        for q, (c, a, out) in spread(best).items():
            options = [(q, c + 3, a + "D", out)]
            if not must_go:
                if (q, role[:1]) in nxt:
                    options.append((nxt[q, role[:1]], c + truncated, a + "K", out + [f"{role}:{text}"]))
                options += [(nxt[q, x], c + 2 + truncated, a + "R", out + [f"{name[x]}:{text}"]) for x in "ua" if (q, x) in nxt]
            for to, *v in options:
                if to not in new or tuple(v[:2]) < new[to][:2]:
                    new[to] = tuple(v)
        best = new
    cost, audit, out = min(v for q, v in spread(best).items() if q in ("", "a"))
    return cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def brute(table, damage=True):
    conv = defaultdict(list)
    for c, t, role, text in table:
        rows = conv[c]
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 if damage else 19
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for c, rows in conv.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns, seen, n, full = [r[0] for r in rows if r[0] is not None], set(), dict.fromkeys("bdti", 0), []
        for i, (_, role, text) in enumerate(rows):
            body = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
            f = "b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            if f:
                n[f] += 1
            if i and rows[i - 1][1][:1] + role[:1] not in ("su", "ua", "au"):
                n["i"] += 1
            full.append((role, text, f in ("b", "d"), f == "t"))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, digest = brute_repair(full)
        out.append((c, gaps, n["b"], n["d"], n["t"], n["i"], cost, audit, digest))
    return sorted(out, key=str)


def random_table(seed, n, longest):
    r = random.Random(seed)
    texts = ["A b.", "A b.", "Why?\n ", "open end", "", " \t", None, "No!", "x. ", "É.", "tail\n."]
    out = []
    for c in [None, *range(n)]:
        for t in range(r.randrange(longest)):
            out.append((c, r.choice([t, t, t, t + 2, None]), r.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool"]),
                        r.choice(texts) if r.random() < 0.5 else f"text {t} of {c}."))
    r.shuffle(out)
    return out


@pytest.mark.parametrize("block", [1, 3, 512])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK", block)
    got = sorted(local_repair(random_table(5, 300, 14), block), key=str)
    assert got == brute(random_table(5, 300, 14), damage=False)


def local_repair(table, block):
    """The operator's class over sorted rows, without Spark."""
    conv = defaultdict(list)
    for c, t, role, text in table:
        conv[c].append((t, " " if role is None else role, " " if text is None else text))
    for c, rows in conv.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        one, seen = C.Conversation(c), set()
        for t, role, text in rows:
            body = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
            one.add(t, role, text, not body, (role, text) in seen, bool(body) and body[-1] not in ".!?")
            seen.add((role, text))
        yield one.result()


def test_query_on_awkward_rows(spark):
    table = random_table(7, 400, 12) + [(9_000, t, "user" if t % 2 else "assistant", f"t{t % 700}") for t in range(2_000)]
    rows = spark.createDataFrame([(*r, "z", 3, None) for r in table], ROWS).repartition(5)
    got = C.repair(C.damaged(rows))
    assert got.columns == [c.split()[0] for c in C.RESULT.split(", ")]
    assert sorted(map(tuple, got.collect()), key=str) == brute(table)


def test_all_dropped_and_empty(spark):
    gone = next(c for c in itertools.count() if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = spark.createDataFrame([(gone, 0, "user", "Hi.", None, None, None)], ROWS)
    assert [tuple(r) for r in C.repair(C.damaged(rows)).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
    assert C.repair(C.damaged(rows.limit(0))).collect() == []
