"""Conversation structure repair: bidirectional Dijkstra over the edit lattice.

A node of the lattice is (rows consumed, state of the role pattern ``(s?(ua)+)?``); its edges keep a row (cost 0),
give it another role (2), delete it (3) or insert an empty row (2), and a truncated row that stays costs 1 more.
Forward and reverse heaps settle nodes until their smallest costs together exceed the best crossing, so every
crossing of that cost is known; of those the least concatenated audit (the edits' initials in order) wins.

Audits of equal cost between the same two nodes are never prefixes of one another (they spell the same path with more
inserts, which cost more), so the least of a concatenation is the concatenation of the least.  That lets a
conversation be solved in blocks of ``BLOCK`` rows: each block between every pair of states, the blocks joined in
order by their ends, the digest of the repaired text carried along for each end state.  Memory is bounded by a block
and the audits, however long a conversation is.

Spark damages and flags rows natively.  Repeats are found by a window over (conversation, role, text digest), which
deals a long conversation out; then rows are dealt by conversation, sorted on disk and streamed in order, because the
digest is a chain over the conversation's text.

Defined results: a null role or text is one space (so the row is blank or has another role); a null turn sorts first
and counts for no gap; a null id is a conversation of its own; rows of one turn stand in order of role and text, so
that repeated rows are adjacent; a conversation whose rows were all dropped has zeros, an empty audit and the digest
of the empty text; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import table
from .crc import crc_sql

BLOCK = 512
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
# States of the pattern: nothing yet, after s, after u, after a; the first and the last may end a conversation.
STATES, ENDS = (0, 1, 2, 3), (0, 3)
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
MADE = {q: [(c, STEP[q, c]) for c in "ua" if (q, c) in STEP] for q in STATES}       # roles that may be made in a state
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}


def edges(row: tuple) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, letter) of the edits of one row ``(initial, must_go, truncated)``."""
    initial, must_go, truncated = row
    out = [(q, q, DELETE, "D") for q in STATES]
    if not must_go:
        out += [(q, STEP[q, initial], KEEP + truncated * TRUNCATED, "K") for q in STATES if (q, initial) in STEP]
        out += [(q, to, REROLE + truncated * TRUNCATED, "R") for q in STATES for _, to in MADE[q]]
    return out


INSERTS = [(q, to, INSERT, "I") for q in STATES for _, to in MADE[q]]


def least_audit(lattice: list, start: int, ends: tuple) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest edits that lead from ``start`` over all rows' edges into one of ``ends``."""
    n = len(lattice)
    label = ({(0, start): (0, "")}, {(n, q): (0, "") for q in ends})
    heap = ([(0, 0, start)], [(0, 0, q) for q in ends])
    done = (set(), set())
    best = 0 if n == 0 and start in ends else float("inf")
    while heap[0] and heap[1] and heap[0][0][0] + heap[1][0][0] <= best:
        side = 0 if heap[0][0][0] <= heap[1][0][0] else 1
        cost, far, q = heapq.heappop(heap[side])
        at = n - far if side else far
        if (at, q) in done[side]:
            continue
        done[side].add((at, q))
        audit = label[side][at, q][1]
        # within one cost, nodes nearer to the side's start come first: free edges only lead away from it
        steps = [(0, e) for e in INSERTS]
        if side and at:
            steps += [(1, e) for e in lattice[at - 1]]
        elif not side and at < n:
            steps += [(1, e) for e in lattice[at]]
        for rows, (a, b, c, letter) in steps:
            if (b if side else a) != q:
                continue
            node = (at - rows, a) if side else (at + rows, b)
            new = (cost + c, letter + audit if side else audit + letter)
            if node not in done[side] and new < label[side].get(node, (float("inf"),)):
                label[side][node] = new
                heapq.heappush(heap[side], (new[0], far + rows, node[1]))
            if node in label[1 - side]:
                best = min(best, new[0] + label[1 - side][node][0])
    crossings = [(x[0] + y[0], x[1] + y[1]) for node, x in label[0].items() if (y := label[1].get(node))]
    return min(crossings, default=None)


def replay(rows: list[tuple], audit: str, state: int) -> Iterator[str]:
    """The ``role:text`` of the rows that ``audit`` leaves, from the state on; rows are (role, text)."""
    source = iter(rows)
    for letter in audit:
        if letter == "I":
            initial, state = MADE[state][0]
            yield f"{ROLES[initial]}:"
            continue
        role, text = next(source)
        if letter == "K":
            state = STEP[state, role[0]]
            yield f"{role}:{text}"
        elif letter == "R":
            initial, state = MADE[state][0]
            yield f"{ROLES[initial]}:{text}"


class Conversation:
    """One conversation's rows in order, block by block."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.turns = None       # (least, largest, different ones, last)
        self.before = None
        self.block: list[tuple] = []
        self.ends = {0: (0, "", hashlib.sha256(), True)}      # state -> cost, audit, digest so far, nothing written yet

    def add(self, turn, role: str, text: str, blank: bool, repeat: bool, open_end: bool) -> None:
        fault = "blank" if blank else "duplicate" if repeat else "truncated" if open_end else None
        if fault:
            self.counts[fault] += 1
        if self.before is not None and self.before + role[:1] not in LEGAL:
            self.counts["illegal"] += 1
        self.before = role[:1]
        if turn is not None:
            low, high, n, last = self.turns or (turn, turn, 0, None)
            self.turns = (min(low, turn), max(high, turn), n + (turn != last), turn)
        self.block.append((role, text, (role[:1], fault in ("blank", "duplicate"), fault == "truncated")))
        if len(self.block) == BLOCK:
            self.close(STATES)

    def close(self, targets: tuple) -> None:
        """Solve the block at hand from every end so far to every target; join them in order."""
        lattice, new = [edges(r[2]) for r in self.block], {}
        for q, (cost, audit, digest, fresh) in self.ends.items():
            for to in targets:
                found = least_audit(lattice, q, (to,))
                if found and (cost + found[0], audit + found[1]) < new.get(to, (float("inf"),))[:2]:
                    new[to] = (cost + found[0], audit + found[1], q, found[1])
        ends = {}
        for to, (cost, audit, q, part) in new.items():
            digest, fresh = self.ends[q][2].copy(), self.ends[q][3]
            for line in replay([r[:2] for r in self.block], part, q):
                digest.update((line if fresh else "\n" + line).encode("utf-8", "surrogatepass"))
                fresh = False
            ends[to] = (cost, audit, digest, fresh)
        self.ends, self.block = ends, []

    def result(self) -> tuple:
        self.close(ENDS)
        cost, audit, digest, _ = min(self.ends.values(), key=lambda e: e[:2])
        low, high, n, _ = self.turns or (0, -1, 0, None)
        return (self.conv_id, high - low + 1 - n, *self.counts.values(), cost, audit, digest.hexdigest())


RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
_SPACE = r"\x20\x09-\x0D"


def flagged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (nulls: one space) of every row with ``blank``, ``repeat`` and ``open_end``."""
    text = F.coalesce("text", F.lit(" "))
    r = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                    F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"),
                    *([F.col("gone")] if "gone" in rows.columns else [F.lit(False).alias("gone")]))
    r = r.withColumn("blank", ~F.col("text").rlike(f"[^{_SPACE}]")).withColumn(
        "open_end", ~F.col("text").rlike(rf"[.!?][{_SPACE}]*\z"))
    same = Window.partitionBy("conv_id", "gone", "role", F.sha2("text", 256)).orderBy("turn")
    plain = ~F.col("blank") & ~F.col("gone")
    seen = r.filter(plain).withColumn("repeat", F.row_number().over(same) > 1)
    return seen.unionByName(r.filter(~plain).withColumn("repeat", F.lit(False)))


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows(conv_id, turn, role, text[, gone])``: what was wrong and the least audit.

    Rows marked ``gone`` only name their conversation.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, out = None, []
        names = [c.split()[0] for c in RESULT.split(", ")]
        for b in batches:
            for conv_id, turn, role, text, gone, blank, repeat, open_end in zip(
                    b["conv_id"].astype("object"), b["turn"].astype("object"), b["role"], b["text"], b["gone"], b["blank"],
                    b["repeat"], b["open_end"]):
                conv_id = None if pd.isna(conv_id) else int(conv_id)
                if now is None or conv_id != now.conv_id:
                    if now:
                        out.append(now.result())
                    now = Conversation(conv_id)
                if not gone:
                    now.add(None if pd.isna(turn) else int(turn), role, text, blank, repeat, open_end)
            yield _frame(out, names)
            out = []
        if now:
            yield _frame([now.result()], names)

    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "repeat"]
    dealt = flagged(rows).repartition("conv_id").sortWithinPartitions(*order)
    cols = ["conv_id", "turn", "role", "text", "gone", "blank", "repeat", "open_end"]
    return dealt.select(F.col("conv_id").cast("string"), F.col("turn").cast("string"), *cols[2:]).mapInPandas(run, RESULT)


def _frame(rows: list, names: list) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names).astype({"conv_id": "Int64"})


def damaged(rows: DataFrame) -> DataFrame:
    """The test damage: a digest of ``conv_id:turn`` drops, empties, opens, repeats or renames rows."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *names)) % 20
    text = F.coalesce("text", F.lit(" "))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind == 0).alias("gone"), F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy"))


def query(spark, sf_dir):
    return repair(damaged(table(spark, sf_dir, "conversations")))


_INSERTED = ", ".join(f"({q}, {to}, {n}, [{made}])" for q, to, n, made in [
    *((q, q, 0, "") for q in STATES),
    *((q, to, 1, f"'{ROLES[c]}:'") for q in STATES for c, to in MADE[q]),
    *((q, to, 2, f"'{ROLES[c]}:', '{ROLES[d]}:'") for q in STATES for c, at in MADE[q] for d, to in MADE[at])])
_STEPS = ", ".join([*(f"({q}, '{c}', {to}, 'K', '')" for (q, c), to in STEP.items()),
                    *(f"({q}, NULL, {to}, 'R', '{ROLES[c]}')" for q in STATES for c, to in MADE[q]),
                    *(f"({q}, NULL, {q}, 'D', '')" for q in STATES)])

# The same damage and faults; the cheapest edits row by row, the least cost and audit kept for every state.
ORACLE = f"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc_sql("hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')))")} % 20 AS kind
  FROM conversations),
dm AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM k WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM dm),
fl AS (SELECT *, NOT regexp_matches(text, '[^{_SPACE}]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
              NOT regexp_matches(text, '[.!?][{_SPACE}]*$') AS open_end, lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before
       FROM o),
rw AS (SELECT conv_id, turn, i, role, text, substr(role, 1, 1) AS initial, blank OR seen AS must_go, NOT blank AND NOT seen AND open_end AS truncated,
              blank, NOT blank AND seen AS duplicate,
              i > 1 AND substr(before, 1, 1) || substr(role, 1, 1) NOT IN ('su', 'ua', 'au') AS illegal
       FROM fl),
cv AS (SELECT DISTINCT conv_id FROM conversations),
n AS (SELECT cv.conv_id, count(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
             count(*) FILTER (illegal) AS illegal
      FROM cv LEFT JOIN rw ON cv.conv_id IS NOT DISTINCT FROM rw.conv_id GROUP BY cv.conv_id),
ins AS (SELECT * FROM (VALUES {_INSERTED}) AS x(q, too, n_made, made)),
st AS (SELECT * FROM (VALUES {_STEPS}) AS x(q, initial, too, letter, role)),
lat AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS q, 0 AS cost, '' AS audit, []::VARCHAR[] AS kept FROM cv
  UNION ALL
  SELECT conv_id, i, q, cost, audit, kept FROM (
    SELECT l.conv_id, r.i, st.too AS q,
           l.cost + {INSERT} * ins.n_made + CASE letter WHEN 'D' THEN {DELETE} WHEN 'R' THEN {REROLE} ELSE {KEEP} END
           + CASE WHEN r.truncated AND letter <> 'D' THEN {TRUNCATED} ELSE 0 END AS cost,
           l.audit || repeat('I', ins.n_made) || letter AS audit,
           list_concat(l.kept, list_concat(ins.made, CASE letter WHEN 'D' THEN [] WHEN 'R' THEN [st.role || ':' || r.text] ELSE [r.role || ':' || r.text] END)) AS kept
    FROM lat l JOIN rw r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.i = l.i + 1
               JOIN ins ON ins.q = l.q JOIN st ON st.q = ins.too AND coalesce(st.initial, r.initial) = r.initial AND (letter = 'D' OR NOT r.must_go))
  QUALIFY row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) = 1),
fin AS (SELECT * FROM (SELECT l.conv_id, l.cost + {INSERT} * ins.n_made AS cost, l.audit || repeat('I', ins.n_made) AS audit, list_concat(l.kept, ins.made) AS kept
        FROM lat l JOIN n ON n.conv_id IS NOT DISTINCT FROM l.conv_id AND l.i = n.n JOIN ins ON ins.q = l.q AND ins.too IN (0, 3))
        QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1)
SELECT n.conv_id, gaps, blank, duplicate, truncated, illegal, cost::BIGINT AS cost, audit, sha256(array_to_string(kept, chr(10))) AS repaired_sha256
FROM n JOIN fin ON n.conv_id IS NOT DISTINCT FROM fin.conv_id
"""
