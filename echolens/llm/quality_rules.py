"""Quality rules: a threshold table compiled into one Spark projection.

The base measures of a text and the ratios the thresholds look at are all
built-in SQL expressions (regular expressions and array functions), so the
whole operator is a projection: no shuffle, no user function.  ``RULES`` is
the threshold table; :func:`verdict` compiles any such table into one
boolean column.

Repeated 5-word windows are found without comparing windows pairwise: the
windows of one text, each as the 64-bit hash of its words' 64-bit hashes, are
sorted together with their positions, equal windows then lie side by side,
and the covered words follow from the gaps between the sorted positions of
repeated windows - n log n for a text of n words.  Texts whose windows are
all distinct skip the sort.  (Two different windows of a text of 20,000
words share a hash with odds of about one in 10^11.)

Defined results: null or empty text has no words and fails the base rule;
very long texts are read whole; repeated rows are judged one by one; an
empty table gives an empty result; columns other than the id and the text
are never read by :func:`measure`, and :func:`filter_documents` returns all
of them untouched whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import sql_words

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# The stop-word ratio counts one word more than found, so that a short clean text without any is not rejected.

# Frequent function words of the corpus languages (fixed values).
STOP_WORDS = (
    "the", "of", "and", "a", "an", "to", "in", "is", "that", "it", "was", "for", "on", "with", "as", "be", "by",
    "at", "from", "this", "are", "or", "not", "he", "what", "here",
    "der", "die", "das", "und", "ein", "eine", "den", "dem", "von", "zu", "mit", "ist", "im", "nicht", "auf",
    "sich", "für", "des", "als", "auch",
    "le", "la", "les", "de", "du", "un", "une", "et", "en", "est", "que", "qui", "dans", "pour", "par", "sur",
    "au", "pas", "avec", "il",
    "el", "los", "las", "y", "una", "por", "para", "con", "del", "se", "lo", "su", "no", "es",
)


@dataclass(frozen=True)
class Rule:
    """``low <= measure <= high`` (either bound may be absent)."""
    name: str
    measure: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("word length", "mean_word_chars", 2.0, 15.0),
    Rule("symbols per word", "symbol_ratio", None, 0.2),
    Rule("stop words", "stop_ratio", 0.02, None),
    Rule("repeated lines", "dup_line_ratio", None, 0.5),
)


def measure(docs: DataFrame, text: str = "text", keep: tuple = ("doc_id",)) -> DataFrame:
    """``keep`` plus the base measures and the ratios of every row's whole text."""
    d = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("t"))
    d = d.select(*keep, "t", sql_words(F.col("t")).alias("w"),
                 F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    d = d.select(
        *keep, F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("w", lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long").alias("n_stop"),
        F.size("lines").cast("long").alias("n_lines"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    base = [*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_stop", "n_lines"]
    window = F.transform(F.sequence(F.lit(0), F.greatest(F.size("h") - WINDOW, F.lit(0))),
                         lambda i: F.xxhash64(*[F.get("h", i + k) for k in range(WINDOW)]))
    d = d.select(*base, window.alias("g"))
    placed = F.sort_array(F.transform("g", lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
    d = d.select(*base, F.when(F.size(F.array_distinct("g")) < F.size("g"), placed).otherwise(
        F.array().cast("array<struct<g:bigint,i:int>>")).alias("s"))
    twin = F.transform("s", lambda x, j: F.when(
        F.coalesce(F.get("s", j - 1)["g"] == x["g"], F.lit(False))
        | F.coalesce(F.get("s", j + 1)["g"] == x["g"], F.lit(False)), x["i"]))
    d = d.select(*base, F.sort_array(F.array_compact(twin)).alias("p"))
    gaps = F.transform("p", lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get("p", j + 1), i + WINDOW) - i))
    d = d.select(*base, F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    words = F.greatest(F.col("n_words"), F.lit(1))
    return d.select(
        *d.columns, base.alias("base_failed"),
        (F.col("word_chars") / words).alias("mean_word_chars"), (F.col("n_symbols") / words).alias("symbol_ratio"),
        ((F.col("n_stop") + 1) / words).alias("stop_ratio"),
        (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("dup_line_ratio"))


def verdict(rules=RULES) -> Column:
    """The threshold table as one boolean column over the measures."""
    ok = ~F.col("base_failed")
    for r in rules:
        if r.low is not None:
            ok = ok & (F.col(r.measure) >= r.low)
        if r.high is not None:
            ok = ok & (F.col(r.measure) <= r.high)
    return ok


def judge(docs: DataFrame, text: str = "text", keep: tuple = ("doc_id",), rules=RULES) -> DataFrame:
    """One row per row of ``docs``: measures, ``base_failed`` and ``kept``."""
    return measure(docs, text, keep).withColumn("kept", verdict(rules))


def filter_documents(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns."""
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("body"))
    # The row number keeps the optimizer from copying the whole projection chain into a pushed-down predicate.
    judged = judge(boxed, "body", ("row",), rules).withColumn("n", F.monotonically_increasing_id())
    return judged.filter(F.col("kept") & (F.col("n") >= 0)).select("row.*")


def query(spark, sf_dir):
    from .base import table
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def oracle_sql(rules=RULES) -> str:
    """The same table in DuckDB SQL."""
    stop = ", ".join("'" + w + "'" for w in STOP_WORDS)
    limits = " AND ".join([f"{r.measure} >= {r.low}" for r in rules if r.low is not None]
                          + [f"{r.measure} <= {r.high}" for r in rules if r.high is not None])
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT rid, i, array_to_string(list_slice(w, i, i + 4), ' ') AS g
      FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM g) WHERE n > 1),
c AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM r) GROUP BY rid),
m AS (SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
             len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS n_stop, len(lines) AS n_lines
      FROM w LEFT JOIN c ON w.rid = c.rid),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
             word_chars / greatest(n_words, 1) AS mean_word_chars, n_symbols / greatest(n_words, 1) AS symbol_ratio,
             (n_stop + 1) / greatest(n_words, 1) AS stop_ratio, n_dup_lines / greatest(n_lines, 1) AS dup_line_ratio FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {limits} AS kept
FROM b
"""
