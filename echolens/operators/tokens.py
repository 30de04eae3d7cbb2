"""Token cleaning as SQL higher-order functions (JVM-side, no Python per row).

``clean_tokens`` (post text, for topics): split on whitespace; drop handles
('@...') and links ('http...', 'www....'); lower-case; strip leading and
trailing punctuation; drop tokens of one character, number-like tokens and
stop words; finally delete every non-letter (digits, '_', inner
punctuation) and drop what is left empty.  The published pipeline also
lemmatised and dropped place names with a trained tagger; an optional
``lemmas`` map (word -> lemma) and ``drop_words`` list stand in for that.

``bio_tokens`` (account bios): keep [a-zA-Z0-9] runs, lower-case, drop stop
words plus the extra bio list, drop numeric tokens and tokens of length <= 2.
"""

from __future__ import annotations

import functools
from importlib import resources

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import BIO_EXTRA_STOPWORDS

# Whitespace that separates raw tokens (spelled out so every engine agrees).
WS_CLASS = r"[ \t\n\r\f\x{0B}]+"
EDGE_PUNCT = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"
NUMBER_LIKE = r"^[\p{N}.,]+$"
NON_LETTER = r"[^\p{L}]"


@functools.lru_cache(maxsize=None)
def _stopwords(language: str) -> tuple:
    text = resources.files("echolens.data").joinpath(f"stopwords_{language}.txt").read_text("utf-8")
    return tuple(w for w in text.split("\n") if w and not w.startswith("#"))


def default_stopwords(language: str = "english") -> list[str]:
    """Spark ML's built-in stop-word list, shipped as package data (no JVM, no session needed)."""
    return list(_stopwords(language))


def _core_tokens(text: Column) -> Column:
    """Lower-case words without edge punctuation, over one character long, numbers among them.

    By patterns over the whole text: a link or handle goes with the blank
    before it; a run of neither letters nor digits that holds a blank parts
    two words and takes the punctuation at their edges with it.
    """
    ws = WS_CLASS[1:-2]
    spaced = F.concat(F.lit(" "), F.lower(text), F.lit(" "))
    kept = F.regexp_replace(spaced, f"[{ws}](?:@|http|www\\.)[^{ws}]*+", "")
    core = F.split(kept, rf"[^\p{{L}}\p{{N}}{ws}]*+[{ws}][^\p{{L}}\p{{N}}]*+", -1)
    return F.filter(core, lambda t: F.length(t) > 1)


def clean_tokens(df: DataFrame, text: str = "content", out: str = "tokens", stopwords=None,
                 lemmas: dict | None = None, drop_words=None) -> DataFrame:
    """Add ``out``: the cleaned token array of ``text`` (null text -> empty array)."""
    stop = list(stopwords) if stopwords is not None else default_stopwords()
    if drop_words:
        stop = stop + [w.lower() for w in drop_words]
    tmp = "_core_" + out
    d = df.withColumn(tmp, _core_tokens(F.coalesce(F.col(text), F.lit(""))))
    if lemmas:
        m = F.create_map(*[x for kv in lemmas.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
        # numbers have no lemma; without a map they go with all that isn't a letter
        d = d.withColumn(tmp, F.transform(F.filter(tmp, lambda t: ~t.rlike(NUMBER_LIKE)), lambda t: F.coalesce(m[t], t)))
    d = StopWordsRemover(inputCol=tmp, outputCol=tmp + "_s", stopWords=stop,
                         caseSensitive=True).transform(d)
    if lemmas:
        cleaned = F.filter(F.transform(tmp + "_s", lambda t: F.regexp_replace(t, NON_LETTER, "")),
                           lambda t: F.length(t) > 0)
    else:   # no word holds a blank: all are cleaned in one string
        cleaned = F.array_remove(F.split(F.regexp_replace(F.array_join(tmp + "_s", " "), r"[^\p{L} ]+", ""), " ", -1), "")
    return d.withColumn(out, cleaned).drop(tmp, tmp + "_s")


def bio_tokens(df: DataFrame, text: str = "description", out: str = "bio_tokens",
               stopwords=None, extra=BIO_EXTRA_STOPWORDS) -> DataFrame:
    stop = (list(stopwords) if stopwords is not None else default_stopwords()) + list(extra)
    tmp = "_bio_" + out
    words = F.filter(F.split(F.lower(F.regexp_replace(F.coalesce(F.col(text), F.lit("")),
                                                      "[^a-zA-Z0-9]+", " ")), " ", -1),
                     lambda t: (F.length(t) > 2) & ~t.rlike("^[0-9]+$"))
    d = df.withColumn(tmp, words)
    d = StopWordsRemover(inputCol=tmp, outputCol=out, stopWords=stop, caseSensitive=True).transform(d)
    return d.drop(tmp)


# -- SQL spelling of clean_tokens for the DuckDB oracle ----------------------

def clean_tokens_sql(text: str, stopwords=None) -> str:
    stop = list(stopwords) if stopwords is not None else default_stopwords()
    stop_list = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in stop) + "]"
    raw = f"string_split_regex(coalesce({text}, ''), '{WS_CLASS}')"
    kept = (f"list_filter({raw}, lambda t: NOT starts_with(t, '@') AND NOT starts_with(lower(t), 'http') "
            f"AND NOT starts_with(lower(t), 'www.'))")
    core = f"list_transform({kept}, lambda t: regexp_replace(lower(t), '{EDGE_PUNCT}', '', 'g'))"
    core = (f"list_filter({core}, lambda t: length(t) > 1 AND NOT regexp_full_match(t, '{NUMBER_LIKE}') "
            f"AND NOT list_contains({stop_list}, t))")
    cleaned = f"list_transform({core}, lambda t: regexp_replace(t, '{NON_LETTER}', '', 'g'))"
    return f"list_filter({cleaned}, lambda t: length(t) > 0)"
