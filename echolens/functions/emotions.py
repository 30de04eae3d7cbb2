"""Column builders for emotion scores: max, argmax, prevalent label, polarity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import ARGMAX_ORDER, PREVALENT_THRESHOLD, SUBTHEME_CODES, UNDEFINED_LABEL


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def _score_array(cols) -> Column:
    return F.array(*[F.nanvl(_c(c).cast("double"), F.lit(None).cast("double")) for c in cols])


def max_score(cols=ARGMAX_ORDER) -> Column:
    """Row maximum over the score columns, skipping nulls (NaN is treated as null)."""
    return F.array_max(_score_array(cols))


def _best(cols) -> Column:
    """Largest (score, -position, name) struct: the max score, ties to the first column.

    One array expression, so the label stays small when the optimizer inlines
    it into pushed-down filters.
    """
    return F.array_max(F.array(*[
        F.struct(F.nanvl(_c(c).cast("double"), F.lit(None).cast("double")).alias("s"),
                 F.lit(-i).alias("p"), F.lit(c).alias("name"))
        for i, c in enumerate(cols)]))


def argmax_label(cols=ARGMAX_ORDER) -> Column:
    """Name of the column holding the row maximum; ties go to the first in ``cols``."""
    b = _best(cols)
    return F.when(b["s"].isNotNull(), b["name"])


def prevalent_emotion(cols=ARGMAX_ORDER, threshold: float = PREVALENT_THRESHOLD) -> Column:
    """Argmax label when the maximum is strictly above ``threshold``, else 'undefined'.

    Never null (a null maximum fails the threshold test).
    """
    b = _best(cols)
    return F.when(F.coalesce(b["s"] > F.lit(threshold), F.lit(False)), b["name"]).otherwise(
        F.lit(UNDEFINED_LABEL))


def with_prevalent(df, prefix: str = "", cols=ARGMAX_ORDER,
                   threshold: float = PREVALENT_THRESHOLD):
    """Add ``emotion_score`` and ``prevalent_emotion`` (optionally prefixed)."""
    return (df.withColumn(prefix + "emotion_score", max_score(cols))
              .withColumn(prefix + "prevalent_emotion", prevalent_emotion(cols, threshold)))


def decode_subtheme(theme: str = "theme", codes=SUBTHEME_CODES, flag_fmt: str = "subtheme{}") -> Column:
    """First true subtheme flag in ``codes`` order; none true -> theme * 10."""
    expr = None
    for code in codes:
        cond = F.coalesce(F.col(flag_fmt.format(code)), F.lit(False))
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return expr.otherwise(F.col(theme) * 10).cast("int")


def theme_of_subtheme(subtheme: str | Column) -> Column:
    """Theme code is the tens digit of the subtheme code."""
    return F.floor(_c(subtheme) / 10).cast("int")


def polarity(pos=("joy", "optimism"), neg=("anger", "sadness")):
    """(positive, negative) column pair."""
    p = sum((_c(c) for c in pos[1:]), _c(pos[0]))
    n = sum((_c(c) for c in neg[1:]), _c(neg[0]))
    return p, n


def softmax_rounded(logits: str | Column, digits: int = 3) -> Column:
    """Softmax of an array of logits, each value rounded half-even to ``digits``."""
    a = _c(logits)
    mx = F.array_max(a)
    ex = F.transform(a, lambda x: F.exp(x - mx))
    tot = F.aggregate(ex, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(ex, lambda x: F.bround(x / tot, digits))
