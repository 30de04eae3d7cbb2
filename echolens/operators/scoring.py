"""Emotion scoring (T17) and the news-account classifier.

Scoring contract: ``(id, anger, joy, optimism, sadness, score_status)``.

* Guard: a text with more than 150 symbol characters gets null scores
  (``skipped``) and never reaches the model.
* Mask: '@handle' -> '@user', 'http...' -> 'http' (single-space tokens).
* Model: pluggable.
  - a fitted Spark ML ``PipelineModel`` whose output column ``probability``
    is a softmax over the four labels (multinomial logistic regression is
    exactly that): runs in the JVM, no Python workers;
  - or a Python ``scorer(texts: list[str]) -> np.ndarray[n, 4]`` of logits
    (e.g. a transformer), called through ``mapInPandas`` on Arrow batches,
    loaded once per task; a failing batch falls back to per-text calls and
    a failing text gets -1 for all four scores (``error``).
* Post-process: softmax of logits, each value rounded half-even to 3 places.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import mask_handles_and_links, symbol_count
from ..schemas import ERROR_SCORE, SYMBOL_LIMIT

# Output order of the model's four labels.
MODEL_LABELS = ["anger", "joy", "optimism", "sadness"]


def prepare(df: DataFrame, text: str = "content", limit: int = SYMBOL_LIMIT) -> DataFrame:
    """Add ``_masked`` and ``_guarded`` (too many symbols) columns."""
    return df.select("*", mask_handles_and_links(text).alias("_masked"),
                     (symbol_count(text) > limit).alias("_guarded"))


def train_text_scorer(docs: DataFrame, text: str = "content", label: str = "label",
                      num_features: int = 1 << 18, max_iter: int = 50, reg: float = 0.01) -> PipelineModel:
    """Multinomial logistic regression over hashed masked tokens.

    ``label`` is one of MODEL_LABELS; the fitted pipeline's ``probability``
    column is the softmax over them (in MODEL_LABELS order).
    """
    spark = docs.sparkSession
    labels = spark.createDataFrame([(lab,) for lab in MODEL_LABELS], f"{label} string")
    idx = StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc")
    prep = docs.select(F.split(F.lower(mask_handles_and_links(text)), r"\s+").alias("_words"), label)
    model = Pipeline(stages=[
        idx.fit(labels),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=num_features),
        LogisticRegression(featuresCol="_tf", labelCol="_label", family="multinomial",
                           maxIter=max_iter, regParam=reg, probabilityCol="probability"),
    ]).fit(prep)
    return model


def score_with_model(df: DataFrame, model: PipelineModel, key: str = "tweetId",
                     text: str = "content") -> DataFrame:
    """Score with a Spark ML pipeline (JVM-side); probabilities rounded half-even to 3 places."""
    p = prepare(df.select(key, text), text)
    inp = p.select(key, "_guarded", F.split(F.lower("_masked"), r"\s+").alias("_words"))
    # the label indexer is a training-time stage only
    stages = [s for s in model.stages if not hasattr(s, "labels")]
    scored = PipelineModel(stages=stages).transform(inp)
    arr = vector_to_array("probability")
    null = F.lit(None).cast("double")
    scores = [F.when(F.col("_guarded"), null).otherwise(F.bround(F.element_at(arr, i + 1), 3)).alias(lab)
              for i, lab in enumerate(MODEL_LABELS)]
    return scored.select(key, *scores, F.when(F.col("_guarded"), F.lit("skipped"))
                         .otherwise(F.lit("ok")).alias("score_status"))


def _softmax_round(logits: np.ndarray) -> np.ndarray:
    z = logits - logits.max(axis=1, keepdims=True)
    e = np.exp(z)
    p = e / e.sum(axis=1, keepdims=True)
    return np.round(p, 3)


def score_with_python(df: DataFrame, make_scorer: Callable[[], Callable], key: str = "tweetId",
                      text: str = "content") -> DataFrame:
    """Score with a Python model through ``mapInPandas`` (Arrow batches).

    ``make_scorer()`` is called once per task and returns
    ``scorer(list[str]) -> logits (n x 4)`` in MODEL_LABELS order.
    """
    p = prepare(df.select(key, text), text).select(key, "_masked", "_guarded")
    key_type = df.schema[key].dataType
    schema = T.StructType([T.StructField(key, key_type)] + [T.StructField(lab, T.DoubleType()) for lab in MODEL_LABELS]
                          + [T.StructField("score_status", T.StringType())])

    def run(batches):
        scorer = make_scorer()
        for pdf in batches:
            n = len(pdf)
            out = np.full((n, 4), np.nan)
            status = np.array(["ok"] * n, dtype=object)
            guarded = pdf["_guarded"].fillna(False).to_numpy(dtype=bool)
            status[guarded] = "skipped"
            todo = np.nonzero(~guarded)[0]
            if len(todo):
                texts = pdf["_masked"].iloc[todo].fillna("").tolist()
                try:
                    out[todo] = _softmax_round(np.asarray(scorer(texts), dtype=float))
                except Exception:  # noqa: BLE001 - model failure -> per-text retry
                    for i, t in zip(todo, texts):
                        try:
                            out[i] = _softmax_round(np.asarray(scorer([t]), dtype=float))[0]
                        except Exception:  # noqa: BLE001
                            out[i] = ERROR_SCORE
                            status[i] = "error"
            res = pd.DataFrame(out, columns=MODEL_LABELS)
            res.loc[guarded, MODEL_LABELS] = None
            res.insert(0, key, pdf[key].to_numpy())
            res["score_status"] = status
            yield res

    return p.mapInPandas(run, schema)


# -- T16: account classifier ---------------------------------------------------

def train_classifier(df: DataFrame, features, label: str = "label", seed: int = 50,
                     vector_cols=(), max_iter: int = 100) -> PipelineModel:
    """Logistic-regression classifier over numeric/boolean features (null -> 0) plus
    optional vector columns (e.g. bag-of-words counts)."""
    num = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]
    d = df.select(*num, *vector_cols, F.col(label).cast("double").alias("_y"))
    asm = VectorAssembler(inputCols=list(features) + list(vector_cols), outputCol="_x")
    lr = LogisticRegression(featuresCol="_x", labelCol="_y", maxIter=max_iter, regParam=0.01)
    return Pipeline(stages=[asm, lr]).fit(d)


def predict_classifier(model: PipelineModel, df: DataFrame, features, key: str, vector_cols=()) -> DataFrame:
    num = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]
    d = df.select(key, *num, *vector_cols)
    out = model.transform(d)
    return out.select(key, (F.col("prediction") > 0.5).alias("pred"),
                      F.element_at(vector_to_array("probability"), 2).alias("p_true"))
