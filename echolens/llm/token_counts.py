"""Token-count totals kept up to date by signed batches.

A change row names its group (source, lang, tokenizer) and the tokens of a
document before and after: an insert has no before, a delete no after, a
revised count both.  A batch is summed to one signed row per group (with a
map-side sum, so a hot group is no hot task) and committed once: it is
written aside and renamed to the folder of its batch id, and a batch id that
is there already is left alone, so a retried or replayed batch changes
nothing.  Totals are the sums over all committed batches.

Defined results: null source, lang or tokenizer is a group of its own; null
tokens on one side mean that the document is not there on that side; a
change without either side counts nothing; repeated change rows count each;
an empty batch commits an empty folder; without batches totals are empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import WORD, scratch_path, table, write_table

GROUP = ["source", "lang", "tokenizer"]
SCHEMA = "source string, lang string, tokenizer string, documents long, tokens long"
# Versions counted by the query: white-space words, and runs of letters or digits and single marks.
VERSIONS = {"words-1": WORD, "words-2": r"\p{L}+|\p{N}+|[^\x20\x09-\x0D\p{L}\p{N}]"}


class TokenTotals:
    """The totals under ``root``, one folder per committed batch."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Commit a batch; False (and no effect) if its id was committed before."""
        import uuid

        done, fs = self._path(f"batches/batch={batch_id}")
        if fs.exists(done):
            return False
        there, was = F.col("after").isNotNull().cast("long"), F.col("before").isNotNull().cast("long")
        sums = changes.groupBy(*GROUP).agg(
            F.coalesce(F.sum(there - was), F.lit(0)).alias("documents"),
            F.coalesce(F.sum(F.coalesce(F.col("after"), F.lit(0)) - F.coalesce(F.col("before"), F.lit(0))), F.lit(0)).cast("long").alias("tokens"))
        name = f"pending/{uuid.uuid4().hex}"
        sums.coalesce(1).write.parquet(f"{self.root}/{name}")
        fs.mkdirs(done.getParent())
        aside, _ = self._path(name)
        return bool(fs.rename(aside, done))

    def totals(self) -> DataFrame:
        path, fs = self._path("batches")
        if not fs.exists(path):
            return self.spark.createDataFrame([], SCHEMA)
        rows = self.spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{self.root}/batches")
        return rows.groupBy(*GROUP).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")).filter(
            (F.col("documents") != 0) | (F.col("tokens") != 0))


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, source, lang, n_chars and one count per version (null text: 0)."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select("doc_id", "source", "lang", F.length(t).alias("chars"),
                       *[F.regexp_count(t, F.lit(p)).cast("long").alias(v) for v, p in VERSIONS.items()])


def _changes(rows: DataFrame, version: str, before, after) -> DataFrame:
    return rows.select("source", "lang", F.lit(version).alias("tokenizer"), before.cast("long").alias("before"),
                       after.cast("long").alias("after"))


def query(spark, sf_dir):
    """Totals after four batches: estimates for all documents, revised to counts; a second version's counts;
    deletion of the documents labelled toxic; and a replay of the second batch."""
    import uuid

    from functools import reduce

    rows = write_table(counted(table(spark, sf_dir, "documents")), "counted")
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id").distinct()
    gone = rows.join(toxic, "doc_id", "left_semi")
    absent, (v1, v2) = F.lit(None), VERSIONS
    estimate = F.ceil(F.col("chars") / 6)
    store = TokenTotals(spark, scratch_path(spark, f"totals/{uuid.uuid4().hex}"))
    revised = _changes(rows, v1, estimate, F.col(v1))
    store.commit("1-insert", _changes(rows, v1, absent, estimate))
    store.commit("2-revise", revised)
    store.commit("3-version", _changes(rows, v2, absent, F.col(v2)))
    store.commit("4-delete", reduce(DataFrame.union, [_changes(gone, v, F.col(v), absent) for v in VERSIONS]))
    store.commit("2-revise", revised)
    return store.totals()


ORACLE = rf"""
WITH d AS (SELECT source, lang, coalesce(text, '') AS t FROM documents
           WHERE doc_id IS NULL OR doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)),
c AS (SELECT source, lang, 'words-1' AS tokenizer, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS n FROM d
      UNION ALL
      SELECT source, lang, 'words-2', len(regexp_extract_all(t, '\p{{L}}+|\p{{N}}+|[^\x20\x09-\x0D\p{{L}}\p{{N}}]')) FROM d)
SELECT source, lang, tokenizer, count(*) AS documents, CAST(sum(n) AS BIGINT) AS tokens FROM c GROUP BY source, lang, tokenizer
"""
