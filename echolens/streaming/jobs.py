"""Structured Streaming versions of the collection-side jobs.

X01 ``dedupe_stream``: posts/replies arrive in files; a reply seen again
    within the watermark is dropped (``dropDuplicatesWithinWatermark``), a
    row behind it is late and dropped, and a key is forgotten once the
    watermark passes its event time by the delay, so state stays bounded.
    ``run_arrivals`` runs one resumed query per landed arrival.
X02 ``weekly_window_stream``: weekly tumbling windows ending on Sunday
    (``window(ts, '7 days', '7 days', '3 days')``; the window end equals
    the Sunday-after label of the batch reports) with counts and means.
    Emitted in update mode through ``foreachBatch`` into an update log: each
    micro-batch is its own folder (rewritten if the batch is retried), and
    every ``COMPACT`` batches the log is folded into one snapshot with the
    latest row per key.  Readers take the last snapshot and the fewer than
    ``COMPACT`` newer batches, however long the stream has run.
X03 ``score_stream``: score-and-append with ``foreachBatch`` around any
    batch scorer; the checkpoint replaces hand-made resume files.

All sinks and checkpoints live under the shared checkpoint folder named by
``spark.checkpoint.dir`` (see ``session.scratch_path``), so a lost executor
or a restarted driver resumes from the last committed batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

COMPACT = 8     # batches of an update log that are folded into its snapshot at a time


def file_stream(spark: SparkSession, directory: str, schema: T.StructType, glob: str | None = None,
                max_files: int | None = None, fmt: str = "parquet") -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(directory)


def _run_dir(spark: SparkSession, name: str) -> tuple[str, str]:
    rid = uuid.uuid4().hex[:12]
    return scratch_path(spark, f"stream/{name}/{rid}/out"), scratch_path(spark, f"stream/{name}/{rid}/ckpt")


def dedupe_stream(stream: DataFrame, key: str | list, event_time: str, delay: str = "7 days") -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def run_append_to_parquet(df: DataFrame, name: str) -> DataFrame:
    """Run a streaming frame to completion into a parquet sink; return the sink as a batch frame."""
    spark = df.sparkSession
    out, ckpt = _run_dir(spark, name)
    q = (df.writeStream.format("parquet").outputMode("append").option("path", out)
           .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def _read_sink(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The batches written by ``foreachBatch``; empty (with ``schema``) when none arrived."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":      # the folder only exists once a batch was written
            raise
        return spark.createDataFrame([], schema)


def weekly_windows(stream: DataFrame, ts: str, measures, delay: str = "7 days",
                   keys=()) -> DataFrame:
    """Weekly (Sunday-ending) tumbling windows: row count and per-measure sum/count."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for m in measures:
        aggs += [F.sum(m).alias(f"_s_{m}"), F.count(m).alias(f"_c_{m}")]
    return (stream.withWatermark(ts, delay)
                  .groupBy(F.window(ts, "7 days", "7 days", "3 days").alias("w"), *keys).agg(*aggs))


class UpdateLog:
    """Latest row per key of an update-mode stream, kept as a snapshot and the batches since.

    A batch is written under its number, so a retried one replaces itself.  A
    snapshot holds every batch up to its number; it counts once it is
    complete, and only then is what it replaces deleted, so a crash at any
    point leaves a readable log.
    """

    def __init__(self, spark: SparkSession, path: str, keys, schema: T.StructType, compact: int = COMPACT):
        self.spark, self.path, self.keys, self.compact = spark, path, list(keys), compact
        self.schema = T.StructType(schema.fields + [T.StructField("_batch", T.LongType())])

    def _numbers(self, kind: str) -> list[int]:
        """Numbers of the complete folders of ``kind``, ascending."""
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        done = [x.getPath() for x in fs.listStatus(root) if fs.exists(jvm.org.apache.hadoop.fs.Path(x.getPath(), "_SUCCESS"))]
        return sorted(int(p.getName()) for p in done)

    def _delete(self, kind: str, number: int) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/{number}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def _parts(self) -> list[str]:
        last = self._numbers("snapshot")[-1:]
        newer = [b for b in self._numbers("batch") if not last or b > last[0]]
        return [f"{self.path}/snapshot/{n}" for n in last] + [f"{self.path}/batch/{b}" for b in newer]

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` sink."""
        batch.withColumn("_batch", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{self.path}/batch/{batch_id}")
        if batch_id % self.compact == self.compact - 1:
            self.fold(batch_id)

    def fold(self, batch_id: int) -> None:
        """Fold the log into the snapshot ``batch_id`` and delete what it replaces."""
        if batch_id in self._numbers("snapshot"):
            return
        self._latest().write.mode("overwrite").parquet(f"{self.path}/snapshot/{batch_id}")
        for kind in ("snapshot", "batch"):
            for n in self._numbers(kind):
                if n < batch_id or kind == "batch" and n == batch_id:
                    self._delete(kind, n)

    def _latest(self) -> DataFrame:
        parts = self._parts()
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*parts)
        rest = [c for c in rows.columns if c not in self.keys]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), "_batch").alias("_row"))
        return newest.select(*[F.col(c) if c in self.keys else F.col(f"_row.{c}") for c in rows.columns])

    def read(self) -> DataFrame:
        return self._latest().drop("_batch")


def run_update_to_parquet(df: DataFrame, name: str, key_cols, compact: int = COMPACT) -> DataFrame:
    """Run an update-mode aggregate to completion; keep the latest row per key."""
    out, ckpt = _run_dir(df.sparkSession, name)
    log = UpdateLog(df.sparkSession, out, key_cols, df.schema, compact)
    q = (df.writeStream.outputMode("update").foreachBatch(log.write)
           .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return log.read()


def run_arrivals(arrivals, schema: T.StructType, build: Callable[[DataFrame], DataFrame], name: str,
                 progress: list | None = None) -> DataFrame:
    """Land one arrival after the other and run ``build(stream)`` to completion after each, resumed from the same
    checkpoint (state and watermark go on); return the append sink.

    ``arrivals``: batch frames, in order of arrival, of any number of files each.  The progress report of every
    run's last batch is added to ``progress``.
    """
    arrivals = list(arrivals)
    spark = arrivals[0].sparkSession
    out, ckpt = _run_dir(spark, name)
    landing = scratch_path(spark, f"stream/{name}/{uuid.uuid4().hex[:12]}/in")
    spark.createDataFrame([], schema).write.parquet(landing)
    sink = build(file_stream(spark, landing, schema))
    for arrived in arrivals:
        arrived.select(*schema.names).write.mode("append").parquet(landing)
        q = (build(file_stream(spark, landing, schema)).writeStream.format("parquet").outputMode("append").option("path", out)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
        if progress is not None:
            progress.append(q.lastProgress)
    return spark.read.schema(sink.schema).parquet(out)


def weekly_window_stream(stream: DataFrame, ts: str, measures, name: str = "weekly") -> DataFrame:
    agg = weekly_windows(stream, ts, measures)
    res = run_update_to_parquet(agg, name, ["w"])
    return res.select(F.to_date(F.col("w.end")).alias("dsw"), "n",
                      *[F.try_divide(F.col(f"_s_{m}"), F.col(f"_c_{m}")).alias(m) for m in measures])


def weekly_window_sums(stream: DataFrame, ts: str, measures, name: str = "weekly_sums") -> DataFrame:
    """Weekly (Sunday-ending) tumbling-window sums of ``measures`` (e.g. keyword flags)."""
    agg = weekly_windows(stream, ts, measures)
    res = run_update_to_parquet(agg, name, ["w"])
    return res.select(F.to_date(F.col("w.end")).alias("dsw"), *[F.col(f"_s_{m}").alias(m) for m in measures])


def score_stream(stream: DataFrame, score_batch: Callable[[DataFrame], DataFrame],
                 name: str = "scores") -> DataFrame:
    """foreachBatch(score_batch) appended per batch (idempotent on retry); returns the sink."""
    spark = stream.sparkSession
    out, ckpt = _run_dir(spark, name)

    def write(batch: DataFrame, batch_id: int):
        (score_batch(batch).withColumn("_batch", F.lit(batch_id)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(out))

    q = (stream.writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
               .trigger(availableNow=True).start())
    q.awaitTermination()
    empty = score_batch(spark.createDataFrame([], stream.schema))
    return _read_sink(spark, out, empty.schema).select(*empty.columns)
