"""Session helpers: configuration, checkpoint folder, stored tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "echolens",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session tuned for the library; used by tests and bench, never by queries."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions or 8),
        "spark.driver.memory": "8g",
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Calendar keys are defined on UTC; align the session if it differs.

    Also caps generated methods at the JIT's size limit: a whole-stage
    function above ~8 KB of bytecode is never JIT-compiled and runs
    interpreted (10x slower); with the cap Spark falls back to per-operator
    code for that subtree instead.  Wide score expressions inlined into
    pushed-down filters hit exactly this.
    """
    if spark.conf.get("spark.sql.session.timeZone", "UTC") not in ("UTC", "Etc/UTC", "GMT"):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get("spark.sql.codegen.hugeMethodLimit", "65535") == "65535":
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster names it in ``spark.checkpoint.dir``.  Only a ``local``
    master (one process, one disk) may leave it unset: then a scratch folder
    of our own is taken.  On any other master an unset folder is an error,
    because a machine-local one would not be seen by the other executors.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on master {master}")
        d = tempfile.mkdtemp(prefix="echolens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame, large: bool = False) -> DataFrame:
    """Cut the lineage of ``df`` inside the shared checkpoint folder (survives executor loss).

    Small intermediates (group aggregates) use a reliable checkpoint.  With
    ``large`` the table is written once as Parquet and read back: columnar
    and compressed, so re-reading it stays cheap when it is big (phrase pair
    counts, bags of words, landed inputs).
    """
    if large:
        return write_table(df, "lineage")
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables: a folder of this application under the shared checkpoint
    folder, removed when the application ends."""
    root = "/".join([ensure_checkpoint_dir(spark).rstrip("/"), "tables", spark.sparkContext.applicationId])
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return f"{root}/{name}"


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the scratch folder and return the stored table."""
    import uuid

    path = scratch_path(df.sparkSession, f"{name}/{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Guard for CPU-heavy per-row work (tokenising long texts) over few, large files.

    When the scan yields fewer partitions than the cluster has cores (a
    single-row-group file gives one task), round-robin it over the cores;
    on a real dataset with many splits this is a no-op and adds no shuffle.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
