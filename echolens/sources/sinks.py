"""Writers: gzip parquet (append / overwrite), partitioned text-free export,
delimited CSV, one folder per batch key, and a first-wins merge that writes
to a new path (never over the path being read)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import month_label
from ..operators.dedupe import upsert_first_wins
from ..schemas import EXPORT_COLS


# Options of delimited files that hold any text, the same for writing and reading.
DELIMITED = {"quote": '"', "escape": '"', "nullValue": "\\N", "emptyValue": '""', "lineSep": "\n",
             "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to ``schema`` exactly (missing columns become typed nulls)."""
    cols = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def append_parquet(df: DataFrame, path: str, schema: T.StructType | None = None,
                   compression: str = "gzip") -> None:
    """Append rows (schema-enforced when ``schema`` is given)."""
    out = conform(df, schema) if schema is not None else df
    out.write.mode("append").option("compression", compression).parquet(path)


def overwrite_parquet(df: DataFrame, path: str, partition_by=None, compression: str = "gzip") -> None:
    w = df.write.mode("overwrite").option("compression", compression)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = True,
                    mode: str = "overwrite", compression: str | None = None) -> None:
    """Fields are quoted where they need it, quotes doubled; nulls and empty texts stay apart."""
    w = df.write.mode(mode).options(**DELIMITED).option("sep", sep).option("header", header)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def export_monthly(df: DataFrame, path: str, date_col: str = "date", cols=EXPORT_COLS,
                   sep: str = ",") -> None:
    """Text-free export: only ``cols``, one gzip CSV folder per 'yyyy-MM'."""
    out = df.select(*[F.col(c) for c in cols], month_label(date_col).alias("month_year"))
    (out.write.mode("overwrite").partitionBy("month_year").option("header", True)
        .option("sep", sep).option("compression", "gzip").csv(path))


def write_per_key(df: DataFrame, path: str, key: str, fmt: str = "parquet") -> None:
    """One folder per key value (e.g. per batch)."""
    df.write.mode("append").partitionBy(key).format(fmt).save(path)


def merge_first_wins(existing: DataFrame, incoming: DataFrame, key, out_path: str,
                     compression: str = "gzip") -> None:
    """Stored rows win; the merged table goes to ``out_path`` (a new path, then swap)."""
    upsert_first_wins(existing, incoming, key).write.mode("overwrite").option(
        "compression", compression).parquet(out_path)
