"""Readers for landed tables and the driver's test tables (fixed schemas, never inferred)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import (ACCOUNT_SCHEMA, CITY_SCHEMA, HEADLINE_SCHEMA, MEDIA_LIST_SCHEMA,
                       POST_SCHEMA, RAW_POST_SCHEMA, SCORE_SCHEMA, TOPIC_RULE_SCHEMA)
from .sinks import DELIMITED

TEST_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver test table (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_parquet(spark: SparkSession, path: str | list, schema: T.StructType | None = None) -> DataFrame:
    """Parquet file, directory or list of paths; with ``schema`` the files are read as that schema."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    paths = [path] if isinstance(path, str) else list(path)
    return r.parquet(*paths)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
             header: bool = True) -> DataFrame:
    """Delimited text with a fixed schema."""
    return (spark.read.schema(schema).option("header", header).option("sep", sep)
            .option("mode", "PERMISSIVE").csv(path))


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", header: bool = True) -> DataFrame:
    """What ``sinks.write_delimited`` wrote, line ends inside fields included."""
    return spark.read.schema(schema).options(**DELIMITED).option("emptyValue", "").option("multiLine", True).option(
        "header", header).option("sep", sep).csv(path)


def read_id_list(spark: SparkSession, path: str, name: str = "value") -> DataFrame:
    """Headerless one-column CSV -> distinct values."""
    sch = T.StructType([T.StructField(name, T.StringType())])
    return read_csv(spark, path, sch, header=False).filter(F.col(name).isNotNull()).distinct()


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON-lines with a fixed schema."""
    return spark.read.schema(schema).json(path)


def read_posts(spark, path):
    return read_parquet(spark, path, POST_SCHEMA)


def read_accounts(spark, path):
    return read_parquet(spark, path, ACCOUNT_SCHEMA)


def read_raw_posts(spark, path, fmt: str = "parquet"):
    """Raw nested search results (parquet or json lines)."""
    if fmt == "json":
        return read_json_lines(spark, path, RAW_POST_SCHEMA)
    return read_parquet(spark, path, RAW_POST_SCHEMA)


def read_media_list(spark, path):
    """';'-separated media list: username;country;media_outlet;media_category."""
    return read_csv(spark, path, MEDIA_LIST_SCHEMA, sep=";")


def read_scores(spark, path, fmt: str = "csv"):
    """Emotion scores (tweetId, anger, joy, optimism, sadness)."""
    if fmt == "csv":
        return read_csv(spark, path, SCORE_SCHEMA)
    return read_parquet(spark, path, SCORE_SCHEMA)


def read_cities(spark, path):
    return read_csv(spark, path, CITY_SCHEMA, sep=";")


def read_headlines(spark, path):
    return read_csv(spark, path, HEADLINE_SCHEMA)


def read_topic_rules(spark, path):
    return read_csv(spark, path, TOPIC_RULE_SCHEMA, sep=";")
