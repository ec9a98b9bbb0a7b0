"""Reading events, one partition per day shard."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardtally.constants import INTRADAY_PREFIX
from shardtally.functions.windows import Window
from shardtally.sources import schema


def read_events(
    spark: SparkSession,
    path: str,
    window: Window | None = None,
    more_fields: Iterable[T.StructField] = (),
) -> DataFrame:
    """Events under ``path`` (Parquet, partitioned by ``shard``), within ``window`` if given.

    The schema is stated, so no file is opened to infer it and ``shard`` stays text.
    ``more_fields`` names columns of the table beyond those the operators read.
    """
    fields = T.StructType([*schema.EVENTS.fields, *more_fields])
    events = spark.read.schema(fields).parquet(path)
    return events if window is None else in_window(events, window)


def in_window(events: DataFrame, window: Window) -> DataFrame:
    return events.where(window.contains("shard"))


def read_config_sessions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.CONFIG_SESSIONS).parquet(path)


def read_internal_phones(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.INTERNAL_PHONES).parquet(path)


def shard_tables(
    spark: SparkSession, table: str, prefix: str = INTRADAY_PREFIX
) -> DataFrame:
    """Names of the shards of a partitioned table, from its partition list."""
    partitions = spark.sql(f"SHOW PARTITIONS {table}")
    day = F.regexp_extract("partition", "shard=([^/]*)", 1)
    return partitions.select(F.concat(F.lit(prefix), day).alias("table_name"))
