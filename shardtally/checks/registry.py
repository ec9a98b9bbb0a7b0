"""The checked queries: a Spark callable and the DuckDB text it must agree with."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property, lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shardtally import constants as C
from shardtally.checks import fixtures, oracle
from shardtally.sources import promoted
from shardtally.sources.by_user import ByUser, read_by_user, write_by_user
from shardtally.sources.events import read_config_sessions, read_events, read_internal_phones, shard_tables
from shardtally.sources.workspace import shared_folder


class Tables:
    """The fixture tables of one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def events(self) -> DataFrame:
        """Events as the library is meant to find them: a table with one partition per day.

        On the first use, Spark derives all of it from the test data and writes it to the folder
        that all executors share (``sources.workspace``); every query then scans that table.
        """
        path = f"{shared_folder(self.spark)}/events-{uuid.uuid4().hex[:8]}"
        derived = fixtures.events(self.spark, self.sf_dir, by_day=True)
        derived.write.partitionBy("shard").parquet(path)
        return read_events(self.spark, path, more_fields=[T.StructField("event_id", T.LongType())])

    def _written(self, name: str, df: DataFrame) -> str:
        path = f"{shared_folder(self.spark)}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return path

    @cached_property
    def sessions(self) -> DataFrame:
        path = self._written("sessions", fixtures.config_sessions(self.spark, self.sf_dir))
        return read_config_sessions(self.spark, path)

    @cached_property
    def phones(self) -> DataFrame:
        path = self._written("phones", fixtures.internal_phones(self.spark, self.sf_dir))
        return read_internal_phones(self.spark, path)

    @cached_property
    def shards(self) -> DataFrame:
        """A catalogue's tables: both families of shards, from the partition list of the event table, and others."""
        (path,) = {file.rsplit("/shard=", 1)[0] for file in self.events.inputFiles()}
        name = f"events_{uuid.uuid4().hex[:8]}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.events.schema)
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (shard) LOCATION '{path}'")
        self.spark.catalog.recoverPartitions(name)
        families = (shard_tables(self.spark, name, prefix) for prefix in (C.INTRADAY_PREFIX, C.FINAL_PREFIX))
        return reduce(DataFrame.union, families, fixtures.other_tables(self.spark))

    @cached_property
    def by_user(self) -> ByUser:
        """The event table once more, laid out by user."""
        name = f"by_user_{uuid.uuid4().hex[:8]}"
        write_by_user(self.events, name, 8, shared_folder(self.spark), share=0.05)
        return read_by_user(self.spark, name)

    @cached_property
    def promoted(self) -> DataFrame:
        """The event table once more, with promoted columns from March on."""
        path = f"{shared_folder(self.spark)}/promoted-{uuid.uuid4().hex[:8]}"
        new = promoted.promote(self.events.where("shard >= '20240301'"))
        for part in (self.events.where("shard < '20240301'"), new):
            part.write.mode("append").partitionBy("shard").parquet(path)
        fields = [T.StructField("event_id", T.LongType()), *promoted.FIELDS]
        return read_events(self.spark, path, more_fields=fields)

    @property
    def all(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self.events, self.sessions, self.phones


@lru_cache(maxsize=8)
def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def check(name: str, body: str):
    """Register ``f(tables) -> DataFrame`` under ``name`` with its DuckDB twin."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query '{name}' is registered twice")

        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(tables(spark, sf_dir))

        QUERIES[name] = query
        ORACLE[name] = oracle.with_fixtures(body)
        return build

    return register
