"""Finding and removing expired day shards."""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import datetime, timedelta
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardtally import constants as C
from shardtally.functions.text import extract
from shardtally.functions.times import as_utc
from shardtally.functions.windows import shard_name
from shardtally.sources.folders import Folders


def shard_day(table_name: Column | str) -> Column:
    """Day of a shard table; NULL for other tables, which are never parsed."""
    name = F.col(table_name) if isinstance(table_name, str) else table_name
    day = F.to_date(extract(name, C.SHARD_DAY_PATTERN), "yyyyMMdd")
    return F.when(name.rlike(C.SHARD_TABLE_PATTERN), day)


def expired_shards(
    tables: DataFrame, as_of: datetime | None = None, days: int = C.RETENTION_DAYS
) -> DataFrame:
    """Shard tables more than ``days`` days old (a shard exactly that old stays)."""
    cutoff = as_utc(as_of).date() - timedelta(days=days)
    return tables.where(shard_day("table_name") < F.lit(cutoff))


def kept_events(
    events: DataFrame, as_of: datetime | None = None, days: int = C.RETENTION_DAYS
) -> DataFrame:
    """Events of shards that have not expired (prunes the expired partitions).

    Only a shard that is a day can expire; rows whose shard is NULL or anything else stay.
    """
    cutoff = as_utc(as_of).date() - timedelta(days=days)
    shard = F.col("shard")
    return events.where(
        shard.isNull() | ~shard.rlike(C.SHARD_PATTERN) | (shard >= shard_name(cutoff))
    )


def _partitions(spark: SparkSession, table: str, prefix: str) -> DataFrame:
    """``partition`` (as Spark lists it) and the ``table_name`` of its shard."""
    listed = spark.sql(f"SHOW PARTITIONS {table}")
    day = F.regexp_extract("partition", "(?:^|/)shard=([^/]*)", 1)
    return listed.select("partition", F.concat(F.lit(prefix), day).alias("table_name"))


def _spec(partition: str) -> str:
    """A listed partition (``shard=20240301/kind=a%2Fb``) as the specification that names it in full."""
    pairs = (part.partition("=") for part in partition.split("/"))
    values = ((name, unquote(value).replace("\\", "\\\\").replace("'", "\\'")) for name, _, value in pairs)
    return "PARTITION (" + ", ".join(f"`{name}`='{value}'" for name, value in values) + ")"


def apply_retention(
    spark: SparkSession,
    table: str,
    as_of: datetime | None = None,
    days: int = C.RETENTION_DAYS,
    prefix: str = C.INTRADAY_PREFIX,
    dry_run: bool = True,
) -> list[str]:
    """Drop the expired partitions of a table partitioned by ``shard``, alone or among other columns.

    Works on the partition list only: the expired partitions come to the driver, and one
    statement drops them all.  Returns each shard's name once; with ``dry_run`` nothing is
    dropped.  Raises if an expired partition is left afterwards.  ``prefix`` says which of the
    two families (``C.INTRADAY_PREFIX``, ``C.FINAL_PREFIX``) the table holds: one table, one family.
    """

    def expired() -> dict[str, str]:
        rows = expired_shards(_partitions(spark, table, prefix), as_of, days)
        return {row.partition: row.table_name for row in rows.collect()}

    found = expired()
    if found and not dry_run:
        parts = ", ".join(_spec(partition) for partition in sorted(found))
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")
        if left := expired():
            raise RuntimeError(f"expired partitions of {table} are left: {sorted(left)}")
    return sorted(set(found.values()))


def drop_expired_tables(
    spark: SparkSession,
    database: str,
    as_of: datetime | None = None,
    days: int = C.RETENTION_DAYS,
    dry_run: bool = True,
) -> list[str]:
    """Drop the expired shard tables of a database that holds one table per day, of both families.

    Returns their names; with ``dry_run`` nothing is dropped.  A table that is gone by the time
    its turn comes is no error, so a run may follow one that broke off.  Raises if one is left.
    """

    def expired() -> list[str]:
        listed = spark.sql(f"SHOW TABLES IN {database}").where(~F.col("isTemporary"))
        names = listed.select(F.col("tableName").alias("table_name"))
        return sorted(row.table_name for row in expired_shards(names, as_of, days).collect())

    found = expired()
    if found and not dry_run:
        for name in found:
            spark.sql(f"DROP TABLE IF EXISTS {database}.`{name}`")
        if left := expired():
            raise RuntimeError(f"expired tables of {database} are left: {left}")
    return found


def apply_retention_to_path(
    spark: SparkSession,
    path: str,
    as_of: datetime | None = None,
    days: int = C.RETENTION_DAYS,
    prefix: str = C.INTRADAY_PREFIX,
    dry_run: bool = True,
) -> list[str]:
    """Delete the expired shards of a bare folder, through the file system that its path names.

    A shard is a folder named like a shard table (``events_20240301``, ``events_intraday_20240301``:
    both families at once) or a partition ``shard=20240301``, which ``prefix`` gives its name.  Either
    may lie below other partitions (``kind=a/shard=20240301``) or hold some; only folder names are
    read, one listing per partition above a shard.  A folder first gets a name that readers skip, in
    one step, and is then deleted; a later run deletes what one that broke off has left under such a name.

    Returns each shard's name once; with ``dry_run`` nothing is changed.  Raises if an expired shard is left.
    """
    folders = Folders(spark)

    def expired() -> dict[str, str]:
        found = dict(_shard_folders(folders, path, prefix))
        if not found:
            return found
        names = spark.createDataFrame(list(found.items()), "folder string, table_name string")
        return {row.folder: row.table_name for row in expired_shards(names, as_of, days).collect()}

    found = expired()
    if not dry_run:
        for folder in sorted(found):
            folders.hide(folder)
        for folder in folders.hidden(path, lambda name: "=" in name):
            folders.delete(folder)
        if left := expired():
            raise RuntimeError(f"expired shards are left: {sorted(left)}")
    return sorted(set(found.values()))


def _shard_folders(folders: Folders, path: str, prefix: str) -> Iterator[tuple[str, str]]:
    """(folder, name) of each shard under ``path``."""
    for folder, name in folders.under(path):
        key, equals, value = name.partition("=")
        if re.search(C.SHARD_TABLE_PATTERN, name):
            yield folder, name
        elif key == "shard":
            yield folder, prefix + unquote(value)
        elif equals:
            yield from _shard_folders(folders, folder, prefix)
