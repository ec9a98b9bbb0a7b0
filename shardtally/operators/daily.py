"""Daily summaries: what reports ask of every event, kept per shard so that it is read once.

``user_marks`` holds who was seen on which device and who was flagged; a list of internal users over
any window is then a union of its shards' marks. ``event_names`` holds which names a shard's events
have; a ``LIKE`` on names becomes a list of names, which reaches the Parquet reader.

``refresh`` writes the summaries of a window's shards, and is run again for a shard whose events have
changed: a summary says nothing about events that came after it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardtally import constants as C
from shardtally.functions.keyvalue import evaluate_once, prop
from shardtally.functions.windows import Window
from shardtally.operators.audience import USER, device_key, internal_devices
from shardtally.sources.events import in_window
from shardtally.sources.folders import Folders
from shardtally.sources.workspace import stored

MARKS = "user_pseudo_id string, device_id string, flagged boolean, shard string"
NAMES = "event_name string, shard string"
#: More names than a scan's filter should list.
MOST_NAMES = 200


def user_marks(events: DataFrame, key: str = C.DEMO_USER_KEY, value: str = "true", strict: bool = False) -> DataFrame:
    """``user_pseudo_id, device_id, flagged, shard``: each (user, device) of a shard once, if it has a device or the flag."""
    flag = F.coalesce(prop(key, strict) == value, F.lit(False))
    known = evaluate_once(events, device_id=device_key(strict), flagged=flag)
    return (
        known.where(F.col("device_id").isNotNull() | F.col("flagged"))
        .groupBy("shard", USER, "device_id")
        .agg(F.max("flagged").alias("flagged"))
        .select(USER, "device_id", "flagged", "shard")
    )


def event_names(events: DataFrame) -> DataFrame:
    """``event_name, shard``: each name of a shard once."""
    return events.where(F.col("event_name").isNotNull()).select("event_name", "shard").distinct()


def refresh(summary: Callable[[DataFrame], DataFrame], events: DataFrame, path: str, window: Window) -> None:
    """Writes ``summary`` of the window's shards under ``path``, in place of what is there for them.

    Other shards stay. A shard that has nothing to summarise any more loses its folder.
    """
    spark = events.sparkSession
    rows = stored(summary(in_window(events, window)), "summary")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path)
    written = {row.shard for row in rows.select("shard").distinct().collect()}  # at most one a day
    folders, (first, last) = Folders(spark), window.shards
    for folder, name in list(folders.under(path)):
        shard = name.removeprefix("shard=")
        if first <= shard <= last and shard not in written:
            folders.hide(folder)
    for folder in list(folders.hidden(path, lambda name: False)):
        folders.delete(folder)


def read_marks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MARKS).parquet(path)


def read_names(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(NAMES).parquet(path)


def internal_users(marks: DataFrame, sessions: DataFrame, phones: DataFrame, window: Window) -> DataFrame:
    """``audience.internal_users`` from marks."""
    pairs = in_window(marks, window).where("device_id is not null").select(USER, "device_id").distinct()
    return pairs.join(internal_devices(sessions, phones), "device_id", "left_semi").select(USER).distinct()


def flagged_users(marks: DataFrame, window: Window) -> DataFrame:
    """``audience.flagged_users`` from marks."""
    return in_window(marks, window).where("flagged").select(USER).distinct()


def internal_or_flagged_users(marks: DataFrame, sessions: DataFrame, phones: DataFrame, window: Window) -> DataFrame:
    """``audience.internal_or_flagged_users`` from marks."""
    pairs = in_window(marks, window).groupBy(USER, "device_id").agg(F.max("flagged").alias("flagged"))
    devices = internal_devices(sessions, phones).withColumn("internal", F.lit(True))
    return pairs.join(devices, "device_id", "left").where(F.col("flagged") | F.col("internal")).select(USER).distinct()


def named_like(events: DataFrame, pattern: str, names: DataFrame | None = None) -> DataFrame:
    """Events whose name is ``LIKE`` the pattern.

    With ``names`` (``event_names``, of any shards) the pattern is tried on these, and the scan of their shards
    looks for equal names, which the Parquet reader can tell from its statistics. Shards without names, and
    patterns that more than ``MOST_NAMES`` names match, are read as without.
    """
    name = F.col("event_name")
    if names is None:
        return events.where(name.like(pattern))
    known = [row.shard for row in names.select("shard").distinct().collect()]  # one a day
    found = [row.event_name for row in names.where(name.like(pattern)).select("event_name").distinct().limit(MOST_NAMES + 1).collect()]
    if not known or len(found) > MOST_NAMES:
        return events.where(name.like(pattern))
    covered = F.col("shard").isin(known)
    rest = events.where((~covered | F.col("shard").isNull()) & name.like(pattern))
    return events.where(covered & name.isin(sorted(found))).union(rest) if found else rest
