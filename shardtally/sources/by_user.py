"""Events laid out by user: what is counted per user or session then needs no exchange.

The table is partitioned by shard and bucketed by user. A bucket is read by one task, so users with a
large share of all events, and events without a user, lie in a second table that is not bucketed
and is counted as usual. A user's events are in one of the two only, so results per user add up.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

USER = "user_pseudo_id"
BUSY = "_busy"
BUCKET = "_bucket"
#: A user with more than this share of all events is busy: at most 1,000 users are.
SHARE = 0.001


@dataclass(frozen=True)
class ByUser:
    """The two tables of one layout."""

    quiet: DataFrame
    busy: DataFrame

    def each(self, count: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``count`` of both tables, one after the other: for results that belong to one user each."""
        return count(self.quiet).union(count(self.busy))


def busy_users(events: DataFrame, share: float = SHARE) -> list[str]:
    """Users with more than ``share`` of all events, 1 / ``share`` of them at most."""
    counts = events.groupBy(USER).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return [row[USER] for row in counts.where((F.col("n") > share * total) & F.col(USER).isNotNull()).collect()]


def write_by_user(events: DataFrame, table: str, buckets: int, path: str | None = None, share: float = SHARE) -> None:
    """Writes ``events`` as ``table`` and ``table_busy`` (in place of what is there); ``path`` is where their files go.

    A task writes whole buckets of some shards, a file each, and a bucket of a shard that is too large
    for one task is split: what a task sorts does not grow with the bucket. Every column stays.
    """
    is_busy = F.col(USER).isNull() | F.col(USER).isin(busy_users(events, share))
    bucket = F.pmod(F.hash(USER), F.lit(buckets))  # as bucketBy has it
    quiet = events.where(~is_busy).withColumn(BUCKET, bucket).hint("rebalance", "shard", BUCKET).drop(BUCKET)
    writers = {
        table: quiet.write.bucketBy(buckets, USER).sortBy(USER),
        table + BUSY: events.where(is_busy).hint("rebalance", "shard").write,
    }
    for name, writer in writers.items():
        if path is not None:
            writer = writer.option("path", f"{path.rstrip('/')}/{name}")
        writer.mode("overwrite").format("parquet").partitionBy("shard").saveAsTable(name)


def read_by_user(spark: SparkSession, table: str) -> ByUser:
    return ByUser(spark.table(table), spark.table(table + BUSY))
