"""Distinct users as state that merges: bitmaps over user numbers.

``number_values`` gives every user a number, once and for all. ``daily_users`` keeps which numbers were
seen on a day as bitmaps of 32,768 numbers each: a row per day, kind of user and bitmap, however
many users and events there were. States of different days, or of parts of a day, merge by OR
(``merged``), so a day's events are read once: months, or any other span of days, come from the state.

``activity.active_users`` gives the same figures from events, in one run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardtally.functions.times import event_date
from shardtally.operators.audience import USER, exclude_users

#: Numbers are dealt in this many lanes, so that no task sees all values.
LANES = 1024
NAMED = "user_id"


def number_values(values: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``value, number`` of every distinct value of the single column of ``values``, and of the ``known`` ones.

    Known values keep their numbers; new ones go on after them. Numbers are unique and from 0, with gaps
    only where hashing fills lanes unevenly. NULL gets none.
    """
    (column,) = values.columns
    new = values.select(F.col(column).alias("value")).where(F.col("value").isNotNull()).distinct()
    lane = F.pmod(F.xxhash64("value"), F.lit(LANES))
    if known is not None:
        new = new.join(known.select("value"), "value", "left_anti")
    new = new.withColumn("__lane", lane)
    place = F.row_number().over(Window.partitionBy("__lane").orderBy("value")).cast("long") - 1
    if known is None:
        return new.select("value", (place * LANES + F.col("__lane")).alias("number"))
    full = known.groupBy((F.col("number") % LANES).alias("__lane")).agg((F.max("number").cast("long") - F.min(F.col("number") % LANES)).alias("__last"))
    start = F.coalesce(F.col("__last") + LANES, F.lit(0))
    numbered = new.withColumn("__place", place).join(full, "__lane", "left")
    more = numbered.select("value", (start + F.col("__place") * LANES + F.col("__lane")).alias("number"))
    return known.select("value", "number").union(more)


def daily_users(events: DataFrame, users: DataFrame, names: DataFrame, excluded: DataFrame | None = None) -> DataFrame:
    """``day, kind, bucket, bitmap``: which pseudo and named users each day's events have.

    ``users`` and ``names`` number the values of ``user_pseudo_id`` and ``user_id`` (``number_values``); a value
    without a number is an error. ``excluded`` leaves out events as in ``audience.exclude_users``.
    """
    days = events.select(event_date().alias("day"), USER, NAMED).distinct()
    days = exclude_users(days, excluded)
    kinds = [_bitmaps(days.select("day", F.col(column).alias("value")), numbers, kind) for kind, column, numbers in ((USER, USER, users), (NAMED, NAMED, names))]
    seen = days.select("day", F.lit("").alias("kind"), F.lit(-1).cast("long").alias("bucket"), F.lit(b"").alias("bitmap")).distinct()
    return kinds[0].union(kinds[1]).union(seen)


def _bitmaps(values: DataFrame, numbers: DataFrame, kind: str) -> DataFrame:
    known = values.where(F.col("value").isNotNull()).join(numbers, "value", "left")
    number = F.coalesce("number", F.raise_error(F.concat(F.lit("no number for "), F.col("value"))).cast("long"))
    placed = known.select("day", number.alias("number"))
    return (
        placed.groupBy("day", F.bitmap_bucket_number("number").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"))
        .select("day", F.lit(kind).alias("kind"), "bucket", "bitmap")
    )


def merged(*states: DataFrame) -> DataFrame:
    """One state of several, which may have days in common."""
    all_rows = states[0]
    for state in states[1:]:
        all_rows = all_rows.unionByName(state)
    return all_rows.groupBy("day", "kind", "bucket").agg(_either("bitmap").alias("bitmap"))


def _either(bitmap: str) -> Column:
    return F.bitmap_or_agg(F.col(bitmap))


def active_users(state: DataFrame) -> DataFrame:
    """Distinct pseudo and named users per day (``DAU``) and per calendar month (``MAU``), as ``activity.active_users``.

    ``state`` has one row per day, kind and bucket, as ``daily_users`` and ``merged`` give it.
    """
    monthly = state.groupBy(F.trunc("day", "MM").alias("day"), "kind", "bucket").agg(_either("bitmap").alias("bitmap"))
    return _totals(state, "DAU").union(_totals(monthly, "MAU"))


def _totals(state: DataFrame, metric: str) -> DataFrame:
    def users(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.bitmap_count("bitmap"))), F.lit(0))

    totals = state.groupBy("day").agg(users(USER).alias("distinct_users"), users(NAMED).alias("distinct_named_users"))
    return totals.select(F.col("day").alias("period"), F.lit(metric).alias("metric_type"), "distinct_users", "distinct_named_users")
