"""Event parameters as columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardtally.functions.keyvalue import with_largest_params


def flatten_event_params(
    events: DataFrame,
    integers: Mapping[str, str],
    strings: Mapping[str, str],
) -> DataFrame:
    """One row per (user, event name, microsecond) with parameters as columns.

    ``integers`` and ``strings`` map output columns to parameter keys.  Of several values the
    largest counts; a missing integer is NULL, a missing string is ''.

    The arrays are reduced in place rather than exploded: rows do not multiply, only the
    columns asked for reach the aggregate, and copies of an event merge on the map side.
    """
    return (
        with_largest_params(events, integers, strings)
        .groupBy("user_pseudo_id", "event_name", "event_timestamp")
        .agg(*[F.max(name).alias(name) for name in (*integers, *strings)])
    )
