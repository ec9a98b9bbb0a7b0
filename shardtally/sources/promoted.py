"""User properties promoted to columns, so that the Parquet reader can tell from its statistics what to skip.

``promote`` adds a column per key beside the arrays, and ``promoted``, which is true where they were added.
``FIELDS`` has ``read_events`` read them; in files written without, they are NULL, and the arrays are looked up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardtally.functions.keyvalue import evaluate_once, prop

KEYS = ("app_flavor", "server", "cchq_domain")
MARK = "promoted"
PREFIX = "property_"
FIELDS = [T.StructField(MARK, T.BooleanType()), *(T.StructField(PREFIX + key, T.StringType()) for key in KEYS)]


def promote(events: DataFrame, keys: Sequence[str] = KEYS, strict: bool = False) -> DataFrame:
    """``events`` with its user properties ``keys`` as columns (the first entry of each)."""
    values = {PREFIX + key: prop(key, strict) for key in keys}
    return evaluate_once(events, **values).withColumn(MARK, F.lit(True))


def is_promoted(events: DataFrame, *keys: str) -> bool:
    return {MARK, *(PREFIX + key for key in keys)} <= set(events.columns)


def user_property(events: DataFrame, key: str, strict: bool = False) -> Column:
    """The property from its column where an event has been promoted, else from the array."""
    looked_up = prop(key, strict)
    if not is_promoted(events, key):
        return looked_up
    return F.when(F.col(MARK), F.col(PREFIX + key)).otherwise(looked_up)


def prune(events: DataFrame, equal: dict[str, str], different: dict[str, str]) -> DataFrame:
    """``events`` without promoted ones whose properties cannot be ``equal`` and ``different`` to these values.

    Says nothing of the others; the condition is one that the Parquet reader understands.
    """
    if not is_promoted(events, *equal, *different):
        return events
    possible = F.lit(True)
    for key, value in equal.items():
        possible &= F.col(PREFIX + key) == value
    for key, value in different.items():
        possible &= F.col(PREFIX + key) != value
    return events.where(F.col(MARK).isNull() | possible)
