"""Flat extract of nested events."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shardtally.functions.keyvalue import param, prop
from shardtally.functions.times import day_text, iso_text
from shardtally.sources import schema


def screen_view_extract(events: DataFrame, strict: bool = False) -> DataFrame:
    """One row per event, 24 flat columns; nested fields keep their leaf names.

    Of several entries with one key the first counts; with ``strict`` they are an error.
    """
    return events.select(
        "event_timestamp",
        iso_text().alias("event_datetime"),
        day_text().alias("event_date"),
        "event_name",
        param("event_params", "firebase_screen_class", strict=strict).alias("screen_name"),
        prop("ccc_enabled", strict).alias("ccc_enabled"),
        prop("user_cid", strict).alias("connect_id"),
        prop("cchq_domain", strict).alias("cchq_domain"),
        prop("user_id", strict).alias("cc_user_id"),
        "user_id",
        "user_pseudo_id",
        *[f"device.{name}" for name in schema.DEVICE.names],
        *[f"geo.{name}" for name in schema.GEO.names],
        *[f"app_info.{name}" for name in schema.APP_INFO.names],
    )
