"""Schemas of the tables (only the fields that some operator reads)."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


KEY_VALUES = T.ArrayType(
    T.StructType(
        [
            T.StructField("key", T.StringType()),
            T.StructField(
                "value",
                T.StructType(
                    [
                        T.StructField("string_value", T.StringType()),
                        T.StructField("int_value", T.LongType()),
                    ]
                ),
            ),
        ]
    )
)

DEVICE = T.StructType(
    _strings(
        "category",
        "mobile_brand_name",
        "mobile_model_name",
        "mobile_marketing_name",
        "mobile_os_hardware_model",
        "operating_system_version",
        "language",
    )
    + [T.StructField("time_zone_offset_seconds", T.LongType())]
)
GEO = T.StructType(_strings("city", "continent", "region", "sub_continent"))
APP_INFO = T.StructType(_strings("version"))

# ``shard`` is a partition column: the day as text, yyyyMMdd.
EVENTS = T.StructType(
    [
        T.StructField("event_name", T.StringType()),
        T.StructField("event_timestamp", T.LongType()),
        T.StructField("user_pseudo_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("event_params", KEY_VALUES),
        T.StructField("user_properties", KEY_VALUES),
        T.StructField("device", DEVICE),
        T.StructField("geo", GEO),
        T.StructField("app_info", APP_INFO),
        T.StructField("shard", T.StringType()),
    ]
)
CONFIG_SESSIONS = T.StructType(_strings("device_id", "phone_number"))
INTERNAL_PHONES = T.StructType(_strings("phone"))
