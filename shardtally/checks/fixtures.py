"""Event tables derived from the test data (see FIXTURES.md) in Spark."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardtally import constants as C
from shardtally.functions.times import DAY_MICROS, utc
from shardtally.sources import schema

AS_OF = datetime(2024, 4, 30, 12, tzinfo=UTC)
MID_MONTH = datetime(2024, 4, 15, 12, tzinfo=UTC)
RETENTION_AS_OF = datetime(2024, 8, 31, 12, tzinfo=UTC)

# Hosts and a flavor of the fixtures.
PRODUCTION_DOMAIN = "main.commcarehq.org"
QA_DOMAIN = "qa1.commcarehq.org"
TEST_DOMAIN = "mytest.commcarehq.org"
PRODUCTION_SERVER = "www.commcarehq.org"
OTHER_FLAVOR = "lts"

PAGE_CYCLE = [*C.PAGES.values(), C.ACTIVITY_SCREEN]
REASON_CYCLE = [*C.PHONE_ERRORS, *C.BIOMETRIC_ERRORS, C.LOCKOUT_REASON]
ACTION_CYCLE = list(C.CLICK_ACTIONS.values())
PACKAGE = "x" * (C.SCREEN_NAME_START - 1)
#: Ids of copied events lie this far from those of their originals.
COPIES_FROM = 1_000_000_000_000


def _cycle(values: list[str], position: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), position.cast("int"))


def _numbered(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _key_values(empty: Column, again: tuple[str, Column] | None = None, **values: Column) -> Column:
    """Key/value array; an entry is left out when its value is NULL, all of them where ``empty`` holds.

    ``again`` is one more entry at the end, whose key may be there before.
    """
    entries = []
    for key, value in [*values.items(), *([again] if again else [])]:
        is_int = key in ("ga_session_id", "ga_session_number", "value")
        slots = F.struct(
            (F.lit(None) if is_int else value).cast("string").alias("string_value"),
            (value if is_int else F.lit(None)).cast("long").alias("int_value"),
        )
        entries.append(F.struct(F.lit(key).alias("key"), slots.alias("value")))
    known = F.filter(
        F.array(*entries),
        lambda e: e["value"]["string_value"].isNotNull() | e["value"]["int_value"].isNotNull(),
    )
    return F.slice(known, 1, F.when(empty, 0).otherwise(len(entries))).cast(schema.KEY_VALUES)


def events(spark: SparkSession, sf_dir: str, by_day: bool = False) -> DataFrame:
    """The event table.  ``by_day`` brings the rows of a day together, for writing day
    partitions: the short raw rows are shuffled and sorted, before the nested columns are
    made (the writer finds them in order and sorts no wide rows), and a day with too many
    rows for one task is split."""
    k = F.col("k")
    uid = F.col("uid")
    made = F.col("event_type")
    name = F.col("event_name")
    row = F.col("event_id")
    click_names = _cycle(list(C.API_EVENTS), row % 3)

    base = (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .select(
            "event_id",
            "event_type",
            F.col("user_id").alias("uid"),
            F.get_json_object("props", "$.k").cast("int").alias("k"),
            (
                F.unix_micros(F.col("ts").cast("timestamp"))
                + (row % 4) * 30 * F.lit(DAY_MICROS)
            ).alias("event_timestamp"),
            F.explode(F.when(row % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .withColumn(
            "event_name",
            F.when(made == "view", C.SCREEN_VIEW)
            .when(made == "error", C.CONFIGURATION_FAILURE)
            .when((made == "signup") & (k % 4 == 0), C.ACCOUNT_CREATED)
            .when(made == "signup", C.SCREEN_VIEW)
            .when((made == "purchase") & (k % 4 == 3), C.MESSAGE_SENT)
            .when(made == "purchase", C.ACCOUNT_RECOVERED)
            .when(k % 3 == 0, click_names)
            .when(k % 3 == 1, "ccc_notification_type")
            .otherwise(C.SCREEN_VIEW),
        )
        .withColumn("shard", F.date_format(utc().cast("date"), "yyyyMMdd"))
    )
    if by_day:
        base = base.hint("rebalance", "shard").sortWithinPartitions("shard")
    is_click = name == "ccc_notification_type"
    original = F.col("copy") == 0
    page = _cycle(PAGE_CYCLE, k % 7)
    params = _key_values(
        row % 101 == 11,
        ("firebase_screen_class", F.when((name == C.SCREEN_VIEW) & (row % 53 == 5), C.NOTIFICATION_SCREEN)),
        ga_session_id=uid * 1000 + (row % 4) * 10 + k % 3,
        ga_session_number=row % 4 + 1,
        firebase_screen_class=F.when(
            is_click | ((made == "click") & (name == C.SCREEN_VIEW)), C.NOTIFICATION_SCREEN
        )
        .when((made == "signup") & (name == C.SCREEN_VIEW), PACKAGE + C.PAGES["phone_page"])
        .when(
            (made == "view") & original,
            F.concat(F.lit(PACKAGE), F.when(row % 7 == 3, F.upper(page)).otherwise(page)),
        ),
        reason=F.when(made == "error", _cycle(REASON_CYCLE, (k + F.col("copy")) % 8)),
        value=F.when(
            (name == C.ACCOUNT_RECOVERED) & original,
            F.when(k % 5 <= 1, 1).when(k % 10 == 9, 2).otherwise(0),
        ),
        event_type=F.when(
            is_click, F.when(k % 11 == 0, "other").otherwise(C.CLICK_EVENT_TYPE)
        ),
        action=F.when(is_click, _cycle(ACTION_CYCLE, k % 8)),
    )
    properties = _key_values(
        row % 89 == 7,
        app_flavor=F.when(uid % 10 == 9, OTHER_FLAVOR).otherwise(C.PRODUCTION_FLAVOR),
        device_id=_numbered("d", uid),
        cchq_domain=F.when(uid % 23 == 5, None)
        .when(uid % 17 == 3, QA_DOMAIN)
        .when(uid % 19 == 4, TEST_DOMAIN)
        .otherwise(PRODUCTION_DOMAIN),
        server=F.when(uid % 29 == 7, C.STAGING_SERVER).otherwise(PRODUCTION_SERVER),
        user_cid=F.when(k % 4 != 1, _numbered("c", uid)),
        user_id=_numbered("cc", uid),
        ccc_enabled=F.when(uid % 2 == 0, "true").otherwise("false"),
        is_personal_id_demo_user=F.when((uid % 13 == 1) & (row % 5 == 0), "true"),
    )
    device = F.struct(
        F.when(uid % 3 == 0, "tablet").otherwise("mobile").alias("category"),
        _numbered("brand", uid % 4).alias("mobile_brand_name"),
        _numbered("model", uid % 8).alias("mobile_model_name"),
        F.when(uid % 4 != 0, _numbered("mkt", uid % 8)).alias("mobile_marketing_name"),
        _numbered("hw", uid % 8).alias("mobile_os_hardware_model"),
        _numbered("Android ", uid % 6 + 9).alias("operating_system_version"),
        _cycle(["fr", "en", "hi"], uid % 3).alias("language"),
        (uid % 5 * 3600).cast("long").alias("time_zone_offset_seconds"),
    )
    geo = F.struct(
        _numbered("city", uid % 12).alias("city"),
        F.when(uid % 2 == 0, "Africa").otherwise("Asia").alias("continent"),
        _numbered("region", uid % 6).alias("region"),
        _numbered("sub", uid % 4).alias("sub_continent"),
    )
    return base.select(
        "shard",
        (row + F.col("copy") * F.lit(COPIES_FROM)).alias("event_id"),
        "event_name",
        "event_timestamp",
        F.when(row % 178 != 7, _numbered("p", uid)).alias("user_pseudo_id"),
        F.when(k % 5 != 0, _numbered("u", uid)).alias("user_id"),
        params.alias("event_params"),
        properties.alias("user_properties"),
        device.alias("device"),
        geo.alias("geo"),
        F.struct(_numbered("2.", k % 5).alias("version")).alias("app_info"),
    )


def config_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    plus = F.when(key % 4 == 0, "++").otherwise("+")
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        _numbered(C.DEVICE_PREFIX + "d", key).alias("device_id"),
        F.concat(plus, (key + 1_000_000).cast("string")).alias("phone_number"),
    )


def internal_phones(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return (
        spark.read.parquet(f"{sf_dir}/supplier.parquet")
        .where(key % 10 == 2)
        .select((key + 1_000_000).cast("string").alias("phone"))
    )


def other_tables(spark: SparkSession) -> DataFrame:
    """Tables of a catalogue that are no shards."""
    return spark.createDataFrame([("events_fresh_20240101",), ("users",)], "table_name string")
