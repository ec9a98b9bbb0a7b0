"""What the physical plans must and must not hold, and that they survive skew and large sides."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from shardtally import checks
from rows import PRODUCTION, at, dimensions, event, events, page
from shardtally.checks import fixtures
from shardtally.functions import windows
from shardtally.functions.times import to_micros
from shardtally.operators import audience
from shardtally.plans import reports
from shardtally.sources.events import read_events

AS_OF = fixtures.AS_OF
REPORTS = [
    "funnel_monthly",
    "funnel_weekly",
    "messaging_monthly",
    "notification_clicks",
    "notification_dau_mau",
    "notification_screen_views",
]
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("events") / "table")
    fixtures.events(spark, SF_DIR, by_day=True).write.partitionBy("shard").parquet(path)
    dims = fixtures.config_sessions(spark, SF_DIR), fixtures.internal_phones(spark, SF_DIR)
    return read_events(spark, path), *dims


@pytest.fixture
def settings(spark):
    before = {}

    def change(**values):
        for key, value in values.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(repr, df.collect()))


def no_broadcast(settings):
    settings(
        **{
            "spark__sql__autoBroadcastJoinThreshold": "-1",
            "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
        }
    )


@pytest.mark.parametrize("name", REPORTS)
def test_reports_prune_and_stay_in_the_jvm(stored, name):
    plan = physical(getattr(reports, name)(*stored, as_of=AS_OF))
    scans = re.findall(r"PartitionFilters: \[([^\]]*)\].*?ReadSchema: (\S.*)", plan)
    events_scans = [(f, schema) for f, schema in scans if "user_pseudo_id" in schema]
    assert events_scans
    for filters, _ in events_scans:
        assert ">= 2024" in filters and "<= 2024" in filters
    assert "EvalPython" not in plan and "PythonUDF" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Window" not in plan


@pytest.mark.parametrize("name", REPORTS)
def test_user_lists_read_only_what_they_need(stored, name):
    plan = physical(getattr(reports, name)(*stored, as_of=AS_OF))
    user_list = [s for s in re.findall(r"ReadSchema: (\S.*)", plan)
                 if "user_pseudo_id" in s and "event_params" not in s]
    assert user_list
    for schema in user_list:
        assert "int_value" not in schema and "device:" not in schema


@pytest.mark.parametrize("name", REPORTS)
def test_reports_without_any_broadcast(stored, settings, name):
    report = getattr(reports, name)
    expected = rows(report(*stored, as_of=AS_OF))
    no_broadcast(settings)
    df = report(*stored, as_of=AS_OF)
    assert "Broadcast" not in physical(df)
    assert rows(df) == expected


@pytest.mark.parametrize("name", REPORTS)
def test_reports_do_not_depend_on_the_session_zone(stored, settings, name):
    report = getattr(reports, name)
    expected = rows(report(*stored, as_of=AS_OF))
    settings(spark__sql__session__timeZone="America/Sao_Paulo")
    assert rows(report(*stored, as_of=AS_OF)) == expected


def test_excluded_ids_are_computed_once(stored, settings):
    no_broadcast(settings)
    events_, sessions, phones = stored
    ids = audience.internal_users(events_, sessions, phones, windows.previous_month(AS_OF))
    df = audience.exclude_users(events_.select("user_pseudo_id", "event_name"), ids)
    df.collect()
    final = physical(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


@pytest.mark.parametrize("name", ["funnel_monthly", "funnel_weekly"])
def test_event_names_reach_the_parquet_reader(stored, name):
    plan = physical(getattr(reports, name)(*stored, as_of=AS_OF))
    assert re.search(r"PushedFilters: \[[^\]]*In\(event_name", plan)


def test_flags_of_a_session_shuffle_as_one_number(stored):
    plan = physical(reports.funnel_monthly(*stored, as_of=AS_OF))
    assert "bit_or" in plan
    assert "max(phone_page" not in plan


@pytest.mark.parametrize("name", REPORTS)
def test_one_user_with_a_third_of_all_events(spark, settings, name):
    """Counts stay whole when one user, device and copied event dominate."""
    settings(
        **{
            "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "1KB",
            "spark__sql__adaptive__advisoryPartitionSizeInBytes": "1KB",
        }
    )
    no_broadcast(settings)
    first = to_micros(at(2024, 3, 10))
    hot = [page("phone_page", "hot", first + i % 50, session=i % 7) for i in range(300)]
    # Copies of an event (same user, name, microsecond) are one event of the largest session.
    merged = {j: max(i % 7 for i in range(300) if i % 50 == j) for j in range(50)}
    hot_sessions = len(set(merged.values()))
    cold = [page("otp_page", f"u{i}", at(2024, 3, 11), session=i) for i in range(300)]
    seen = [
        event("e", f"u{i}", at(2024, 3, 12), props=PRODUCTION | {"device_id": "d1"})
        for i in range(300)
        if i % 3 == 0
    ]
    table = events(spark, hot + cold + seen).repartition(16)
    report = getattr(reports, name)(table, *dimensions(spark, ["d1"]), as_of=AS_OF)
    result = report.collect()
    if name == "funnel_monthly":
        assert (result[0].phone, result[0].otp) == (1, 200)
    if name == "funnel_weekly":
        assert {r.outcome: (r.old_users, r.old_sessions) for r in result} == {
            "Phone": (1, hot_sessions),
            "OTP": (200, 200),
        }


def test_entry_has_a_stable_schema(spark):
    df = contract.entry(spark)
    assert df.columns[:3] == ["min_date", "max_date", "phone"]
    assert df.count() == 1


def test_every_query_has_a_twin():
    assert checks.QUERIES.keys() == checks.ORACLE.keys() <= contract.queries().keys()
    assert len(checks.QUERIES) > 100


# --- properties over the derived data -----------------------------------------------------


@pytest.fixture(scope="module")
def outcome(spark):
    return lambda name: contract.queries()[name](spark, SF_DIR)


def test_each_session_has_one_outcome(outcome):
    sessions = outcome("furthest_step")
    assert sessions.groupBy("user_pseudo_id", "ga_session_id").count().where("count > 1").count() == 0
    counted = outcome("outcome_summary_monthly").agg(F.sum("sessions")).first()[0]
    assert counted == sessions.where("ga_session_id IS NOT NULL").count()


def test_daily_users_never_exceed_monthly_users(outcome):
    periods = outcome("notification_dau_mau").withColumn("month", F.trunc("period", "MM"))
    largest = periods.groupBy("month").pivot("metric_type", ["DAU", "MAU"]).max("distinct_users")
    assert largest.where("DAU > MAU").count() == 0


def test_kept_and_expired_shards_are_disjoint_and_whole(outcome):
    kept = {r.shard for r in outcome("apply_retention").select("shard").distinct().collect()}
    expired = {
        r.table_name[-8:] for r in outcome("expired_shards").collect()
    }
    everything = {r.shard for r in outcome("scan_wildcard").select("shard").distinct().collect()}
    assert kept | expired == everything and not kept & expired
