"""Daily summaries give what the events give, also after a shard was read anew."""

import pytest
from pyspark.sql import functions as F

from rows import PRODUCTION, at, dimensions, event, events
from shardtally import constants as C
from shardtally.functions import windows
from shardtally.operators import activity, audience, daily
from shardtally.sources.events import read_events

MARCH = windows.previous_month(at(2024, 4, 30))
DEMO = {C.DEMO_USER_KEY: "true"}


def day(n, name, user, **props):
    return event(name, user, at(2024, 3, n), {"firebase_screen_class": C.NOTIFICATION_SCREEN}, PRODUCTION | props)


ROWS = [
    day(1, "screen_view", "inside", device_id="d1"),
    day(1, "screen_view", "outside", device_id="d9"),
    day(2, "ccc_notification_type", "inside", device_id="d1"),
    day(2, "x_screen_view_y", "demo", **DEMO),
    day(3, "other", None, device_id="d1"),
    day(3, "screen_view", "nobody"),
    event("screen_view", "late", at(2024, 4, 2), props=PRODUCTION | {"device_id": "d1"}),
    event(None, "unnamed", at(2024, 3, 3)),
]


def users(df):
    return sorted((r[0] for r in df.collect()), key=str)


def written(spark, tmp_path, rows):
    path = str(tmp_path / "events")
    events(spark, rows).write.mode("overwrite").partitionBy("shard").parquet(path)
    return read_events(spark, path)


def test_lists_from_marks(spark):
    df, (sessions, phones) = events(spark, ROWS), dimensions(spark, ["d1"])
    marks = daily.user_marks(df)
    assert marks.count() == 6
    for window in (MARCH, windows.history_to_date(at(2024, 4, 30))):
        assert users(daily.internal_users(marks, sessions, phones, window)) == users(audience.internal_users(df, sessions, phones, window))
        assert users(daily.flagged_users(marks, window)) == users(audience.flagged_users(df, window))
        both = audience.internal_or_flagged_users(df, sessions, phones, window)
        assert users(daily.internal_or_flagged_users(marks, sessions, phones, window)) == users(both)
    assert None in users(daily.internal_users(marks, sessions, phones, MARCH))


@pytest.mark.parametrize("names", [None, [], ["20240301", "20240302"], ["20240301", "20240302", "20240303", "20240402"]])
@pytest.mark.parametrize("most", [200, 0])
def test_named_like(spark, names, most, monkeypatch):
    monkeypatch.setattr(daily, "MOST_NAMES", most)
    df = events(spark, ROWS)
    known = None if names is None else daily.event_names(df.where(F.col("shard").isin(names)))
    got = daily.named_like(df, C.SCREEN_VIEW_PATTERN, known)
    assert sorted(r.user_pseudo_id for r in got.collect()) == ["demo", "inside", "late", "nobody", "outside"]
    assert activity.notification_screen_views(df, names=known).count() == 4
    assert daily.named_like(df, "%nothing%", known).count() == 0


def test_names_reach_the_reader(spark, tmp_path):
    df = written(spark, tmp_path, ROWS)
    plan = daily.named_like(df, C.SCREEN_VIEW_PATTERN, daily.event_names(df))._jdf.queryExecution().executedPlan().toString()
    assert "In(event_name, [screen_view,x_screen_view_y])" in plan


def test_a_shard_is_read_anew(spark, tmp_path):
    sessions, phones = dimensions(spark, ["d1"])
    path, names_path = str(tmp_path / "marks"), str(tmp_path / "names")
    df = written(spark, tmp_path, ROWS)
    for summary, to in ((daily.user_marks, path), (daily.event_names, names_path)):
        daily.refresh(summary, df, to, windows.history_to_date(at(2024, 4, 30)))
    assert daily.read_marks(spark, path).count() == 6 and daily.read_names(spark, names_path).count() == 6

    changed = [r for r in ROWS if r["shard"] != "20240302"] + [day(2, "new_screen_view", "moved", device_id="d1")]
    changed = [r for r in changed if r["shard"] != "20240303"] + [event("plain", "nobody", at(2024, 3, 3))]
    df = written(spark, tmp_path, changed)
    for summary, to in ((daily.user_marks, path), (daily.event_names, names_path)):
        daily.refresh(summary, df, to, windows.Window(at(2024, 3, 2).date(), at(2024, 3, 3).date()))
    marks, names = daily.read_marks(spark, path), daily.read_names(spark, names_path)
    assert users(daily.internal_users(marks, sessions, phones, MARCH)) == ["inside", "moved"]
    assert users(marks.where("shard = '20240303'")) == []  # nothing left to say about that day
    assert users(marks.where("shard = '20240402'")) == ["late"]
    assert {r.event_name for r in names.where("shard = '20240302'").collect()} == {"new_screen_view"}
    assert daily.named_like(df, C.SCREEN_VIEW_PATTERN, names).count() == df.where(F.col("event_name").like(C.SCREEN_VIEW_PATTERN)).count()
    assert not list((tmp_path / "marks").glob("_expired-*"))


def test_the_list_of_a_report_reads_no_events(spark, tmp_path):
    df, (sessions, phones) = written(spark, tmp_path, ROWS), dimensions(spark, ["d1"])
    path = str(tmp_path / "marks")
    daily.refresh(daily.user_marks, df, path, MARCH)
    ids = daily.internal_users(daily.read_marks(spark, path), sessions, phones, MARCH)
    plan = ids._jdf.queryExecution().executedPlan().toString()
    assert "event_timestamp" not in plan and "user_properties" not in plan and "PartitionFilters" in plan
