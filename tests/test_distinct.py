"""Bitmap state against plain sets."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rows import at, event, events
from shardtally.operators import activity, distinct


def some(seed, days=(1, 40), n=400):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        day, user = rng.randrange(*days), rng.choice([None, *(f"p{i}" for i in range(60))])
        name = rng.choice([None, *(f"n{i}" for i in range(40))])
        out.append(event("e", user, at(2024, 1 + day // 31, 1 + day % 28), user_id=name))
    return out


def brute(rows):
    seen = defaultdict(lambda: (set(), set()))
    for row in rows:
        day = f"{row['shard'][:4]}-{row['shard'][4:6]}-{row['shard'][6:]}"
        for key in ((day, "DAU"), (day[:8] + "01", "MAU")):
            for found, value in zip(seen[key], (row["user_pseudo_id"], row["user_id"])):
                if value is not None:
                    found.add(value)
    return sorted((period, metric, len(a), len(b)) for (period, metric), (a, b) in seen.items())


def result(df):
    return sorted((str(r.period), r.metric_type, r.distinct_users, r.distinct_named_users) for r in df.collect())


def state_of(df, users=None, names=None, excluded=None):
    users, names = distinct.number_values(df.select("user_pseudo_id"), users), distinct.number_values(df.select("user_id"), names)
    return distinct.daily_users(df, users, names, excluded), users, names


def test_one_run_equals_sets_and_the_events_report(spark):
    rows = some(1)
    df = events(spark, rows)
    state, _, _ = state_of(df)
    assert result(distinct.active_users(state)) == brute(rows) == result(activity.active_users(df))


def test_runs_merge(spark):
    parts = [some(2), some(3, (20, 60)), some(4, (20, 30), n=50)]
    users = names = merged = None
    for part in parts:
        state, users, names = state_of(events(spark, part), users, names)
        merged = state if merged is None else distinct.merged(merged, state)
    assert result(distinct.active_users(merged)) == brute([r for p in parts for r in p])
    rows = merged.groupBy("day", "kind", "bucket").count()
    assert rows.where("count > 1").count() == 0 and rows.count() <= 3 * len({r["shard"] for p in parts for r in p})


def test_numbers_are_unique_and_stay(spark):
    values = spark.range(5000).select(F.concat(F.lit("v"), "id").alias("v"))
    first = distinct.number_values(values.union(values).union(spark.createDataFrame([(None,)], "v string")))
    one = dict(first.collect())
    assert len(one) == len(set(one.values())) == 5000 and min(one.values()) >= 0 and max(one.values()) < 40_000
    more = spark.range(4000, 9000).select(F.concat(F.lit("v"), "id").alias("w"))
    two = dict(distinct.number_values(more, first).collect())
    assert len(two) == len(set(two.values())) == 9000 and one.items() <= two.items()


def test_excluded_users(spark):
    rows = some(5)
    df = events(spark, rows)
    for ids in ([("p1",), ("p2",)], [], [("p1",), (None,)]):
        excluded = spark.createDataFrame(ids, "user_pseudo_id string")
        state, _, _ = state_of(df, excluded=excluded)
        assert result(distinct.active_users(state)) == result(activity.active_users(df, excluded))


def test_a_value_without_a_number_is_an_error(spark):
    df = events(spark, some(6))
    _, users, names = state_of(df.where("user_pseudo_id <> 'p3'"))
    with pytest.raises(Exception, match="no number for p3"):
        distinct.daily_users(df, users, names).collect()


def test_no_events(spark):
    state, _, _ = state_of(events(spark, []))
    assert result(distinct.active_users(state)) == []


def test_plan_of_the_report_reads_the_state_only(spark, tmp_path):
    state, _, _ = state_of(events(spark, some(7)))
    state.write.parquet(str(tmp_path / "state"))
    report = distinct.active_users(spark.read.parquet(str(tmp_path / "state")))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Generate" not in plan and "user_pseudo_id" not in plan.split("ReadSchema")[1].split("\n")[0]
