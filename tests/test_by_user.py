"""The layout by user: no exchange for what is counted per user, busy users apart, equal results."""

import random

import pytest
from pyspark.sql import functions as F

from rows import at, event, events, page
from shardtally import constants as C
from shardtally.functions.times import to_micros
from shardtally.operators import audience, funnel
from shardtally.sources import by_user

FLAGS = list(C.PAGES)


def some(n=600, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        user = "busy" if i % 3 == 0 else rng.choice([None, *(f"u{k}" for k in range(80))])
        when = to_micros(at(2024, 3, rng.randrange(1, 20))) + i
        out.append(page(rng.choice(FLAGS), user, when, rng.randrange(4)) if rng.random() < 0.8 else event(C.ACCOUNT_CREATED, user, when, {"ga_session_id": rng.randrange(4)}))
    return out + out[:40]


def rollup(df):
    return funnel.with_outcome(funnel.session_rollup(funnel.funnel_step_flags(funnel.funnel_events(df.where(audience.has_flavor())))))


@pytest.fixture
def laid_out(spark, tmp_path):
    df = events(spark, some())
    by_user.write_by_user(df, "laid_out", 4, str(tmp_path), share=0.2)
    yield df, by_user.read_by_user(spark, "laid_out")
    for table in ("laid_out", "laid_out_busy"):
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_every_event_is_in_one_table(laid_out):
    df, table = laid_out
    columns = df.columns
    assert table.each(lambda x: x.select(columns)).exceptAll(df).count() == 0 and table.quiet.count() + table.busy.count() == df.count()
    assert {r[0] for r in table.busy.select("user_pseudo_id").distinct().collect()} == {"busy", None}


def test_results_add_up(laid_out):
    df, table = laid_out
    assert sorted(map(str, table.each(rollup).collect())) == sorted(map(str, rollup(df).collect()))


def test_no_exchange_for_quiet_users(spark, laid_out):
    df, table = laid_out
    plan = rollup(table.quiet)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert rollup(df)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2


def test_a_busy_user_is_spread(laid_out):
    """A third of all events are one user's: none of them is in a bucket, and partial counts come before the exchange."""
    _, table = laid_out
    assert table.quiet.where("user_pseudo_id = 'busy'").count() == 0
    plan = rollup(table.busy)._jdf.queryExecution().executedPlan().toString()
    assert "partial_" in plan and "Bucketed: true" not in plan


def test_written_again(spark, tmp_path, laid_out):
    by_user.write_by_user(events(spark, some(30)), "laid_out", 2, str(tmp_path), share=1.0)
    table = by_user.read_by_user(spark, "laid_out")
    assert table.quiet.count() + table.busy.count() == 60 and table.busy.where(F.col("user_pseudo_id").isNotNull()).count() == 0


def test_no_events(spark, tmp_path):
    by_user.write_by_user(events(spark, []), "nothing", 2, str(tmp_path))
    try:
        assert by_user.read_by_user(spark, "nothing").each(rollup).count() == 0
    finally:
        for table in ("nothing", "nothing_busy"):
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_a_bucket_is_written_by_many_tasks(spark, tmp_path):
    """What a task sorts must not grow with the bucket: two buckets are no two tasks, and nothing is lost."""
    df = events(spark, some())
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        by_user.write_by_user(df, "split", 2, str(tmp_path), share=1.0)
        table = by_user.read_by_user(spark, "split")
        tasks = {file.rsplit("/part-", 1)[1].split("-")[0] for file in table.quiet.inputFiles()}
        assert len(tasks) > 2 and set(table.quiet.columns) == set(df.columns)
        assert sorted(map(str, table.each(rollup).collect())) == sorted(map(str, rollup(df).collect()))
        plan = rollup(table.quiet)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SelectedBucketsCount: 2 out of 2" in plan
    finally:
        for key in small:
            spark.conf.unset(key)
        for name in ("split", "split_busy"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
