import pytest

from rows import PRODUCTION, at, dimensions, event, events
from shardtally import constants as C
from shardtally.checks import fixtures
from shardtally.functions import windows
from shardtally.operators import audience

MARCH = windows.previous_month(at(2024, 4, 30))


def names(df):
    return sorted((r[0] for r in df.collect()), key=str)


@pytest.mark.parametrize(
    "ids, kept",
    [
        ([], ["a", "b", None]),
        (["a"], ["b"]),
        (["z"], ["a", "b"]),
        (["a", "a"], ["b"]),
        (["a", None], []),
        ([None], []),
    ],
)
@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_exclusion_follows_not_in(spark, ids, kept, threshold):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "user_pseudo_id string")
    id_set = spark.createDataFrame([(i,) for i in ids], "some_id string")
    default = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        assert names(audience.exclude_users(df, id_set)) == sorted(kept, key=str)
        df.createOrReplaceTempView("people")
        id_set.createOrReplaceTempView("ids")
        sql = "SELECT * FROM people WHERE user_pseudo_id NOT IN (SELECT some_id FROM ids)"
        assert names(spark.sql(sql)) == sorted(kept, key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", default)


def test_no_id_set_excludes_nobody(spark):
    df = spark.createDataFrame([("a",), (None,)], "user_pseudo_id string")
    assert audience.exclude_users(df, None) is df


def test_internal_users(spark):
    rows = [
        event("e", "inside", props={"device_id": "d1"}),
        event("e", "inside", props={"device_id": "d9"}),
        event("e", "outside", props={"device_id": "d9"}),
        event("e", "no device", props={}),
        event("e", "too early", at(2024, 2, 29), props={"device_id": "d1"}),
    ]
    df = events(spark, rows)
    sessions, phones = dimensions(spark, ["d1"])
    assert names(audience.internal_users(df, sessions, phones, MARCH)) == ["inside"]


def test_one_pass_equals_the_two_lists(spark):
    rows = [
        event("e", "internal", props={"device_id": "d1"}),
        event("e", "flagged", props={"is_personal_id_demo_user": "true"}),
        event("e", "flagged once", props={"is_personal_id_demo_user": "true", "device_id": "d2"}),
        event("e", "flagged once", props={"device_id": "d2"}),
        event("e", "neither", props={"is_personal_id_demo_user": "false", "device_id": "d3"}),
        event("e", None, props={"device_id": "d1"}),
    ]
    df = events(spark, rows)
    dims = dimensions(spark, ["d1"])
    both = audience.internal_or_flagged_users(df, *dims, MARCH)
    lists = audience.internal_users(df, *dims, MARCH).union(audience.flagged_users(df, MARCH))
    assert names(both) == names(lists.distinct())
    assert set(r[0] for r in both.collect()) == {None, "flagged", "flagged once", "internal"}


def test_production_events(spark):
    cases = {
        "kept": {},
        "qa": {"cchq_domain": "my-" + fixtures.QA_DOMAIN},
        "test": {"cchq_domain": fixtures.TEST_DOMAIN},
        "staging": {"server": C.STAGING_SERVER},
        "lts": {"app_flavor": fixtures.OTHER_FLAVOR},
        "no domain": {"cchq_domain": None},
        "no server": {"server": None},
        "no flavor": {"app_flavor": None},
        "qa elsewhere": {"cchq_domain": "qa.example.org"},
    }
    df = events(spark, [event("e", name, props=PRODUCTION | case) for name, case in cases.items()])
    assert names(audience.production_events(df).select("user_pseudo_id")) == ["kept", "qa elsewhere"]
    assert audience.production_events(df).columns == df.columns
