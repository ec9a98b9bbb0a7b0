"""Random small event tables, with repeated keys, copies, NULL users and ties, against brute force."""

import random

import pytest

import brute
from rows import PACKAGE, at, dimensions, entries, event, events
from shardtally import constants as C
from shardtally.checks import fixtures
from shardtally.functions import windows
from shardtally.functions.times import to_micros
from shardtally.operators.flatten import flatten_event_params
from shardtally.plans import reports

AS_OF = at(2024, 4, 30, 12)
SCREENS = [*C.PAGES.values(), C.ACTIVITY_SCREEN, "Other", C.FUNNEL_SCREEN_WORD.upper() + "x"]
REASONS = [*C.PHONE_ERRORS, *C.BIOMETRIC_ERRORS, C.LOCKOUT_REASON, C.CREATED, "other", ""]


USERS = [f"u{i}" for i in range(40)]


def random_params(rng):
    found = []
    if rng.random() < 0.6:
        found.append(("firebase_screen_class", PACKAGE + rng.choice(SCREENS)))
    for _ in range(rng.choice([0, 1, 1, 3])):
        key = rng.choice(["ga_session_id", "value", "firebase_screen_class", "reason", "extra"])
        value = {
            "ga_session_id": rng.choice([1, 2, 3, None]),
            "value": rng.choice([0, 0, 0, 1, 2, None]),
            "firebase_screen_class": rng.choice([PACKAGE + s for s in SCREENS] + ["short", None]),
            "reason": rng.choice([*REASONS, None]),
            "extra": rng.choice(["zzz", 9, None]),
        }[key]
        found.append((key, value))
    return found


def random_event(rng, null_users):
    user = rng.choice([*USERS, "a", "b", None if null_users else "g"])
    props = {"app_flavor": rng.choice([C.PRODUCTION_FLAVOR] * 9 + [fixtures.OTHER_FLAVOR, None])}
    if user == "a" and rng.random() < 0.3:
        props[C.DEMO_USER_KEY] = "true"
    if user == "b" and rng.random() < 0.3:
        props["device_id"] = "inside"
    day = rng.choice([at(2024, 3, 10), at(2024, 3, 30, 11, 59, 58), at(2024, 4, 20)])
    micros = to_micros(day) + rng.choice([0, 1, 500_000, 1_000_000, 2_500_000, 3_000_000])
    names = [C.SCREEN_VIEW] * 6 + [*C.FUNNEL_EVENTS, C.CONFIGURATION_FAILURE, "other_event"]
    name = rng.choice(names)
    return event(name, user, micros, props=props) | {
        "event_params": entries(random_params(rng)) if rng.random() < 0.95 else None
    }


def table(seed, null_users=True):
    rng = random.Random(seed)
    rows = [random_event(rng, null_users) for _ in range(500)]
    return rows + rows[:40]


@pytest.mark.parametrize("seed", range(3))
def test_flatten(spark, seed):
    rows = table(seed)
    flat = flatten_event_params(
        events(spark, rows),
        integers={"session": "ga_session_id", "success": "value"},
        strings={"screen": "firebase_screen_class", "reason": "reason"},
    )
    found = {
        (r.user_pseudo_id, r.event_name, r.event_timestamp): (
            r.session,
            r.success,
            r.screen,
            r.reason,
        )
        for r in flat.collect()
    }
    assert found == brute.flatten(rows)


@pytest.mark.parametrize("null_users", [True, False])
@pytest.mark.parametrize("seed", range(4))
def test_funnel_reports(spark, seed, null_users):
    rows = table(seed, null_users)
    df, dims = events(spark, rows), dimensions(spark, ["inside"])

    (row,) = reports.funnel_monthly(df, *dims, as_of=AS_OF).collect()
    march = windows.previous_month(AS_OF).shards
    assert row.asDict() == brute.monthly(rows, march, {"inside"})

    report = reports.funnel_weekly(df, *dims, as_of=AS_OF).collect()
    span = windows.two_trailing_windows(AS_OF).shards
    border = to_micros(AS_OF) - 31 * brute.DAY
    assert {r.outcome: tuple(r)[1:] for r in report} == brute.weekly(
        rows, span, {"inside"}, border
    )
    assert len(report) > 5
