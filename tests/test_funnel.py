import pytest

from rows import PRODUCTION, at, dimensions, event, events, page
from shardtally import constants as C
from shardtally.functions.times import iso_second, to_micros
from shardtally.operators import funnel
from shardtally.plans import reports

AS_OF = at(2024, 4, 30, 12)
LOCKED = "start_configuration_locked_account_failure"


def failure(reason, when=at(2024, 3, 10), user="u", session=1):
    params = {"ga_session_id": session, "reason": reason}
    return event("personal_id_configuration_failure", user, when, params)


def recovery(success, when=at(2024, 3, 10), user="u", session=1):
    params = {"ga_session_id": session, "value": success}
    return event(C.ACCOUNT_RECOVERED, user, when, params)


def creation(when=at(2024, 3, 10), user="u", session=1):
    return event(C.ACCOUNT_CREATED, user, when, {"ga_session_id": session})


def sessions(spark, rows):
    flags = funnel.funnel_step_flags(funnel.funnel_events(events(spark, rows)))
    return funnel.with_outcome(funnel.session_rollup(flags))


def outcome(spark, *rows):
    (row,) = sessions(spark, list(rows)).collect()
    return row.final_state, row.outcome


def second(n):
    return at(2024, 3, 10, 0, 0, n)


def wrong_codes(*seconds):
    return [recovery(0, second(n)) for n in seconds]


@pytest.mark.parametrize(
    "rows, state",
    [
        ([creation()], "Created"),
        ([recovery(1)], "Recovered"),
        ([failure(LOCKED)], "Locked"),
        ([recovery(1, second(1)), failure(LOCKED, second(2))], "Locked"),
        ([recovery(1, second(2)), failure(LOCKED, second(1))], "Recovered"),
        # The same second is not after, even if the microsecond is.
        (
            [recovery(1, second(1)), failure(LOCKED, to_micros(second(1)) + 500_000)],
            "Recovered",
        ),
        ([creation(second(1)), failure(LOCKED, second(2))], "Locked"),
        # A recovery hides the creation in the comparison.
        (
            [creation(second(1)), failure(LOCKED, second(2)), recovery(1, second(3))],
            "Recovered",
        ),
        (wrong_codes(1, 2, 3), "Locked (new)"),
        (wrong_codes(1, 2), "Not configured"),
        ([recovery(1, second(1)), *wrong_codes(2, 3, 4)], "Locked (new)"),
        ([*wrong_codes(1, 2, 3), recovery(1, second(4))], "Recovered"),
        ([creation(second(1)), *wrong_codes(2, 3, 4)], "Locked (new)"),
        ([failure(LOCKED, second(1)), *wrong_codes(2, 3, 4)], "Locked"),
        # Neither a recovery nor a wrong code.
        ([recovery(None), recovery(2)], "Not configured"),
    ],
)
def test_final_state(spark, rows, state):
    assert outcome(spark, *rows)[0] == state


@pytest.mark.parametrize(
    "rows, label",
    [
        ([page("phone_page")], "Phone"),
        ([page("phone_page"), failure("play_services_9", second(1))], "Phone Error"),
        ([page("biometric_page"), failure("play_services_9", second(1))], "Biometric"),
        ([page("biometric_page"), failure("min_biometric_needs_update")], "Biometric Error"),
        ([page("phone_page"), page("otp_page", when=second(1))], "OTP"),
        ([page("photo_page"), page("name_page", when=second(1))], "Photo"),
        ([page("photo_page"), creation(second(1))], "Created"),
        ([failure("play_services_2")], ""),
        # A failure whose reason reads like an event counts as that event.
        ([failure("created")], "Created"),
    ],
)
def test_furthest_step(spark, rows, label):
    assert outcome(spark, *rows)[1] == label


def test_only_funnel_screens_count(spark):
    any_case = C.FUNNEL_SCREEN_WORD.lower() + "Something"
    names = [C.ACTIVITY_SCREEN, any_case, "OtherFragment"]
    rows = [
        event("screen_view", name, params={"firebase_screen_class": "p" * 34 + name})
        for name in names
    ]
    rows.append(event("screen_view", "short", params={"firebase_screen_class": C.FUNNEL_SCREEN_WORD}))
    rows.append(event("screen_view", "none"))
    kept = {r.user_pseudo_id for r in funnel.funnel_events(events(spark, rows)).collect()}
    assert kept == {any_case}


def test_copies_of_an_event_are_one(spark):
    rows = [recovery(0, second(1)) for _ in range(5)]
    (row,) = sessions(spark, rows).collect()
    assert row.incorrect_backup_codes == 1


def test_copies_that_differ_keep_the_largest_value(spark):
    rows = [failure("play_services_2", session=1), failure("play_services_9", session=2)]
    (row,) = sessions(spark, rows).collect()
    assert (row.ga_session_id, row.play_services_2, row.play_services_9) == (2, 0, 1)


def test_event_without_parameters_forms_a_null_session(spark):
    (row,) = sessions(spark, [event(C.ACCOUNT_CREATED)]).collect()
    assert (row.ga_session_id, row.outcome) == (None, "Created")
    summary = funnel.outcome_summary(funnel.outcome_users(sessions(spark, [event(C.ACCOUNT_CREATED)])))
    (row,) = summary.collect()
    assert (row.users, row.sessions) == (1, 0)


def test_monthly_report_on_no_events_is_one_empty_row(spark):
    (row,) = reports.funnel_monthly(events(spark, []), *dimensions(spark), as_of=AS_OF).collect()
    assert set(row.asDict().values()) == {None}
    assert len(row) == 14


def test_monthly_report(spark):
    demo = PRODUCTION | {"is_personal_id_demo_user": "true"}
    inside = PRODUCTION | {"device_id": "d1"}
    rows = [
        page("phone_page", "a"),
        page("phone_page", "b", at(2024, 3, 20), session=2),
        page("phone_page", "b", at(2024, 3, 21), session=3),
        creation(at(2024, 3, 30), "a", session=4),
        page("otp_page", "demo", props=demo),
        page("otp_page", "inside", props=inside),
        page("otp_page", "other app", props={"app_flavor": "lts"}),
        page("otp_page", "too late", at(2024, 4, 1)),
        failure("no_such_reason", at(2024, 3, 1), "c"),
    ]
    report = reports.funnel_monthly(
        events(spark, rows), *dimensions(spark, ["d1"]), as_of=AS_OF
    )
    (row,) = report.collect()
    filled = {k: v for k, v in row.asDict().items() if v is not None}
    assert filled == {
        # The outcome '' has no column, but its dates count.
        "min_date": "2024-03-01T00:00:00Z",
        "max_date": "2024-03-30T00:00:00Z",
        "phone": 2,
        "created": 1,
    }


def test_weekly_report_counts_users_per_path(spark):
    rows = [
        page("phone_page", "a", session=1),
        page("phone_page", "a", at(2024, 3, 11), session=2),
        failure("play_services_2", at(2024, 3, 12), "a", session=3),
        page("phone_page", "a", at(2024, 3, 12), session=3),
        failure("play_services_9", at(2024, 3, 13), "a", session=4),
        page("phone_page", "a", at(2024, 3, 13), session=4),
        page("phone_page", "b", at(2024, 4, 20), session=5),
    ]
    report = reports.funnel_weekly(events(spark, rows), *dimensions(spark), as_of=AS_OF)
    counts = {r.outcome: (r.old_users, r.recent_users, r.old_sessions, r.recent_sessions) for r in report.collect()}
    assert counts == {"Phone": (1, 1, 2, 1), "Phone Error": (2, 0, 2, 0)}


def test_recent_is_by_hours_not_by_calendar(spark):
    rows = [
        page("phone_page", "noon", at(2024, 3, 30, 12)),
        page("phone_page", "after noon", at(2024, 3, 30, 12, 0, 1)),
    ]
    labelled = funnel.compare_windows(events(spark, rows), AS_OF, 30)
    assert {r.user_pseudo_id: r.recent_data for r in labelled.collect()} == {
        "noon": 0,
        "after noon": 1,
    }


def test_last_times_only_for_a_single_session(spark):
    rows = [
        creation(at(2024, 3, 10), "alone"),
        recovery(1, at(2024, 3, 11), "x"),
        recovery(1, at(2024, 3, 12), "y"),
    ]
    flagged = funnel.compare_windows(funnel.funnel_events(events(spark, rows)), AS_OF)
    flags = funnel.funnel_step_flags(flagged, carry=["recent_data"])
    paths = funnel.path_rollup(funnel.path_users(funnel.session_rollup(flags, ["recent_data"])))
    found = {
        r.outcome: (r.created_at, r.recovered_at)
        for r in paths.select(
            "outcome",
            iso_second("last_created").alias("created_at"),
            iso_second("last_recovered").alias("recovered_at"),
        ).collect()
    }
    assert found == {"Created": ("2024-03-10T00:00:00Z", None), "Recovered": (None, None)}
