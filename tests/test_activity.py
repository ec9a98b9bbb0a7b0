from datetime import date

from rows import PRODUCTION, at, dimensions, event, events
from shardtally.operators import activity, audience
from shardtally.plans import reports

AS_OF = at(2024, 4, 30, 12)


def click(action, user="u", when=at(2024, 3, 10), **params):
    values = {
        "event_type": "click_notification",
        "firebase_screen_class": "PushNotificationActivity",
        "action": action,
    }
    return event("ccc_notification_type", user, when, values | params)


def view(user, when, user_id=None):
    params = {"firebase_screen_class": "PushNotificationActivity"}
    return event("screen_view", user, when, params, user_id=user_id)


def call(user, when, cid):
    return event("ccc_api_jobs", user, when, props=PRODUCTION | {"user_cid": cid})


def message(user, when, user_id=None):
    return event("personal_id_message_sent", user, when, user_id=user_id)


def test_empty_and_missing_actions(spark):
    df = events(spark, [click(""), click(None), click("ccc_payment"), click("unknown")])
    (row,) = reports.notification_clicks(df, *dimensions(spark), as_of=AS_OF).collect()
    counted = {k: v for k, v in row.asDict().items() if k != "event_month" and v}
    assert counted == {"empty_action_count": 1, "ccc_payment_count": 1}
    assert row.event_month == date(2024, 3, 1)


def test_only_clicks_on_the_notification_screen(spark):
    rows = [
        click("ccc_payment", event_type="shown"),
        click("ccc_payment", firebase_screen_class="Other"),
    ]
    assert activity.notification_clicks(events(spark, rows)).count() == 0


def test_underscores_in_event_patterns_match_any_character(spark):
    rows = [event(name) | {"event_params": click("x")["event_params"]} for name in
            ("my_cccXnotificationYtype_2", "ccc_notification")]
    kept = activity.notification_clicks(events(spark, rows)).collect()
    assert [r.event_name for r in kept] == ["my_cccXnotificationYtype_2"]


def test_active_users_by_day_and_calendar_month(spark):
    rows = [
        view("a", at(2024, 3, 1), "A"),
        view("a", at(2024, 3, 31), "A2"),
        view("b", at(2024, 3, 31)),
        view(None, at(2024, 4, 1), "N"),
    ]
    found = {
        (r.period, r.metric_type): (r.distinct_users, r.distinct_named_users)
        for r in activity.active_users(events(spark, rows)).collect()
    }
    assert found == {
        (date(2024, 3, 1), "DAU"): (1, 1),
        (date(2024, 3, 31), "DAU"): (2, 1),
        (date(2024, 3, 1), "MAU"): (2, 2),
        (date(2024, 4, 1), "DAU"): (0, 1),
        (date(2024, 4, 1), "MAU"): (0, 1),
    }


def test_messaging_keeps_only_months_with_calls(spark):
    rows = [
        call("a", at(2024, 2, 1), None),
        call("a", at(2024, 3, 1), "c1"),
        call("b", at(2024, 3, 1), "c1"),
        message("a", at(2024, 3, 2), "A"),
        message("b", at(2024, 3, 2), "B"),
        message("b", at(2024, 3, 3), "B"),
        click("ccc_message", when=at(2024, 3, 4)),
        click("ccc_payment", when=at(2024, 3, 5)),
        click(None, when=at(2024, 3, 6)),
        message("a", at(2024, 4, 2), "A"),
    ]
    report = reports.messaging_monthly(events(spark, rows), *dimensions(spark), as_of=AS_OF)
    assert [tuple(r) for r in report.collect()] == [
        ("2024-02", 0, None, None, None, None, None, None),
        ("2024-03", 1, 2, 3, 1.5, 1, 3, 33.33),
    ]


def test_messages_without_named_users_have_no_average(spark):
    rows = [call("a", at(2024, 3, 1), "c"), message("a", at(2024, 3, 1))]
    report = reports.messaging_monthly(events(spark, rows), *dimensions(spark), as_of=AS_OF)
    (row,) = report.collect()
    assert (row.messaging_distinct_users, row.total_messages, row.avg_messages_per_user) == (0, 1, None)


def test_one_pass_messaging_equals_the_three_joined(spark):
    months = [1, 2, 3, 3, 4]
    rows = [
        make(f"u{i % 4}", at(2024, m, 1 + i))
        for i, m in enumerate(months * 4)
        for make in (
            lambda u, w: call(u, w, u + "c" if w.day % 2 else None),
            lambda u, w: message(u, w, u if w.day % 3 else None),
            lambda u, w: click("ccc_message" if w.day % 4 else "", u, w),
        )
        if w_allowed(make, m)
    ]
    df = events(spark, rows)
    excluded = spark.createDataFrame([("u1",)], "id string")
    calls = df.where("event_name = 'ccc_api_jobs'")
    messages = df.where("event_name = 'personal_id_message_sent'")
    joined = (
        activity.monthly_distinct_users(calls, excluded)
        .join(activity.monthly_message_stats(messages, excluded), "event_month", "left")
        .join(
            activity.monthly_action_share(activity.notification_clicks(df), excluded),
            "event_month",
            "left",
        )
    )
    one_pass = activity.monthly_messaging(df, excluded)
    assert sorted(map(tuple, one_pass.select(joined.columns).collect())) == sorted(
        map(tuple, joined.collect())
    )


def w_allowed(make, month):
    """January has no calls, February no messages."""
    kind = make.__code__.co_names[0]
    return (kind, month) not in {("call", 1), ("message", 2)}


def test_month_is_of_the_event_and_range_is_of_the_shard(spark):
    late = click("ccc_payment", when=at(2024, 5, 1)) | {"shard": "20240430"}
    (row,) = reports.notification_clicks(
        events(spark, [late]), *dimensions(spark), as_of=AS_OF
    ).collect()
    assert row.event_month == date(2024, 5, 1)


def test_screen_views_report(spark):
    rows = [
        view("kept", at(2024, 4, 2, 3, 4, 5), "K")
        | {"device": {"category": "tablet"}, "geo": {"city": "X"}, "app_info": {"version": "2.1"}},
        view("too old", at(2024, 2, 28)),
        view("inside", at(2024, 4, 2)) | {"user_properties": event("e", props=PRODUCTION | {"device_id": "d1"})["user_properties"]},
    ]
    report = reports.notification_screen_views(
        events(spark, rows), *dimensions(spark, ["d1"]), as_of=AS_OF
    )
    assert len(report.columns) == 24
    (row,) = report.collect()
    assert (row.user_pseudo_id, row.event_datetime, row.event_date) == (
        "kept", "2024-04-02T03:04:05Z", "2024-04-02")
    assert (row.category, row.city, row.version, row.language) == ("tablet", "X", "2.1", None)


def test_a_null_among_the_internal_ids_empties_a_report(spark):
    rows = [
        click("ccc_payment", "a"),
        event("e", None, props={"device_id": "d1"}),
    ]
    df = events(spark, rows)
    dims = dimensions(spark, ["d1"])
    assert reports.notification_clicks(df, *dims, as_of=AS_OF).count() == 0
    assert audience.internal_users(df, *dims, _march()).count() == 1


def _march():
    from shardtally.functions import windows

    return windows.previous_month(AS_OF)
