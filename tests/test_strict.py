"""Events that hold a looked-up key twice: the first entry counts, or it is an error."""

import pytest

from rows import PACKAGE, PRODUCTION, at, dimensions, event, events
from shardtally import constants as C
from shardtally.plans import reports

AS_OF = at(2024, 4, 30, 12)
OTHER = {"cchq_domain": "elsewhere", "app_flavor": "lts", "device_id": "d9"}
CLICK = {
    "event_type": C.CLICK_EVENT_TYPE,
    "firebase_screen_class": C.NOTIFICATION_SCREEN,
    "action": C.MESSAGE_ACTION,
}
PAGE = {"ga_session_id": 1, "firebase_screen_class": PACKAGE + C.PAGES["phone_page"]}
FUNNEL = ("funnel_monthly", "funnel_weekly")


def rows_with(spark, repeated):
    """A view, a click and a funnel page, whose users repeat the property ``repeated``."""
    props = [*PRODUCTION.items(), ("device_id", "d1"), ("user_cid", "c1")]
    if repeated:
        props.append((repeated, OTHER[repeated]))
    return events(
        spark,
        [
            event("screen_view", "a", at(2024, 3, 10), CLICK, props),
            event("ccc_notification_type", "a", at(2024, 3, 11), CLICK, props),
            event(C.API_EVENTS[0], "a", at(2024, 3, 11), (), props),
            event("screen_view", "a", at(2024, 3, 12), PAGE, props),
        ],
    )


def result(spark, name, repeated, **options):
    report = getattr(reports, name)
    df = rows_with(spark, repeated)
    return sorted(map(str, report(df, *dimensions(spark, ["d5"]), as_of=AS_OF, **options).collect()))


@pytest.mark.parametrize(
    "name, key",
    [(name, key) for name in FUNNEL for key in ("app_flavor", "device_id")]
    + [
        (name, key)
        for name in (
            "messaging_monthly",
            "notification_clicks",
            "notification_dau_mau",
            "notification_screen_views",
        )
        for key in ("cchq_domain", "device_id")
    ],
)
def test_a_repeated_property(spark, name, key):
    plain = result(spark, name, None)
    assert plain
    assert result(spark, name, None, strict=True) == plain
    assert result(spark, name, key) == plain
    with pytest.raises(Exception, match=f"key '{key}' occurs more than once"):
        result(spark, name, key, strict=True)


@pytest.mark.parametrize("name", ["messaging_monthly", "notification_clicks"])
def test_a_repeated_parameter_of_a_click(spark, name):
    click = event(
        "ccc_notification_type", "a", at(2024, 3, 11), [*CLICK.items(), ("action", "other")]
    )
    df, dims = events(spark, [click]), dimensions(spark, ["d5"])
    report = getattr(reports, name)
    report(df, *dims, as_of=AS_OF).collect()
    with pytest.raises(Exception, match="key 'action' occurs more than once"):
        report(df, *dims, as_of=AS_OF, strict=True).collect()
