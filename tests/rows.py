"""Hand-written events for unit tests."""

from datetime import UTC, datetime

from shardtally import constants as C
from shardtally.checks import fixtures
from shardtally.functions.times import to_micros
from shardtally.sources import schema

PACKAGE = "p" * (C.SCREEN_NAME_START - 1)
PRODUCTION = {
    "app_flavor": C.PRODUCTION_FLAVOR,
    "cchq_domain": fixtures.PRODUCTION_DOMAIN,
    "server": fixtures.PRODUCTION_SERVER,
}


def at(*when: int) -> datetime:
    return datetime(*when, tzinfo=UTC)


def entries(values):
    """Key/value array from a dict, or from a list of pairs if keys repeat; None stays NULL."""
    if values is None:
        return None
    pairs = values.items() if isinstance(values, dict) else values
    return [
        {
            "key": key,
            "value": {
                "string_value": value if isinstance(value, str) else None,
                "int_value": value if isinstance(value, int) else None,
            },
        }
        for key, value in pairs
    ]


def event(name, user="u", when=at(2024, 3, 10), params=(), props=None, **fields):
    when = when if isinstance(when, int) else to_micros(when)
    day = datetime.fromtimestamp(when // 1_000_000, UTC).strftime("%Y%m%d")
    row = {
        "event_name": name,
        "event_timestamp": when,
        "user_pseudo_id": user,
        "user_id": None,
        "event_params": entries(params),
        "user_properties": entries(PRODUCTION if props is None else props),
        "device": None,
        "geo": None,
        "app_info": None,
        "shard": day,
    }
    return row | fields


def page(flag, user="u", when=at(2024, 3, 10), session=1, **fields):
    params = {"ga_session_id": session, "firebase_screen_class": PACKAGE + C.PAGES[flag]}
    return event("screen_view", user, when, params, **fields)


def events(spark, rows):
    return spark.createDataFrame(rows, schema.EVENTS)


def dimensions(spark, internal_devices=()):
    """Configuration sessions and phones that make the given devices internal."""
    sessions = [(C.DEVICE_PREFIX + device, f"++{i}") for i, device in enumerate(internal_devices)]
    phones = [(str(i),) for i in range(len(sessions))]
    return (
        spark.createDataFrame(sessions + [("other", "+999")], schema.CONFIG_SESSIONS),
        spark.createDataFrame(phones + [("888",)], schema.INTERNAL_PHONES),
    )
