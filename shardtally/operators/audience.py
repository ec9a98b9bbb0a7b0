"""Who counts: internal and flagged users, exclusion of users, production events.

``strict`` makes an event that holds a looked-up key more than once an error; without it the
first entry counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardtally import constants as C
from shardtally.functions.keyvalue import evaluate_once, prop
from shardtally.functions.windows import Window
from shardtally.sources import promoted
from shardtally.sources.events import in_window

USER = "user_pseudo_id"


def internal_devices(sessions: DataFrame, phones: DataFrame) -> DataFrame:
    """Devices that were configured with an internal phone number.

    A semi join: a number listed many times on both sides does not multiply rows.
    """
    dialled = sessions.select("device_id", F.ltrim("phone_number", F.lit("+")).alias("phone"))
    return dialled.join(phones, "phone", "left_semi").select("device_id").distinct()


def device_key(strict: bool = False) -> Column:
    """Device id of an event, spelled as in the configuration sessions."""
    return F.concat(F.lit(C.DEVICE_PREFIX), prop("device_id", strict))


def internal_users(
    events: DataFrame,
    sessions: DataFrame,
    phones: DataFrame,
    window: Window,
    strict: bool = False,
) -> DataFrame:
    """Ids of users seen on an internal device within the window.

    Events shrink to distinct (user, device) pairs before the join, so a busy user or device
    weighs no more than a quiet one; by then Spark knows the real size of the device list
    and broadcasts it only if it is small.
    """
    pairs = (
        evaluate_once(in_window(events, window), device_id=device_key(strict))
        .where(F.col("device_id").isNotNull())
        .select(USER, "device_id")
        .distinct()
    )
    devices = internal_devices(sessions, phones)
    return pairs.join(devices, "device_id", "left_semi").select(USER).distinct()


def flagged_users(
    events: DataFrame,
    window: Window,
    key: str = C.DEMO_USER_KEY,
    value: str = "true",
    strict: bool = False,
) -> DataFrame:
    """Ids of users with an event in the window whose property ``key`` equals ``value``."""
    return in_window(events, window).where(prop(key, strict) == value).select(USER).distinct()


def internal_or_flagged_users(
    events: DataFrame,
    sessions: DataFrame,
    phones: DataFrame,
    window: Window,
    key: str = C.DEMO_USER_KEY,
    value: str = "true",
    strict: bool = False,
) -> DataFrame:
    """``internal_users`` and ``flagged_users`` together, in one pass over the events."""
    flag = F.coalesce(prop(key, strict) == value, F.lit(False))
    pairs = (
        evaluate_once(in_window(events, window), device_id=device_key(strict), flagged=flag)
        .where(F.col("device_id").isNotNull() | F.col("flagged"))
        .groupBy(USER, "device_id")
        .agg(F.max("flagged").alias("flagged"))
    )
    devices = internal_devices(sessions, phones).withColumn("internal", F.lit(True))
    return (
        pairs.join(devices, "device_id", "left")
        .where(F.col("flagged") | F.col("internal"))
        .select(USER)
        .distinct()
    )


def exclude_users(df: DataFrame, ids: DataFrame | None, column: str = USER) -> DataFrame:
    """Rows whose ``column`` is NOT IN the single column of ``ids``, with SQL's NULL rules.

    No ids: every row stays, also NULL ones.  A NULL among the ids: no row stays.
    Otherwise rows with a NULL are dropped along with the listed ones.

    Spark runs ``NOT IN (subquery)`` by broadcasting the ids, however many there are.
    Here one count over the ids decides the NULL rules, and a plain anti join drops the
    rest, so Spark may broadcast or shuffle as the sizes ask.  The null-safe equality
    keeps the ids' plan the same in both places, so that it runs once.
    """
    if ids is None:
        return df
    (id_column,) = ids.columns
    ids = ids.select(F.col(id_column).alias("__excluded_id")).distinct()
    tally = ids.agg(
        F.struct(F.count("*").alias("all"), F.count("__excluded_id").alias("known")).alias("tally")
    ).scalar()
    eligible = df.where(
        (tally["all"] == 0) | ((tally["all"] == tally["known"]) & F.col(column).isNotNull())
    )
    return eligible.join(ids, eligible[column].eqNullSafe(ids["__excluded_id"]), "left_anti")


def has_flavor(flavor: str = C.PRODUCTION_FLAVOR, strict: bool = False) -> Column:
    return prop("app_flavor", strict) == flavor


def of_flavor(
    events: DataFrame, flavor: str = C.PRODUCTION_FLAVOR, strict: bool = False
) -> DataFrame:
    """Events of one app flavor."""
    if not promoted.is_promoted(events, "app_flavor"):
        return events.where(has_flavor(flavor, strict))
    known = promoted.prune(events, {"app_flavor": flavor}, {})
    return known.where(promoted.user_property(known, "app_flavor", strict) == flavor)


def production_events(
    events: DataFrame,
    domains: Sequence[str] = C.NON_PRODUCTION_DOMAINS,
    server: str = C.STAGING_SERVER,
    flavor: str = C.PRODUCTION_FLAVOR,
    strict: bool = False,
) -> DataFrame:
    """Events of production apps; an event without a domain or a server is not one."""
    if promoted.is_promoted(events, "app_flavor", "server", "cchq_domain"):
        # arrays are looked up for events of old files only, so a lookup may stand in several places
        events = promoted.prune(events, {"app_flavor": flavor}, {"server": server})
        found = (promoted.user_property(events, key, strict) for key in ("app_flavor", "server", "cchq_domain"))
        return events.where(_is_production(*found, domains, server, flavor))
    known = evaluate_once(
        events,
        __flavor=prop("app_flavor", strict),
        __server=prop("server", strict),
        __domain=prop("cchq_domain", strict),
    )
    wanted = _is_production(F.col("__flavor"), F.col("__server"), F.col("__domain"), domains, server, flavor)
    return known.where(wanted).drop("__flavor", "__server", "__domain")


def _is_production(
    own_flavor: Column,
    own_server: Column,
    own_domain: Column,
    domains: Sequence[str],
    server: str,
    flavor: str,
) -> Column:
    wanted = (own_flavor == flavor) & (own_server != server)
    for pattern in domains:
        wanted &= ~own_domain.like(pattern)
    return wanted
