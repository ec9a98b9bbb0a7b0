"""Reports over events, configuration sessions and internal phones.

Every report takes ``as_of`` (default: now).  ``excluded`` replaces the list of users to
leave out: pass it to compute the list once for several reports.  Of several entries of an
event with one key the first counts; with ``strict`` a looked-up key that repeats is an error.
Flattened funnel parameters take the largest entry either way.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardtally import constants as C
from shardtally.functions import windows
from shardtally.functions.times import as_utc, iso_second
from shardtally.operators import activity, audience, extract, funnel, retention
from shardtally.sources.events import in_window


def funnel_monthly(
    events: DataFrame,
    sessions: DataFrame,
    phones: DataFrame,
    as_of: datetime | None = None,
    excluded: DataFrame | None = None,
    strict: bool = False,
) -> DataFrame:
    """Users per sign-up outcome in the previous month, as one wide row."""
    window = windows.previous_month(as_of)
    if excluded is None:
        excluded = audience.internal_or_flagged_users(
            events, sessions, phones, window, strict=strict
        )
    started = audience.of_flavor(in_window(events, window), strict=strict)
    rolled_up = funnel.session_rollup(funnel.funnel_step_flags(funnel.funnel_events(started)))
    outcomes = funnel.with_outcome(rolled_up)
    per_user = audience.exclude_users(funnel.outcome_users(outcomes), excluded)
    row = funnel.pivot_outcomes(funnel.outcome_summary(per_user))
    return _with_dates(row, *C.OUTCOME_COLUMNS, dates_first=True)


def funnel_weekly(
    events: DataFrame,
    sessions: DataFrame,
    phones: DataFrame,
    as_of: datetime | None = None,
    window_days: int = C.FUNNEL_WINDOW_DAYS,
    excluded: DataFrame | None = None,
    strict: bool = False,
) -> DataFrame:
    """Users and sessions per sign-up outcome, in the last days and in the days before."""
    as_of = as_utc(as_of)
    window = windows.two_trailing_windows(as_of, window_days)
    if excluded is None:
        excluded = audience.internal_or_flagged_users(
            events, sessions, phones, window, strict=strict
        )
    started = audience.of_flavor(in_window(events, window), strict=strict)
    labelled = funnel.compare_windows(funnel.funnel_events(started), as_of, window_days)
    flags = funnel.funnel_step_flags(labelled, carry=["recent_data"])
    rolled_up = funnel.session_rollup(flags, by=["recent_data"])
    per_user = audience.exclude_users(funnel.path_users(rolled_up), excluded)
    totals = funnel.outcome_totals(funnel.path_rollup(per_user))
    counts = ("old_users", "recent_users", "old_sessions", "recent_sessions")
    return _with_dates(totals, "outcome", *counts).orderBy("outcome")


def messaging_monthly(
    events: DataFrame,
    sessions: DataFrame,
    phones: DataFrame,
    as_of: datetime | None = None,
    history_months: int = C.HISTORY_MONTHS,
    excluded: DataFrame | None = None,
    strict: bool = False,
) -> DataFrame:
    """Connected users, messages, and message notifications per month."""
    recent, excluded = _production(
        events, sessions, phones, as_of, history_months, excluded, strict
    )
    return activity.monthly_messaging(recent, excluded, strict).orderBy("event_month")


def notification_clicks(
    events: DataFrame,
    sessions: DataFrame,
    phones: DataFrame,
    as_of: datetime | None = None,
    history_months: int = C.HISTORY_MONTHS,
    excluded: DataFrame | None = None,
    strict: bool = False,
) -> DataFrame:
    """Clicks on notifications per month and action."""
    recent, excluded = _production(
        events, sessions, phones, as_of, history_months, excluded, strict
    )
    clicks = activity.notification_clicks(recent, strict)
    return activity.monthly_action_pivot(clicks, excluded).orderBy("event_month")


def notification_dau_mau(
    events: DataFrame,
    sessions: DataFrame,
    phones: DataFrame,
    as_of: datetime | None = None,
    history_months: int = C.HISTORY_MONTHS,
    excluded: DataFrame | None = None,
    strict: bool = False,
) -> DataFrame:
    """Daily and monthly users of the notification screen."""
    recent, excluded = _production(
        events, sessions, phones, as_of, history_months, excluded, strict
    )
    views = activity.notification_screen_views(recent, strict)
    return activity.active_users(views, excluded).orderBy("period", "metric_type")


def notification_screen_views(
    events: DataFrame,
    sessions: DataFrame,
    phones: DataFrame,
    as_of: datetime | None = None,
    history_months: int = C.SCREEN_VIEW_HISTORY_MONTHS,
    excluded: DataFrame | None = None,
    strict: bool = False,
) -> DataFrame:
    """Every view of the notification screen, flat."""
    recent, excluded = _production(
        events, sessions, phones, as_of, history_months, excluded, strict
    )
    views = extract.screen_view_extract(
        activity.notification_screen_views(recent, strict), strict
    )
    return audience.exclude_users(views, excluded)


def retention_statements(
    tables: DataFrame, as_of: datetime | None = None, days: int = C.RETENTION_DAYS
) -> DataFrame:
    """Expired shard tables with the statement that drops each."""
    return retention.expired_shards(tables, as_of, days).select(
        "table_name", F.format_string("DROP TABLE `%s`;", "table_name").alias("statement")
    )


def _production(events, sessions, phones, as_of, months, excluded, strict):
    as_of = as_utc(as_of)
    if excluded is None:
        seen = windows.history_to_date(as_of, months)
        excluded = audience.internal_users(events, sessions, phones, seen, strict)
    recent = in_window(events, windows.history_to_month_end(as_of, months))
    return audience.production_events(recent, strict=strict), excluded


def _with_dates(df: DataFrame, *columns: str, dates_first: bool = False) -> DataFrame:
    dates = [
        iso_second("first_second").alias("min_date"),
        iso_second("last_second").alias("max_date"),
    ]
    return df.select(*dates, *columns) if dates_first else df.select(*columns, *dates)
