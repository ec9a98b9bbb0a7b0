"""Checked queries of the user-level operators and the reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardtally import constants as C
from shardtally.checks import oracle as O
from shardtally.checks.fixtures import AS_OF, RETENTION_AS_OF
from shardtally.checks.registry import Tables, check
from shardtally.functions import windows
from shardtally.functions.keyvalue import param, prop
from shardtally.functions.times import iso_second
from shardtally.operators import activity, audience, daily, distinct, extract, flatten, funnel, retention
from shardtally.plans import reports
from shardtally.sources.events import in_window

LAST_MONTH = windows.previous_month(AS_OF)
BOTH_WINDOWS = windows.two_trailing_windows(AS_OF)
HISTORY = windows.history_to_month_end(AS_OF)
SEEN = windows.history_to_date(AS_OF)

FUNNEL = O.funnel("TRUE")
SESSIONS = FUNNEL + O.session_rows()
WEEKLY_SESSIONS = O.funnel(O.TWO_WINDOWS) + O.session_rows("recent_data,")
COUNTED = (
    f"WHERE {O.not_internal(O.MARCH)} AND {O.not_demo(O.MARCH)}",
    f"WHERE {O.not_internal(O.TWO_WINDOWS)} AND {O.not_demo(O.TWO_WINDOWS)}",
)
SUMMARY = """,
summary AS (
  SELECT outcome, count(DISTINCT user_pseudo_id) AS users, count(ga_session_id) AS sessions,
         min(min_date) AS min_date, max(max_date) AS max_date
  FROM sess GROUP BY outcome
)"""
WIDE_ROW = "SELECT min(min_date) AS min_date, max(max_date) AS max_date, " + ", ".join(
    f"max(users) FILTER (WHERE outcome = '{outcome}') AS {column}"
    for column, outcome in C.OUTCOME_COLUMNS.items()
)


def _flags(t: Tables) -> DataFrame:
    started = t.events.where(audience.has_flavor())
    return funnel.funnel_step_flags(funnel.funnel_events(started))


def _sessions(t: Tables) -> DataFrame:
    return funnel.with_outcome(funnel.session_rollup(_flags(t)))


def _paths(t: Tables) -> DataFrame:
    started = in_window(t.events, BOTH_WINDOWS).where(audience.has_flavor())
    labelled = funnel.compare_windows(funnel.funnel_events(started), AS_OF)
    flags = funnel.funnel_step_flags(labelled, carry=["recent_data"])
    return funnel.path_rollup(funnel.path_users(funnel.session_rollup(flags, by=["recent_data"])))


def _history(t: Tables) -> DataFrame:
    return audience.production_events(in_window(t.events, HISTORY))


def _internal(t: Tables) -> DataFrame:
    return audience.internal_users(*t.all, SEEN)


def _dated(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(
        *columns,
        iso_second("first_second").alias("min_date"),
        iso_second("last_second").alias("max_date"),
    )


def _last_times() -> list:
    return [iso_second(name).alias(name) for name in funnel.LAST_TIMES]


# --- reading and attributes ---------------------------------------------------------------


@check(
    "read_events_window",
    f" SELECT shard, event_id, event_name, event_timestamp, user_pseudo_id FROM ev WHERE {O.MARCH}",
)
def read_events_window(t):
    return in_window(t.events, LAST_MONTH).select(
        "shard", "event_id", "event_name", "event_timestamp", "user_pseudo_id"
    )


@check(
    "prop",
    f""" SELECT event_id, {O.p('device_id')} AS device_id, {O.p('cchq_domain')} AS cchq_domain,
    {O.p('user_cid')} AS user_cid, {O.p('no_such_key')} AS no_such_key FROM ev""",
)
def prop_lookup(t):
    keys = ("device_id", "cchq_domain", "user_cid", "no_such_key")
    return t.events.select("event_id", *[prop(key).alias(key) for key in keys])


@check(
    "param",
    f""" SELECT event_id, {O.e('action')} AS action, {O.e('reason')} AS reason,
    {O.e('value', 'int_value')} AS success, {O.e('ga_session_id', 'int_value')} AS ga_session_id FROM ev""",
)
def param_lookup(t):
    return t.events.select(
        "event_id",
        param("event_params", "action").alias("action"),
        param("event_params", "reason").alias("reason"),
        param("event_params", "value", "int").alias("success"),
        param("event_params", "ga_session_id", "int").alias("ga_session_id"),
    )


# --- audience -----------------------------------------------------------------------------


@check("internal_users", f" SELECT DISTINCT user_pseudo_id FROM internal_seen WHERE {O.MARCH}")
def internal_users(t):
    return audience.internal_users(*t.all, LAST_MONTH)


@check("internal_users_marks", f" SELECT DISTINCT user_pseudo_id FROM internal_seen WHERE {O.MARCH}")
def internal_users_marks(t):
    """From the daily marks of all events, of which the window's are read."""
    return daily.internal_users(daily.user_marks(t.events), t.sessions, t.phones, LAST_MONTH)


@check("flagged_users", f" SELECT DISTINCT user_pseudo_id FROM demo_seen WHERE {O.MARCH}")
def flagged_users(t):
    return audience.flagged_users(t.events, LAST_MONTH)


@check(
    "exclude_users",
    f""" SELECT event_id, user_pseudo_id FROM ev
    WHERE {O.not_demo(O.MARCH)} AND {O.not_internal(O.MARCH)}""",
)
def exclude_users(t):
    ids = audience.internal_or_flagged_users(*t.all, LAST_MONTH)
    return audience.exclude_users(t.events.select("event_id", "user_pseudo_id"), ids)


@check("production_events", f" SELECT event_id, user_pseudo_id FROM ev WHERE {O.IS_PRODUCTION}")
def production_events(t):
    return audience.production_events(t.events).select("event_id", "user_pseudo_id")


@check("production_events_promoted", f" SELECT event_id, user_pseudo_id FROM ev WHERE {O.IS_PRODUCTION}")
def production_events_promoted(t):
    """From files of which those of the last two months have promoted columns."""
    return audience.production_events(t.promoted).select("event_id", "user_pseudo_id")


# --- funnel -------------------------------------------------------------------------------


@check(
    "flatten_event_params",
    f""", starting AS (SELECT * FROM ev), {O.FLAT.strip()} SELECT * FROM flat""",
)
def flatten_event_params(t):
    return flatten.flatten_event_params(
        t.events,
        integers={
            "ga_session_id": "ga_session_id",
            "ga_session_number": "ga_session_number",
            "success": "value",
        },
        strings={"screen_class": "firebase_screen_class", "reason": "reason"},
    )


@check("funnel_step_flags", FUNNEL + " SELECT * EXCLUDE (recent_data) FROM flags")
def funnel_step_flags(t):
    return _flags(t).select(
        "user_pseudo_id",
        "ga_session_id",
        iso_second("event_second").alias("event_datetime"),
        *funnel.STEPS,
        "incorrect_backup_code",
        *[
            iso_second(f"{kind}_second").alias(f"{kind}_date")
            for kind in ("lockout", "recovered", "created", "wrong_backup_code")
        ],
    )


@check("session_rollup", SESSIONS + " SELECT * FROM rolled")
def session_rollup(t):
    return _dated(
        _sessions(t),
        "user_pseudo_id",
        "ga_session_id",
        *funnel.STEPS,
        "incorrect_backup_codes",
        *_last_times(),
    )


@check("session_rollup_by_user", SESSIONS + " SELECT * FROM rolled")
def session_rollup_by_user(t):
    """From a table bucketed by user."""

    def sessions(events: DataFrame) -> DataFrame:
        started = events.where(audience.has_flavor())
        return funnel.with_outcome(funnel.session_rollup(funnel.funnel_step_flags(funnel.funnel_events(started))))

    columns = ["user_pseudo_id", "ga_session_id", *funnel.STEPS, "incorrect_backup_codes", *_last_times()]
    return _dated(t.by_user.each(sessions), *columns)


@check("final_state", SESSIONS + " SELECT user_pseudo_id, ga_session_id, final_state FROM sess")
def final_state(t):
    return _sessions(t).select("user_pseudo_id", "ga_session_id", "final_state")


@check("furthest_step", SESSIONS + " SELECT user_pseudo_id, ga_session_id, outcome FROM sess")
def furthest_step(t):
    return _sessions(t).select("user_pseudo_id", "ga_session_id", "outcome")


@check("outcome_summary_monthly", SESSIONS + SUMMARY + " SELECT * FROM summary")
def outcome_summary_monthly(t):
    summary = funnel.outcome_summary(funnel.outcome_users(_sessions(t)))
    return _dated(summary, "outcome", "users", "sessions")


@check("pivot_outcomes", SESSIONS + SUMMARY + f" {WIDE_ROW} FROM summary")
def pivot_outcomes(t):
    summary = funnel.outcome_summary(funnel.outcome_users(_sessions(t)))
    return _dated(funnel.pivot_outcomes(summary), *C.OUTCOME_COLUMNS)


@check(
    "compare_windows",
    f""" SELECT event_id, recent_data,
      CASE WHEN recent_data = 0 THEN user_pseudo_id END AS older_user_id,
      CASE WHEN recent_data = 1 THEN user_pseudo_id END AS recent_user_id
    FROM (SELECT *, CAST(date_diff('second', make_timestamp(event_timestamp), TIMESTAMP '2024-04-30 12:00:00')
                         < 31 * 86400 AS BIGINT) AS recent_data
          FROM ev WHERE {O.TWO_WINDOWS})""",
)
def compare_windows(t):
    labelled = funnel.compare_windows(in_window(t.events, BOTH_WINDOWS), AS_OF)
    recent, user = F.col("recent_data"), F.col("user_pseudo_id")
    return labelled.select(
        "event_id",
        "recent_data",
        F.when(recent == 0, user).alias("older_user_id"),
        F.when(recent == 1, user).alias("recent_user_id"),
    )


@check(
    "path_rollup",
    WEEKLY_SESSIONS
    + O.PATHS
    + " SELECT * EXCLUDE (last_lockout, last_recovered, last_created, last_wrong_backup_code) FROM paths",
)
def path_rollup(t):
    return _dated(
        _paths(t),
        *funnel.STEPS,
        "incorrect_backup_codes",
        "final_state",
        "outcome",
        "had_errors",
        "old_users",
        "recent_users",
        "old_sessions",
        "recent_sessions",
    )


@check(
    "single_user_value",
    WEEKLY_SESSIONS
    + O.PATHS
    + f" SELECT {', '.join(O.PATH_FLAGS)}, incorrect_backup_codes, final_state, {', '.join(O.LAST)} FROM paths",
)
def single_user_value(t):
    return _paths(t).select(
        *funnel.STEPS, "incorrect_backup_codes", "final_state", *_last_times()
    )


# --- activity -----------------------------------------------------------------------------

_COUNTED = f"{O.HISTORY} AND {O.IS_PRODUCTION} AND {O.not_internal(O.HISTORY)}"
_CONNECT = f""",
connect AS (
  SELECT {O.MONTH_TEXT} AS event_month, count(DISTINCT cid) AS overall_distinct_connect_users
  FROM (SELECT event_timestamp, {O.p('user_cid')} AS cid FROM ev
        WHERE event_name IN ('ccc_api_jobs', 'ccc_api_delivery_progress', 'ccc_api_learn_progress')
          AND {_COUNTED})
  GROUP BY 1
)"""
_SENT = f""",
sent AS (
  SELECT {O.MONTH_TEXT} AS event_month, count(DISTINCT user_id) AS messaging_distinct_users,
         count(*) AS total_messages,
         round(count(*) / nullif(count(DISTINCT user_id), 0), 2) AS avg_messages_per_user
  FROM ev WHERE event_name = 'personal_id_message_sent' AND {_COUNTED}
  GROUP BY 1
)"""
_CLICKED = f""",
clicks AS (
  SELECT event_timestamp, user_pseudo_id, {O.e('action')} AS action
  FROM ev WHERE {O.IS_CLICK} AND {_COUNTED}
),
clicked AS (
  SELECT {O.MONTH_TEXT} AS event_month, count(*) AS total_notifications,
         count(*) FILTER (WHERE action = 'ccc_message') AS ccc_message_count,
         round(count(*) FILTER (WHERE action = 'ccc_message') / count(*) * 100, 2) AS ccc_message_percentage
  FROM clicks GROUP BY 1
)"""
_PIVOT = f""" SELECT {O.MONTH_DATE} AS event_month,
    count(*) FILTER (WHERE action = 'ccc_message') AS ccc_message_count,
    count(*) FILTER (WHERE action = 'ccc_payment') AS ccc_payment_count,
    count(*) FILTER (WHERE action = 'ccc_payment_info_confirmation') AS ccc_payment_info_confirmation_count,
    count(*) FILTER (WHERE action = 'ccc_opportunity_summary_page') AS ccc_opportunity_summary_page_count,
    count(*) FILTER (WHERE action = 'ccc_learn_progress') AS ccc_learn_progress_count,
    count(*) FILTER (WHERE action = 'ccc_delivery_progress') AS ccc_delivery_progress_count,
    count(*) FILTER (WHERE action = '') AS empty_action_count"""
_ACTIVE = """
  SELECT CAST(d AS DATE) AS period, 'DAU' AS metric_type,
    count(DISTINCT user_pseudo_id) AS distinct_users, count(DISTINCT user_id) AS distinct_named_users
  FROM viewed GROUP BY d
  UNION ALL
  SELECT CAST(date_trunc('month', d) AS DATE), 'MAU',
    count(DISTINCT user_pseudo_id), count(DISTINCT user_id)
  FROM viewed GROUP BY date_trunc('month', d)"""


@check("monthly_distinct_users", _CONNECT + " SELECT * FROM connect")
def monthly_distinct_users(t):
    calls = _history(t).where(F.col("event_name").isin(*C.API_EVENTS))
    return activity.monthly_distinct_users(calls, _internal(t))


@check("monthly_message_stats", _SENT + " SELECT * FROM sent")
def monthly_message_stats(t):
    sent = _history(t).where(F.col("event_name") == C.MESSAGE_SENT)
    return activity.monthly_message_stats(sent, _internal(t))


@check("monthly_action_share", _CLICKED + " SELECT * FROM clicked")
def monthly_action_share(t):
    clicks = activity.notification_clicks(_history(t))
    return activity.monthly_action_share(clicks, _internal(t))


@check(
    "monthly_action_pivot",
    f""", clicks AS (SELECT event_timestamp, {O.e('action')} AS action FROM ev WHERE {O.IS_CLICK})"""
    + _PIVOT
    + " FROM clicks GROUP BY 1",
)
def monthly_action_pivot(t):
    return activity.monthly_action_pivot(activity.notification_clicks(t.events))


@check("named_like", f" SELECT event_id, event_name FROM ev WHERE event_name LIKE '{C.NOTIFICATION_PATTERN}'")
def named_like(t):
    """With the names of the shards up to April only: later ones are read by the pattern."""
    names = daily.event_names(t.events.where("shard < '20240401'"))
    return daily.named_like(t.events, C.NOTIFICATION_PATTERN, names).select("event_id", "event_name")


@check(
    "active_users",
    f""", viewed AS (SELECT {O.DAY_DATE} AS d, user_pseudo_id, user_id FROM ev WHERE {O.IS_VIEW})"""
    + _ACTIVE,
)
def active_users(t):
    return activity.active_users(activity.notification_screen_views(t.events))


@check(
    "active_users_state",
    f""", viewed AS (SELECT {O.DAY_DATE} AS d, user_pseudo_id, user_id FROM ev WHERE {O.IS_VIEW})"""
    + _ACTIVE,
)
def active_users_state(t):
    """State of two runs, the second over later days and a day of the first again."""
    views = activity.notification_screen_views(t.events)
    runs = [views.where("shard <= '20240315'"), views.where("shard >= '20240315'")]
    users = names = None
    states = []
    for run in runs:
        users, names = (distinct.number_values(run.select(c), n) for c, n in (("user_pseudo_id", users), ("user_id", names)))
        states.append(distinct.daily_users(run, users, names))
    return distinct.active_users(distinct.merged(*states))


_EXTRACT = f""" SELECT event_timestamp,
    strftime(make_timestamp(event_timestamp), '%Y-%m-%dT%H:%M:%SZ') AS event_datetime,
    strftime(make_timestamp(event_timestamp), '%Y-%m-%d') AS event_date,
    event_name, {O.e('firebase_screen_class')} AS screen_name,
    {O.p('ccc_enabled')} AS ccc_enabled, {O.p('user_cid')} AS connect_id,
    {O.p('cchq_domain')} AS cchq_domain, {O.p('user_id')} AS cc_user_id,
    user_id, user_pseudo_id, device.*, geo.*, app_info.* FROM ev"""


@check("screen_view_extract", _EXTRACT + " WHERE event_name LIKE '%screen_view%'")
def screen_view_extract(t):
    views = t.events.where(F.col("event_name").like(C.SCREEN_VIEW_PATTERN))
    return extract.screen_view_extract(views)


# --- retention ----------------------------------------------------------------------------

_EXPIRED = f""" FROM shards
    WHERE regexp_matches(table_name, '{C.SHARD_TABLE_PATTERN}')
      AND right(table_name, 8) < '20240304'"""


@check("expired_shards", " SELECT table_name" + _EXPIRED)
def expired_shards(t):
    return retention.expired_shards(t.shards, RETENTION_AS_OF)


@check("apply_retention", " SELECT shard, event_id FROM ev WHERE shard >= '20240304'")
def apply_retention(t):
    return retention.kept_events(t.events, RETENTION_AS_OF).select("shard", "event_id")


# --- reports ------------------------------------------------------------------------------


@check(
    "funnel_monthly",
    O.funnel(O.MARCH, COUNTED[0]) + O.session_rows() + SUMMARY + f" {WIDE_ROW} FROM summary",
)
def funnel_monthly(t):
    return reports.funnel_monthly(*t.all, as_of=AS_OF)


@check(
    "funnel_weekly",
    O.funnel(O.TWO_WINDOWS, COUNTED[1])
    + O.session_rows("recent_data,")
    + O.PATHS
    + """ SELECT outcome,
      CAST(sum(old_users) AS BIGINT) AS old_users, CAST(sum(recent_users) AS BIGINT) AS recent_users,
      CAST(sum(old_sessions) AS BIGINT) AS old_sessions,
      CAST(sum(recent_sessions) AS BIGINT) AS recent_sessions,
      min(min_date) AS min_date, max(max_date) AS max_date
    FROM paths GROUP BY outcome ORDER BY outcome""",
)
def funnel_weekly(t):
    return reports.funnel_weekly(*t.all, as_of=AS_OF)


@check(
    "messaging_monthly",
    _CONNECT
    + _SENT
    + _CLICKED
    + """ SELECT event_month, overall_distinct_connect_users, messaging_distinct_users, total_messages,
      avg_messages_per_user, ccc_message_count, total_notifications, ccc_message_percentage
    FROM connect LEFT JOIN sent USING (event_month) LEFT JOIN clicked USING (event_month)
    ORDER BY event_month""",
)
def messaging_monthly(t):
    return reports.messaging_monthly(*t.all, as_of=AS_OF)


@check("notification_clicks", _CLICKED + _PIVOT + " FROM clicks GROUP BY 1 ORDER BY 1")
def notification_clicks(t):
    return reports.notification_clicks(*t.all, as_of=AS_OF)


@check(
    "notification_dau_mau",
    f""", viewed AS (SELECT {O.DAY_DATE} AS d, user_pseudo_id, user_id FROM ev
      WHERE {O.IS_VIEW} AND {_COUNTED})"""
    + _ACTIVE
    + " ORDER BY 1, 2",
)
def notification_dau_mau(t):
    return reports.notification_dau_mau(*t.all, as_of=AS_OF)


@check(
    "notification_screen_views",
    _EXTRACT
    + f" WHERE {O.VIEW_HISTORY} AND {O.IS_VIEW} AND {O.IS_PRODUCTION} AND {O.not_internal(O.VIEW_HISTORY)}",
)
def notification_screen_views(t):
    return reports.notification_screen_views(*t.all, as_of=AS_OF)


@check(
    "retention",
    " SELECT table_name, 'DROP TABLE `' || table_name || '`;' AS statement" + _EXPIRED,
)
def retention_report(t):
    return reports.retention_statements(t.shards, RETENTION_AS_OF)
