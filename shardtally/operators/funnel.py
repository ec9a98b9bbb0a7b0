"""The sign-up funnel: events -> step flags -> sessions -> outcomes -> report rows.

Times are whole seconds since the epoch until a report formats them.  A session's flags
travel as the bits of one number (``steps``): one column to shuffle and to group by
instead of sixteen.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardtally import constants as C
from shardtally.functions.text import contains_ignoring_case
from shardtally.functions.times import DAY_MICROS, event_second, to_micros
from shardtally.operators.flatten import flatten_event_params

ERRORS = (*C.PHONE_ERRORS, *C.BIOMETRIC_ERRORS)
STEPS = (*C.PAGES, *ERRORS, C.LOCKOUT_REASON, C.RECOVERED, C.CREATED)
LAST_TIMES = ("last_lockout", "last_recovered", "last_created", "last_wrong_backup_code")
PATH = ("steps", "incorrect_backup_codes", "final_state")


# --- events -------------------------------------------------------------------------------


def funnel_events(events: DataFrame) -> DataFrame:
    """Flattened events of the funnel with ``screen_name`` and ``outcome``."""
    flat = flatten_event_params(
        events.where(F.col("event_name").isin(*C.FUNNEL_EVENTS)),
        integers={"ga_session_id": "ga_session_id", "success": "value"},
        strings={"screen_class": "firebase_screen_class", "reason": "reason"},
    )
    name = F.col("event_name")
    is_screen = name == C.SCREEN_VIEW
    screen = F.coalesce(F.substr("screen_class", F.lit(C.SCREEN_NAME_START)), F.lit(""))
    named = flat.select(
        "user_pseudo_id",
        "event_name",
        "event_timestamp",
        "ga_session_id",
        "success",
        F.when(is_screen, screen).otherwise("").alias("screen_name"),
        F.when(name == C.ACCOUNT_CREATED, C.CREATED)
        .when(name == C.ACCOUNT_RECOVERED, C.RECOVERED)
        .otherwise(F.col("reason"))
        .alias("outcome"),
    )
    on_funnel_screen = contains_ignoring_case(
        F.col("screen_name"), C.FUNNEL_SCREEN_WORD
    ) & ~contains_ignoring_case(F.col("screen_name"), C.NON_FUNNEL_SCREEN_WORD)
    return named.where(~is_screen | on_funnel_screen)


def funnel_step_flags(events: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """0/1 flags of one event, and its time under each kind of event that ends a session.

    ``carry`` names further columns to keep.
    """
    second = F.col("event_second")
    screen, outcome = F.col("screen_name"), F.col("outcome")
    recovery = outcome == C.RECOVERED
    happened = {flag: screen == page for flag, page in C.PAGES.items()}
    happened |= {reason: outcome == reason for reason in (*ERRORS, C.LOCKOUT_REASON)}
    happened[C.RECOVERED] = recovery & (F.col("success") == 1)
    happened[C.CREATED] = outcome == C.CREATED
    wrong_code = recovery & (F.col("success") == 0)
    return events.withColumn("event_second", event_second()).select(
        "user_pseudo_id",
        *carry,
        "ga_session_id",
        "event_second",
        *[_flag(happened[step]).alias(step) for step in STEPS],
        _flag(wrong_code).alias("incorrect_backup_code"),
        F.when(happened[C.LOCKOUT_REASON], second).alias("lockout_second"),
        F.when(happened[C.RECOVERED], second).alias("recovered_second"),
        F.when(happened[C.CREATED], second).alias("created_second"),
        F.when(wrong_code, second).alias("wrong_backup_code_second"),
    )


def compare_windows(
    events: DataFrame, as_of: datetime, days: int = C.FUNNEL_WINDOW_DAYS
) -> DataFrame:
    """Label events: ``recent_data`` is 1 if less than ``days + 1`` times 24 hours have passed."""
    border = to_micros(as_of) - (days + 1) * DAY_MICROS
    return events.withColumn("recent_data", _flag(F.col("event_timestamp") > border))


# --- sessions -----------------------------------------------------------------------------


def session_rollup(flags: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per user and session (and ``by``): steps seen, wrong codes, times, final state."""
    bits = [F.shiftleft(F.col(step), bit) for bit, step in enumerate(STEPS)]
    sessions = flags.groupBy("user_pseudo_id", *by, "ga_session_id").agg(
        F.bit_or(reduce(Column.bitwiseOR, bits)).alias("steps"),
        F.sum("incorrect_backup_code").alias("incorrect_backup_codes"),
        F.min("event_second").alias("first_second"),
        F.max("event_second").alias("last_second"),
        F.max("lockout_second").alias("last_lockout"),
        F.max("recovered_second").alias("last_recovered"),
        F.max("created_second").alias("last_created"),
        F.max("wrong_backup_code_second").alias("last_wrong_backup_code"),
    )
    return sessions.withColumn("final_state", final_state())


def with_outcome(df: DataFrame) -> DataFrame:
    """Sessions or paths with a 0/1 column per step and their outcome."""
    return unpack_steps(df).withColumn("outcome", furthest_step())


def unpack_steps(df: DataFrame) -> DataFrame:
    """Add one 0/1 column per step from the bits of ``steps``."""
    return df.select(
        "*", *[F.getbit("steps", F.lit(bit)).cast("long").alias(s) for bit, s in enumerate(STEPS)]
    )


def final_state() -> Column:
    """How the session ended, from the order of its last lockout, recovery, creation, wrong code.

    An event in the same second as the one it is compared with is not after it.
    """
    ended_well = F.coalesce("last_recovered", "last_created")
    too_many = F.col("incorrect_backup_codes") > C.WRONG_CODES_ALLOWED
    label = C.OUTCOME_COLUMNS
    return (
        F.when(too_many & (F.col("last_wrong_backup_code") > ended_well), label["locked_new"])
        .when(F.col("last_lockout") > ended_well, label["locked"])
        .when(F.col("last_recovered").isNotNull(), label["recovered"])
        .when(F.col("last_created").isNotNull(), label["created"])
        .when(F.col("last_lockout").isNotNull(), label["locked"])
        .when(too_many, label["locked_new"])
        .otherwise(C.NOT_CONFIGURED)
    )


def furthest_step() -> Column:
    """Outcome of a session: its final state if it has one, else the furthest page it reached."""
    label = C.OUTCOME_COLUMNS
    seen = {step: F.col(step) == 1 for step in STEPS}
    outcome = F.when(F.col("final_state") != C.NOT_CONFIGURED, F.col("final_state"))
    for step in ("photo", "backup_code", "name", "otp"):
        outcome = outcome.when(seen[f"{step}_page"], label[step])
    for step, errors in (("biometric", C.BIOMETRIC_ERRORS), ("phone", C.PHONE_ERRORS)):
        failed = reduce(Column.__or__, [seen[error] for error in errors])
        outcome = outcome.when(seen[f"{step}_page"] & failed, label[f"{step}_error"])
        outcome = outcome.when(seen[f"{step}_page"], label[step])
    return outcome.otherwise("")


# --- outcomes -----------------------------------------------------------------------------


def outcome_users(sessions: DataFrame) -> DataFrame:
    """Sessions counted per outcome and user: a handful of rows for even the busiest user."""
    return sessions.groupBy("outcome", "user_pseudo_id").agg(
        F.count("ga_session_id").alias("sessions"),
        F.min("first_second").alias("first_second"),
        F.max("last_second").alias("last_second"),
    )


def outcome_summary(per_user: DataFrame) -> DataFrame:
    """Per outcome: distinct users, sessions, first and last second."""
    return per_user.groupBy("outcome").agg(
        F.count("user_pseudo_id").alias("users"),
        F.sum("sessions").alias("sessions"),
        F.min("first_second").alias("first_second"),
        F.max("last_second").alias("last_second"),
    )


def pivot_outcomes(summary: DataFrame) -> DataFrame:
    """One wide row with the users of each outcome; also for no input at all."""
    return summary.agg(
        F.min("first_second").alias("first_second"),
        F.max("last_second").alias("last_second"),
        *[
            F.max(F.when(F.col("outcome") == outcome, F.col("users"))).alias(column)
            for column, outcome in C.OUTCOME_COLUMNS.items()
        ],
    )


# --- paths --------------------------------------------------------------------------------


def path_users(sessions: DataFrame) -> DataFrame:
    """Sessions counted per path, window and user."""
    return sessions.groupBy(*PATH, "recent_data", "user_pseudo_id").agg(
        F.count("*").alias("rows"),
        F.count("ga_session_id").alias("sessions"),
        F.min("first_second").alias("first_second"),
        F.max("last_second").alias("last_second"),
        *[F.max(name).alias(name) for name in LAST_TIMES],
    )


def path_rollup(per_user: DataFrame) -> DataFrame:
    """One row per path: users and sessions of each window, ``outcome``, ``had_errors``.

    The four last times are given only for a path that a single session took.
    """
    is_user = F.col("user_pseudo_id").isNotNull()
    older, recent = F.col("recent_data") == 0, F.col("recent_data") == 1
    sessions = F.col("sessions")
    user_rows = F.sum(F.when(is_user, F.col("rows")).otherwise(0))
    paths = per_user.groupBy(*PATH).agg(
        F.min("first_second").alias("first_second"),
        F.max("last_second").alias("last_second"),
        F.count_if(older & is_user).alias("old_users"),
        F.count_if(recent & is_user).alias("recent_users"),
        F.sum(F.when(older, sessions).otherwise(0)).alias("old_sessions"),
        F.sum(F.when(recent, sessions).otherwise(0)).alias("recent_sessions"),
        *[single_user_value(user_rows, F.max(name)).alias(name) for name in LAST_TIMES],
    )
    return with_outcome(paths).withColumn("had_errors", _flag(F.greatest(*ERRORS) > 0))


def single_user_value(rows: Column, value: Column) -> Column:
    """``value`` if the group holds exactly one row, else NULL."""
    return F.when(rows == 1, value)


def outcome_totals(paths: DataFrame) -> DataFrame:
    """Paths added up per outcome (a user with two paths counts twice)."""
    counts = ("old_users", "recent_users", "old_sessions", "recent_sessions")
    return paths.groupBy("outcome").agg(
        *[F.sum(name).alias(name) for name in counts],
        F.min("first_second").alias("first_second"),
        F.max("last_second").alias("last_second"),
    )


def _flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
