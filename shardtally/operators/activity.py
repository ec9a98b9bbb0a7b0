"""Monthly and daily activity of users.

Each operator first counts per user, then drops the excluded users, then totals.  A user
with a third of all events is a few rows by the time rows are joined.

``strict`` makes an event that holds a looked-up key more than once an error; without it the
first entry counts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardtally import constants as C
from shardtally.functions.keyvalue import evaluate_once, param, prop
from shardtally.functions.numbers import percentage, ratio
from shardtally.functions.times import event_date, event_month, month_text
from shardtally.operators.audience import USER, exclude_users
from shardtally.operators.daily import named_like

MONTH = "event_month"


def notification_clicks(
    events: DataFrame, strict: bool = False, names: DataFrame | None = None
) -> DataFrame:
    """Clicks on push notifications, with their ``action`` (``names``: see ``daily.named_like``)."""
    named = named_like(events, C.NOTIFICATION_PATTERN, names)
    known = evaluate_once(
        named,
        __event_type=param("event_params", "event_type", strict=strict),
        __screen=param("event_params", "firebase_screen_class", strict=strict),
        action=param("event_params", "action", strict=strict),
    )
    is_click = (F.col("__event_type") == C.CLICK_EVENT_TYPE) & (
        F.col("__screen") == C.NOTIFICATION_SCREEN
    )
    return known.where(is_click).drop("__event_type", "__screen")


def notification_screen_views(
    events: DataFrame, strict: bool = False, names: DataFrame | None = None
) -> DataFrame:
    """Views of the notification screen (``names``: see ``daily.named_like``)."""
    named = named_like(events, C.SCREEN_VIEW_PATTERN, names)
    screen = param("event_params", "firebase_screen_class", strict=strict)
    return named.where(screen == C.NOTIFICATION_SCREEN)


def monthly_distinct_users(
    events: DataFrame,
    excluded: DataFrame | None = None,
    key: str = "user_cid",
    strict: bool = False,
) -> DataFrame:
    """Distinct values of a user property per month (``yyyy-MM``)."""
    connect_id = prop(key, strict).alias("connect_id")
    ids = events.select(USER, month_text().alias(MONTH), connect_id).distinct()
    return (
        exclude_users(ids, excluded)
        .groupBy(MONTH)
        .agg(F.count_distinct("connect_id").alias("overall_distinct_connect_users"))
    )


def monthly_message_stats(events: DataFrame, excluded: DataFrame | None = None) -> DataFrame:
    """Named users, messages, and messages per named user, per month."""
    per_user = (
        events.select(USER, "user_id", month_text().alias(MONTH))
        .groupBy(USER, "user_id", MONTH)
        .agg(F.count("*").alias("messages"))
    )
    totals = exclude_users(per_user, excluded).groupBy(MONTH).agg(
        F.count_distinct("user_id").alias("messaging_distinct_users"),
        F.sum("messages").alias("total_messages"),
    )
    average = ratio(F.col("total_messages"), F.col("messaging_distinct_users"))
    return totals.withColumn("avg_messages_per_user", average)


def monthly_action_share(
    clicks: DataFrame, excluded: DataFrame | None = None, action: str = C.MESSAGE_ACTION
) -> DataFrame:
    """Clicks per month, and how many of them (also in percent) had the given action."""
    per_user = (
        clicks.select(USER, month_text().alias(MONTH), "action")
        .groupBy(USER, MONTH)
        .agg(F.count("*").alias("clicks"), F.count_if(F.col("action") == action).alias("hits"))
    )
    totals = exclude_users(per_user, excluded).groupBy(MONTH).agg(
        F.sum("clicks").alias("total_notifications"), F.sum("hits").alias("ccc_message_count")
    )
    share = percentage(F.col("ccc_message_count"), F.col("total_notifications"))
    return totals.withColumn("ccc_message_percentage", share)


def monthly_action_pivot(
    clicks: DataFrame,
    excluded: DataFrame | None = None,
    actions: Mapping[str, str] = C.CLICK_ACTIONS,
) -> DataFrame:
    """Clicks per month (first day, a date), one column per action."""
    per_user = (
        clicks.select(USER, event_month().alias(MONTH), "action")
        .groupBy(USER, MONTH)
        .agg(*[F.count_if(F.col("action") == v).alias(name) for name, v in actions.items()])
    )
    return (
        exclude_users(per_user, excluded)
        .groupBy(MONTH)
        .agg(*[F.sum(name).alias(name) for name in actions])
    )


def active_users(events: DataFrame, excluded: DataFrame | None = None) -> DataFrame:
    """Distinct pseudo and named users per day (``DAU``) and per calendar month (``MAU``).

    One pass: each distinct (day, user, name) counts for its day and for its month.
    """
    days = events.select(event_date().alias("day"), USER, "user_id").distinct()
    periods = F.explode(
        F.array(
            F.struct(F.lit("DAU").alias("metric_type"), F.col("day").alias("period")),
            F.struct(F.lit("MAU").alias("metric_type"), F.trunc("day", "MM").alias("period")),
        )
    )
    return (
        exclude_users(days, excluded)
        .select(periods.alias("p"), USER, "user_id")
        .groupBy(F.col("p.period").alias("period"), F.col("p.metric_type").alias("metric_type"))
        .agg(
            F.count_distinct(USER).alias("distinct_users"),
            F.count_distinct("user_id").alias("distinct_named_users"),
        )
    )


def monthly_messaging(
    events: DataFrame, excluded: DataFrame | None = None, strict: bool = False
) -> DataFrame:
    """API users, messages and message clicks per month, in one pass over the events.

    Equal to ``monthly_distinct_users`` left-joined with ``monthly_message_stats`` and
    ``monthly_action_share``: only months with API events appear, and a month without
    messages (or clicks) has NULL there, not zero.
    """
    name = F.col("event_name")
    is_api, is_message = name.isin(*C.API_EVENTS), name == C.MESSAGE_SENT
    kind = F.when(is_api, "api").when(is_message, "message").otherwise("click")
    wanted = events.where(is_api | is_message | name.like(C.NOTIFICATION_PATTERN))

    def click_param(key: str) -> Column:
        return F.when(kind == "click", param("event_params", key, strict=strict))

    known = evaluate_once(
        wanted,
        kind=kind,
        connect_id=F.when(is_api, prop("user_cid", strict)),
        sender_id=F.when(is_message, F.col("user_id")),
        event_type=click_param("event_type"),
        screen=click_param("firebase_screen_class"),
        action=click_param("action"),
    )
    is_kind = F.col("kind")
    is_click = (F.col("event_type") == C.CLICK_EVENT_TYPE) & (
        F.col("screen") == C.NOTIFICATION_SCREEN
    )
    per_user = (
        known.where((is_kind != "click") | is_click)
        .withColumn(MONTH, month_text())
        .groupBy(USER, MONTH, "connect_id", "sender_id")
        .agg(
            F.count_if(is_kind == "api").alias("api_calls"),
            F.count_if(is_kind == "message").alias("messages"),
            F.count_if(is_kind == "click").alias("clicks"),
            F.count_if((is_kind == "click") & (F.col("action") == C.MESSAGE_ACTION)).alias(
                "message_clicks"
            ),
        )
    )
    totals = (
        exclude_users(per_user, excluded)
        .groupBy(MONTH)
        .agg(
            F.count_distinct("connect_id").alias("connect_users"),
            F.count_distinct("sender_id").alias("senders"),
            *[F.sum(c).alias(c) for c in ("api_calls", "messages", "clicks", "message_clicks")],
        )
        .where(F.col("api_calls") > 0)
    )
    messages, clicks = F.col("messages"), F.col("clicks")
    return totals.select(
        MONTH,
        F.col("connect_users").alias("overall_distinct_connect_users"),
        F.when(messages > 0, F.col("senders")).alias("messaging_distinct_users"),
        F.when(messages > 0, messages).alias("total_messages"),
        ratio(messages, F.col("senders")).alias("avg_messages_per_user"),
        F.when(clicks > 0, F.col("message_clicks")).alias("ccc_message_count"),
        F.when(clicks > 0, clicks).alias("total_notifications"),
        percentage(F.col("message_clicks"), clicks).alias("ccc_message_percentage"),
    )
