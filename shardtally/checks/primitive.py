"""Checked queries of single constructs, each over the whole event table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardtally import constants as C
from shardtally.checks import fixtures
from shardtally.checks import oracle as O
from shardtally.checks.fixtures import AS_OF, MID_MONTH, RETENTION_AS_OF
from shardtally.checks.registry import Tables, check
from shardtally.functions import times, windows
from shardtally.functions.keyvalue import evaluate_once, param, prop
from shardtally.functions.numbers import percentage, ratio
from shardtally.functions.text import contains_ignoring_case, extract
from shardtally.operators import audience, flatten, retention
from shardtally.sources.events import in_window

ID = "event_id"
DUCK_TIME = "make_timestamp(event_timestamp)"
DUCK_DAY = "CAST(make_timestamp(event_timestamp) AS DATE)"


def _lookup(name: str):
    """The attribute ``name`` as a column."""
    return {
        "device_id": prop("device_id"),
        "domain": prop("cchq_domain"),
        "server": prop("server"),
        "flavor": prop("app_flavor"),
        "cid": prop("user_cid"),
        "screen": param("event_params", "firebase_screen_class"),
        "reason": param("event_params", "reason"),
        "action": param("event_params", "action"),
        "success": param("event_params", "value", "int"),
        "session": param("event_params", "ga_session_id", "int"),
    }[name]


def _attributes(t: Tables, *names: str) -> DataFrame:
    """Events with the named attributes as columns (only those: unused ones would still be evaluated)."""
    return evaluate_once(t.events, **{name: _lookup(name) for name in names}) if names else t.events


ATTRIBUTES = f""",
attr AS (
  SELECT *, {O.p('device_id')} AS device_id, {O.p('cchq_domain')} AS domain, {O.p('server')} AS server,
    {O.p('app_flavor')} AS flavor, {O.p('user_cid')} AS cid, {O.e('firebase_screen_class')} AS screen,
    {O.e('reason')} AS reason, {O.e('action')} AS action, {O.e('value', 'int_value')} AS success,
    {O.e('ga_session_id', 'int_value')} AS session
  FROM ev
)"""


def _monthly(t: Tables, *names: str) -> DataFrame:
    return _attributes(t, *names).withColumn("month", times.event_month())


MONTHLY = ATTRIBUTES + f""",
monthly AS (SELECT *, {O.MONTH_DATE} AS month FROM attr)"""


# --- scans --------------------------------------------------------------------------------


@check("scan_wildcard", " SELECT shard, event_id, event_name, event_timestamp, user_id FROM ev")
def scan_wildcard(t):
    return t.events.select("shard", ID, "event_name", "event_timestamp", "user_id")


@check(
    "shard_between_string",
    " SELECT shard, event_id FROM ev WHERE shard BETWEEN '20240201' AND '20240415'",
)
def shard_between_string(t):
    lo, hi = windows.history_to_date(MID_MONTH, months=2).shards
    return t.events.where(F.col("shard").between(lo, hi)).select("shard", ID)


@check(
    "shard_between_date",
    """ SELECT shard, event_id FROM ev
    WHERE CAST(strptime(shard, '%Y%m%d') AS DATE) BETWEEN DATE '2024-03-01' AND DATE '2024-04-30'""",
)
def shard_between_date(t):
    span = windows.history_to_month_end(AS_OF, months=1)
    day = F.to_date(F.col("shard").cast("string"), "yyyyMMdd")
    return t.events.where(day.between(F.lit(span.first), F.lit(span.last))).select("shard", ID)


@check("shard_two_ranges", f" SELECT shard, event_id FROM ev WHERE {O.TWO_WINDOWS}")
def shard_two_ranges(t):
    return in_window(t.events, windows.two_trailing_windows(AS_OF)).select("shard", ID)


@check("scan_dimension", " SELECT device_id, phone_number FROM sessions")
def scan_dimension(t):
    return t.sessions


@check("scan_catalogue", " SELECT table_name FROM shards")
def scan_catalogue(t):
    return t.shards


@check(
    "unnest_left",
    """ SELECT event_id, kv.key AS key, kv.value.string_value AS string_value, kv.value.int_value AS int_value
    FROM (SELECT event_id, unnest(CASE WHEN len(event_params) = 0 THEN [NULL] ELSE event_params END) AS kv
          FROM ev)""",
)
def unnest_left(t):
    rows = t.events.select(ID, F.explode_outer("event_params").alias("kv"))
    return rows.select(ID, "kv.key", "kv.value.string_value", "kv.value.int_value")


@check(
    "drop_table",
    f""" SELECT 'DROP TABLE `' || table_name || '`;' AS statement FROM shards
    WHERE regexp_matches(table_name, '{C.SHARD_TABLE_PATTERN}')
      AND right(table_name, 8) < '20240304'""",
)
def drop_table(t):
    expired = retention.expired_shards(t.shards, RETENTION_AS_OF)
    return expired.select(F.format_string("DROP TABLE `%s`;", "table_name").alias("statement"))


# --- projections and predicates -----------------------------------------------------------


@check(
    "project_alias",
    " SELECT event_id AS id, event_name AS name, 'DAU' AS metric_type FROM ev",
)
def project_alias(t):
    return t.events.select(
        F.col(ID).alias("id"), F.col("event_name").alias("name"), F.lit("DAU").alias("metric_type")
    )


@check(
    "nested_field",
    """ SELECT event_id, device.category, device.time_zone_offset_seconds, geo.city, app_info.version
    FROM ev""",
)
def nested_field(t):
    return t.events.select(
        ID, "device.category", "device.time_zone_offset_seconds", "geo.city", "app_info.version"
    )


@check(
    "compare",
    ATTRIBUTES
    + f""" SELECT event_id FROM attr
    WHERE event_name = '{C.ACCOUNT_RECOVERED}' AND success > 0 AND session < 100000
      AND user_pseudo_id > 'p2'""",
)
def compare(t):
    return (
        _attributes(t, "success", "session")
        .where(F.col("event_name") == C.ACCOUNT_RECOVERED)
        .where((F.col("success") > 0) & (F.col("session") < 100_000))
        .where(F.col("user_pseudo_id") > "p2")
        .select(ID)
    )


@check(
    "between",
    f" SELECT event_id FROM ev WHERE {DUCK_DAY} BETWEEN DATE '2024-02-01' AND DATE '2024-02-29'",
)
def between(t):
    day = times.event_date()
    return t.events.where(day.between("2024-02-01", "2024-02-29")).select(ID)


@check(
    "in_list",
    """ SELECT event_id, event_name FROM ev WHERE event_name IN
    ('ccc_api_jobs', 'ccc_api_delivery_progress', 'ccc_api_learn_progress')""",
)
def in_list(t):
    return t.events.where(F.col("event_name").isin(*C.API_EVENTS)).select(ID, "event_name")


@check(
    "not_in_subquery",
    " SELECT event_id FROM ev WHERE user_pseudo_id NOT IN (SELECT user_pseudo_id FROM demo_seen)",
)
def not_in_subquery(t):
    demo = t.events.where(prop(C.DEMO_USER_KEY) == "true").select("user_pseudo_id")
    return audience.exclude_users(t.events.select(ID, "user_pseudo_id"), demo).select(ID)


@check(
    "like",
    " SELECT event_id, event_name FROM ev WHERE event_name LIKE '%ccc_notification_type%'",
)
def like(t):
    return t.events.where(F.col("event_name").like(C.NOTIFICATION_PATTERN)).select(
        ID, "event_name"
    )


@check(
    "not_like",
    ATTRIBUTES
    + f""" SELECT event_id, domain FROM attr
    WHERE NOT (domain LIKE '{C.NON_PRODUCTION_DOMAINS[0]}' OR domain LIKE '{C.NON_PRODUCTION_DOMAINS[1]}')""",
)
def not_like(t):
    rows = _attributes(t, "domain")
    for pattern in C.NON_PRODUCTION_DOMAINS:
        rows = rows.where(~F.col("domain").like(pattern))
    return rows.select(ID, "domain")


@check(
    "contains_ci",
    ATTRIBUTES
    + f""" SELECT event_id, screen FROM attr
    WHERE screen ILIKE '%{C.FUNNEL_SCREEN_WORD.upper()}%'
      AND screen NOT ILIKE '%{C.NON_FUNNEL_SCREEN_WORD.upper()}%'""",
)
def contains_ci(t):
    screen = F.col("screen")
    return (
        _attributes(t, "screen")
        .where(contains_ignoring_case(screen, C.FUNNEL_SCREEN_WORD))
        .where(~contains_ignoring_case(screen, C.NON_FUNNEL_SCREEN_WORD))
        .select(ID, "screen")
    )


@check(
    "is_null",
    ATTRIBUTES + " SELECT event_id FROM attr WHERE user_id IS NULL AND cid IS NOT NULL",
)
def is_null(t):
    return _attributes(t, "cid").where(F.col("user_id").isNull() & F.col("cid").isNotNull()).select(ID)


@check(
    "and_or_not",
    ATTRIBUTES
    + f""" SELECT event_id FROM attr
    WHERE (success = 1 OR reason = 'play_services_2' OR action = '') AND NOT domain = '{fixtures.QA_DOMAIN}'""",
)
def and_or_not(t):
    any_of = (
        (F.col("success") == 1) | (F.col("reason") == C.PHONE_ERRORS[1]) | (F.col("action") == "")
    )
    return _attributes(t, "domain", "reason", "action", "success").where(any_of & ~(F.col("domain") == fixtures.QA_DOMAIN)).select(ID)


@check(
    "scalar_subquery_filter",
    f""" SELECT event_id FROM ev
    WHERE EXISTS (SELECT 1 FROM (SELECT unnest(user_properties) AS kv) WHERE kv.key = 'app_flavor'
                  AND kv.value.string_value = '{C.PRODUCTION_FLAVOR}')""",
)
def scalar_subquery_filter(t):
    return t.events.where(audience.has_flavor()).select(ID)


@check(
    "case_when",
    ATTRIBUTES
    + """ SELECT event_id, CASE WHEN success = 1 THEN 'ok' WHEN success = 0 THEN 'wrong' END AS label,
    CASE WHEN reason LIKE 'min%' THEN 'biometric' WHEN reason LIKE 'play%' THEN 'phone' ELSE '' END AS area
    FROM attr""",
)
def case_when(t):
    success, reason = F.col("success"), F.col("reason")
    return _attributes(t, "reason", "success").select(
        ID,
        F.when(success == 1, "ok").when(success == 0, "wrong").alias("label"),
        F.when(reason.startswith("min"), "biometric")
        .when(reason.startswith("play"), "phone")
        .otherwise("")
        .alias("area"),
    )


@check(
    "if_expr",
    ATTRIBUTES + " SELECT event_id, if(success = 1, session, NULL) AS session_if, if(action = 'ccc_message', action, '') AS action_if FROM attr",
)
def if_expr(t):
    return _attributes(t, "action", "success", "session").select(
        ID,
        F.when(F.col("success") == 1, F.col("session")).alias("session_if"),
        F.when(F.col("action") == C.MESSAGE_ACTION, F.col("action"))
        .otherwise("")
        .alias("action_if"),
    )


@check(
    "coalesce",
    ATTRIBUTES + " SELECT event_id, ifnull(substr(screen, 35), '') AS screen_name FROM attr",
)
def coalesce(t):
    cut = F.substr("screen", F.lit(C.SCREEN_NAME_START))
    return _attributes(t, "screen").select(ID, F.coalesce(cut, F.lit("")).alias("screen_name"))


# --- joins --------------------------------------------------------------------------------


@check(
    "join_inner_expr_key",
    " SELECT device_id, phone FROM sessions, phones WHERE ltrim(phone_number, '+') = phone",
)
def join_inner_expr_key(t):
    dialled = F.ltrim(t.sessions["phone_number"], F.lit("+"))
    return t.sessions.join(t.phones, dialled == t.phones["phone"]).select("device_id", "phone")


@check(
    "join_inner_subquery",
    f""" SELECT DISTINCT user_pseudo_id, i.device_id FROM ev JOIN (
      SELECT DISTINCT device_id FROM sessions JOIN phones ON ltrim(phone_number, '+') = phone) AS i
    ON i.device_id = '{C.DEVICE_PREFIX}' || {O.p('device_id')}""",
)
def join_inner_subquery(t):
    pairs = evaluate_once(t.events, device_id=audience.device_key())
    pairs = pairs.select("user_pseudo_id", "device_id").distinct()
    devices = audience.internal_devices(t.sessions, t.phones)
    return pairs.join(devices, "device_id").select("user_pseudo_id", "device_id")


@check(
    "join_left_chain",
    f""", m AS (SELECT {O.MONTH_TEXT} AS event_month, * FROM ev)
    SELECT a.event_month, a.views, b.messages, c.failures
    FROM (SELECT event_month, count(*) AS views FROM m WHERE event_name = 'screen_view' GROUP BY 1) a
    LEFT JOIN (SELECT event_month, count(*) AS messages FROM m
               WHERE event_name = 'personal_id_message_sent' GROUP BY 1) b
      ON b.event_month = a.event_month
    LEFT JOIN (SELECT event_month, count(*) AS failures FROM m
               WHERE event_name = 'personal_id_configuration_failure' GROUP BY 1) c
      ON c.event_month = a.event_month""",
)
def join_left_chain(t):
    named = t.events.withColumn("event_month", times.month_text())

    def monthly(events: DataFrame, name: str, label: str) -> DataFrame:
        matching = events.where(F.col("event_name") == name)
        return matching.groupBy("event_month").agg(F.count("*").alias(label))

    views = monthly(named, C.SCREEN_VIEW, "views")
    messages = monthly(named, C.MESSAGE_SENT, "messages")
    failures = monthly(named, C.CONFIGURATION_FAILURE, "failures")
    return views.join(messages, "event_month", "left").join(failures, "event_month", "left")


@check(
    "join_lateral_unnest",
    """ SELECT event_id, kv.key AS key FROM ev LEFT JOIN LATERAL (SELECT unnest(ev.user_properties) AS kv) ON true""",
)
def join_lateral_unnest(t):
    return t.events.select(ID, F.explode_outer("user_properties").alias("kv")).select(
        ID, "kv.key"
    )


@check(
    "anti_join_null_aware",
    """ , callers AS (SELECT user_id FROM ev WHERE event_name = 'ccc_api_jobs')
    SELECT event_id, user_id, 'known' AS ids FROM ev
    WHERE user_id NOT IN (SELECT user_id FROM callers WHERE user_id IS NOT NULL)
    UNION ALL SELECT event_id, user_id, 'with NULL' FROM ev WHERE user_id NOT IN (SELECT user_id FROM callers)
    UNION ALL SELECT event_id, user_id, 'none' FROM ev WHERE user_id NOT IN (SELECT user_id FROM callers WHERE false)""",
)
def anti_join_null_aware(t):
    """The ids without their NULLs, with them (no row stays), and no ids (all rows stay)."""
    callers = t.events.where(F.col("event_name") == C.API_EVENTS[0]).select("user_id")
    rows = t.events.select(ID, "user_id")
    lists = {"known": callers.where("user_id IS NOT NULL"), "with NULL": callers, "none": callers.where("false")}
    parts = [audience.exclude_users(rows, ids, "user_id").withColumn("ids", F.lit(name)) for name, ids in lists.items()]
    return parts[0].union(parts[1]).union(parts[2])


# --- aggregations -------------------------------------------------------------------------


@check(
    "agg_group_by",
    """ SELECT shard, event_name, count(*) AS n FROM ev GROUP BY shard, event_name""",
)
def agg_group_by(t):
    return t.events.groupBy("shard", "event_name").agg(F.count("*").alias("n"))


@check(
    "agg_group_by_alias",
    f" SELECT {O.MONTH_TEXT} AS event_month, count(*) AS n FROM ev GROUP BY event_month",
)
def agg_group_by_alias(t):
    rows = t.events.withColumn("event_month", times.month_text())
    return rows.groupBy("event_month").agg(F.count("*").alias("n"))


@check(
    "agg_global",
    " SELECT min(event_timestamp) AS first_event, max(event_timestamp) AS last_event, count(*) AS n FROM ev",
)
def agg_global(t):
    return t.events.agg(
        F.min("event_timestamp").alias("first_event"),
        F.max("event_timestamp").alias("last_event"),
        F.count("*").alias("n"),
    )


@check("agg_count_star", MONTHLY + " SELECT month, count(*) AS n FROM monthly GROUP BY month")
def agg_count_star(t):
    return _monthly(t).groupBy("month").agg(F.count("*").alias("n"))


@check(
    "agg_count_col",
    MONTHLY + " SELECT month, count(cid) AS cids, count(user_id) AS named FROM monthly GROUP BY month",
)
def agg_count_col(t):
    return (
        _monthly(t, "cid").groupBy("month").agg(F.count("cid").alias("cids"), F.count("user_id").alias("named"))
    )


@check(
    "agg_count_distinct",
    MONTHLY
    + " SELECT month, count(DISTINCT user_pseudo_id) AS users, count(DISTINCT user_id) AS named FROM monthly GROUP BY month",
)
def agg_count_distinct(t):
    return (
        _monthly(t)
        .groupBy("month")
        .agg(
            F.count_distinct("user_pseudo_id").alias("users"),
            F.count_distinct("user_id").alias("named"),
        )
    )


@check(
    "agg_countif",
    MONTHLY
    + """ SELECT month, count(CASE WHEN action = 'ccc_message' THEN 1 END) AS messages,
    count(CASE WHEN action = '' THEN 1 END) AS empty FROM monthly GROUP BY month""",
)
def agg_countif(t):
    action = F.col("action")
    return (
        _monthly(t, "action")
        .groupBy("month")
        .agg(
            F.count_if(action == C.MESSAGE_ACTION).alias("messages"),
            F.count_if(action == "").alias("empty"),
        )
    )


@check(
    "agg_sum",
    MONTHLY
    + " SELECT month, CAST(sum(success) AS BIGINT) AS recovered, CAST(sum(device.time_zone_offset_seconds) AS BIGINT) AS offsets FROM monthly GROUP BY month",
)
def agg_sum(t):
    return (
        _monthly(t, "success")
        .groupBy("month")
        .agg(
            F.sum("success").alias("recovered"),
            F.sum("device.time_zone_offset_seconds").alias("offsets"),
        )
    )


@check(
    "agg_min_max",
    MONTHLY
    + """ SELECT month, min(reason) AS first_reason, max(reason) AS last_reason,
    min(session) AS least, max(session) AS most FROM monthly GROUP BY month""",
)
def agg_min_max(t):
    return (
        _monthly(t, "reason", "session")
        .groupBy("month")
        .agg(
            F.min("reason").alias("first_reason"),
            F.max("reason").alias("last_reason"),
            F.min("session").alias("least"),
            F.max("session").alias("most"),
        )
    )


@check(
    "agg_max_if",
    f""", starting AS (SELECT * FROM ev), {O.FLAT.strip()}
    SELECT user_pseudo_id, event_name, event_timestamp, ga_session_number, reason FROM flat""",
)
def agg_max_if(t):
    return flatten.flatten_event_params(
        t.events, integers={"ga_session_number": "ga_session_number"}, strings={"reason": "reason"}
    )


@check(
    "agg_pivot_case",
    """ SELECT shard, max(CASE event_name WHEN 'screen_view' THEN n END) AS views,
      max(CASE event_name WHEN 'personal_id_message_sent' THEN n END) AS messages
    FROM (SELECT shard, event_name, count(*) AS n FROM ev GROUP BY shard, event_name) GROUP BY shard""",
)
def agg_pivot_case(t):
    counts = t.events.groupBy("shard", "event_name").agg(F.count("*").alias("n"))
    name = F.col("event_name")
    return counts.groupBy("shard").agg(
        F.max(F.when(name == C.SCREEN_VIEW, F.col("n"))).alias("views"),
        F.max(F.when(name == C.MESSAGE_SENT, F.col("n"))).alias("messages"),
    )


@check(
    "agg_expr_over_aggs",
    ATTRIBUTES
    + """ SELECT user_pseudo_id, CASE WHEN sum(success) > 5 THEN 'often' WHEN max(success) > min(success)
      THEN 'mixed' WHEN max(success) IS NULL THEN 'never' ELSE 'rare' END AS label
    FROM attr GROUP BY user_pseudo_id""",
)
def agg_expr_over_aggs(t):
    success = F.col("success")
    label = (
        F.when(F.sum(success) > 5, "often")
        .when(F.max(success) > F.min(success), "mixed")
        .when(F.max(success).isNull(), "never")
        .otherwise("rare")
    )
    return _attributes(t, "success").groupBy("user_pseudo_id").agg(label.alias("label"))


@check(
    "agg_expr_of_keys",
    ATTRIBUTES
    + """ SELECT flavor, success, CASE WHEN success > 0 THEN 1::BIGINT ELSE 0::BIGINT END AS ok, count(*) AS n
    FROM attr GROUP BY flavor, success""",
)
def agg_expr_of_keys(t):
    counts = _attributes(t, "flavor", "success").groupBy("flavor", "success").agg(F.count("*").alias("n"))
    return counts.withColumn("ok", F.when(F.col("success") > 0, 1).otherwise(0).cast("long"))


@check("distinct", ATTRIBUTES + " SELECT DISTINCT user_pseudo_id, device_id FROM attr")
def distinct(t):
    return _attributes(t, "device_id").select("user_pseudo_id", "device_id").distinct()


# --- sort and union -----------------------------------------------------------------------


@check(
    "order_by",
    f""" SELECT {O.DAY_DATE} AS period, event_name, count(*) AS n FROM ev
    GROUP BY ALL ORDER BY period, event_name""",
)
def order_by(t):
    counts = t.events.groupBy(times.event_date().alias("period"), "event_name")
    return counts.agg(F.count("*").alias("n")).orderBy("period", "event_name")


@check(
    "union_all",
    f""" SELECT {O.DAY_DATE} AS period, 'DAU' AS metric_type, count(DISTINCT user_pseudo_id) AS users
    FROM ev GROUP BY 1
    UNION ALL SELECT {O.MONTH_DATE}, 'MAU', count(DISTINCT user_pseudo_id) FROM ev GROUP BY 1
    ORDER BY 1, 2""",
)
def union_all(t):
    def active(period, label):
        users = t.events.groupBy(period.alias("period"))
        return users.agg(F.count_distinct("user_pseudo_id").alias("users")).select(
            "period", F.lit(label).alias("metric_type"), "users"
        )

    daily, monthly = active(times.event_date(), "DAU"), active(times.event_month(), "MAU")
    return daily.unionByName(monthly).orderBy("period", "metric_type")


# --- text ---------------------------------------------------------------------------------


@check(
    "str_ltrim_chars",
    " SELECT device_id, regexp_replace(phone_number, '^[+]*', '') AS phone FROM sessions",
)
def str_ltrim_chars(t):
    return t.sessions.select("device_id", F.ltrim("phone_number", F.lit("+")).alias("phone"))


@check(
    "str_concat",
    ATTRIBUTES
    + f" SELECT event_id, '{C.DEVICE_PREFIX}' || device_id AS device_key, 'cid:' || cid AS cid_key FROM attr",
)
def str_concat(t):
    return _attributes(t, "device_id", "cid").select(
        ID,
        F.concat(F.lit(C.DEVICE_PREFIX), "device_id").alias("device_key"),
        F.concat(F.lit("cid:"), "cid").alias("cid_key"),
    )


@check(
    "str_substr_from",
    ATTRIBUTES + " SELECT event_id, screen[35:] AS screen_name FROM attr",
)
def str_substr_from(t):
    cut = F.substr("screen", F.lit(C.SCREEN_NAME_START))
    return _attributes(t, "screen").select(ID, cut.alias("screen_name"))


@check(
    "str_contains_ci",
    ATTRIBUTES
    + f" SELECT event_id, contains(lower(screen), '{C.FUNNEL_SCREEN_WORD.lower()}') AS in_funnel FROM attr",
)
def str_contains_ci(t):
    found = contains_ignoring_case(F.col("screen"), C.FUNNEL_SCREEN_WORD)
    return _attributes(t, "screen").select(ID, found.alias("in_funnel"))


@check(
    "str_like",
    ATTRIBUTES
    + f""" SELECT event_id, domain LIKE '{C.NON_PRODUCTION_DOMAINS[0]}' AS is_qa,
    server LIKE 'staging%' AS is_staging FROM attr""",
)
def str_like(t):
    return _attributes(t, "domain", "server").select(
        ID,
        F.col("domain").like(C.NON_PRODUCTION_DOMAINS[0]).alias("is_qa"),
        F.col("server").like("staging%").alias("is_staging"),
    )


@check(
    "str_regexp_match",
    f" SELECT table_name, regexp_matches(table_name, '{C.SHARD_TABLE_PATTERN}') AS is_shard FROM shards",
)
def str_regexp_match(t):
    is_shard = F.col("table_name").rlike(C.SHARD_TABLE_PATTERN)
    return t.shards.select("table_name", is_shard.alias("is_shard"))


@check(
    "str_regexp_extract",
    " SELECT table_name, nullif(regexp_extract(table_name, '[0-9]{8}'), '') AS day FROM shards",
)
def str_regexp_extract(t):
    return t.shards.select(
        "table_name", extract(F.col("table_name"), C.SHARD_DAY_PATTERN).alias("day")
    )


@check(
    "str_format",
    " SELECT printf('%s of %s', event_name, user_pseudo_id) AS label FROM ev WHERE user_pseudo_id IS NOT NULL",
)
def str_format(t):
    return t.events.where("user_pseudo_id IS NOT NULL").select(F.format_string("%s of %s", "event_name", "user_pseudo_id").alias("label"))


@check("str_cast", " SELECT event_id, CAST(event_timestamp AS VARCHAR) AS micros FROM ev")
def str_cast(t):
    return t.events.select(ID, F.col("event_timestamp").cast("string").alias("micros"))


# --- dates and times ----------------------------------------------------------------------


@check(
    "dt_timestamp_micros",
    f" SELECT event_id, strftime({DUCK_TIME}, '%Y-%m-%d %H:%M:%S.%f') AS event_time FROM ev",
)
def dt_timestamp_micros(t):
    text = F.date_format(F.timestamp_micros("event_timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return t.events.select(ID, text.alias("event_time"))


@check(
    "dt_format_iso",
    f" SELECT event_id, strftime({DUCK_TIME}, '%Y-%m-%dT%H:%M:%SZ') AS event_datetime FROM ev",
)
def dt_format_iso(t):
    return t.events.select(ID, times.iso_text().alias("event_datetime"))


@check("dt_format_month", f" SELECT event_id, {O.MONTH_TEXT} AS event_month FROM ev")
def dt_format_month(t):
    return t.events.select(ID, times.month_text().alias("event_month"))


@check(
    "dt_format_day", f" SELECT event_id, strftime({DUCK_TIME}, '%Y-%m-%d') AS event_date FROM ev"
)
def dt_format_day(t):
    return t.events.select(ID, times.day_text().alias("event_date"))


@check("dt_date_of_ts", f" SELECT event_id, {O.DAY_DATE} AS event_date FROM ev")
def dt_date_of_ts(t):
    return t.events.select(ID, times.event_date().alias("event_date"))


@check("dt_trunc_month", f" SELECT event_id, {O.MONTH_DATE} AS event_month FROM ev")
def dt_trunc_month(t):
    return t.events.select(ID, times.event_month().alias("event_month"))


@check(
    "dt_sub_days",
    f" SELECT event_id, CAST({DUCK_DAY} - INTERVAL (2 * 30) DAY AS DATE) AS earlier FROM ev",
)
def dt_sub_days(t):
    earlier = F.date_sub(times.event_date(), F.lit(2 * C.FUNNEL_WINDOW_DAYS))
    return t.events.select(ID, earlier.alias("earlier"))


@check(
    "dt_sub_months",
    f" SELECT event_id, CAST({DUCK_DAY} - INTERVAL 3 MONTH AS DATE) AS earlier FROM ev",
)
def dt_sub_months(t):
    earlier = F.add_months(times.event_date(), -C.HISTORY_MONTHS)
    return t.events.select(ID, earlier.alias("earlier"))


@check("dt_last_day", f" SELECT event_id, last_day({DUCK_DAY}) AS month_end FROM ev")
def dt_last_day(t):
    return t.events.select(ID, F.last_day(times.event_date()).alias("month_end"))


@check(
    "dt_parse",
    " SELECT event_id, CAST(strptime(shard, '%Y%m%d') AS DATE) AS shard_day FROM ev",
)
def dt_parse(t):
    return t.events.select(ID, F.to_date("shard", "yyyyMMdd").alias("shard_day"))


@check("dt_format_date", f" SELECT event_id, strftime({DUCK_DAY}, '%Y%m%d') AS day FROM ev")
def dt_format_date(t):
    return t.events.select(ID, F.date_format(times.event_date(), "yyyyMMdd").alias("day"))


@check(
    "dt_diff_days",
    """ SELECT event_id, CAST(trunc((epoch_us(TIMESTAMP '2024-04-15 12:00:00') - event_timestamp)
      / 86400000000) AS BIGINT) AS days FROM ev""",
)
def dt_diff_days(t):
    return t.events.select(ID, times.elapsed_days(MID_MONTH).alias("days"))


# --- numbers, arrays, structs -------------------------------------------------------------


@check(
    "math_safe_divide",
    ATTRIBUTES
    + """ SELECT user_pseudo_id, CASE WHEN count(success) <> 0 THEN count(*) / count(success) END AS per_recovery
    FROM attr GROUP BY user_pseudo_id""",
)
def math_safe_divide(t):
    per = F.try_divide(F.count("*"), F.count("success"))
    return _attributes(t, "success").groupBy("user_pseudo_id").agg(per.alias("per_recovery"))


@check(
    "math_round",
    MONTHLY
    + """ SELECT month, round(count(success) / count(*) * 100, 2) AS share,
    round(count(*) / count(DISTINCT user_pseudo_id), 2) AS per_user FROM monthly GROUP BY month""",
)
def math_round(t):
    return (
        _monthly(t, "success")
        .groupBy("month")
        .agg(
            percentage(F.count("success"), F.count("*")).alias("share"),
            ratio(F.count("*"), F.count_distinct("user_pseudo_id")).alias("per_user"),
        )
    )


@check(
    "math_arith",
    ATTRIBUTES + " SELECT event_id, session * 2 + 1 AS twice, session - 30 AS less FROM attr",
)
def math_arith(t):
    session = F.col("session")
    return _attributes(t, "session").select(ID, (session * 2 + 1).alias("twice"), (session - 30).alias("less"))


@check(
    "arr_lookup_key",
    """ SELECT event_id, (SELECT max(kv.value.string_value) FROM (SELECT unnest(user_properties) AS kv)
      WHERE kv.key = 'server') AS server FROM ev""",
)
def arr_lookup_key(t):
    return t.events.select(ID, prop("server", strict=True).alias("server"))


@check(
    "arr_unnest",
    """ SELECT kv.key AS key, count(*) AS n, count(DISTINCT kv.value.string_value) AS texts
    FROM (SELECT unnest(event_params) AS kv FROM ev) GROUP BY kv.key""",
)
def arr_unnest(t):
    entries = t.events.select(F.explode("event_params").alias("kv"))
    return entries.groupBy("kv.key").agg(
        F.count("*").alias("n"), F.count_distinct("kv.value.string_value").alias("texts")
    )


@check(
    "struct_get",
    " SELECT event_id, event_params[1].key AS first_key, event_params[1].value.int_value AS first_int, geo.region AS region FROM ev",
)
def struct_get(t):
    first = F.get("event_params", F.lit(0))
    return t.events.select(
        ID,
        first["key"].alias("first_key"),
        first["value"]["int_value"].alias("first_int"),
        F.col("geo.region").alias("region"),
    )
