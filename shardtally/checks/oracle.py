"""The fixture tables and the funnel as DuckDB text, written apart from the Spark code."""

from __future__ import annotations

from shardtally import constants as C
from shardtally.checks import fixtures

PREFIX34 = "repeat('x', 34)"


def p(key: str, of: str = "user_properties", slot: str = "string_value") -> str:
    """Lookup of one key in a key/value list."""
    return f"list_filter({of}, lambda kv: kv.key = '{key}')[1].value.{slot}"


def e(key: str, slot: str = "string_value") -> str:
    return p(key, "event_params", slot)


def _entry(key: str, string: str = "NULL", integer: str = "NULL") -> str:
    return (
        f"{{'key': '{key}', 'value': {{'string_value': CAST({string} AS VARCHAR), "
        f"'int_value': CAST({integer} AS BIGINT)}}}}"
    )


def _entries(empty: str, *entries: str) -> str:
    return (
        f"list_filter([{', '.join(entries)}], lambda kv: "
        "kv.value.string_value IS NOT NULL OR kv.value.int_value IS NOT NULL)"
        f"[1:CASE WHEN {empty} THEN 0 ELSE {len(entries)} END]"
    )


def _pick(number: str, values: list[str]) -> str:
    """The value at position ``number`` (from 0); NULL past the end."""
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][{number} + 1]"


_PAGES = [*C.PAGES.values(), C.ACTIVITY_SCREEN]
_REASONS = [*C.PHONE_ERRORS, *C.BIOMETRIC_ERRORS, C.LOCKOUT_REASON]
_ACTIONS = list(C.CLICK_ACTIONS.values())

FIXTURES = f"""
raw AS (
  SELECT event_id, event_type AS made, user_id AS uid,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         epoch_us(ts) + (event_id % 4) * 30 * 86400000000 AS event_timestamp,
         unnest(CASE WHEN event_id % 20 = 0 THEN [0, 1] ELSE [0] END) AS copy
  FROM events
),
named AS (
  SELECT *,
    CASE made
      WHEN 'view' THEN 'screen_view'
      WHEN 'error' THEN 'personal_id_configuration_failure'
      WHEN 'signup' THEN CASE WHEN k % 4 = 0 THEN '{C.ACCOUNT_CREATED}' ELSE 'screen_view' END
      WHEN 'purchase' THEN CASE WHEN k % 4 = 3 THEN 'personal_id_message_sent' ELSE '{C.ACCOUNT_RECOVERED}' END
      ELSE CASE k % 3
        WHEN 0 THEN {_pick('event_id % 3', list(C.API_EVENTS))}
        WHEN 1 THEN 'ccc_notification_type'
        ELSE 'screen_view' END
    END AS event_name
  FROM raw
),
ev AS (
  SELECT strftime(make_timestamp(event_timestamp), '%Y%m%d') AS shard,
    event_id + copy * {fixtures.COPIES_FROM} AS event_id, event_name, event_timestamp,
    CASE WHEN event_id % 178 <> 7 THEN 'p' || uid END AS user_pseudo_id,
    CASE WHEN k % 5 <> 0 THEN 'u' || uid END AS user_id,
    {_entries(
      'event_id % 101 = 11',
      _entry('ga_session_id', integer='uid * 1000 + (event_id % 4) * 10 + k % 3'),
      _entry('ga_session_number', integer='event_id % 4 + 1'),
      _entry('firebase_screen_class', f'''CASE
        WHEN event_name = 'ccc_notification_type' OR (made = 'click' AND event_name = 'screen_view') THEN 'PushNotificationActivity'
        WHEN made = 'signup' AND event_name = 'screen_view' THEN {PREFIX34} || '{C.PAGES['phone_page']}'
        WHEN made = 'view' AND copy = 0 THEN {PREFIX34} || CASE WHEN event_id % 7 = 3 THEN upper({_pick('k % 7', _PAGES)}) ELSE {_pick('k % 7', _PAGES)} END END'''),
      _entry('reason', f"CASE WHEN made = 'error' THEN {_pick('(k + copy) % 8', _REASONS)} END"),
      _entry('value', integer=f"CASE WHEN event_name = '{C.ACCOUNT_RECOVERED}' AND copy = 0 THEN CASE WHEN k % 5 <= 1 THEN 1 WHEN k % 10 = 9 THEN 2 ELSE 0 END END"),
      _entry('event_type', "CASE WHEN event_name = 'ccc_notification_type' THEN CASE WHEN k % 11 = 0 THEN 'other' ELSE 'click_notification' END END"),
      _entry('action', f"CASE WHEN event_name = 'ccc_notification_type' THEN {_pick('k % 8', _ACTIONS)} END"),
      _entry('firebase_screen_class', "CASE WHEN event_name = 'screen_view' AND event_id % 53 = 5 THEN 'PushNotificationActivity' END"),
    )} AS event_params,
    {_entries(
      'event_id % 89 = 7',
      _entry('app_flavor', f"CASE WHEN uid % 10 = 9 THEN '{fixtures.OTHER_FLAVOR}' ELSE '{C.PRODUCTION_FLAVOR}' END"),
      _entry('device_id', "'d' || uid"),
      _entry('cchq_domain', f'''CASE WHEN uid % 23 = 5 THEN NULL WHEN uid % 17 = 3 THEN '{fixtures.QA_DOMAIN}'
        WHEN uid % 19 = 4 THEN '{fixtures.TEST_DOMAIN}' ELSE '{fixtures.PRODUCTION_DOMAIN}' END'''),
      _entry('server', f"CASE WHEN uid % 29 = 7 THEN '{C.STAGING_SERVER}' ELSE '{fixtures.PRODUCTION_SERVER}' END"),
      _entry('user_cid', "CASE WHEN k % 4 <> 1 THEN 'c' || uid END"),
      _entry('user_id', "'cc' || uid"),
      _entry('ccc_enabled', "CASE WHEN uid % 2 = 0 THEN 'true' ELSE 'false' END"),
      _entry('is_personal_id_demo_user', "CASE WHEN uid % 13 = 1 AND event_id % 5 = 0 THEN 'true' END"),
    )} AS user_properties,
    {{'category': CASE WHEN uid % 3 = 0 THEN 'tablet' ELSE 'mobile' END,
      'mobile_brand_name': 'brand' || (uid % 4), 'mobile_model_name': 'model' || (uid % 8),
      'mobile_marketing_name': CASE WHEN uid % 4 <> 0 THEN 'mkt' || (uid % 8) END,
      'mobile_os_hardware_model': 'hw' || (uid % 8),
      'operating_system_version': 'Android ' || (9 + uid % 6),
      'language': {_pick('uid % 3', ['fr', 'en', 'hi'])},
      'time_zone_offset_seconds': CAST(uid % 5 * 3600 AS BIGINT)}} AS device,
    {{'city': 'city' || (uid % 12), 'continent': CASE WHEN uid % 2 = 0 THEN 'Africa' ELSE 'Asia' END,
      'region': 'region' || (uid % 6), 'sub_continent': 'sub' || (uid % 4)}} AS geo,
    {{'version': '2.' || (k % 5)}} AS app_info
  FROM named
),
sessions AS (
  SELECT '{C.DEVICE_PREFIX}d' || c_custkey AS device_id,
         CASE WHEN c_custkey % 4 = 0 THEN '++' ELSE '+' END || (1000000 + c_custkey) AS phone_number
  FROM customer
),
phones AS (
  SELECT CAST(1000000 + s_suppkey AS VARCHAR) AS phone FROM supplier WHERE s_suppkey % 10 = 2
),
shards AS (
  SELECT 'events_intraday_' || shard AS table_name FROM ev
  UNION SELECT 'events_' || shard FROM ev
  UNION SELECT 'events_fresh_20240101' UNION SELECT 'users'
),
internal_seen AS (
  SELECT shard, user_pseudo_id FROM ev
  WHERE '{C.DEVICE_PREFIX}' || {p('device_id')} IN (
    SELECT device_id FROM sessions WHERE ltrim(phone_number, '+') IN (SELECT phone FROM phones))
),
demo_seen AS (
  SELECT shard, user_pseudo_id FROM ev WHERE {p('is_personal_id_demo_user')} = 'true'
)"""

IS_FLAVOR = f"{p('app_flavor')} = '{C.PRODUCTION_FLAVOR}'"
IS_PRODUCTION = (
    f"{p('cchq_domain')} NOT LIKE '{C.NON_PRODUCTION_DOMAINS[0]}' "
    f"AND {p('cchq_domain')} NOT LIKE '{C.NON_PRODUCTION_DOMAINS[1]}' "
    f"AND {p('server')} <> '{C.STAGING_SERVER}' AND {IS_FLAVOR}"
)
IS_CLICK = (
    f"event_name LIKE '%ccc_notification_type%' AND {e('event_type')} = 'click_notification' "
    f"AND {e('firebase_screen_class')} = 'PushNotificationActivity'"
)
IS_VIEW = (
    f"event_name LIKE '%screen_view%' AND {e('firebase_screen_class')} = 'PushNotificationActivity'"
)

MARCH = "shard BETWEEN '20240301' AND '20240331'"
TWO_WINDOWS = (
    "(shard BETWEEN '20240331' AND '20240430' OR shard BETWEEN '20240301' AND '20240330')"
)
HISTORY = "shard BETWEEN '20240101' AND '20240430'"
VIEW_HISTORY = "shard BETWEEN '20240301' AND '20240430'"

MONTH_TEXT = "strftime(make_timestamp(event_timestamp), '%Y-%m')"
MONTH_DATE = "CAST(date_trunc('month', make_timestamp(event_timestamp)) AS DATE)"
DAY_DATE = "CAST(make_timestamp(event_timestamp) AS DATE)"


def not_internal(span: str) -> str:
    return f"user_pseudo_id NOT IN (SELECT user_pseudo_id FROM internal_seen WHERE {span})"


def not_demo(span: str) -> str:
    return f"user_pseudo_id NOT IN (SELECT user_pseudo_id FROM demo_seen WHERE {span})"


PATH_FLAGS = [
    *C.PAGES,
    *C.PHONE_ERRORS,
    *C.BIOMETRIC_ERRORS,
    C.LOCKOUT_REASON,
    "recovered",
    "created",
]
LAST = ["last_lockout", "last_recovered", "last_created", "last_wrong_backup_code"]
NOON_MARCH_30 = "make_timestamp(2024, 3, 30, 12, 0, 0)"

FLAT = """
flat AS (
  SELECT user_pseudo_id, event_name, event_timestamp,
    max(kv.value.int_value) FILTER (WHERE kv.key = 'ga_session_id') AS ga_session_id,
    max(kv.value.int_value) FILTER (WHERE kv.key = 'ga_session_number') AS ga_session_number,
    max(kv.value.int_value) FILTER (WHERE kv.key = 'value') AS success,
    max(CASE WHEN kv.key = 'firebase_screen_class' THEN kv.value.string_value ELSE '' END) AS screen_class,
    max(CASE WHEN kv.key = 'reason' THEN kv.value.string_value ELSE '' END) AS reason
  FROM (SELECT user_pseudo_id, event_name, event_timestamp,
               unnest(CASE WHEN len(event_params) = 0 THEN [NULL] ELSE event_params END) AS kv
        FROM starting)
  GROUP BY ALL
)"""


def _page(flag: str) -> str:
    return f"CAST(screen_name = '{C.PAGES[flag]}' AS BIGINT) AS {flag}"


def _reason(name: str) -> str:
    return f"CAST(outcome IS NOT DISTINCT FROM '{name}' AS BIGINT) AS {name}"


def funnel(where: str, excluded: str = "") -> str:
    """CTEs from the events of ``where`` to session rows (``older`` splits weekly sessions)."""
    return f""",
starting AS (SELECT * FROM ev WHERE {where} AND {IS_FLAVOR} AND event_name IN
  ('{C.SCREEN_VIEW}', '{C.CONFIGURATION_FAILURE}', '{C.ACCOUNT_CREATED}', '{C.ACCOUNT_RECOVERED}')),
{FLAT},
steps AS (
  SELECT *,
    strftime(make_timestamp(event_timestamp), '%Y-%m-%dT%H:%M:%SZ') AS event_datetime,
    CAST(make_timestamp(event_timestamp) > {NOON_MARCH_30} AS BIGINT) AS recent_data,
    CASE event_name WHEN 'screen_view' THEN substr(screen_class, 35) ELSE '' END AS screen_name,
    CASE event_name WHEN '{C.ACCOUNT_CREATED}' THEN 'created'
                    WHEN '{C.ACCOUNT_RECOVERED}' THEN 'recovered' ELSE reason END AS outcome
  FROM flat {excluded}
),
flags AS (
  SELECT user_pseudo_id, recent_data, ga_session_id, event_datetime,
    {', '.join(_page(flag) for flag in C.PAGES)},
    {', '.join(_reason(name) for name in [*C.PHONE_ERRORS, *C.BIOMETRIC_ERRORS, C.LOCKOUT_REASON])},
    CAST(outcome = 'recovered' AND success IS NOT DISTINCT FROM 1 AS BIGINT) AS recovered,
    CAST(outcome = 'created' AS BIGINT) AS created,
    CAST(outcome = 'recovered' AND success IS NOT DISTINCT FROM 0 AS BIGINT) AS incorrect_backup_code,
    CASE WHEN {C.LOCKOUT_REASON} = 1 THEN event_datetime END AS lockout_date,
    CASE WHEN recovered = 1 THEN event_datetime END AS recovered_date,
    CASE WHEN created = 1 THEN event_datetime END AS created_date,
    CASE WHEN incorrect_backup_code = 1 THEN event_datetime END AS wrong_backup_code_date
  FROM steps
  WHERE event_name <> 'screen_view'
     OR (screen_name ILIKE '%{C.FUNNEL_SCREEN_WORD}%' AND screen_name NOT ILIKE '%{C.NON_FUNNEL_SCREEN_WORD}%')
)"""


def session_rows(by: str = "") -> str:
    """CTEs ``rolled`` (states) and ``sess`` (outcomes) after ``funnel``."""
    return f""",
rolled AS (
  SELECT user_pseudo_id, {by} ga_session_id,
    min(event_datetime) AS min_date, max(event_datetime) AS max_date,
    {', '.join(f'max({flag}) AS {flag}' for flag in PATH_FLAGS)},
    CAST(sum(incorrect_backup_code) AS BIGINT) AS incorrect_backup_codes,
    max(lockout_date) AS last_lockout, max(recovered_date) AS last_recovered,
    max(created_date) AS last_created, max(wrong_backup_code_date) AS last_wrong_backup_code
  FROM flags GROUP BY user_pseudo_id, {by} ga_session_id
),
stated AS (
  SELECT *, CASE
      WHEN incorrect_backup_codes > 2 AND last_wrong_backup_code > ifnull(last_recovered, last_created)
        THEN 'Locked (new)'
      WHEN last_lockout > ifnull(last_recovered, last_created) THEN 'Locked'
      WHEN last_recovered IS NOT NULL THEN 'Recovered'
      WHEN last_created IS NOT NULL THEN 'Created'
      WHEN last_lockout IS NOT NULL THEN 'Locked'
      WHEN incorrect_backup_codes > 2 THEN 'Locked (new)'
      ELSE 'Not configured' END AS final_state
  FROM rolled
),
sess AS (
  SELECT *, CASE
      WHEN final_state <> 'Not configured' THEN final_state
      ELSE list_filter([
        CASE WHEN photo_page = 1 THEN 'Photo' END,
        CASE WHEN backup_code_page = 1 THEN 'Backup Code' END,
        CASE WHEN name_page = 1 THEN 'Name' END,
        CASE WHEN otp_page = 1 THEN 'OTP' END,
        CASE WHEN biometric_page = 1 THEN CASE WHEN {' + '.join(C.BIOMETRIC_ERRORS)} > 0
             THEN 'Biometric Error' ELSE 'Biometric' END END,
        CASE WHEN phone_page = 1 THEN CASE WHEN {' + '.join(C.PHONE_ERRORS)} > 0
             THEN 'Phone Error' ELSE 'Phone' END END,
        ''], lambda s: s IS NOT NULL)[1] END AS outcome
  FROM stated
)"""


PATHS = f""",
paths AS (
  SELECT {', '.join(PATH_FLAGS)}, incorrect_backup_codes, final_state, outcome,
    CAST({' + '.join([*C.PHONE_ERRORS, *C.BIOMETRIC_ERRORS])} > 0 AS BIGINT) AS had_errors,
    min(min_date) AS min_date, max(max_date) AS max_date,
    count(DISTINCT user_pseudo_id) FILTER (WHERE recent_data = 0) AS old_users,
    count(DISTINCT user_pseudo_id) FILTER (WHERE recent_data = 1) AS recent_users,
    count(ga_session_id) FILTER (WHERE recent_data = 0) AS old_sessions,
    count(ga_session_id) FILTER (WHERE recent_data = 1) AS recent_sessions,
    {', '.join(f'CASE WHEN count(user_pseudo_id) = 1 THEN max({t}) END AS {t}' for t in LAST)}
  FROM sess GROUP BY ALL
)"""


def with_fixtures(body: str) -> str:
    """Whole query: the fixture CTEs, then ``body`` (which may start with more CTEs)."""
    return "WITH " + FIXTURES.strip() + body
