"""The funnel and the flattening once more, row by row in plain Python."""

from collections import defaultdict
from datetime import UTC, datetime

from shardtally import constants as C

DAY = 86_400_000_000


def top(values):
    known = [v for v in values if v is not None]
    return max(known) if known else None


def values_of(row, key, slot, default):
    """What each entry contributes; an event without entries contributes the default once."""
    found = [
        e["value"][slot] if e["key"] == key else default for e in row["event_params"] or []
    ]
    return found or [default]


def flatten(rows):
    """{(user, name, micros): (session, success, screen class, reason)}"""
    groups = defaultdict(list)
    for row in rows:
        groups[row["user_pseudo_id"], row["event_name"], row["event_timestamp"]].append(row)
    wanted = [
        ("ga_session_id", "int_value", None),
        ("value", "int_value", None),
        ("firebase_screen_class", "string_value", ""),
        ("reason", "string_value", ""),
    ]
    return {
        group: tuple(
            top(v for row in members for v in values_of(row, *spec)) for spec in wanted
        )
        for group, members in groups.items()
    }


def prop(row, key):
    for entry in row["user_properties"] or []:
        if entry["key"] == key:
            return entry["value"]["string_value"]
    return None


def iso(micros):
    return datetime.fromtimestamp(micros // 1_000_000, UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def not_in(user, ids):
    if not ids:
        return True
    return user is not None and None not in ids and user not in ids


def sessions(rows, window, internal_devices, recent_after=None):
    """Session rows as dicts, for the events of the shards in ``window``."""
    lo, hi = window
    rows = [r for r in rows if lo <= r["shard"] <= hi]
    excluded = {
        r["user_pseudo_id"]
        for r in rows
        if prop(r, C.DEMO_USER_KEY) == "true" or prop(r, "device_id") in internal_devices
    }
    started = [
        r
        for r in rows
        if prop(r, "app_flavor") == C.PRODUCTION_FLAVOR and r["event_name"] in C.FUNNEL_EVENTS
    ]
    grouped = defaultdict(list)
    for (user, name, micros), (session, success, screen, reason) in flatten(started).items():
        page = ""
        if name == C.SCREEN_VIEW:
            page = (screen or "")[C.SCREEN_NAME_START - 1 :]
            low = page.lower()
            if C.FUNNEL_SCREEN_WORD.lower() not in low or C.NON_FUNNEL_SCREEN_WORD.lower() in low:
                continue
        if name == C.ACCOUNT_CREATED:
            reason = C.CREATED
        if name == C.ACCOUNT_RECOVERED:
            reason = C.RECOVERED
        if not not_in(user, excluded):
            continue
        recent = None if recent_after is None else int(micros > recent_after)
        grouped[user, recent, session].append((iso(micros), page, reason, success))
    return [
        {"user": u, "recent": r, "session": s} | judge(found)
        for (u, r, s), found in grouped.items()
    ]


def judge(found):
    def last(test):
        return top(time for time, _, reason, success in found if test(reason, success))

    pages = {page for _, page, _, _ in found}
    reasons = {reason for _, _, reason, _ in found}
    lockout = last(lambda reason, success: reason == C.LOCKOUT_REASON)
    recovered = last(lambda reason, success: reason == C.RECOVERED and success == 1)
    created = last(lambda reason, success: reason == C.CREATED)
    wrong = [time for time, _, reason, success in found if reason == C.RECOVERED and success == 0]
    well = recovered if recovered is not None else created

    def after(time):
        return time is not None and well is not None and time > well

    if len(wrong) > 2 and after(top(wrong)):
        state = "Locked (new)"
    elif after(lockout):
        state = "Locked"
    elif recovered is not None:
        state = "Recovered"
    elif created is not None:
        state = "Created"
    elif lockout is not None:
        state = "Locked"
    elif len(wrong) > 2:
        state = "Locked (new)"
    else:
        state = None

    outcome = state or ""
    if state is None:
        for flag, name in [
            ("photo_page", "Photo"),
            ("backup_code_page", "Backup Code"),
            ("name_page", "Name"),
            ("otp_page", "OTP"),
            ("biometric_page", "Biometric"),
            ("phone_page", "Phone"),
        ]:
            if C.PAGES[flag] in pages:
                errors = {"Biometric": C.BIOMETRIC_ERRORS, "Phone": C.PHONE_ERRORS}.get(name, ())
                outcome = name + (" Error" if reasons & set(errors) else "")
                break
    path = (
        frozenset(pages & set(C.PAGES.values())),
        frozenset(reasons & {*C.PHONE_ERRORS, *C.BIOMETRIC_ERRORS, C.LOCKOUT_REASON}),
        recovered is not None,
        created is not None,
        len(wrong),
        state,
    )
    times = [time for time, _, _, _ in found]
    return {"outcome": outcome, "path": path, "first": min(times), "last": max(times)}


def monthly(rows, window, internal_devices):
    found = sessions(rows, window, internal_devices)
    users = defaultdict(set)
    for s in found:
        users[s["outcome"]].add(s["user"])
    row = {
        "min_date": min((s["first"] for s in found), default=None),
        "max_date": max((s["last"] for s in found), default=None),
    }
    for column, outcome in C.OUTCOME_COLUMNS.items():
        row[column] = len(users[outcome] - {None}) if outcome in users else None
    return row


def weekly(rows, window, internal_devices, recent_after):
    found = sessions(rows, window, internal_devices, recent_after)
    paths = defaultdict(set)
    totals = defaultdict(lambda: [0, 0, 0, 0])
    for s in found:
        paths[s["outcome"], s["path"], s["recent"]].add(s["user"])
        totals[s["outcome"]][2 + s["recent"]] += s["session"] is not None
    for (outcome, _, recent), users in paths.items():
        totals[outcome][recent] += len(users - {None})
    return {
        outcome: (
            *counts,
            min(s["first"] for s in found if s["outcome"] == outcome),
            max(s["last"] for s in found if s["outcome"] == outcome),
        )
        for outcome, counts in totals.items()
    }
