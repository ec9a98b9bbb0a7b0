"""UTC calendar of event timestamps (microseconds since the epoch).

Timestamps are turned into zone-less UTC wall-clock values, so no result
depends on the session time zone.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000


def _after_epoch(unit: str, amount: Column) -> Column:
    return F.timestamp_add(unit, amount, F.lit("1970-01-01").cast("timestamp_ntz"))


def utc(micros: Column | str = "event_timestamp") -> Column:
    """UTC wall-clock time (timestamp without time zone)."""
    micros = F.col(micros) if isinstance(micros, str) else micros
    return _after_epoch("MICROSECOND", micros)


def event_date(micros: Column | str = "event_timestamp") -> Column:
    return utc(micros).cast("date")


def event_month(micros: Column | str = "event_timestamp") -> Column:
    """First day of the month, as a date."""
    return F.trunc(event_date(micros), "MM")


def month_text(micros: Column | str = "event_timestamp") -> Column:
    """Month as ``yyyy-MM``."""
    return F.substring(event_date(micros).cast("string"), 1, 7)


def day_text(micros: Column | str = "event_timestamp") -> Column:
    """Day as ``yyyy-MM-dd``."""
    return event_date(micros).cast("string")


def event_second(micros: Column | str = "event_timestamp") -> Column:
    """Whole seconds since the epoch: orders events as their ISO text does, and sums up faster."""
    micros = F.col(micros) if isinstance(micros, str) else micros
    return F.call_function("div", micros - F.pmod(micros, F.lit(1_000_000)), F.lit(1_000_000))


def iso_second(seconds: Column | str) -> Column:
    """Seconds since the epoch as ``yyyy-MM-ddTHH:mm:ssZ``."""
    seconds = F.col(seconds) if isinstance(seconds, str) else seconds
    text = _after_epoch("SECOND", seconds).cast("string")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("Z"))


def iso_text(micros: Column | str = "event_timestamp") -> Column:
    """Event time as ISO text, cut to the second."""
    return iso_second(event_second(micros))


def elapsed_days(as_of: datetime, micros: Column | str = "event_timestamp") -> Column:
    """Whole 24-hour periods from the event to ``as_of`` (not calendar days)."""
    micros = F.col(micros) if isinstance(micros, str) else micros
    return F.call_function("div", F.lit(to_micros(as_of)) - micros, F.lit(DAY_MICROS))


def to_micros(moment: datetime) -> int:
    delta = as_utc(moment) - datetime(1970, 1, 1, tzinfo=UTC)
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def as_utc(moment: datetime | None) -> datetime:
    """``moment`` in UTC: now if it is missing, taken as UTC if it has no zone."""
    if moment is None:
        return datetime.now(UTC)
    return moment.replace(tzinfo=UTC) if moment.tzinfo is None else moment.astimezone(UTC)
