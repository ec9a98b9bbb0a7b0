"""Inclusive date windows, computed from an ``as_of`` time before the query starts.

The bounds reach the query as literals, so they prune shards in the scan.
"""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from shardtally.functions.times import as_utc


@dataclass(frozen=True)
class Window:
    first: date
    last: date

    @property
    def shards(self) -> tuple[str, str]:
        return shard_name(self.first), shard_name(self.last)

    def contains(self, shard: Column | str = "shard") -> Column:
        """Predicate on the shard column; text order of ``yyyyMMdd`` is date order."""
        column = F.col(shard) if isinstance(shard, str) else shard
        return column.between(*self.shards)


def shard_name(day: date) -> str:
    return day.strftime("%Y%m%d")


def months_before(day: date, months: int) -> date:
    """Same day ``months`` earlier, clipped to the end of that month."""
    index = day.year * 12 + day.month - 1 - months
    year, month = index // 12, index % 12 + 1
    return date(year, month, min(day.day, calendar.monthrange(year, month)[1]))


def month_end(day: date) -> date:
    return day.replace(day=calendar.monthrange(day.year, day.month)[1])


def previous_month(as_of: datetime | None = None) -> Window:
    today = as_utc(as_of).date()
    return Window(months_before(today, 1).replace(day=1), today.replace(day=1) - timedelta(days=1))


def two_trailing_windows(as_of: datetime | None = None, days: int = 30) -> Window:
    """The recent window and the older one before it; they touch, so they are one range."""
    today = as_utc(as_of).date()
    return Window(today - timedelta(days=2 * days), today)


def history_to_month_end(as_of: datetime | None = None, months: int = 3) -> Window:
    today = as_utc(as_of).date()
    return Window(months_before(today, months).replace(day=1), month_end(today))


def history_to_date(as_of: datetime | None = None, months: int = 3) -> Window:
    today = as_utc(as_of).date()
    return Window(months_before(today, months).replace(day=1), today)
