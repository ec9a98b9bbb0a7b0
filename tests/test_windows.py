from datetime import date

import pytest

from rows import at
from shardtally.functions import windows
from shardtally.functions.times import as_utc


@pytest.mark.parametrize(
    "as_of, first, last",
    [
        (at(2024, 4, 30, 12), date(2024, 3, 1), date(2024, 3, 31)),
        (at(2024, 3, 31), date(2024, 2, 1), date(2024, 2, 29)),
        (at(2024, 1, 1), date(2023, 12, 1), date(2023, 12, 31)),
    ],
)
def test_previous_month(as_of, first, last):
    assert windows.previous_month(as_of) == windows.Window(first, last)


def test_history_reaches_back_whole_months():
    as_of = at(2024, 5, 31, 23, 59)
    assert windows.history_to_month_end(as_of, 3).shards == ("20240201", "20240531")
    assert windows.history_to_date(at(2024, 5, 3), 3).shards == ("20240201", "20240503")
    assert windows.history_to_month_end(at(2024, 2, 3), 3).shards == ("20231101", "20240229")


def test_two_trailing_windows_touch():
    span = windows.two_trailing_windows(at(2024, 4, 30, 12), 30)
    assert span.shards == ("20240301", "20240430")


def test_months_before_clips_to_the_month():
    assert windows.months_before(date(2024, 3, 31), 1) == date(2024, 2, 29)
    assert windows.months_before(date(2024, 1, 15), 13) == date(2022, 12, 15)


def test_time_without_zone_is_utc_and_missing_is_now():
    assert as_utc(at(2024, 1, 1).replace(tzinfo=None)) == at(2024, 1, 1)
    assert as_utc(None).tzinfo is not None
