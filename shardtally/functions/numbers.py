"""Ratios for reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part / whole`` rounded; NULL if ``whole`` is zero."""
    return F.round(F.try_divide(part, whole), digits)


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part, whole) * 100, digits)
