"""Partition labels, ages and request days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def day_label(instant: Column) -> Column:
    """``YYYY-MM-DD``, the buffer's and the event table's partition value."""
    return F.date_format(instant, "yyyy-MM-dd")


def compact_day(instant: Column) -> Column:
    """``YYYYMMDD``."""
    return F.date_format(instant, "yyyyMMdd")


def month_label(day: Column) -> Column:
    """``YYYYMM``, the article table's partition value."""
    return F.date_format(day, "yyyyMM")


def hour_start(instant: Column) -> Column:
    return F.date_trunc("hour", instant)


def strict_date(label: Column) -> Column:
    """The date a partition label names, or null: only ``YYYY-MM-DD`` counts.

    A bare cast would also take ``2026``, ``2026-8-9`` and the like.
    """
    return F.when(label.rlike(ISO_DATE), label.try_cast("date"))


def expires_at(instant: Column, days: int) -> Column:
    """Midnight after the last day a row is kept."""
    return F.date_add(F.to_date(instant), days).cast("timestamp")


def age_seconds(since: Column, now: Column) -> Column:
    """Elapsed seconds with their fraction."""
    return (F.unix_micros(now) - F.unix_micros(since)) / F.lit(1_000_000)


def target_day(today: Column, lookback_days: int = 1) -> Column:
    """The day a batch request asks for: reports appear about a day late."""
    return F.date_sub(today, lookback_days)
