"""The day before which history is closed: its raw rows may be gone, its marts are final.

One stored value that every writer consults. Retention moves it before it removes anything, so
that nothing is recomputed from rows that are no longer there. It never moves back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import storage


def first_kept_day(now: dt.datetime, days: int) -> dt.date:
    """The oldest day that ``days`` days of retention leave at ``now``."""
    return (now - dt.timedelta(days=days)).date() + dt.timedelta(days=1)


def read_horizon(spark: SparkSession, root: str | None) -> dt.datetime | None:
    """The start of the first open day, or None while nothing was ever closed."""
    if root is None:
        return None
    days = [day for _, day in storage.dated_directories(spark, root)]
    return dt.datetime.combine(max(days), dt.time(), dt.timezone.utc) if days else None


def advance_horizon(spark: SparkSession, root: str, day: dt.date) -> dt.datetime:
    """Close all days before ``day``, unless later ones are closed already; the horizon then.

    The new mark is there before the old one goes, and the latest mark counts.
    """
    storage.make_directory(spark, f"{root.rstrip('/')}/dt={day.isoformat()}")
    marks = storage.dated_directories(spark, root)
    latest = max(marked for _, marked in marks)
    for path, marked in marks:
        if marked < latest:
            storage.delete(spark, path)
    return dt.datetime.combine(latest, dt.time(), dt.timezone.utc)


def is_open(instant: Column, horizon: dt.datetime | None) -> Column:
    """Whether a time lies in a day that is not closed."""
    return F.lit(True) if horizon is None else instant >= F.lit(horizon)


def split(deliveries: DataFrame, horizon: dt.datetime | None) -> tuple[DataFrame, DataFrame]:
    """Deliveries of open days, and those that came after their day was closed."""
    inside = is_open(F.col("event_dt"), horizon)
    return deliveries.where(inside), deliveries.where(~inside)
