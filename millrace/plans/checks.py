"""Data-quality checks of what a run has touched, added up over all runs.

A rule is looked at per partition: its violations in one partition must not depend on any
other, as with a grain or an audit whose key decides the partition. Then only the partitions
of the last write are read, and what was found in the others still holds.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.functions.dates import day_label
from millrace.layout import Layout
from millrace.plans import marts
from millrace.plans.quality import grain_violations
from millrace.versions import VersionedTable

Rule = Callable[[DataFrame], DataFrame]


def partition_grain(grain: list[str], partition: str) -> Rule:
    """Keys more than one row of a partition has. The key has to decide the partition."""
    return lambda rows: grain_violations(rows, [partition, *grain])


def violations_table(
    spark: SparkSession, root: str, columns: T.StructType, partition: str
) -> VersionedTable:
    """Where the violations of one rule are kept, by the partition they were found in."""
    return VersionedTable(spark, root, columns, partition)


def grain_schema(table: T.StructType, grain: list[str]) -> T.StructType:
    """The columns of a grain's violations, without the partition."""
    return T.StructType([*(table[name] for name in grain), T.StructField("copies", T.LongType())])


def check_touched(
    violations: VersionedTable, rows: DataFrame, rule: Rule, touched: Iterable[str], run: int
) -> None:
    """Put what ``rule`` finds in the touched partitions of ``rows`` in place of what it found before.

    Partitions that were not touched are not read. ``run`` numbers grow; a run that died is
    repeated with its number and ends in the same state. Partitions without a violation, or
    without any row, keep none.
    """
    values = sorted(set(touched))
    if not values:
        return
    found = rule(rows.where(F.col(violations.partition).isin(values)))
    violations.write(found, run, values)
    violations.commit(run)
    violations.forget(run)


def run_number(now: dt.datetime) -> int:
    """Runs numbered by their time, in milliseconds."""
    return int(now.timestamp() * 1000)


def days_filled(ledger: DataFrame, filled_at: dt.datetime) -> list[str]:
    """The days of the mart that the run at ``filled_at`` has written."""
    hours = ledger.where(F.col("filled_at") == F.lit(filled_at))
    days = hours.select(day_label(F.col("hour_ts")).alias("dt")).distinct()
    return [row["dt"] for row in days.collect()]  # days of the calendar


def check_mart(
    spark: SparkSession, layout: Layout, now: dt.datetime, days: Iterable[str] | None = None
) -> dict[str, int]:
    """Grain and audit of the mart's days; violations by rule, over all days checked so far.

    ``days`` are those the run at ``now`` has filled if none are given.
    """
    if days is None:
        days = days_filled(marts.read_ledger(spark, layout.ledger), now)
    days = list(days)
    mart = marts.read_edits_hourly(spark, layout.edits_hourly)
    grain = schemas.GRAINS["edits_hourly"]
    rules: dict[str, tuple[Rule, T.StructType]] = {
        "edits_hourly_grain": (partition_grain(grain, "dt"), grain_schema(schemas.EDITS_HOURLY, grain)),
        "edits_hourly_not_null_wiki": (marts.without_wiki, schemas.EDITS_HOURLY),
    }
    counts = {}
    for name, (rule, columns) in rules.items():
        found = violations_table(spark, layout.violations(name), columns, "dt")
        check_touched(found, mart, rule, days, run_number(now))
        counts[name] = found.read().count()
    return counts
