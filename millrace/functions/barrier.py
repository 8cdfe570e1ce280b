"""Control over where and how often an expression is evaluated."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluated_once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """``keep`` plus ``columns``, as a one-element generator.

    The optimizer pushes a filter below a projection by copying the projected
    expressions into it, which would parse every document a second time. It does
    not push through a generator, and this one stays inside code generation.
    """
    made = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*keep, F.inline(F.array(made)))


def out_of_line(value: Column, rule: Callable[[Column], Column]) -> Column:
    """``rule(value)``, evaluated outside generated code: for branches few rows take.

    Bulky rare rules inlined into the generated method would push it past the
    size the JVM compiles. ``value`` is evaluated once however often the rule uses it.
    """
    return F.get(F.transform(F.array(value), rule), F.lit(0))
