"""Row numbers without pulling a group, or the whole table, into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.session import shared_dir


def numbered(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], name: str
) -> DataFrame:
    """``df`` plus 1-based positions within ``group`` by ``order``; BIGINT.

    A window would sort each group in one task. Here a range exchange spreads the rows
    over tasks in order, however large a group is; each task numbers its own rows, and
    only the row counts per task and group are summed up. ``order`` must be total
    within a group for the numbers to be well defined.

    The ordered rows are checkpointed: range bounds are sampled, and counting one
    sample's tasks while numbering another's would be wrong.
    """
    shared_dir(df.sparkSession)
    keys = [*group, *order]
    ordered = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_task", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id())
        .checkpoint()
    )
    task = W.partitionBy(*group).orderBy("_task")
    counts = ordered.groupBy("_task", *group).agg(
        F.count("*").alias("_rows"), F.min("_row").alias("_first")
    )
    offsets = counts.select(
        "_task",
        *group,
        "_first",
        F.coalesce(
            F.sum("_rows").over(task.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
    )
    matched = ordered.alias("r").join(
        offsets.alias("o"),
        on=[F.col("r._task") == F.col("o._task")]
        + [F.col(f"r.{g}").eqNullSafe(F.col(f"o.{g}")) for g in group],
    )
    position = F.col("r._row") - F.col("o._first") + F.col("o._before") + 1
    return matched.select(
        *[F.col(f"r.{c}") for c in df.columns], position.cast("bigint").alias(name)
    )
