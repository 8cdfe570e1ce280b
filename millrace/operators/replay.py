"""How far back to go after an interruption."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: seconds after which a stored position is too old to resume from.
MAX_RESUME_AGE = 900


def resume_positions(stored: DataFrame, max_age_seconds: float = MAX_RESUME_AGE) -> DataFrame:
    """The id to resume each source from, or null to start from now, and which of both.

    A position older than the bound would replay hours at once; a gap is the better
    trade. A position of unknown age is used, and one exactly at the bound too.
    """
    too_old = F.coalesce(F.col("age_seconds") > max_age_seconds, F.lit(False))
    resumed = stored.withColumn("resume_id", F.when(~too_old, F.col("last_event_id")))
    return resumed.withColumn(
        "start_at", F.when(F.col("resume_id").isNotNull(), "stored").otherwise("latest")
    )


def bounded_replay(
    events: DataFrame, now: dt.datetime | str, max_age_seconds: int = MAX_RESUME_AGE
) -> DataFrame:
    """The events a bounded resume would replay: not older than the bound.

    ``now`` is a time, or the name of a column holding it.
    """
    moment = F.col(now) if isinstance(now, str) else F.lit(now)
    oldest = moment - F.make_interval(secs=F.lit(max_age_seconds))
    return events.where(F.col("event_dt") >= oldest)


def starting_offsets(
    topic: str,
    positions: dict[int, int] | None,
    age_seconds: float | None,
    max_age_seconds: float = MAX_RESUME_AGE,
) -> str:
    """Where a stream with no checkpoint of its own should begin reading its topic.

    ``positions`` are the stored next offsets by partition. They are used under the same
    bound as :func:`resume_positions`; without them, or beyond it, reading starts from now.
    """
    if not positions or (age_seconds is not None and age_seconds > max_age_seconds):
        return "latest"
    return json.dumps({topic: {str(p): positions[p] for p in sorted(positions)}})
