"""Captured event-stream text, decoded into frames.

One capture file is one connection. A frame is the run of lines up to a blank line;
what follows the last blank line was cut off and is not a frame. ``data`` lines of a
frame are joined with line breaks, ``event`` holds for its frame only, ``id`` holds
until the connection sets another, comments and ``retry`` have no effect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Fields of every line that means something, with its place in its file.

    A file is read in blocks by several tasks. ``block`` orders them, ``pos`` orders the
    lines inside one. ``file_key`` stands for the path, which is longer than most lines.
    """
    lines = spark.read.text(paths, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("line"),
    )
    name = F.substring_index(F.col("line"), ":", 1)
    rest = F.when(
        F.contains("line", F.lit(":")), F.substring(F.col("line"), F.length(name) + 2, F.length("line"))
    ).otherwise("")
    value = F.when(F.startswith(rest, F.lit(" ")), F.substring(rest, F.lit(2), F.length(rest)))
    fields = lines.select(
        "file",
        F.xxhash64("file").alias("file_key"),
        "block",
        "pos",
        (F.col("line") == "").alias("ends_frame"),
        name.alias("name"),
        F.coalesce(value, rest).alias("value"),
    )
    is_id = (F.col("name") == "id") & ~F.contains("value", F.lit("\x00"))
    told = fields.select(
        "file",
        "file_key",
        "block",
        "pos",
        "ends_frame",
        F.when(is_id, F.col("value")).alias("id"),
        F.when(F.col("name") == "event", F.col("value")).alias("event"),
        F.when(F.col("name") == "data", F.col("value")).alias("data"),
    )
    return told.where(F.col("ends_frame") | F.coalesce("id", "event", "data").isNotNull())


def _latest(column: str, by: str) -> Column:
    present = F.col(column).isNotNull()
    return F.max_by(column, F.when(present, F.col(by)))


def _carried_over(lines: DataFrame) -> DataFrame:
    """Per block: its file, how many frames ended before it and which id was in force.

    Lines are summed up where they are read. The running sums go over one row per block, so
    a capture of any size is no burden.
    """
    blocks = lines.groupBy("file_key", "block").agg(
        F.collect_set("file").alias("files"),
        F.count_if("ends_frame").alias("ended"),
        _latest("id", "pos").alias("id"),
    )
    earlier = W.partitionBy("file_key").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    of_key = W.partitionBy("file_key")
    file = F.col("files")[0]
    shared = (F.size("files") > 1) | (F.min(file).over(of_key) != F.max(file).over(of_key))
    problem = F.raise_error(F.concat(F.lit("two captures with one hash: "), file)).cast("string")
    return blocks.select(
        "file_key",
        "block",
        F.when(shared, problem).otherwise(file).alias("file"),
        F.coalesce(F.sum("ended").over(earlier), F.lit(0)).alias("frames_before"),
        F.last("id", ignorenulls=True).over(earlier).alias("id_before"),
    )


def _pieces(lines: DataFrame) -> DataFrame:
    """Frames as far as one block shows them, numbered within the block."""
    in_block = W.partitionBy("file_key", "block").orderBy("pos")
    so_far = in_block.rowsBetween(W.unboundedPreceding, W.currentRow)
    before = in_block.rowsBetween(W.unboundedPreceding, -1)
    placed = lines.select(
        "file_key",
        "block",
        "pos",
        "ends_frame",
        "event",
        "data",
        F.coalesce(F.sum(F.col("ends_frame").cast("bigint")).over(before), F.lit(0)).alias("nth"),
        F.last("id", ignorenulls=True).over(so_far).alias("id"),
    )
    data = F.when(F.col("data").isNotNull(), F.struct("pos", "data"))
    return placed.groupBy("file_key", "block", "nth").agg(
        F.max("ends_frame").alias("ended"),
        _latest("event", "pos").alias("event"),
        _latest("id", "pos").alias("id"),
        F.sort_array(F.collect_list(data))["data"].alias("data"),
    )


def decode_frames(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``file, frame, id, event, data`` of every complete frame that has data lines.

    ``frame`` counts blank lines from the start of the file and so orders its frames.
    """
    lines = _read_lines(spark, paths)
    placed = _pieces(lines).join(_carried_over(lines), ["file_key", "block"]).select(
        "file",
        "block",
        (F.col("frames_before") + F.col("nth")).alias("frame"),
        "nth",
        "ended",
        "event",
        F.coalesce("id", "id_before").alias("id"),
        "data",
    )
    # Only pieces at the edge of a block can belong together; the others are whole.
    inner = F.col("ended") & (F.col("nth") > 0)
    whole = placed.where(inner).select("file", "frame", "ended", "id", "event", "data")
    joined = (
        placed.where(~inner)
        .groupBy("file", "frame")
        .agg(
            F.max("ended").alias("ended"),
            _latest("id", "block").alias("id"),
            _latest("event", "block").alias("event"),
            F.flatten(F.sort_array(F.collect_list(F.struct("block", "data")))["data"]).alias("data"),
        )
    )
    frames = whole.unionByName(joined)
    return frames.where(F.col("ended") & (F.size("data") > 0)).select(
        "file", "frame", "id", "event", F.array_join("data", "\n").alias("data")
    )


def with_payload(frames: DataFrame) -> DataFrame:
    """Frames worth forwarding: an empty payload is dropped."""
    return frames.where(F.length("data") > 0)
