from pathlib import Path
from urllib.parse import urlparse

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from millrace.llm import tables

MEGABYTE = 1 << 20


def large_rows(spark, n):
    return spark.range(0, n, 1, 1).withColumn("data", F.randstr(F.lit(MEGABYTE), F.lit(1)).cast("binary"))


def test_large_rows_are_kept_in_small_row_groups(spark):
    tables.prepare(spark)
    kept = tables.stored(large_rows(spark, 40), "large-rows", large_rows=True)
    assert kept.where(F.octet_length("data") == MEGABYTE).count() == 40
    groups = [
        pq.ParquetFile(path).metadata.row_group(i).total_byte_size
        for path in (Path(urlparse(name).path) for name in kept.inputFiles())
        for i in range(pq.ParquetFile(path).metadata.num_row_groups)
    ]
    assert max(groups) <= tables.SMALL_GROUPS["parquet.block.size"] + 2 * MEGABYTE


def test_batches_of_large_rows_are_small(spark):
    def sizes(batches):
        for batch in batches:
            yield type(batch).from_pydict({"n": [batch.nbytes]})

    tables.prepare(spark)
    found = large_rows(spark, 40).mapInArrow(sizes, "n bigint").collect()
    assert max(r["n"] for r in found) <= 10 * MEGABYTE and len(found) > 3
