import datetime as dt

from pyspark.sql import functions as F

from millrace import schemas, storage
from millrace.layout import Layout
from millrace.plans import checks, marts
from millrace.plans.quality import grain_violations

UTC = dt.timezone.utc
DAYS = ["2025-03-09", "2025-03-10", "2025-03-11"]


def at(day, hour=0):
    return dt.datetime.fromisoformat(day).replace(hour=hour, tzinfo=UTC)


def write_mart(spark, root, rows):
    full = [(wiki, at(day, hour), 1, 0, 1) for wiki, day, hour in rows]
    mart = spark.createDataFrame(full, schemas.EDITS_HOURLY)
    storage.replace_partitions(mart.withColumn("dt", F.date_format("hour_ts", "yyyy-MM-dd")), root, ["dt"])


def found(violations):
    return sorted((r["dt"], r["wiki"], r["copies"]) for r in violations.read().collect())


def test_only_touched_partitions_are_looked_at_again(spark, tmp_path):
    mart_root, grain = str(tmp_path / "mart"), schemas.GRAINS["edits_hourly"]
    rule = checks.partition_grain(grain, "dt")
    violations = checks.violations_table(
        spark, str(tmp_path / "found"), checks.grain_schema(schemas.EDITS_HOURLY, grain), "dt"
    )
    mart = lambda: marts.read_edits_hourly(spark, mart_root)

    write_mart(spark, mart_root, [("a", DAYS[0], 1)] * 2 + [("a", DAYS[1], 1), ("b", DAYS[1], 1)])
    checks.check_touched(violations, mart(), rule, DAYS[:2], 1)
    assert found(violations) == [(DAYS[0], "a", 2)]

    write_mart(spark, mart_root, [("b", DAYS[1], 2)] * 3 + [("c", DAYS[2], 2)])
    checks.check_touched(violations, mart(), rule, DAYS[1:], 2)
    assert found(violations) == [(DAYS[0], "a", 2), (DAYS[1], "b", 3)]
    whole = grain_violations(mart(), ["dt", *grain]).collect()
    assert sorted((r["dt"], r["wiki"], r["copies"]) for r in whole) == found(violations)

    write_mart(spark, mart_root, [("a", DAYS[0], 1)])
    checks.check_touched(violations, mart(), rule, [DAYS[0]], 3)
    checks.check_touched(violations, mart(), rule, [DAYS[0]], 3)  # repeated after a crash
    assert found(violations) == [(DAYS[1], "b", 3)]
    checks.check_touched(violations, mart(), rule, [], 4)
    assert violations.committed() == 3


def test_partitions_that_were_not_touched_are_not_read(spark, tmp_path, capsys):
    root = str(tmp_path / "mart")
    write_mart(spark, root, [("a", day, 1) for day in DAYS])
    touched = marts.read_edits_hourly(spark, root).where(F.col("dt").isin(DAYS[:1]))
    checks.partition_grain(["wiki", "hour_ts"], "dt")(touched).explain("formatted")
    plan = capsys.readouterr().out
    [filters] = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert DAYS[0] in filters and DAYS[1] not in filters
    files = {row[0] for row in touched.select("_metadata.file_path").collect()}
    assert files and all(DAYS[0] in path for path in files)


def test_the_mart_is_checked_for_the_days_of_a_run(spark, tmp_path):
    layout = Layout(str(tmp_path))
    write_mart(spark, layout.edits_hourly, [("", DAYS[0], 1), ("a", DAYS[1], 1), ("", DAYS[2], 1)])

    def filled(now, *days):
        rows = spark.createDataFrame([(at(day, 1), now) for day in days], schemas.LEDGER)
        rows.write.mode("append").parquet(layout.ledger)

    first, second = at(DAYS[2], 10), at(DAYS[2], 11)
    filled(first, *DAYS[:2])
    assert checks.check_mart(spark, layout, first) == {"edits_hourly_grain": 0, "edits_hourly_not_null_wiki": 1}
    filled(second, DAYS[2])
    assert checks.check_mart(spark, layout, second)["edits_hourly_not_null_wiki"] == 2
    write_mart(spark, layout.edits_hourly, [("a", DAYS[0], 1)] * 2)
    counts = checks.check_mart(spark, layout, at(DAYS[2], 12), DAYS[:1])
    assert counts == {"edits_hourly_grain": 1, "edits_hourly_not_null_wiki": 1}
