"""Every registered query against its SQL counterpart, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from millrace.oracles import ORACLES
from millrace.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_a_counterpart():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql())


def test_entry(spark):
    frame = entry_point.entry(spark)
    assert frame.columns == ["wiki", "hour_ts", "edit_count", "bot_edit_count", "distinct_editors"]
    assert not frame.isEmpty()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    frame = QUERIES[name](spark, SF_DIR)
    result = db.execute(ORACLES[name])
    names = [column[0] for column in result.description]
    assert sorted(frame.columns) == sorted(names)
    in_order = sorted(names)
    want = sorted(repr([row[names.index(n)] for n in in_order]) for row in result.fetchall())
    got = sorted(repr([row[n] for n in in_order]) for row in frame.collect())
    assert got == want
