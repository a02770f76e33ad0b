"""Every registered query against its SQL counterpart on the small driver tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as spark_entry
from ledgerline.workload.oracle import ORACLE_SQL as ORACLE
from ledgerline.workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables not mounted")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    frame = QUERIES[name](spark, SF_DIR)
    cursor = con.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    expected = sorted(tuple(str(dict(zip(columns, row))[c]) for c in frame.columns) for row in cursor.fetchall())
    assert sorted(tuple(str(v) for v in row) for row in frame.collect()) == expected


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 245
