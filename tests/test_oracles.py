"""Every registered query against its oracle on the smallest data folder."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from check import TABLES, normal

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return connection


def test_every_query_has_an_oracle():
    assert set(entry.QUERIES) == set(entry.ORACLES)


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query(spark, con, name):
    got = entry.queries()[name](spark, FOLDER).toPandas()
    want = con.execute(entry.oracle_sql()[name]).fetchdf()
    pd.testing.assert_frame_equal(normal(got), normal(want), check_dtype=False)


def test_entry(spark):
    df = entry.entry(spark)
    counts = [r.n for r in df.collect()]
    assert (len(counts), sum(counts), max(counts)) == (320, 4073, 22)
