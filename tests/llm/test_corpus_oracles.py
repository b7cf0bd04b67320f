"""Queries against their SQL in DuckDB, and the contract of all of them, on whole small tables."""

import os

import duckdb
import pytest

import __spark_entry__
from reptally.llm.oracles import ORACLES
from reptally.llm.queries import QUERIES

FOLDER = os.environ.get("REPTALLY_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(FOLDER):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{f}'")
    return c


def plain(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(map(repr, frame.where(frame.notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, name):
    got, want = QUERIES[name](spark, FOLDER).toPandas(), con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    whole = [c for c in got.columns if got[c].dtype == float]  # ids with nulls
    got[whole], want[whole] = got[whole].astype("Int64"), want[whole].astype("Int64")
    assert plain(got) == plain(want)


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())
