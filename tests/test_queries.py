"""Every registered query beside its SQL twin on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.registry import ORACLES, QUERIES
from checks.views import BASE
from verify import cell, rows_of

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in BASE:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["failure_class", "failure_subclass", "n_records", "fix_strategy"] and df.count() > 0


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    res = con.execute(ORACLES[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(df.columns)
    wanted = sorted(names)
    assert rows_of(df.collect(), df.columns, wanted) == rows_of(res.fetchall(), names, wanted)
    assert cell(None) == "~null"
