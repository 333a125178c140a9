"""Every registered query at the smallest scale: equal to its SQL oracle, or at least runs."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from check_oracles import TABLES, compare

BASE = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(BASE), reason="test tables not present")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{BASE}/{name}.parquet')")
    yield con
    con.close()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, oracle, name):
    got = QUERIES[name](spark, BASE).toArrow()
    assert compare(got, oracle.sql(ORACLES[name]).to_arrow_table()) == "ok"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"l13_param_sweep", "l25_cluster_wcss_by_k"}))
def test_query_without_oracle_gives_rows(spark, name):
    assert QUERIES[name](spark, BASE).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
