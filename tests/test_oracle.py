"""Every registered query against its DuckDB oracle (the driver's correctness gate) at sf0.001."""

import pytest

import __spark_entry__ as E
from tierstore.plans.registry import QUERIES as CORE
from tools.oracle_check import digest, duck

from conftest import SF001

QUERIES = {k: v for k, v in E.queries().items() if k in CORE}     # text queries: tests/llm
SQLS = {k: v for k, v in E.oracle_sql().items() if k in CORE}


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_is_registered_with_an_oracle_or_rows_only():
    rows_only = set(QUERIES) - set(SQLS)
    assert rows_only == set()
    assert set(SQLS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQLS))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    res = con.sql(SQLS[name])
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(res.columns)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(res.columns, drows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["tier", "year", "num_rows", "min_dt", "max_dt", "num_counters", "value_sum"]
    assert df.count() >= 0
