"""Every registered query against its DuckDB oracle at sf0.001 (the driver
checks sf0.01; ``python tests/oracle_check.py`` runs that size)."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
from usagelens.plans import catalog
from tests.oracle_check import compare, duck_conn, spark_rows, type_diffs

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = catalog.spark_callables()
ORACLES = catalog.oracle_sqls()


@pytest.fixture(scope="module")
def duck():
    return duck_conn(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.queries()[E.FLAGSHIP](spark, E.SMOKE_DIR).columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    assert type_diffs(df, duck.sql(ORACLES[name])) == {}
    s_cols, s_rows = spark_rows(df)
    cur = duck.execute(ORACLES[name])
    d_cols = [c[0] for c in cur.description]
    err = compare(name, s_cols, s_rows, d_cols, cur.fetchall())
    assert err is None, err
