"""Registered queries against their DuckDB SQL on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from tests.conftest import SF_SMALL
from usagelens.llm import queries

LLM_SF = os.environ.get("LLM_SF_DIR", SF_SMALL)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{LLM_SF}/{name}.parquet')")
    return con


def norm(rows, names):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(round(r[k], 9) if isinstance(r[k], float) else r[k] for k in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, LLM_SF)
    res = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in res.description]
    assert sorted(got.columns) == sorted(names)
    assert norm([tuple(r) for r in got.collect()], got.columns) == norm(res.fetchall(), names)
