"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
from oracle_check import SPARK_TO_DUCK, TABLES, _digest  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from zonescope.plans.queries import oracle_queries, spark_queries  # noqa: E402

# The queries of the optional folder have tests of their own beside it.
QUERIES = spark_queries()
SQL = oracle_queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


def test_entry_registers_them_all():
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(SQL[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    duck_types = {d[0]: str(d[1]) for d in res.description}
    for f in df.schema.fields:
        assert SPARK_TO_DUCK.get(f.dataType.simpleString()) == duck_types[f.name], (f.name, f.dataType)
    assert len(rows) == len(want)
    assert _digest(df.columns, rows)[0] == _digest(cols, want)[0]


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0 and "score_rendement" in df.columns
