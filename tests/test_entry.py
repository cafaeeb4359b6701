"""Driver contract: entry point, registry and oracle SQL, with every query
checked against DuckDB on the sf0.001 tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from conftest import SF0001
from oracle_compare import compare, duck


def test_entry_runs_on_smoke_tables(spark):
    df = E.entry(spark)
    assert df.columns == ["category", "revenue", "units"]
    rows = df.collect()
    assert rows and [r.revenue for r in rows] == sorted((r.revenue for r in rows), reverse=True)


def test_every_query_has_oracle_sql():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(E.catalog.QUERIES) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    result = compare(E.queries()[name](spark, SF0001), con, E.oracle_sql()[name])
    assert result["ok"], result


def test_end_to_end_job(spark):
    import os

    from lakestar import run
    from lakestar.session import new_run_dir

    out = new_run_dir(spark, "metrics-job")
    assert run.main(["--local", "--data", SF0001, "--no-gate", "--metrics-csv", out]) == 2
    files = [f for f in os.listdir(out) if f.endswith(".csv")]
    with open(os.path.join(out, files[0])) as fh:
        lines = fh.read().splitlines()
    assert lines[0] == "metric,value" and len(lines) == 20
    assert run.main(["--local", "--data", SF0001]) == 1  # the gate fails on this data
