"""Every query with SQL gives the rows that DuckDB gives; the contract's functions agree with each other."""

import math
import subprocess
import sys
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from vitalgrain.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events".split()


def cell(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return "~"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, (int, float, Decimal)):
        return f"{float(x):.6g}"
    return str(x)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = catalogue.QUERIES[name](spark, sf_dir)
    result = duck.sql(catalogue.ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(result.columns)
    got = sorted(tuple(cell(r[c]) for c in columns) for r in df.collect())
    at = [result.columns.index(c) for c in columns]
    want = sorted(tuple(cell(r[i]) for i in at) for r in result.fetchall())
    assert got == want


def test_contract():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalogue.QUERIES) == set(catalogue.ORACLE_SQL)


def test_entry(spark):
    assert entry.entry(spark).count() == 3


def test_plans_read_only_what_they_need(spark, sf_dir):
    plan = catalogue.missing_summary(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan and plan.count("Scan parquet") == 1
    spikes = catalogue.vital_spike(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert spikes.count("Exchange hashpartitioning") == 1


def test_the_rest_works_without_what_only_training_data_needs():
    code = "import sys; sys.modules.update(xxhash=None, zstandard=None, regex=None); import __spark_entry__ as e; assert 'overview' in e.queries() and 'pipeline' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parent.parent)
