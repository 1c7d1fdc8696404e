"""The driver contract: every registered query runs on the smallest test
data and matches its DuckDB oracle (rows, columns, values)."""

import os
import sys

import duckdb
import pandas as pd
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from check_oracle import ALL, digest  # noqa: E402
from panelforge.plans.catalog import REGISTRY  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ALL:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(queries()) and set(REGISTRY) <= set(oracle_sql())


def test_entry_smoke(spark):
    df = entry(spark)
    assert len(df.columns) == 30 and df.count() > 0


@pytest.mark.parametrize("key", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, key):
    df = queries()[key](spark, SF)
    sp = pd.DataFrame([r.asDict() for r in df.collect()], columns=df.columns)
    ora = con.execute(oracle_sql()[key]).fetchdf()
    ora = ora.astype(object).where(ora.notna(), None)
    a, b = digest(sp), digest(ora)
    assert a[:2] == b[:2]
    assert a[2] == b[2]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan
