"""Every registered query against its SQL in DuckDB, over whole tables."""

from __future__ import annotations

import importlib.util
import sys
from pathlib import Path

import duckdb
import pytest
from conftest import SF_DIR

ROOT = Path(__file__).resolve().parent.parent
spec = importlib.util.spec_from_file_location("check_oracle", ROOT / "tools" / "check_oracle.py")
check = importlib.util.module_from_spec(spec)
sys.modules["check_oracle"] = check
spec.loader.exec_module(check)

# The corpus operators, which may be left out, have tests of their own in tests/llm.
from driver_queries import ORACLES, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in check.TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(check.entry.queries()) and set(ORACLES) <= set(check.entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    result = db.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    wanted = check.bag(result.fetchall(), columns)
    assert check.bag([tuple(r) for r in df.collect()], df.columns) == wanted
    assert wanted


def test_entry(spark):
    rows = check.entry.entry(spark).collect()
    assert len(rows) == 7
    assert all(r["input_rows"] == r["output_rows"] > 0 for r in rows)
