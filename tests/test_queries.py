"""Every registered query against its SQL, on the smallest given tables."""

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

import __spark_entry__ as entry  # noqa: E402
from check_oracle import TABLES, difference  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
RUNS, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from read_parquet('{FOLDER}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(RUNS))
def test_query(spark, duck, name):
    ours = RUNS[name](spark, FOLDER).toPandas()
    if name in SQL:
        note = difference(ours, duck.execute(SQL[name]).df())
        assert note == "", note


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)


def test_oracles_name_queries():
    assert set(SQL) <= set(RUNS)
