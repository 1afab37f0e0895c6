"""Every registered query against its SQL on the same tables."""

import math
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from conftest import DATA

import __spark_entry__ as entry_module
from barloom.plans.oracle import ORACLE
from barloom.plans.registry import QUERIES

TABLES = ["orders", "customer", "lineitem", "events", "documents"]
ROWS_ONLY = {"forecast_additive", "additive_validation"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return con


def _sorted_rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(x):
        return "nan" if isinstance(x, float) and math.isnan(x) else x

    table = [tuple(cell(r[i]) for i in order) for r in rows]
    return sorted(table, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLE) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, DATA)
    cursor = duck.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    assert _sorted_rows(frame.collect(), frame.columns) == _sorted_rows(cursor.fetchall(), columns)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_entry_survives_a_missing_library():
    """Without a library that only the training-data operators need, the other queries are still there."""
    code = (
        "import sys, warnings; sys.modules['ahocorasick'] = None; sys.modules['xxhash'] = None; warnings.simplefilter('ignore');"
        "import __spark_entry__ as e; from barloom.plans.registry import QUERIES;"
        "assert set(QUERIES) <= set(e.queries()) and 'op4_token_counts' not in e.queries()"
    )
    root = Path(__file__).resolve().parents[1]
    if (root / "barloom" / "llm").exists():
        subprocess.run([sys.executable, "-c", code], check=True, cwd=root)
