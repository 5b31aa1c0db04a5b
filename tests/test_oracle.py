"""Every registered query against its DuckDB oracle on the smallest fixture (sf0.001).

Same comparison as the driver's gate: row count, column names and an
order-insensitive hash of the values.
"""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from cataloguer.plans import QUERIES
from cataloguer.sources.tables import BASE_TABLES

from .conftest import SMALL

ORACLES = E.oracle_sql()
NAMES = sorted(QUERIES)


def _canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6))
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_canon(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


ROWS_ONLY: set[str] = set()  # every registered query has an oracle


def test_every_query_has_an_oracle():
    assert set(NAMES) - ROWS_ONLY == set(ORACLES) & set(NAMES)


@pytest.mark.parametrize("name", [n for n in NAMES if n not in ROWS_ONLY])
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "project_id"
