"""Driver contract: entry() smoke, queries/oracle key parity, and every registered
query against its DuckDB oracle on the smallest driver tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from quotebars.plans import oracle as O
from quotebars.plans import queries as Q
from quotebars.sources.driver_tables import TABLES
from tools.oracle_check import compare

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["symbol", "window_start_ms", "window_end_ms", "open", "high", "low", "close",
                          "volume", "quote_volume", "vwap", "trade_count"]
    assert df.count() > 0


BASE = Q.queries()


def test_every_query_has_an_oracle():
    assert set(BASE) == set(O.oracle_sql())
    assert set(BASE) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(BASE))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    drows = res.fetchall()
    exact, _, maxdiff, msg = compare(rows, df.columns, drows, [d[0] for d in res.description])
    assert exact, f"{name}: {msg} maxdiff={maxdiff}"
