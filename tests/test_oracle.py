"""Every registered query against its DuckDB oracle on the smallest test
tables (the driver runs the same comparison at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.util import bag

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
SQL = E.oracle_sql()
KEYS = sorted(SQL)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_a_reason():
    reasons = E.no_oracle()
    assert set(E.queries()) - set(SQL) == set(reasons)
    assert all(reasons.values()) and set(reasons) <= {"pipeline"} | {k for k in E.queries() if k.startswith("op")}


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF_SMALL)
    srows = [r.asDict(recursive=True) for r in sdf.collect()]
    rel = con.sql(SQL[key])
    dcols = rel.columns
    drows = [dict(zip(dcols, r)) for r in rel.fetchall()]
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert bag(srows) == bag(drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "day_vwap" in df.columns
