"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import duckdb
import pytest

import __spark_entry__ as E
from tuneforge.plans.catalog import QUERIES as CATALOG
from tuneforge.plans.compare import same_result
from tuneforge.sources.tables import TABLES

from .conftest import SF_SMALL

QUERIES = {n: q for n, q in E.queries().items() if n in CATALOG}
ORACLES = {n: q for n, q in E.oracle_sql().items() if n in CATALOG}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLES[name])
    ok, msg = same_result(df.columns, rows, rel.columns, rel.fetchall())
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["source", "n_train", "n_valid", "n_total"]
