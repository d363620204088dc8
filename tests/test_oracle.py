"""Every registered query against its DuckDB oracle at sf0.001 (the driver
runs the same comparison at sf0.01)."""

import duckdb
import pytest

from compare import same
from loomis.plans.bindings import TABLES
from loomis.plans.registry import load_all

QUERIES, ORACLE = load_all()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, sf, con, name):
    got = QUERIES[name](spark, sf).toPandas()
    want = con.execute(ORACLE[name]).df()
    ok, why = same(got, want)
    assert ok, why


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, sf, name):
    pdf = QUERIES[name](spark, sf).toPandas()
    assert len(pdf.columns) > 0


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
