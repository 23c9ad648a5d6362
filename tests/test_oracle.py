"""Every registered query against its DuckDB oracle on the smallest scale.

The driver compares at sf0.01 (``check_oracle.py`` does the same locally);
here sf0.001 keeps the suite quick.  Doubles are compared exactly; the
oracles present order-dependent sums rounded, as the Spark plans do.
"""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracle import TABLES, rows_of
from spark_ledger.plans import registry

registry.load_all()
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES      # the training-data operators have tests of their own


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["month", "income", "spending", "net_cashflow"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    c1, r1 = rows_of(df.columns, srows)
    c2, r2 = rows_of(ocols, res.fetchall())
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2
