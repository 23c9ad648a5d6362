"""Registered queries that have SQL, on the smallest scale."""

import duckdb
import pytest

from check_oracle import TABLES, rows_of
from spark_ledger.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    df = queries.QUERIES[name](spark, sf_dir)
    res = con.execute(queries.ORACLES[name])
    want = rows_of([d[0] for d in res.description], res.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want
