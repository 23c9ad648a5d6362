"""Readers and cleaning loaders on hand-made rows."""

import datetime as dt

from pyspark.sql.types import DateType, DoubleType, StringType, StructField, StructType

from spark_ledger.operators import cleaning
from spark_ledger.sources import readers


def test_conform_by_name(spark):
    df = spark.createDataFrame([("1.5", "X", "extra")], "AMOUNT string, account_id string, junk string")
    schema = StructType([StructField("account_id", StringType()), StructField("amount", DoubleType()),
                         StructField("date", DateType())])
    row = readers.conform(df, schema).first()
    assert (row.account_id, row.amount, row.date) == ("X", 1.5, None)


def test_read_csv_bom_and_encoding(spark, tmp_path):
    p = tmp_path / "d.csv"
    p.write_bytes(b"\xef\xbb\xbfcategory,parent_category\nFood, Meals \n")
    df = readers.read_csv(spark, str(p), infer=True)
    assert df.columns == ["category", "parent_category"]
    q = tmp_path / "w.csv"
    q.write_bytes("name\nCaf\xe9\n".encode("cp1252"))
    assert readers.read_csv(spark, str(q), encoding="cp1252").first()[0] == "Café"
    assert readers.read_parquet_optional(spark, str(tmp_path / "missing")) is None


def test_clean_category_dim(spark):
    df = spark.createDataFrame([(" Food ", None, " Fixed ", "1", "yes")],
                               "category string, parent_category string, top_bucket string, "
                               "exclude_from_budget string, is_transfer string")
    r = cleaning.clean_category_dim(df).first()
    # the narrow flag parser accepts only 1/true
    assert (r.category, r.parent_category, r.top_bucket, r.notes, r.exclude_from_budget, r.is_transfer) == \
        ("Food", "", "Fixed", "", True, False)


def test_clean_balances_file_date(spark):
    df = spark.createDataFrame([("A1", "12.5", "/x/balances-2024-03-31.csv"), ("A2", "n/a", "/x/balances-2024-03-31.csv")],
                               "account string, amount string, source_file string")
    rows = sorted(tuple(r) for r in cleaning.clean_balances(df).collect())
    assert rows == [(dt.date(2024, 3, 31), "A1", 12.5), (dt.date(2024, 3, 31), "A2", 0.0)]


def test_backfill_and_generic(spark):
    old = spark.createDataFrame([("t1", 1.005, None), ("t2", 2.0, 199)], "txn_id string, amount double, amount_cents long")
    got = {r.txn_id: (r.amount_cents, r.is_transfer) for r in cleaning.backfill_cents(old).collect()}
    assert got == {"t1": (100, False), "t2": (199, False)}     # 100.49999... rounds to 100
    raw = spark.createDataFrame([("01/02/2024", " Shop ", "x", None)], "`Posted Date` string, Payee string, Amt string, Memo string")
    r = cleaning.normalize_generic(raw).first()
    assert (r.date, r.merchant, r.amount, r.account_id) == (dt.date(2024, 1, 2), "Shop", 0.0, "unknown")
