"""Hand-made edge rows for the column functions (FIXTURES.md section 3)."""

import datetime as dt

from pyspark.sql import functions as F

from spark_ledger.functions import (date_from_filename, desc_norm, flexible_date, normalize_merchant,
                                    normalize_merchant_v1, parse_bool, parse_money, slug_symbol, to_cents,
                                    txn_id_sha256)
from spark_ledger.operators.calendar import calendar_columns


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_parse_money(spark):
    got = one_col(spark, ["($1,234.50)", "$5", "abc", None, " 12 ", "(7)"], parse_money)
    assert got == [-1234.5, 5.0, None, None, 12.0, -7.0]


def test_to_cents_half_even(spark):
    got = one_col(spark, ["0.125", "$1,000", "x", None, "0.135"], to_cents)
    # 0.125*100 = 12.5 -> 12 (half-even); 0.135*100 = 13.500000000000002 -> 14
    assert got == [12, 100000, 0, 0, 14]


def test_normalize_merchant(spark):
    got = one_col(spark, ["The ACME-Store, Inc. #12", None, "  ", "Co. Corp LLC"], normalize_merchant)
    assert got == ["acme 12", "", "", ""]


def test_normalize_merchant_v1(spark):
    got = one_col(spark, ["The ACME-Store, Inc.  #12"], normalize_merchant_v1)
    assert got == ["the acmestore inc 12"]


def test_file_name_dates(spark):
    got = one_col(spark, ["/raw/v/x-2024-03-05.csv", "/raw/v/x-03-05-2024.csv", "/raw/v/x-20240305.csv",
                          "/raw/v/none.csv"], date_from_filename)
    d = dt.date(2024, 3, 5)
    assert got == [d, d, d, None]


def test_slug(spark):
    got = one_col(spark, ["Large  Cap (US) Fund!", "", None, "A-B fund"], slug_symbol)
    assert got == ["LARGE_CAP_US_FUND", "UNKNOWN_FUND", "UNKNOWN_FUND", "AB_FUND"]


def test_parse_bool(spark):
    got = one_col(spark, ["1", "TRUE", " yes ", "y", "t", "no", None, "0"], parse_bool)
    assert got == [True, True, True, True, True, False, False, False]


def test_flexible_date(spark):
    got = one_col(spark, ["2024-01-31", "1/31/2024", "31.01.2024", None], flexible_date)
    assert got == [dt.date(2024, 1, 31), dt.date(2024, 1, 31), None, None]


def test_desc_norm_first_match_only(spark):
    # T-1: each replacement hits only its first match.
    got = one_col(spark, ["A#B#C  D"], lambda c: desc_norm(c, "first"))
    assert got == ["a b#c  d"]
    got = one_col(spark, ["A#B#C  D"], lambda c: desc_norm(c, "all"))
    assert got == ["a b c d"]


def test_iso_week_and_fiscal(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2025, 7, 1),)], "d date")
    cal = df.select(*calendar_columns(F.col("d"), fiscal_start=7)).collect()
    assert (cal[0]["iso_week"], cal[0]["iso_year"]) == (1, 2025)
    assert cal[0]["week_start_monday"] == dt.date(2024, 12, 30)
    assert cal[0]["fiscal_year"] == 2024 and cal[0]["fiscal_month_num"] == 6 and cal[0]["fiscal_quarter"] == 2
    assert cal[1]["fiscal_year"] == 2025 and cal[1]["fiscal_month_num"] == 1 and cal[1]["fiscal_quarter"] == 1
    assert cal[0]["is_weekend"] is False and cal[0]["days_in_month"] == 31 and cal[0]["month_short"] == "Dec"


def test_txn_id_sha256_matches_python(spark):
    import hashlib
    df = spark.createDataFrame([(dt.date(2024, 1, 2), "CHK", 1234, "acme", 1)],
                               "date date, account_id string, amount_cents long, merchant_norm string, dup_seq long")
    got = df.select(txn_id_sha256("date", "account_id", "amount_cents", "merchant_norm", "dup_seq")).first()[0]
    assert got == hashlib.sha256(b"2024-01-02|CHK|1234|acme|1").hexdigest()
