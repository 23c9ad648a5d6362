"""Filter context, shares over two frames, previews, treatment of dividends."""

import pytest
from pyspark.sql import functions as F

from spark_ledger.operators import allocation, budget, context, treatment
from spark_ledger.operators.common import first_n, top_n
from spark_ledger.operators.context import Model, Relationship


@pytest.fixture(scope="module")
def model(spark):
    facts = spark.createDataFrame([("a", "2024-01", 1.0), ("a", "2024-02", 2.0), ("b", "2024-01", 4.0), ("zz", "2024-01", 8.0), (None, "2024-02", 16.0)],
                                  "cat string, month string, v double")
    dim = spark.createDataFrame([("a", "X"), ("b", "Y"), ("c", "X"), (None, "X")], "cat string, bucket string")
    months = spark.createDataFrame([("2024-01",), ("2024-02",)], "month string")
    cash = spark.createDataFrame([("2024-01", -1.0), ("2024-02", 5.0)], "month string, net double")
    return Model({"facts": facts, "dim": dim, "months": months, "cash": cash},
                 [Relationship("facts", "cat", "dim", "cat"), Relationship("facts", "month", "months", "month"),
                  Relationship("cash", "month", "months", "month", both=True)])


def total(ctx):
    return ctx["facts"].agg(F.sum("v")).first()[0]


def test_selection_reaches_facts_and_keeps_the_blank_member(model):
    bucket = F.col("bucket")
    assert total(model.select({"dim": bucket == "X"})) == 3.0
    assert total(model.select({"dim": bucket.isNull() | (bucket == "X")})) == 27.0        # unknown and null keys are blank
    assert total(model.select({"dim": bucket.isNull()})) == 24.0
    shown = {r["bucket"]: r["v"] for r in model.axis(model.select({}), "facts", {"dim": ["bucket"]}).groupBy("bucket").agg(F.sum("v").alias("v")).collect()}
    assert shown == {"X": 3.0, "Y": 4.0, None: 24.0}


def test_facts_filter_a_dimension_both_ways(model):
    ctx = model.select({"cash": F.col("net") < 0})
    assert [r.month for r in ctx["months"].collect()] == ["2024-01"] and total(ctx) == 13.0
    assert total(model.select({"cash": F.col("net") < 0, "dim": F.col("bucket") == "X"})) == 1.0
    assert model.select({"facts": F.col("v") > 100})["months"].count() == 2                # facts do not filter it


def test_share_scopes(spark):
    all_ = spark.createDataFrame([("m1", "a", 1.0), ("m1", "b", 3.0), ("m2", "a", 4.0), ("m2", "c", 0.0)], "month string, cls string, value double")
    sel = all_.where("cls <> 'b'")
    of = lambda df: {(r.month, r.cls): r.share for r in df.collect()}
    by = ["month", "cls"]
    assert of(context.share(sel, by, scope="self")) == {("m1", "a"): 1.0, ("m2", "a"): 1.0, ("m2", "c"): None}
    assert of(context.share(sel, by, scope="selected")) == {("m1", "a"): 0.2, ("m2", "a"): 0.8, ("m2", "c"): 0.0}
    assert of(context.share(sel, by, scope="all", everything=all_, within=("month",)))[("m1", "a")] == 0.25
    value = lambda months: context.latest_value(all_, months).first()[0]
    assert value(None) == 4.0 and value(["m1"]) == 4.0 and value(["m1", "m2"]) == 8.0


def test_absent_dimensions_read_unknown(spark):
    p = spark.createDataFrame([("2024-01-31", "A", "X", 5.0)], "d string, account_id string, symbol string, market_value double") \
        .withColumn("as_of_date", F.to_date("d"))
    r = allocation.positions_enriched(p, None, None).first()
    assert (r.asset_class, r.acct_group, r.expense_ratio) == ("Unknown", "Unknown", 0.0)


def test_previews(spark):
    df = spark.createDataFrame([("a", i) for i in range(9)] + [("b", 1)], "k string, v int")
    assert sorted(first_n(df, ["k"], [F.col("v").desc()], 2).collect()) == [("a", 7), ("a", 8), ("b", 1)]
    top = top_n(df, [F.col("v").desc(), F.col("k")], 3)
    assert [r.v for r in top.collect()] == [8, 7, 6]
    assert "TakeOrdered" in top._jdf.queryExecution().executedPlan().toString()


def test_budget_keeps_the_last_row(spark):
    b = spark.createDataFrame([("Food", 202501, 9.0, 1), ("Food", 202501, 3.0, 2)], "parent_category string, yyyymm int, budget_amount double, row_idx int")
    assert sorted((r.yyyymm, r.budget_amount) for r in budget.budget_roll_forward(b, 202502).collect()) == [(202501, 3.0), (202502, 3.0)]
    with pytest.raises(ValueError, match="budget_amount"):
        budget.budget_roll_forward(b.drop("budget_amount"), 202502)


def test_treatment(spark):
    held = spark.createDataFrame([("A", s, 100.0) for s in ("muni", "tsy", "std", "code", "none", "odd")] + [("B", "std", 100.0)],
                                 "account_id string, symbol string, value double")
    y = spark.createDataFrame([("muni", 0.1, 0.5, "Muni", 0.0), ("tsy", None, 0.1, "treasury", 0.0), ("std", 0.1, None, None, 0.5),
                               ("code", 0.1, None, "standard", 999.0), ("none", None, None, "standard", 0.0), ("odd", 0.1, None, "other", 0.0)],
                              "symbol string, yield_forward double, yield_trailing double, tax_treatment string, qualified_ratio double")
    acc = spark.createDataFrame([("A", "Liquid")], "account_id string, acct_group string")
    got = {(r.account_id, r.symbol): r for r in treatment.treated_dividends(held, y, acc, 0.3, 0.2, 0.05).collect()}
    assert set(got) == {("A", s) for s in ("muni", "tsy", "std", "code", "odd")} | {("B", "std")}
    tax = {k: (round(r.federal_tax, 9), round(r.state_tax, 9)) for k, r in got.items()}
    assert tax[("A", "muni")] == (0.0, 0.0) and tax[("A", "tsy")] == (3.0, 0.0) and tax[("A", "std")] == (2.5, 0.5)
    assert tax[("A", "code")] == (0.0, 0.0) and tax[("A", "odd")] == (3.0, 0.5)
    assert round(got[("A", "std")].spendable_net, 9) == 7.0 and got[("B", "std")].spendable_net == 0.0
