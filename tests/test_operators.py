"""Operator behaviour on hand-made rows: traps, edge cases and invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from spark_ledger.operators import budget, identity, measures, projection, rules, tax, upsert
from spark_ledger.operators.common import keep_first

D = dt.date

TXN_SCHEMA = ("txn_id string, date date, account_id string, amount_cents long, amount double, "
              "description string, category string, memo string")


def txns(spark, data):
    return spark.createDataFrame(data, TXN_SCHEMA)


# ------------------------------------------------------------------ dedupe
def test_same_day_refund_collapses(spark):
    t = txns(spark, [("a", D(2024, 1, 5), "X", 500, 5.0, "Shop", None, None),
                     ("b", D(2024, 1, 5), "X", -500, -5.0, "Shop", None, None)])
    out = identity.dedupe_transactions(t).collect()
    assert [r.txn_id for r in out] == ["a"]          # T-2, tie broken by txn_id


def test_null_dates_form_one_group(spark):
    t = txns(spark, [("a", None, "X", 100, 1.0, "one", None, None),
                     ("b", None, "Y", 200, 2.0, "two", None, None),
                     ("c", D(2024, 1, 1), "Y", 200, 2.0, "two", None, None)])
    out = sorted(r.txn_id for r in identity.dedupe_transactions(t).collect())
    assert out == ["a", "c"]                          # T-4


def test_pending_text_ranks_last(spark):
    t = txns(spark, [("a", None, "X", 100, 1.0, "pending shop", None, None),
                     ("b", None, "X", 100, 1.0, "shop", None, None)])
    assert [r.txn_id for r in identity.dedupe_transactions(t).collect()] == ["b"]


def test_dedupe_idempotent(spark, sf_dir):
    from spark_ledger.sources.fixtures import Tables
    t = Tables(spark, sf_dir).transactions
    once = identity.dedupe_transactions(t)
    twice = identity.dedupe_transactions(once.select(*t.columns))
    assert once.count() == twice.count() <= t.count()
    assert once.select("dupe_key").distinct().count() == once.count()


def test_pending_only_is_kept(spark):
    t = txns(spark, [("p", D(2024, 1, 1), "X", 100, 1.0, "ORIG CO NAME: shop", None, None),
                     ("p2", D(2024, 1, 2), "X", 100, 1.0, "ORIG CO NAME: shop", None, None),
                     ("s", D(2024, 1, 2), "X", 100, 1.0, "shop", None, None)])
    out = sorted(r.txn_id for r in identity.drop_pending_with_settled(t).collect())
    assert out == ["p", "s"]


def test_pending_in_file(spark):
    t = txns(spark, [("p", D(2024, 1, 1), "X", 100, 1.0, "ORIG CO x", None, None),
                     ("s", D(2024, 1, 1), "X", 100, 1.0, "x", None, None),
                     ("q", D(2024, 1, 1), "Y", 100, 1.0, "ORIG CO y", None, None)])
    out = sorted(r.txn_id for r in identity.drop_pending_in_file(t).collect())
    assert out == ["q", "s"]


# ------------------------------------------------------------------ rules
RULES = "match_type string, pattern string, category string, priority int, subscription string"
OVR = "active boolean, date date, description_regex string, amount double, category string, subscription boolean"


def test_categorize_precedence_and_empty_pattern(spark):
    t = txns(spark, [("1", D(2024, 1, 1), "X", -1000, -10.0, "Big Ring Store", None, None),
                     ("2", D(2024, 1, 1), "X", -1000, -10.0, "anything", "Base", None),
                     ("3", D(2024, 1, 2), "X", -1234, -12.34, "hot anvil", None, None)])
    r = spark.createDataFrame([("contains", " RING ", "Jewelry", 10, "yes"),
                               ("contains", "", "Everything", 50, None),
                               ("regex", "big ring", "Longer", 10, "no")], RULES)
    o = spark.createDataFrame([(True, None, "hot anvil", 12.34, "Anvil", True),
                               (False, None, ".*", None, "Never", False)], OVR)
    for method in ("compiled", "join"):
        got = {x.txn_id: (x.category, x.is_subscription)
               for x in rules.categorize(t, r, o, method=method).collect()}
        # ' RING ' is trimmed+lowered to 'ring' (T-5); longer pattern wins the tie
        assert got["1"] == ("Longer", False)
        assert got["2"] == ("Everything", False)     # empty 'contains' matches all
        assert got["3"] == ("Anvil", True)           # override beats rules, abs amount match


def test_priorities_are_numbers(spark):
    t = txns(spark, [("1", D(2024, 1, 1), "X", -1000, -10.0, "abc coffee", None, None)])
    r = spark.createDataFrame([("contains", "abc", "First", 9.5, None), ("contains", "coffee", "Second", 10.0, None)],
                              RULES.replace("priority int", "priority double"))
    for method in ("compiled", "join"):
        assert rules.categorize(t, r, None, method=method).first().category == "First"


def test_many_rules_and_overrides_equal_few(spark):
    t = txns(spark, [(str(i), D(2024, 1, 1 + i % 9), "X", -100 * i, -1.0 * i, f"shop w{i}w", None, None) for i in range(40)])
    few = [("contains", "w7w", "Seven", 1, None), ("regex", "shop w1.w", "Ten", 2, "y")]
    ov = [(True, "1/3/2024", "w2w", "$2.00", "Two", "yes"), (True, None, "w[34]w", None, "Three", None)]
    many = few + [("contains", f"none{i}", f"N{i}", 3, None) for i in range(2500)]
    more = ov + [(True, None, f"never{i}", None, f"A{i}", None) for i in range(2500)]
    ovr = "active boolean, date string, description_regex string, amount string, category string, subscription string"
    want = None
    for method, r, o in (("compiled", few, ov), ("join", few, ov), ("join", many, more)):
        got = {x.txn_id: (x.category, x.is_subscription) for x in rules.categorize(
            t, spark.createDataFrame(r, RULES), spark.createDataFrame(o, ovr), method=method).collect()}
        want = want or got
        assert got == want
    assert want["7"] == ("Seven", False) and want["12"] == ("Ten", True) and want["2"] == ("Two", True)
    assert want["3"] == ("Three", False) and want["20"] == ("Uncategorized", False)


def test_first_match_rules(spark):
    t = txns(spark, [("1", D(2024, 1, 1), "ACCT", -500, -5.0, "The Gear Store", "Vendor", None),
                     ("2", D(2024, 1, 1), "ACCT", 500, 5.0, "Coffee BAR", None, None)])
    r = spark.createDataFrame(
        [("contains", "coffee", "Coffee", 5, None, "negative", None),
         ("merchant_norm", "GEAR", "Gear", 1, None, None, "acct"),
         ("regex", "c.ffee", "Cafe", 9, None, None, None)],
        "match_type string, pattern string, category string, priority int, subscription string, sign string, account_id string")
    got = {x.txn_id: x.category for x in rules.apply_rules_first_match(t, r).collect()}
    assert got == {"1": "Gear", "2": "Cafe"}


# ------------------------------------------------------------------ upsert
def test_upsert_twice_equals_once(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    stg = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    once = upsert.upsert(tgt, stg, ["k"])
    twice = upsert.upsert(once, stg, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect()) == [(1, "a"), (2, "B"), (3, "C")]
    assert sorted(upsert.insert_ignore(tgt, stg, ["k"]).collect()) == [(1, "a"), (2, "b"), (3, "C")]


def test_snapshot_replace_removes_sold(spark):
    sch = "as_of_date date, account_id string, symbol string, shares double, price double, market_value double"
    tgt = spark.createDataFrame([(D(2024, 1, 31), "A", "X", 1.0, 1.0, 1.0), (D(2024, 1, 31), "A", "Y", 1.0, 1.0, 1.0),
                                 (D(2024, 1, 31), "B", "X", 1.0, 1.0, 1.0)], sch)
    stg = spark.createDataFrame([(D(2024, 1, 31), "A", "Y", 2.0, 1.0, 2.0)], sch)
    out = sorted((r.account_id, r.symbol, r.shares) for r in upsert.snapshot_replace(tgt, stg).collect())
    assert out == [("A", "Y", 2.0), ("B", "X", 1.0)]


def test_update_by_key_takes_null(spark):
    tgt = spark.createDataFrame([("AAA", 0.1, 0.2), ("BBB", 0.3, 0.4)], "symbol string, dividend_yield double, qualified_ratio double")
    upd = spark.createDataFrame([("aaa", None)], "symbol string, dividend_yield double")
    out = {r.symbol: (r.dividend_yield, r.qualified_ratio)
           for r in upsert.update_columns_by_key(tgt, upd, "symbol", ["dividend_yield", "qualified_ratio"]).collect()}
    assert out == {"AAA": (None, 0.2), "BBB": (0.3, 0.4)}


def test_versioned_write(spark, tmp_path):
    root = str(tmp_path / "t")
    df1 = spark.createDataFrame([(1,)], "k int")
    upsert.write_version(df1, root)
    import time
    time.sleep(0.01)
    upsert.write_version(spark.createDataFrame([(2,), (3,)], "k int"), root)
    assert sorted(r.k for r in upsert.read_current(spark, root).collect()) == [2, 3]


# ------------------------------------------------------------------ budget
def test_budget_gap_fill(spark):
    b = spark.createDataFrame([("Food", 202511, 100.0), ("Food", 202602, 120.0), ("Rent", 202701, 5.0)],
                              "parent_category string, yyyymm int, budget_amount double")
    out = sorted((r.parent_category, r.yyyymm, r.budget_amount) for r in budget.budget_roll_forward(b, 202603).collect())
    assert out == [("Food", 202511, 100.0), ("Food", 202512, 100.0), ("Food", 202601, 100.0),
                   ("Food", 202602, 120.0), ("Food", 202603, 120.0), ("Rent", 202701, 5.0)]


# ------------------------------------------------------------------ projection
ASSUME = "Category string, Variable string, Value string, Start_Year string, Duration string"


def _assumptions(spark, extra):
    base = [("Global", "current_year", "2025", None, None), ("Global", "inflation_rate", "0.02", None, None),
            ("Global", "real_return_rate", "0.03", None, None), ("Global", "death_year", "2052", None, None)]
    return spark.createDataFrame(base + extra, ASSUME)


def test_lifetime_and_pre_inflate(spark):
    a = _assumptions(spark, [("Withdrawal", "trip", "100", "2027", "2"),
                             ("Withdrawal", "care", "10", "2050", "lifetime"),
                             ("Contribution", "save_monthly", "10", "2026", "1"),
                             ("Contribution", "match_pct", "0.05", "2026", "")])
    g, inflows, outflows = projection.expand_assumptions(a, 2025)
    out = {(r.Variable, r.Year): r.Value for r in outflows.collect()}
    assert round(out[("trip", 2027)], 6) == 104.04
    assert round(out[("trip", 2028)], 6) == round(104.04 * 1.02, 6)
    assert sorted(y for v, y in out if v == "care") == [2050, 2051, 2052]
    ins = {(r.Variable, r.Year): r.Value for r in inflows.collect()}
    assert ins == {("save_monthly", 2026): 120.0, ("match_pct", 2026): 0.05}


def test_missing_required_global_raises(spark):
    a = spark.createDataFrame([("Global", "inflation_rate", "0.02", None, None),
                               ("Global", "real_return_rate", "0.03", None, None),
                               ("Contribution", "x", "1", "2026", "1")], ASSUME)
    with pytest.raises(Exception, match="death_year"):
        projection.expand_assumptions(a, 2025)[1].collect()


def test_closed_form_equals_recursion(spark):
    sv = spark.createDataFrame([("A", 1000.0), ("B", None)], "account_id string, start_value double")
    c = spark.createDataFrame([("A", 2026, 100.0), ("A", 2025, 999.0), ("B", 2027, 50.0)],
                              "account_id string, year int, amount double")
    p = spark.createDataFrame([(2025, 2030, 0.05)], "start_year int, end_year int, g double")
    fold = {(r.account_id, r.year): r.value for r in projection.project_balances(sv, c, p).collect()}
    closed = {(r.account_id, r.year): r.value for r in projection.project_balances_closed_form(sv, c, p).collect()}
    v, ref = 1000.0, {}
    for y in range(2025, 2031):
        if y > 2025:
            v = (v + (100.0 if y == 2026 else 0.0)) * 1.05
        ref[("A", y)] = v
    assert fold[("A", 2025)] == 1000.0          # contributions in the start year are ignored
    for k, val in ref.items():
        assert fold[k] == pytest.approx(val, rel=1e-12)
        assert closed[k] == pytest.approx(val, rel=1e-12)
    assert fold[("B", 2027)] == pytest.approx(50.0 * 1.05)


def test_sold_position_counts_in_start_balance(spark):
    pe = spark.createDataFrame([(D(2024, 1, 31), "A", "OLD", 10.0), (D(2024, 2, 29), "A", "NEW", 5.0)],
                               "as_of_date date, account_id string, symbol string, value double")
    ad = spark.createDataFrame([("A", "Acct A", "Taxable", "me", True)],
                               "account_id string, account_name string, tax_bucket string, owner string, include_networth boolean")
    out = projection.starting_balances(pe, ad).collect()
    assert out[0].balance_today == 15.0              # T-13


# ------------------------------------------------------------------ tax
def test_brackets(spark):
    df = spark.createDataFrame([(x,) for x in (23850.0, 96950.0, 206700.0, 800000.0, -5.0)], "ti double")
    got = [round(r[0]) for r in df.select(tax.progressive_tax(F.col("ti"))).collect()]
    assert got == [2385, 11157, 35302, 208919, 0]


def test_continuous_brackets_are_continuous():
    br = tax.continuous_brackets()
    lo = 0
    for (hi, base, rate), nxt in zip(br, br[1:]):
        assert nxt[1] == pytest.approx(base + (hi - lo) * rate)
        lo = hi


# ------------------------------------------------------------------ windows
def test_keep_first_plan_is_partial_limit(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    df = keep_first(li, ["l_suppkey"], [F.col("l_shipdate").desc()])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_withdrawal_rates(spark):
    t = spark.createDataFrame([(2025, 100.0, -5.0), (2026, 200.0, -20.0), (2027, 0.0, -1.0)],
                              "year int, beg_balance double, outflows double")
    r = measures.withdrawal_rates(t).first()
    assert r.avg_withdrawal_rate == pytest.approx(25.0 / 300.0)
    assert r.initial_withdrawal_rate == pytest.approx(0.05)


def test_sequence_within_equals_window(spark):
    import random
    from pyspark.sql import Window
    random.seed(7)
    rows = [(random.choice(["a", "b", None]), random.choice([1, 2]), i) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, j int, row_idx long")
    got = {r.row_idx: r.seq for r in identity.sequence_within(df, ["k", "j"], "row_idx", "seq").collect()}
    w = Window.partitionBy("k", "j").orderBy("row_idx")
    ref = {r.row_idx: r.seq for r in df.withColumn("seq", F.row_number().over(w)).collect()}
    assert got == ref
