"""Report cards, slicers and budget measures (L-2, L-3, L-7, L-13; K), and the
cleaning loaders (B-14 ... B-18) over inputs derived from the full tables."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from spark_ledger.functions import round_to
from spark_ledger.operators import allocation, cleaning, measures, rollups
from spark_ledger.plans.queries_core import TWC_NT_SQL, twc_frame
from spark_ledger.plans.queries_portfolio import BAL_ENRICHED_SQL, M, PE_SQL, R, _money_sql, _pe, _ratio_sql, _signed
from spark_ledger.plans.queries_retirement import BUDGET_CTES, _rolled
from spark_ledger.plans.registry import register
from spark_ledger.plans.sql_snippets import CATEGORIZE_CTES, DEDUP_CTES, NON_TRANSFER_CTE, TWC_FIXTURES
from spark_ledger.sources.fixtures import Tables, with_clause

# The buckets shown by the monthly amount chart.
CHART_BUCKETS = ["Discretionary", "Fixed", "Income"]


def _with_dim(twc, cd):
    c = cd.select(F.col("category").alias("__c"), "parent_category", "top_bucket")
    return twc.join(c, twc["category"] == c["__c"], "left").drop("__c")


# ------------------------------------------------------------ L-2 ---------
@register("amount_by_month_bucket", TWC_NT_SQL + """
SELECT CAST(strftime(t.date, '%Y%m') AS INT) AS yyyymm, cd.top_bucket,
       CAST(SUM(t.amount_cents) AS DOUBLE) / 100.0 AS amount
FROM twc_nt t JOIN category_dim cd ON cd.category = t.category
WHERE cd.top_bucket IN ('Discretionary', 'Fixed', 'Income')
GROUP BY 1, 2""")
def q_amount_by_month_bucket(spark, sf_dir):
    """L-2: amount by yyyymm for the chart's top buckets (transfers removed)."""
    t = Tables(spark, sf_dir)
    j = _with_dim(rollups.non_transfer(twc_frame(t), t.category_dim), t.category_dim)
    j = j.filter(F.col("top_bucket").isin(*CHART_BUCKETS))
    return j.groupBy((F.year("date") * 100 + F.month("date")).cast("int").alias("yyyymm"), "top_bucket").agg(
        (F.sum("amount_cents").cast("double") / 100.0).alias("amount"))


# ------------------------------------------------------------ L-7 ---------
@register("latest_portfolio_value", PE_SQL + f"""
SELECT month, {_money_sql('SUM(value)')} AS portfolio_value FROM pe
WHERE month = (SELECT MAX(month) FROM pe) GROUP BY month""")
def q_latest_portfolio_value(spark, sf_dir):
    """L-7 / Portfolio Value (Latest): total allocation value of the latest
    month (no month selected)."""
    ma = allocation.monthly_allocation(_pe(Tables(spark, sf_dir)))
    latest = ma.agg(F.max("month")).scalar()
    return ma.filter(F.col("month") == latest).groupBy("month").agg(
        round_to(F.sum("value"), M).alias("portfolio_value"))


# ------------------------------------------------------------ L-13 --------
@register("slicer_months", with_clause("transactions") + """
SELECT DISTINCT strftime(date, '%Y-%m') AS month FROM transactions""")
def q_slicer_months(spark, sf_dir):
    """L-13: the month slicer's values, newest first."""
    from spark_ledger.plans.reports import slicer_values
    t = Tables(spark, sf_dir).transactions
    return slicer_values(t.select(F.date_format("date", "yyyy-MM").alias("month")), "month")


# ------------------------------------------------------------ K: NW % -----
@register("net_worth_group_pct", BAL_ENRICHED_SQL + f""",
g AS (SELECT month, acct_group, {_signed("counts")} AS value FROM be GROUP BY ALL),
y AS (SELECT CAST(substr(month, 1, 4) AS INTEGER) AS year, * FROM g),
last AS (SELECT year, MAX(month) AS m FROM y GROUP BY year),
e AS (SELECT y.year, y.acct_group, y.value FROM y JOIN last ON last.year = y.year AND last.m = y.month)
SELECT year, acct_group, value,
       {_ratio_sql("CASE WHEN SUM(value) OVER (PARTITION BY year) <> 0 THEN value / SUM(value) OVER (PARTITION BY year) END")} AS pct
FROM e""")
def q_net_worth_group_pct(spark, sf_dir):
    """NW By Group (EOP) and NW Group % per year: each group's value in the
    year's last month over that month's total (the frame is already
    aggregated to year x group, so the window is small)."""
    t = Tables(spark, sf_dir)
    g = rollups.monthly_net_worth_by_group(t.balance_snapshot, t.account_dim, scale=M)
    g = g.withColumn("year", F.substring("month", 1, 4).cast("int"))
    # the EOP month is the year's last month for every group
    last = g.groupBy("year").agg(F.max("month").alias("__m"))
    e = g.join(last, "year").filter(F.col("month") == F.col("__m")).select("year", "acct_group", "value")
    tot = F.sum("value").over(Window.partitionBy("year"))
    return e.select("year", "acct_group", "value", round_to(measures.divide(F.col("value"), tot), R).alias("pct"))


# ------------------------------------------------------------ K: budget ---
@register("budget_vs_actual", with_clause(*TWC_FIXTURES, "category_dim", "budgets") + "," + DEDUP_CTES + ","
          + CATEGORIZE_CTES + "," + NON_TRANSFER_CTE + BUDGET_CTES + f""",
act AS (SELECT CAST(strftime(t.date, '%Y%m') AS INT) AS yyyymm, cd.parent_category,
               CAST(SUM(t.amount_cents) AS DOUBLE) / 100.0 AS actual_amount
        FROM twc_nt t JOIN category_dim cd ON cd.category = t.category GROUP BY 1, 2),
bud AS (SELECT yyyymm, parent_category, SUM(budget_amount) AS budget_amount FROM rolled GROUP BY 1, 2),
j AS (SELECT COALESCE(a.yyyymm, b.yyyymm) AS yyyymm, COALESCE(a.parent_category, b.parent_category) AS parent_category,
             b.budget_amount, a.actual_amount
      FROM act a FULL JOIN bud b ON a.yyyymm = b.yyyymm AND a.parent_category = b.parent_category)
SELECT yyyymm, parent_category, {_money_sql('budget_amount')} AS budget_amount, {_money_sql('actual_amount')} AS actual_amount,
       {_money_sql('COALESCE(actual_amount, 0.0) - COALESCE(budget_amount, 0.0)')} AS variance,
       {_ratio_sql('CASE WHEN budget_amount <> 0 THEN (COALESCE(actual_amount, 0.0) - COALESCE(budget_amount, 0.0)) / budget_amount END')} AS variance_pct
FROM j""")
def q_budget_vs_actual(spark, sf_dir):
    """Budget Amount, Actual Amount, Variance (actual - budget, blanks as 0)
    and Variance % by month and parent category."""
    t = Tables(spark, sf_dir)
    j = _with_dim(rollups.non_transfer(twc_frame(t), t.category_dim), t.category_dim).filter(
        F.col("parent_category").isNotNull())
    act = j.groupBy((F.year("date") * 100 + F.month("date")).cast("int").alias("yyyymm"), "parent_category").agg(
        (F.sum("amount_cents").cast("double") / 100.0).alias("actual_amount"))
    bud = _rolled(t).groupBy("yyyymm", "parent_category").agg(F.sum("budget_amount").alias("budget_amount"))
    x = act.join(bud, ["yyyymm", "parent_category"], "full")
    var = F.coalesce(F.col("actual_amount"), F.lit(0.0)) - F.coalesce(F.col("budget_amount"), F.lit(0.0))
    return x.select("yyyymm", "parent_category", round_to("budget_amount", M).alias("budget_amount"),
                    round_to("actual_amount", M).alias("actual_amount"), round_to(var, M).alias("variance"),
                    round_to(measures.divide(var, F.col("budget_amount")), R).alias("variance_pct"))


# ------------------------------------------------------------ B-14 --------
@register("clean_account_dim", with_clause("account_dim") + """
SELECT TRIM(' ' || account_id || ' ') AS account_id, TRIM(COALESCE(account_name || '  ', '')) AS account_name,
       TRIM(COALESCE(CASE WHEN owner = 'A' THEN NULL ELSE owner END, '')) AS owner,
       TRIM(COALESCE(type, '')) AS type, TRIM(COALESCE(acct_group, '')) AS acct_group,
       TRIM(COALESCE(tax_bucket, '')) AS tax_bucket, TRIM(COALESCE(liquidity, '')) AS liquidity,
       include_networth AS include_networth, include_liquid AS include_liquid
FROM account_dim""")
def q_clean_account_dim(spark, sf_dir):
    """Account dimension loaded from text with padding, blanks and yes/0 /
    true/false flags, cleaned back to the typed dimension."""
    a = Tables(spark, sf_dir).account_dim
    raw = a.select(F.concat(F.lit(" "), "account_id", F.lit(" ")).alias("account_id"),
                   F.concat("account_name", F.lit("  ")).alias("account_name"),
                   F.when(F.col("owner") != "A", F.col("owner")).alias("owner"),
                   "type", "acct_group", "tax_bucket", "liquidity",
                   F.when(F.col("include_networth"), F.lit(" Yes")).otherwise(F.lit("0")).alias("include_networth"),
                   F.col("include_liquid").cast("string").alias("include_liquid"))
    return cleaning.clean_account_dim(raw)


# ------------------------------------------------------------ B-15 --------
@register("clean_balances", """
SELECT last_day(CAST(o_orderdate AS DATE)) AS as_of_date, 'S' || CAST(o_custkey % 100 AS STRING) AS account_id,
       CASE WHEN o_orderpriority LIKE '5%' THEN 0.0 ELSE o_totalprice END AS balance
FROM orders""")
def q_clean_balances(spark, sf_dir):
    """Balance rows exported with ``account`` / ``amount`` headers and text
    values (non-numeric for one priority) cleaned to (as_of_date,
    account_id, balance)."""
    o = Tables(spark, sf_dir).orders
    raw = o.select(F.last_day(F.col("o_orderdate").cast("date")).cast("string").alias("as_of_date"),
                   F.concat(F.lit("S"), (F.col("o_custkey") % 100).cast("string")).alias("Account"),
                   F.when(F.col("o_orderpriority").startswith("5"), F.lit("n/a"))
                    .otherwise(F.col("o_totalprice").cast("string")).alias("Amount"))
    return cleaning.clean_balances(raw)


# ------------------------------------------------------------ B-17 --------
@register("backfill_cents", with_clause("transactions") + """
SELECT txn_id, COALESCE(CASE WHEN txn_id LIKE '%-d' THEN NULL ELSE amount_cents END,
                        CAST(ROUND(amount * 100) AS BIGINT)) AS amount_cents,
       CAST(NULL AS VARCHAR) AS memo, CAST(NULL AS VARCHAR) AS tags, FALSE AS is_transfer
FROM transactions""")
def q_backfill_cents(spark, sf_dir):
    """An older table without memo/tags/is_transfer and with missing cents
    for the duplicated lines, migrated: columns added, cents backfilled."""
    t = Tables(spark, sf_dir).transactions
    old = t.select("txn_id", "amount", F.when(~F.col("txn_id").endswith("-d"), F.col("amount_cents"))
                   .alias("amount_cents"))
    return cleaning.backfill_cents(old).select("txn_id", "amount_cents", "memo", "tags", "is_transfer")


# ------------------------------------------------------------ B-18 --------
@register("generic_csv_normalize", with_clause("transactions") + """
SELECT date, description AS merchant,
       CASE WHEN txn_id LIKE '%-oc' THEN 0.0 ELSE amount END AS amount,
       account_id, CAST(NULL AS VARCHAR) AS category, CAST(NULL AS VARCHAR) AS subcategory, txn_id AS memo
FROM transactions""")
def q_generic_csv_normalize(spark, sf_dir):
    """A generic export (Transaction Date / Payee / Amt / Account Name /
    Notes, text values, unparseable amounts on the pending twins)
    normalized to the standard columns."""
    t = Tables(spark, sf_dir).transactions
    raw = t.select(F.date_format("date", "yyyy-MM-dd").alias("Transaction Date"),
                   F.concat(F.lit("  "), "description").alias("Payee"),
                   F.when(F.col("txn_id").endswith("-oc"), F.lit("n/a")).otherwise(F.col("amount").cast("string"))
                    .alias("Amt"),
                   F.col("account_id").alias("Account Name"), F.col("txn_id").alias("Notes"))
    return cleaning.normalize_generic(raw)
