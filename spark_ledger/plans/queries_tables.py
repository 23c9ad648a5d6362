"""Readers, sinks and cleaners over written tables, and the remaining measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from spark_ledger.functions import round_to
from spark_ledger.operators import budget, calendar, cleaning, measures, projection, rollups
from spark_ledger.operators.common import maybe_broadcast
from spark_ledger.plans.queries_core import TWC_NT_SQL, twc_frame
from spark_ledger.plans.queries_portfolio import BAL_ENRICHED_SQL, CAL_CTES, M, MNW_SELECT, PE_SQL, R, _cal_sources, _money_sql, _pe, _ratio_sql
from spark_ledger.plans.queries_retirement import BTD_CTES, BUDGET_CTES, MEASURE_CTES, RET_SQL, TODAY_YEAR, _retirement_inputs, _rolled, _v_sql
from spark_ledger.plans.raw_exports import export_root, write_bank_exports
from spark_ledger.plans.registry import register
from spark_ledger.plans.sql_snippets import CATEGORIZE_CTES, DEDUP_CTES, NON_TRANSFER_CTE, TWC_FIXTURES
from spark_ledger.sources import files, readers, sinks
from spark_ledger.sources.fixtures import Tables, with_clause

SECURITY_SCHEMA = ("symbol string, asset_class string, region string, style string, size string, expense_ratio decimal(9,6), "
                   "dividend_yield double, qualified_ratio double")


# ------------------------------------------------------- A-1 / A-2 / A-9 / B-14
@register("reload_security_dim", with_clause("security_dim") + """
SELECT symbol, asset_class, region, style, size, CAST(expense_ratio AS DECIMAL(9, 6)) AS expense_ratio, dividend_yield, qualified_ratio FROM security_dim""")
def q_reload_security_dim(spark, sf_dir):
    """The security dimension written as CSV (padded names, other column order, an
    extra column), read as text and inserted by name into the fixed schema."""
    t = Tables(spark, sf_dir)
    path = export_root(t, "security_dim")
    d = t.security_dim
    sinks.write_csv(d.select("qualified_ratio", F.concat(F.lit(" "), "symbol", F.lit("  ")).alias("Symbol"), "region", "asset_class", "style", "size",
                             "dividend_yield", "expense_ratio", F.lit("x").alias("comment")), path)
    return cleaning.clean_security_dim(readers.read_csv(spark, path), SECURITY_SCHEMA)


@register("clean_budget_and_targets", with_clause("budgets", "target_allocation") + """
SELECT 'budget' AS kind, parent_category AS name, make_date(yyyymm // 100, yyyymm % 100, 1) AS month, CAST(budget_amount AS DOUBLE) AS amount FROM budgets
UNION ALL SELECT 'target', asset_class, NULL, ROUND(target_weight * 1000000) / 1000000 FROM target_allocation""")
def q_clean_budget_and_targets(spark, sf_dir):
    """Monthly budgets with first-of-month text dates and target weights with
    padded classes, cleaned to their typed tables."""
    t = Tables(spark, sf_dir)
    b = cleaning.clean_budget_monthly(t.budgets.select(
        F.concat_ws("/", F.expr("yyyymm % 100"), F.lit("1"), F.expr("yyyymm div 100")).alias("Month"), F.col("parent_category").alias("Category"),
        F.format_string("$%,.2f", "budget_amount").alias("Amount")))
    w = cleaning.clean_target_allocation(t.target_allocation.select(F.concat(F.lit(" "), "asset_class").alias("asset_class"),
                                                                   F.col("target_weight").cast("string").alias("target_weight")))
    return b.select(F.lit("budget").alias("kind"), F.col("category").alias("name"), "month", "amount").unionByName(
        w.select(F.lit("target").alias("kind"), F.col("asset_class").alias("name"), F.lit(None).cast("date").alias("month"),
                 (F.round(F.col("target_weight") * 1000000) / 1000000).alias("amount")))


# ------------------------------------------------------------ A-5 / A-7 ----
@register("export_and_union", PE_SQL + f"""
SELECT month, COUNT(*) AS n, {_money_sql('SUM(value)')} AS value FROM pe GROUP BY month""")
def q_export_and_union(spark, sf_dir):
    """Enriched positions exported as Parquet tables at two depths (a missing table
    is skipped), read back as one dataset."""
    t = Tables(spark, sf_dir)
    root, pe = export_root(t, "exports"), _pe(t)
    late = F.col("month") >= "1995"
    names = sinks.export_parquet({"positions": pe.where(~late), "absent": None}, root)
    names += ["deep/" + n for n in sinks.export_parquet({"positions": pe.where(late)}, f"{root}/deep")]
    every = readers.read_parquet_union(spark, [f"{root}/{n}.parquet" for n in names])
    if readers.read_parquet_optional(spark, f"{root}/absent.parquet") is not None:
        raise ValueError("a table that was not given has been written")
    return every.groupBy("month").agg(F.count("*").alias("n"), round_to(F.sum("value"), M).alias("value"))


# ------------------------------------------------------------ F-7 / A-10 ---
@register("staged_files", with_clause("transactions") + """,
x AS (SELECT CAST(substr(account_id, 2) AS INT) AS s FROM transactions)
SELECT CASE WHEN s % 2 = 0 THEN 'chase' ELSE 'amex' END AS vendor, COUNT(DISTINCT CASE WHEN s % 2 = 0 THEN s % 4 ELSE s % 3 END) AS files, COUNT(*) AS n
FROM x GROUP BY 1""")
def q_staged_files(spark, sf_dir):
    """Files and rows staged by vendor."""
    root = write_bank_exports(Tables(spark, sf_dir))
    rows = files.parse_files(files.raw_lines(spark, root))
    vendor, _ = files.path_parts()
    return rows.select(vendor, "source_file").groupBy("vendor").agg(F.count_distinct("source_file").alias("files"), F.count("*").alias("n"))


# ------------------------------------------------------------ B-16 ---------
@register("clean_positions", with_clause("positions") + """
SELECT as_of_date, account_id, symbol, shares, CASE WHEN account_id LIKE '%1' THEN NULL ELSE ROUND(price * 1000000) / 1000000 END AS price,
       ROUND(market_value * 100) / 100 AS market_value FROM positions""")
def q_clean_positions(spark, sf_dir):
    """Positions exported as text (lower-case accounts, padded symbols, some prices
    that are no numbers), cleaned."""
    p = Tables(spark, sf_dir).positions
    raw = p.select(F.col("as_of_date").cast("string").alias("as_of_date"), F.concat(F.lower("account_id"), F.lit(" ")).alias("account_id"),
                   F.concat(F.lit(" "), "symbol").alias("symbol"), F.col("shares").cast("string").alias("shares"),
                   F.when(F.col("account_id").endswith("1"), F.lit("n/a")).otherwise(F.col("price").cast("string")).alias("price"),
                   F.col("market_value").cast("string").alias("market_value"))
    c = cleaning.clean_positions(raw)
    return c.withColumn("price", round_to("price", 6)).withColumn("market_value", round_to("market_value", M))


# ------------------------------------------------------------ A-17 / K28 ---
@register("month_columns", CAL_CTES + """,
m AS (SELECT make_date(year(d), month(d), 1) AS month FROM days GROUP BY 1)
SELECT month, month AS month_start, CAST(year(month) * 100 + month(month) AS INT) AS yyyymm, last_day(month) AS month_end, CAST(year(month) AS INT) AS year,
       'Q' || quarter(month) || ' ' || year(month) AS quarter_year FROM m""")
def q_month_columns(spark, sf_dir):
    """The month dimension's calculated columns, from its text months."""
    import datetime as dt
    t = Tables(spark, sf_dir)
    m = calendar.month_dim(calendar.calendar_dim(spark, _cal_sources(t), today=dt.date(2025, 1, 1)))
    text = m.select(F.date_format("month", "yyyy-MM").alias("month"))
    named = dict(MonthStart="month_start", MonthEnd="month_end", Year="year", QuarterYear="quarter_year")
    return text.select(*calendar.month_dim_columns(calendar.month_date("month"))).withColumnsRenamed(named)


# ------------------------------------------------------------ J-15 ---------
@register("inflated_balances", f"""
SELECT c_custkey AS customer, CAST(2025 + n AS INT) AS year, {_v_sql('c_acctbal * pow(1.03, n)')} AS value
FROM customer JOIN range(0, 25) AS every(n) ON n <= c_nationkey""")
def q_inflated_balances(spark, sf_dir):
    """Customer balances inflated at 3 % for as many years as the nation's number."""
    c = Tables(spark, sf_dir).customer
    series = projection.inflate_series(F.col("c_acctbal").cast("double"), F.lit(2025), F.lit(2025) + F.col("c_nationkey").cast("int"), F.lit(0.03))
    return c.select(F.col("c_custkey").alias("customer"), F.inline(series)).select("customer", F.col("year").cast("int").alias("year"),
                                                                                  round_to("value", 6).alias("value"))


# ------------------------------------------------------- K13 / K14 / K16 ---
@register("return_measures", RET_SQL + MEASURE_CTES + f""",
r AS (SELECT CAST(y AS INT) AS year, dividends, inflows, outflows, dividends / NULLIF(pv, 0) AS dy, COALESCE(real_r, 0) AS rr, COALESCE(infl, 0) AS ii
      FROM range(2024, 2101) AS every(y) LEFT JOIN fy ON fy.year = y, world)
SELECT year, {_money_sql('dividends')} AS dividends_net, {_money_sql('inflows')} AS inflows, {_money_sql('-outflows')} AS outflows,
       {_money_sql('COALESCE(inflows + outflows, inflows, outflows)')} AS net_flow,
       {_money_sql('CASE WHEN COALESCE(inflows, outflows, dividends) IS NOT NULL THEN COALESCE(inflows, 0) + COALESCE(outflows, 0) + COALESCE(dividends, 0) END')}
         AS net_flow_with_dividends,
       {_ratio_sql('rr + ii + rr * ii')} AS nominal_total_return, {_ratio_sql('dy')} AS dividend_yield,
       {_ratio_sql('(1 + rr) / (1 + COALESCE(dy, 0)) - 1')} AS return_ex_div_real,
       {_ratio_sql('(1 + rr) * (1 + ii) / (1 + COALESCE(dy, 0)) - 1')} AS return_ex_div_nominal
FROM r""")
def q_return_measures(spark, sf_dir):
    """Dividends, flows and returns by year."""
    years, cf, dfy, _, g = _retirement_inputs(spark, Tables(spark, sf_dir), need=("cf", "dfy", "g"))
    m = measures.return_measures(years, cf, dfy, g)
    return m.select("year", *(round_to(c, M).alias(c) for c in ("dividends_net", "inflows", "outflows", "net_flow", "net_flow_with_dividends")),
                    *(round_to(c, R).alias(c) for c in ("nominal_total_return", "dividend_yield", "return_ex_div_real", "return_ex_div_nominal")))


@register("net_worth_line", RET_SQL + MEASURE_CTES + f"""
SELECT year, {_money_sql('end_balance')} AS net_worth FROM eb WHERE year > 2024 AND year <= 2080""")
def q_net_worth_line(spark, sf_dir):
    """L-10: Net Worth (EOY) by year, page filter 2024 < Year <= 2080."""
    e = measures.end_balance_by_year(*_retirement_inputs(spark, Tables(spark, sf_dir)), TODAY_YEAR)
    return e.where("year > 2024 and year <= 2080").select("year", round_to("end_balance", M).alias("net_worth")).orderBy("year")


# ------------------------------------------------------------ K4 / K5 ------
@register("cashflow_measures", TWC_NT_SQL + """
SELECT CAST(year(date) AS INT) AS year, CAST(SUM(amount_cents) FILTER (WHERE amount_cents > 0) AS DOUBLE) / 100 AS cf_income,
       CAST(-SUM(amount_cents) FILTER (WHERE amount_cents < 0) AS DOUBLE) / 100 AS cf_spending, CAST(SUM(amount_cents) AS DOUBLE) / 100 AS cf_net
FROM twc_nt GROUP BY 1""")
def q_cashflow_measures(spark, sf_dir):
    """CF Income, CF Spending (sign flipped) and CF Net by year."""
    t = Tables(spark, sf_dir)
    m = rollups.monthly_cashflow(twc_frame(t), t.category_dim).withColumn("year", F.substring("month", 1, 4).cast("int"))
    return m.groupBy("year").agg(round_to(F.sum("income"), M).alias("cf_income"), round_to(-F.sum("spending"), M).alias("cf_spending"),
                                 round_to(F.sum("net_cashflow"), M).alias("cf_net"))


@register("net_worth_liquid", BAL_ENRICHED_SQL + ", mnw AS (" + MNW_SELECT + """)
SELECT CAST(month[1:4] AS INT) AS year, arg_max(liquid_net_worth, month) AS nw_liquid FROM mnw GROUP BY 1""")
def q_net_worth_liquid(spark, sf_dir):
    """NW Liquid at the last month of each year."""
    t = Tables(spark, sf_dir)
    m = rollups.monthly_net_worth(t.balance_snapshot, t.account_dim, scale=M).withColumn("year", F.substring("month", 1, 4).cast("int"))
    return rollups.net_worth_eop(m, ["year"], ("liquid_net_worth",)).withColumnRenamed("liquid_net_worth", "nw_liquid")


# ------------------------------------------------------------ L-5 ----------
@register("budget_bars", with_clause(*TWC_FIXTURES, "category_dim", "budgets") + "," + DEDUP_CTES + "," + CATEGORIZE_CTES + ","
          + NON_TRANSFER_CTE + BUDGET_CTES + BTD_CTES + f""",
act AS (SELECT CAST(year(date) AS INT) AS year, parent_category, -CAST(SUM(amount_cents) AS DOUBLE) / 100 AS actual_spend
        FROM twc_nt JOIN category_dim USING (category) GROUP BY ALL)
SELECT year, parent_category, {_money_sql('budget_to_date')} AS budget_to_date, {_money_sql('actual_spend')} AS actual_spend
FROM btd FULL JOIN act USING (year, parent_category)""")
def q_budget_bars(spark, sf_dir):
    """L-5: budget to date beside actual spending, every year and parent category."""
    t = Tables(spark, sf_dir)
    dim = maybe_broadcast(t.category_dim.select("category", "parent_category"))
    act = rollups.non_transfer(twc_frame(t), t.category_dim).join(dim, "category").groupBy(F.year("date").alias("year"), "parent_category").agg(
        (-F.sum("amount_cents").cast("double") / 100).alias("actual_spend"))
    b = budget.budget_to_date(t.transactions, _rolled(t)).withColumn("year", F.col("year").cast("int"))
    return b.join(act, ["year", "parent_category"], "full").select("year", "parent_category", round_to("budget_to_date", M).alias("budget_to_date"),
                                                                  round_to("actual_spend", M).alias("actual_spend"))
