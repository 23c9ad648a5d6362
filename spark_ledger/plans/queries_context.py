"""Filter context, measures over two frames, previews and tax treatment."""

from __future__ import annotations

from pyspark.sql import functions as F

from spark_ledger.functions import month_label, round_to
from spark_ledger.operators import allocation, context, identity, projection, rollups, rules, treatment
from spark_ledger.operators.common import first_n, top_n
from spark_ledger.operators.context import Model, Relationship
from spark_ledger.plans.queries_core import TWC_NT_SQL, TWC_SQL, twc_frame
from spark_ledger.plans.queries_portfolio import M, PE_CTE, PE_SQL, R, _money_sql, _pe, _ratio_sql
from spark_ledger.plans.queries_retirement import BUDGET_CTES, LATEST_CTE, _rolled
from spark_ledger.plans.registry import register
from spark_ledger.session import written
from spark_ledger.sources.fixtures import Tables, with_clause


# ------------------------------------------------------------ E-14 --------
@register("filter_propagation", TWC_NT_SQL + """,
months AS (SELECT strftime(date, '%Y-%m') AS month FROM twc_nt GROUP BY 1 HAVING SUM(amount_cents) < 0)
SELECT top_bucket, month, COUNT(*) AS n, CAST(SUM(amount_cents) AS DOUBLE) / 100 AS amount
FROM (SELECT *, strftime(date, '%Y-%m') AS month FROM twc) t LEFT JOIN category_dim c ON c.category = t.category
WHERE month IN (FROM months) AND ifnull(top_bucket, 'Discretionary') = 'Discretionary' GROUP BY ALL""")
def q_filter_propagation(spark, sf_dir):
    """Transactions by bucket and month where two selections meet: months of
    negative cash flow (selected on the cash-flow table, which filters the month
    dimension in both directions) and the buckets 'Discretionary' or blank, the
    member of facts whose category the dimension does not hold."""
    t = Tables(spark, sf_dir)
    # a row's category depends on the row alone: given before the dedupe, texts need not travel; the
    # few columns that the model and the cash flow read are written once and read as often as they ask
    known = rules.categorize(t.transactions, t.category_rules, t.category_overrides)
    rows = written(identity.dedupe_transactions(known).select("date", "category", "amount_cents"))
    twc = rows.withColumn("month", month_label("date"))
    cash = rollups.monthly_cashflow(rows, t.category_dim)
    model = Model({"facts": twc, "category_dim": t.category_dim, "month_dim": twc.select("month").distinct(), "monthly_cashflow": cash}, [
        Relationship("facts", "category", "category_dim", "category"), Relationship("facts", "month", "month_dim", "month"),
        Relationship("monthly_cashflow", "month", "month_dim", "month", both=True)])
    bucket = F.col("top_bucket")
    ctx = model.select({"monthly_cashflow": F.col("net_cashflow") < 0, "category_dim": bucket.isNull() | (bucket == "Discretionary")})
    shown = model.axis(ctx, "facts", {"category_dim": ["top_bucket"]})
    return shown.groupBy("top_bucket", "month").agg(F.count("*").alias("n"), (F.sum("amount_cents").cast("double") / 100).alias("amount"))


# ------------------------------------------------------------ K7 / K9 / L-8
SELECTED_YEARS = ("1996", "1997")


@register("portfolio_weights", with_clause("positions", "security_dim", "account_dim", "target_allocation") + "," + PE_CTE + f""",
sel AS (SELECT * FROM pe WHERE month[1:4] IN {SELECTED_YEARS}),
v AS (SELECT month, asset_class, SUM(value) AS value FROM sel GROUP BY ALL)
SELECT month, asset_class, {_money_sql("value")} AS portfolio_value, {_money_sql("value")} AS check_sum, CAST(1 AS DOUBLE) AS actual_weight,
       {_ratio_sql("value / (SELECT SUM(value) FROM sel)")} AS weight_selected,
       {_ratio_sql("value / (SELECT SUM(value) FROM pe p WHERE p.month = v.month)")} AS weight_all,
       {_ratio_sql("target_weight")} AS target_weight, {_ratio_sql("1 - target_weight")} AS variance_weight,
       (SELECT MAX(month) FROM pe) AS latest_month
FROM v LEFT JOIN target_allocation USING (asset_class)""")
def q_portfolio_weights(spark, sf_dir):
    """Portfolio Value, Check Sum, Actual / Target / Variance Weight and Latest
    Month by month and class, two years selected; the weight over the selection and
    over all positions of the month beside the model's own (which divides a sum by
    itself)."""
    t = Tables(spark, sf_dir)
    everything = allocation.monthly_allocation(_pe(t))
    sel = everything.where(F.substring("month", 1, 4).isin(*SELECTED_YEARS))
    by = ["month", "asset_class"]
    own = context.share(sel, by, scope="self").withColumnRenamed("share", "actual_weight")
    of_all = context.share(sel, by, scope="all", everything=everything, within=("month",)).select(*by, F.col("share").alias("weight_all"))
    of_sel = context.share(sel, by, scope="selected").select(*by, F.col("share").alias("weight_selected"))
    target = allocation.allocation_vs_target(_pe(t), t.target_allocation).groupBy(*by).agg(F.avg("target_weight").alias("target_weight"))
    j = own.join(of_sel, by).join(of_all, by).join(target, by, "left")
    return j.select(*by, round_to("value", M).alias("portfolio_value"), round_to("value", M).alias("check_sum"), "actual_weight",
                    round_to("weight_selected", R).alias("weight_selected"), round_to("weight_all", R).alias("weight_all"),
                    round_to("target_weight", R).alias("target_weight"),
                    round_to(F.col("actual_weight") - F.col("target_weight"), R).alias("variance_weight"),
                    context.latest_month(everything).alias("latest_month"))


SELECTIONS = {"none": None, "one": ["1997-06"], "several": ["1997-01", "1997-02", "1998-03"]}


@register("latest_value_by_selection", PE_SQL + " UNION ALL ".join(
    f"SELECT '{name}' AS selection, {_money_sql('SUM(value)')} AS value FROM pe WHERE month "
    + (f"IN ({', '.join(repr(m) for m in months)})" if months else "= (SELECT MAX(month) FROM pe)") for name, months in SELECTIONS.items()))
def q_latest_value_by_selection(spark, sf_dir):
    """Portfolio Value (Latest) with no month, one month and several selected."""
    everything = allocation.monthly_allocation(_pe(Tables(spark, sf_dir)))
    parts = [context.latest_value(everything, months).select(F.lit(name).alias("selection"), round_to("value", M).alias("value"))
             for name, months in SELECTIONS.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ------------------------------------------------------------ G-5 / H-2 / H-3
@register("budget_preview", with_clause("transactions", "budgets") + BUDGET_CTES + """
SELECT * FROM rolled QUALIFY ROW_NUMBER() OVER (PARTITION BY parent_category ORDER BY yyyymm DESC) <= 3""")
def q_budget_preview(spark, sf_dir):
    """The last three budget months of each category."""
    return first_n(_rolled(Tables(spark, sf_dir)), ["parent_category"], [F.col("yyyymm").desc()], 3)


@register("top_spending", TWC_SQL + """
SELECT description, COUNT(*) AS n, -CAST(SUM(amount_cents) AS DOUBLE) / 100 AS spent FROM twc WHERE amount_cents < 0
GROUP BY description ORDER BY SUM(amount_cents), description LIMIT 25""")
def q_top_spending(spark, sf_dir):
    """The 25 descriptions with most outflows, largest first, ties by text."""
    g = twc_frame(Tables(spark, sf_dir)).where("amount_cents < 0").groupBy("description").agg(F.count("*").alias("n"), F.sum("amount_cents").alias("c"))
    return top_n(g, [F.col("c").asc(), F.col("description").asc()], 25).select("description", "n", (-F.col("c").cast("double") / 100).alias("spent"))


# ------------------------------------------------------------ J-20 --------
ORDINARY, QUALIFIED, STATE = 0.3, 0.15, 0.05


@register("dividends_by_treatment", with_clause("positions", "security_dim", "account_dim", "security_yields") + "," + PE_CTE + "," + LATEST_CTE + f""",
d AS (SELECT COALESCE(lower(trim(tax_treatment)), 'standard') AS treatment, ifnull(acct_group = 'Liquid', FALSE) AS spendable,
             h.value * COALESCE(yield_forward, yield_trailing) AS gross, CASE WHEN qualified_ratio = 999 THEN 0 ELSE 1 END AS due, qualified_ratio AS q
      FROM held h JOIN security_yields USING (symbol) LEFT JOIN account_dim USING (account_id) WHERE COALESCE(yield_forward, yield_trailing) IS NOT NULL),
x AS (SELECT *, gross * due * (treatment <> 'muni')::INT * ({ORDINARY} - q * ({ORDINARY} - {QUALIFIED})) AS fed,
             gross * due * (treatment NOT IN ('muni', 'treasury'))::INT * {STATE} AS state FROM d)
SELECT treatment, {_money_sql("SUM(gross)")} AS gross, {_money_sql("SUM(fed)")} AS federal_tax, {_money_sql("SUM(state)")} AS state_tax,
       {_money_sql("SUM(gross - fed - state)")} AS net, {_money_sql("COALESCE(SUM(gross - fed - state) FILTER (WHERE spendable), 0)")} AS spendable_net
FROM x GROUP BY treatment""")
def q_dividends_by_treatment(spark, sf_dir):
    """Dividends of the latest holdings by tax treatment, and what of them can be
    spent before retirement."""
    t = Tables(spark, sf_dir)
    inc = t.account_dim.where("not include_networth").select("account_id")
    held = projection.latest_positions(_pe(t)).join(inc, "account_id", "left_anti").select("account_id", "symbol", "value")
    d = treatment.treated_dividends(held, t.security_yields, t.account_dim, ORDINARY, QUALIFIED, STATE)
    return d.groupBy("treatment").agg(*(round_to(F.sum(c), M).alias(c) for c in ("gross", "federal_tax", "state_tax", "net", "spendable_net")))
