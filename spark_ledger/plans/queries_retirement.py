"""Retirement, budget and tax queries over the full fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from spark_ledger.functions import round_to
from spark_ledger.operators import allocation, budget, measures, projection, tax
from spark_ledger.plans import reports
from spark_ledger.plans.queries_core import TWC_SQL, twc_frame
from spark_ledger.plans.sql_snippets import CATEGORIZE_CTES, DEDUP_CTES, NON_TRANSFER_CTE, TWC_FIXTURES
from spark_ledger.plans.queries_portfolio import PE_CTE, _money_sql, _ratio_sql
from spark_ledger.plans.registry import register
from spark_ledger.session import cut_lineage
from spark_ledger.sources.fixtures import Tables, with_clause

TODAY_YEAR = 2025      # "today" is an argument so results repeat
M, R, V = 2, 10, 6     # money, ratio and projected-value scales


def _v_sql(x):
    return f"ROUND(({x}) * 1000000) / 1000000"


LIFE_SQL = "['lifetime', 'life', 'perpetuity', 'forever']"
HINTS_SQL = "[" + ", ".join(f"'{h}'" for h in projection.RATE_VAR_HINTS) + "]"


def _text(c):
    return f"CASE WHEN NOT list_contains(['', 'NA', 'None'], trim({c})) THEN {c} END"


def _whole(c):
    return f"CAST(ROUND(TRY_CAST(trim({c}) AS DOUBLE)) AS INT)"


# J-14: each timed row meets the years it covers; growth is one exponent, the years
# from the base (never before it) to the start plus the years since the start.
EXPAND_CTES = f"""
said AS (
  SELECT lower(trim(COALESCE({_text('category')}, ''))) AS kind, {_text('variable')} AS variable, lower(COALESCE({_text('variable')}, '')) AS word,
         TRY_CAST(trim({_text('value')}) AS DOUBLE) AS amount, {_text('value')} AS value_text, {_text('start_year')} AS start_text,
         {_whole(_text('start_year'))} AS begins, {_text('duration')} AS lasts, COALESCE({_text('applies_to')}, '') AS applies_to
  FROM retirement_assumptions),
gl AS (SELECT variable AS "Variable", amount AS "Value" FROM said WHERE start_text IS NULL),
world AS (
  SELECT MAX(amount) FILTER (WHERE variable = 'inflation_rate') AS infl, MAX(amount) FILTER (WHERE variable = 'real_return_rate') AS real_r,
         CAST(MAX(amount) FILTER (WHERE variable = 'death_year') AS INT) AS death,
         CAST(COALESCE(MAX(amount) FILTER (WHERE variable = 'current_year'), {TODAY_YEAR}) AS INT) AS base
  FROM said WHERE start_text IS NULL),
spans AS (
  SELECT kind, variable, applies_to, begins, amount * CASE WHEN contains(word, '_monthly') AND NOT rate THEN 12 ELSE 1 END AS amount,
         begins + CASE WHEN lasts IS NULL THEN 0 WHEN list_contains({LIFE_SQL}, lower(trim(lasts))) THEN death - begins
                       ELSE {_whole('lasts')} - 1 END AS ends,
         NOT rate AND (kind = 'withdrawal' OR contains(word, 'socialsecurity')) AS grows, infl, base
  FROM (SELECT *, list_contains({HINTS_SQL}, word) OR regexp_matches(word, '(_rate|_pct|_percentage)$') AS rate FROM said), world
  WHERE begins IS NOT NULL),
flows AS (
  SELECT kind, CAST(y AS INT) AS "Year", variable AS "Variable",
         amount * CASE WHEN grows THEN pow(1 + infl, greatest(begins, base) - base + y - begins) ELSE 1 END AS "Value",
         '' AS account_id, applies_to, '' AS "Notes"
  FROM spans JOIN range(1900, 2300) AS every(y) ON y BETWEEN begins AND ends),
ret_inflows AS (SELECT * EXCLUDE (kind) FROM flows WHERE kind = 'contribution'),
ret_outflows AS (SELECT * EXCLUDE (kind) FROM flows WHERE kind = 'withdrawal')"""

# J-13: every parameter has candidates in order of preference; the first known one counts.
PARAMS_CTES = f"""
given AS (SELECT word, MAX(value_text) AS v FROM said GROUP BY word),
options AS (
  SELECT 'start_year' AS name, 1 AS place, MIN(begins)::DOUBLE AS v FROM said
  UNION ALL SELECT 'start_year', 2, {_whole('v')} FROM given WHERE word = 'current_year'
  UNION ALL SELECT 'start_year', 3, {TODAY_YEAR}
  UNION ALL SELECT 'end_year', 1, {_whole('v')} FROM given WHERE word = 'end_year'
  UNION ALL SELECT 'end_year', 2, COALESCE((SELECT {_whole('v')} FROM given WHERE word = 'death_year'), 2100)
            FROM said WHERE list_contains({LIFE_SQL}, lower(lasts))
  UNION ALL SELECT 'end_year', 3, MAX(begins + {_whole('lasts')} - 1) FROM said
  UNION ALL SELECT 'end_year', 4, COALESCE((SELECT MIN(begins) FROM said), (SELECT {_whole('v')} FROM given WHERE word = 'current_year'), {TODAY_YEAR}) + 40
  UNION ALL SELECT 'retirement_year', 1, {_whole('v')} FROM given WHERE word = 'retirement_year'
  UNION ALL SELECT 'retirement_year', 2, {TODAY_YEAR + 15}
  UNION ALL SELECT word, 1, TRY_CAST(v AS DOUBLE) FROM given
            WHERE word IN ('real_return_rate', 'inflation_rate', 'tax_rate_working', 'tax_rate_retirement')
  UNION ALL VALUES ('real_return_rate', 2, 0), ('inflation_rate', 2, 0), ('tax_rate_working', 2, 0.30), ('tax_rate_retirement', 2, 0.25)),
chosen AS (SELECT name, arg_min(v, place) AS v FROM options WHERE v IS NOT NULL GROUP BY name),
params AS (
  SELECT CAST(MAX(v) FILTER (WHERE name = 'start_year') AS INT) AS start_year, CAST(MAX(v) FILTER (WHERE name = 'end_year') AS INT) AS end_year,
         CAST(MAX(v) FILTER (WHERE name = 'retirement_year') AS INT) AS retirement_year,
         MAX(v) FILTER (WHERE name = 'real_return_rate') AS real_r, MAX(v) FILTER (WHERE name = 'inflation_rate') AS infl,
         MAX(v) FILTER (WHERE name = 'tax_rate_working') AS tax_work, MAX(v) FILTER (WHERE name = 'tax_rate_retirement') AS tax_ret,
         (1 + MAX(v) FILTER (WHERE name = 'real_return_rate')) * (1 + MAX(v) FILTER (WHERE name = 'inflation_rate')) - 1 AS g
  FROM chosen)"""

# Holdings are the last value of each (account, symbol); an account without a
# dimension row counts, one that is excluded does not.
LATEST_CTE = """
held AS (
  SELECT account_id, symbol, value FROM (SELECT account_id, symbol, arg_max(value, as_of_date) AS value FROM pe GROUP BY ALL) h
  WHERE NOT EXISTS (SELECT 1 FROM account_dim a WHERE a.account_id = h.account_id AND NOT a.include_networth))"""


def _kept(rate):
    """Share of a dividend left after tax: ordinary part at ``rate``, qualified part at 15 %."""
    return f"((1 - q) * (1 - {rate}) + q * 0.85)"


# J-9 in closed form: a start value and each contribution grow by themselves.
PROJ_CTES = f"""
called AS (
  SELECT account_id AS text, account_id, 1 AS by_name FROM account_dim
  UNION ALL SELECT lower(account_name), MIN(account_id), 2 FROM account_dim WHERE account_name IS NOT NULL GROUP BY ALL),
mapped AS (
  SELECT DISTINCT ON (w.account_id, w."Variable", w.applies_to) w.account_id AS a, w."Variable" AS v, w.applies_to AS t, c.account_id
  FROM (SELECT DISTINCT account_id, "Variable", applies_to FROM ret_inflows) w,
       LATERAL (VALUES (1, 1, trim(w.account_id)), (2, 1, trim(w."Variable")), (3, 1, trim(w.applies_to)),
                       (4, 2, lower(trim(w."Variable"))), (5, 2, lower(trim(w.applies_to)))) AS try(place, by_name, text)
       JOIN called c ON c.text = try.text AND c.by_name = try.by_name AND try.text <> ''
  ORDER BY w.account_id, w."Variable", w.applies_to, place),
paid_in AS (
  SELECT m.account_id, "Year" AS year, SUM("Value") AS amount
  FROM ret_inflows i JOIN mapped m ON (m.a, m.v, m.t) = (i.account_id, i."Variable", i.applies_to) WHERE "Value" <> 0 GROUP BY ALL),
owned AS (
  SELECT d.account_id, d.account_name, d.acct_group, d.tax_bucket, SUM(h.value) AS v0,
         SUM(h.value * COALESCE(s.dividend_yield, 0)) / NULLIF(SUM(h.value), 0) AS div_yield,
         SUM(h.value * COALESCE(s.qualified_ratio, 0)) / NULLIF(SUM(h.value), 0) AS q
  FROM held h JOIN account_dim d USING (account_id) LEFT JOIN security_dim s USING (symbol) GROUP BY ALL),
pv AS (
  SELECT o.account_id, y AS year, o.v0 * pow(1 + g, y - start_year)
         + COALESCE(SUM(c.amount * pow(1 + g, y - c.year + 1)) FILTER (WHERE c.year > start_year AND c.year <= y), 0) AS value
  FROM owned o CROSS JOIN params JOIN range(1900, 2300) AS every(y) ON y BETWEEN start_year AND end_year
  LEFT JOIN paid_in c USING (account_id) GROUP BY o.account_id, y, o.v0, g, start_year),
paid AS (
  SELECT year, o.account_id, account_name, acct_group, tax_bucket, value, div_yield, value * COALESCE(div_yield, 0) AS gross, COALESCE(q, 0) AS q,
         tax_work AS early, tax_ret AS late, CASE WHEN year < retirement_year THEN tax_work ELSE tax_ret END AS now
  FROM pv JOIN owned o USING (account_id), params),
dfy AS (
  SELECT year, account_id, account_name, acct_group, tax_bucket, value AS portfolio_value, div_yield AS dividend_yield_weighted,
         gross AS dividends_gross, gross * {_kept('now')} AS dividends_net_by_year,
         gross * {_kept('early')} AS dividends_net_working, gross * {_kept('late')} AS dividends_net_retirement
  FROM paid)"""

RET_FIX = ("retirement_assumptions", "positions", "security_dim", "account_dim")


def _ret_with():
    return with_clause(*RET_FIX) + "," + EXPAND_CTES + "," + PE_CTE + "," + \
        LATEST_CTE + "," + PARAMS_CTES + "," + PROJ_CTES


RET_SQL = _ret_with()


def _pe(t):
    return t.memo("pe", lambda: allocation.positions_enriched(t.positions, t.security_dim, t.account_dim))


def _expand(t):
    return t.memo("expand", lambda: projection.expand_assumptions(t.retirement_assumptions, TODAY_YEAR))


def _rv(df, cols):
    return df.select(*[round_to(c, V).alias(c) if c in cols else F.col(c) for c in df.columns])


# ------------------------------------------------------------ J-14 --------
@register("ret_inflows", RET_SQL + f"""
SELECT "Year", "Variable", {_v_sql('"Value"')} AS "Value", account_id, applies_to, "Notes" FROM ret_inflows""")
def q_ret_inflows(spark, sf_dir):
    return _rv(_expand(Tables(spark, sf_dir))[1], ["Value"])


@register("ret_outflows", RET_SQL + f"""
SELECT "Year", "Variable", {_v_sql('"Value"')} AS "Value", account_id, applies_to, "Notes" FROM ret_outflows""")
def q_ret_outflows(spark, sf_dir):
    return _rv(_expand(Tables(spark, sf_dir))[2], ["Value"])


@register("ret_globals", RET_SQL + """
SELECT "Variable", "Value" FROM gl""")
def q_ret_globals(spark, sf_dir):
    return _expand(Tables(spark, sf_dir))[0]


# ------------------------------------------------------------ J-13 --------
@register("resolve_params", RET_SQL + """
SELECT * FROM params""")
def q_resolve_params(spark, sf_dir):
    return projection.resolve_params(Tables(spark, sf_dir).retirement_assumptions, TODAY_YEAR)


# ------------------------------------------------------------ J-10 --------
@register("starting_balances", RET_SQL + f"""
SELECT account_id, ifnull(MAX(account_name), account_id) AS account_name, ifnull(MAX(tax_bucket), 'Unknown') AS tax_bucket_final,
       ifnull(MAX(owner), '') AS owner, {_money_sql("SUM(value)")} AS balance_today
FROM held LEFT JOIN account_dim USING (account_id) GROUP BY account_id""")
def q_starting_balances(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return projection.starting_balances(_pe(t), t.account_dim).withColumn("balance_today", round_to("balance_today", M))


# ------------------------------------------------------------ J-11 --------
@register("dividend_flows", RET_SQL + f""",
earned AS (
  SELECT a.account_id, ifnull(a.account_name, h.account_id) AS account_name, ifnull(a.acct_group, 'Unknown') AS acct_group,
         ifnull(a.tax_bucket, 'Unknown') AS tax_bucket, h.value * s.dividend_yield AS gross, ifnull(s.qualified_ratio, 0) AS q
  FROM held h JOIN security_dim s USING (symbol) LEFT JOIN account_dim a ON a.account_id = h.account_id WHERE s.dividend_yield IS NOT NULL)
SELECT account_id, account_name, acct_group, tax_bucket, {_money_sql("SUM(gross)")} AS dividends_gross,
       {_money_sql("SUM(gross * " + _kept("(SELECT tax_work FROM params)") + ")")} AS dividends_net_working,
       {_money_sql("SUM(gross * " + _kept("(SELECT tax_ret FROM params)") + ")")} AS dividends_net_retirement
FROM earned GROUP BY ALL""")
def q_dividend_flows(spark, sf_dir):
    t = Tables(spark, sf_dir)
    d = projection.dividend_flows(_pe(t), t.security_dim, t.account_dim, t.retirement_assumptions)
    return d.select("account_id", "account_name", "acct_group", "tax_bucket",
                    *[round_to(c, M).alias(c) for c in ("dividends_gross", "dividends_net_working", "dividends_net_retirement")])


# ------------------------------------------------------------ E-10 --------
@register("account_mapping", RET_SQL + f"""
SELECT account_id, year, {_v_sql('amount')} AS amount FROM paid_in""")
def q_account_mapping(spark, sf_dir):
    t = Tables(spark, sf_dir)
    c = projection.investable_contribs(_expand(t)[1], t.account_dim)
    return c.select("account_id", F.col("year").cast("int").alias("year"), round_to("amount", V).alias("amount"))


# ------------------------------------------------------------ J-9 ---------
def _projection_inputs(t):
    pe = _pe(t)
    h = projection.acct_holdings(pe, t.account_dim)
    sv = h.groupBy("account_id").agg(F.sum("value").alias("start_value"))
    contribs = projection.investable_contribs(_expand(t)[1], t.account_dim)
    params = projection.resolve_params(t.retirement_assumptions, TODAY_YEAR)
    return sv, contribs, params


PV_SELECT = f"""
SELECT account_id, CAST(year AS INT) AS year, {_money_sql('value')} AS value FROM pv"""


@register("project_balances", RET_SQL + PV_SELECT)
def q_project_balances(spark, sf_dir):
    p = projection.project_balances(*_projection_inputs(Tables(spark, sf_dir)))
    return p.withColumn("value", round_to("value", M))


@register("project_balances_closed_form", RET_SQL + PV_SELECT)
def q_project_balances_closed_form(spark, sf_dir):
    """Closed form (running-sum window); equal to the recursion to the cent."""
    p = projection.project_balances_closed_form(*_projection_inputs(Tables(spark, sf_dir)))
    return p.withColumn("value", round_to("value", M))


# ------------------------------------------------------------ J-12 --------
@register("dividend_flows_by_year", RET_SQL + f"""
SELECT year, account_id, account_name, acct_group, tax_bucket, {_money_sql('portfolio_value')} AS portfolio_value,
       {_ratio_sql('dividend_yield_weighted')} AS dividend_yield_weighted,
       {_money_sql('dividends_gross')} AS dividends_gross, {_money_sql('dividends_net_by_year')} AS dividends_net_by_year,
       {_money_sql('dividends_net_working')} AS dividends_net_working,
       {_money_sql('dividends_net_retirement')} AS dividends_net_retirement
FROM dfy""")
def q_dividend_flows_by_year(spark, sf_dir):
    t = Tables(spark, sf_dir)
    d = _dfy(t)
    money = ["portfolio_value", "dividends_gross", "dividends_net_by_year", "dividends_net_working", "dividends_net_retirement"]
    return d.select(F.col("year").cast("int").alias("year"), "account_id", "account_name", "acct_group", "tax_bucket",
                    *[round_to(c, M).alias(c) for c in money[:1]],
                    round_to("dividend_yield_weighted", R).alias("dividend_yield_weighted"),
                    *[round_to(c, M).alias(c) for c in money[1:]])


def _dfy(t):
    return t.memo("dfy", lambda: projection.dividend_flows_by_year(_pe(t), t.security_dim, t.account_dim, t.retirement_assumptions,
                                             _expand(t)[1], TODAY_YEAR))


# ------------------------------------------------------------ K / L-10/11 -
MEASURE_CTES = f""",
moved AS (
  SELECT "Year" AS year, SUM("Value") AS inflows, NULL::DOUBLE AS outflows, NULL::DOUBLE AS dividends, NULL::DOUBLE AS pv FROM ret_inflows GROUP BY ALL
  UNION ALL SELECT "Year", NULL, -SUM("Value"), NULL, NULL FROM ret_outflows GROUP BY ALL
  UNION ALL SELECT year, NULL, NULL, SUM(dividends_net_by_year), SUM(portfolio_value) FROM dfy GROUP BY ALL),
fy AS (SELECT year, SUM(inflows) AS inflows, SUM(outflows) AS outflows, SUM(dividends) AS dividends, SUM(pv) AS pv FROM moved GROUP BY year),
ax AS (
  SELECT CAST(y AS INT) AS year, (1 + COALESCE(real_r, 0)) * (1 + COALESCE(infl, 0)) / (1 + COALESCE(dividends / NULLIF(pv, 0), 0)) AS growth, base,
         COALESCE((SELECT SUM(value) FROM held), 0) AS s
  FROM range(2024, 2101) AS every(y) LEFT JOIN fy ON fy.year = y, world),
eb AS (
  SELECT ax.year, base, s, s * pow(growth, ax.year - base) + COALESCE(SUM(
           (COALESCE(inflows, 0) + COALESCE(outflows, 0) + COALESCE(dividends, 0)) * pow(growth, ax.year - fy.year)), 0) AS end_balance
  FROM ax LEFT JOIN fy ON fy.year <= ax.year GROUP BY ax.year, growth, base, s),
rt AS (
  SELECT eb.year, CASE WHEN eb.year = base THEN s ELSE (SELECT e.end_balance FROM eb e WHERE e.year = eb.year - 1) END AS beg_balance,
         inflows, dividends, outflows, end_balance
  FROM eb LEFT JOIN fy USING (year))"""


def _retirement_inputs(spark, t, need=("cf", "dfy", "sb", "g")):
    """The tables the retirement measures read, each cut from its lineage
    (they are exported tables in the model: flows, dividends by year,
    starting balances, globals — all small, bounded by accounts x years).
    Only the ``need``-ed ones are computed."""
    g, inflows, outflows = _expand(t)
    cf = cut_lineage(projection.cashflows(inflows, outflows)) if "cf" in need else None
    dfy = cut_lineage(_dfy(t)) if "dfy" in need else None
    sb = None
    if "sb" in need:
        sbt = cut_lineage(projection.starting_balances(_pe(t), t.account_dim).agg(F.sum("balance_today").alias("s")))
        sb = sbt.select("s").scalar()
    return measures.year_axis(spark), cf, dfy, sb, (cut_lineage(g) if "g" in need else None)


@register("end_balance_by_year", RET_SQL + MEASURE_CTES + f"""
SELECT year, {_money_sql('end_balance')} AS end_balance FROM eb""")
def q_end_balance_by_year(spark, sf_dir):
    years, cf, dfy, sb, g = _retirement_inputs(spark, Tables(spark, sf_dir))
    e = measures.end_balance_by_year(years, cf, dfy, sb, g, TODAY_YEAR)
    return e.select("year", round_to("end_balance", M).alias("end_balance"))


@register("amount_by_type", RET_SQL + MEASURE_CTES + f"""
SELECT year, type, CAST(place AS INT) AS sort_key, {_money_sql('amount')} AS amount
FROM (SELECT year, unnest(['Beg Balance', 'Inflows', 'Dividends', 'Outflows', 'End Balance']) AS type, unnest([1, 2, 3, 4, 5]) AS place,
             unnest([beg_balance, inflows, dividends, outflows, end_balance]) AS amount FROM rt)""")
def q_amount_by_type(spark, sf_dir):
    """Amount By Type: one value per year and member of the literal TypeDim."""
    a = measures.amount_by_type(*_retirement_inputs(spark, Tables(spark, sf_dir)), TODAY_YEAR)
    return a.select("year", "type", "sort_key", round_to("amount", M).alias("amount"))


@register("retirement_pivot", RET_SQL + MEASURE_CTES + f"""
SELECT year, {_money_sql('beg_balance')} AS beg_balance, {_money_sql('inflows')} AS inflows,
       {_money_sql('dividends')} AS dividends, {_money_sql('outflows')} AS outflows, {_money_sql('end_balance')} AS end_balance
FROM rt WHERE year > 2024 AND year <= 2080""")
def q_retirement_pivot(spark, sf_dir):
    """L-11: Year x {Beg, Inflows, Dividends, Outflows, End}; page filter 2024 < Year <= 2080."""
    a = measures.amount_by_type(*_retirement_inputs(spark, Tables(spark, sf_dir)), TODAY_YEAR)
    p = measures.type_pivot(a.filter((F.col("year") > 2024) & (F.col("year") <= 2080)))
    return p.select("year", *[round_to(F.col(f"`{t}`"), M).alias(t.lower().replace(" ", "_")) for t, _ in measures.TYPE_DIM]) \
        .orderBy("year")


@register("withdrawal_rates", RET_SQL + MEASURE_CTES + f""",
el AS (SELECT * FROM rt WHERE ABS(outflows) > 0 AND beg_balance > 0)
SELECT {_ratio_sql("SUM(ABS(outflows)) / NULLIF(SUM(beg_balance), 0)")} AS avg_withdrawal_rate,
       {_ratio_sql("(SELECT ABS(outflows) / NULLIF(beg_balance, 0) FROM el ORDER BY year LIMIT 1)")} AS initial_withdrawal_rate
FROM el""")
def q_withdrawal_rates(spark, sf_dir):
    years, cf, dfy, sb, g = _retirement_inputs(spark, Tables(spark, sf_dir))
    w = measures.withdrawal_rates(measures.retirement_table(years, cf, dfy, sb, g, TODAY_YEAR))
    return w.select(*[round_to(c, R).alias(c) for c in w.columns])


@register("cumulative_net_flow", RET_SQL + MEASURE_CTES + f""",
nf AS (SELECT CAST(y AS INT) AS year, COALESCE(inflows, 0) + COALESCE(outflows, 0) AS net_flow
       FROM range(2024, 2101) AS every(y) LEFT JOIN fy ON fy.year = y)
SELECT a.year, {_money_sql('a.net_flow')} AS net_flow, {_money_sql('SUM(b.net_flow)')} AS cumulative_net_flow
FROM nf a JOIN nf b ON b.year <= a.year GROUP BY a.year, a.net_flow""")
def q_cumulative_net_flow(spark, sf_dir):
    years, cf, _, _, _ = _retirement_inputs(spark, Tables(spark, sf_dir), need=("cf",))
    c = measures.cumulative_net_flow(years, cf)
    return c.select("year", round_to("net_flow", M).alias("net_flow"),
                    round_to("cumulative_net_flow", M).alias("cumulative_net_flow"))


@register("net_worth_with_growth", RET_SQL + MEASURE_CTES + f""",
pace AS (SELECT (1 + real_r) * (1 + infl) AS growth, base, (SELECT SUM(value) FROM held) AS s FROM world)
SELECT CAST(y AS INT) AS year, {_money_sql("MAX(s * pow(growth, y - base)) + COALESCE(SUM((COALESCE(inflows, 0) + COALESCE(outflows, 0)) * pow(growth, y - year)), 0)")}
       AS net_worth_with_growth
FROM pace CROSS JOIN range(2024, 2101) AS every(y) LEFT JOIN fy ON fy.year <= y GROUP BY y""")
def q_net_worth_with_growth(spark, sf_dir):
    years, cf, _, sb, g = _retirement_inputs(spark, Tables(spark, sf_dir), need=("cf", "sb", "g"))
    n = measures.net_worth_with_growth(years, cf, sb, g, TODAY_YEAR)
    return n.select("year", round_to("net_worth_with_growth", M).alias("net_worth_with_growth"))


# ------------------------------------------------------------ J-16 / K ----
# a budget month holds until the category's next one, the last until the target
BUDGET_CTES = """,
tgt AS (SELECT MAX(year(date) * 12 + month(date) - 1) AS t FROM transactions),
bl AS (SELECT parent_category, yyyymm, arg_max(budget_amount, row_idx) AS budget_amount, yyyymm // 100 * 12 + yyyymm % 100 - 1 AS i FROM budgets GROUP BY ALL),
rolled AS (
  SELECT parent_category, CAST(m // 12 * 100 + m % 12 + 1 AS INT) AS yyyymm, budget_amount
  FROM bl, tgt JOIN range(20000, 26000) AS every(m) ON m >= i AND (m = i OR m <= t)
  WHERE m = i OR NOT EXISTS (SELECT 1 FROM bl n WHERE n.parent_category = bl.parent_category AND n.i > bl.i AND n.i <= m))"""


def _rolled(t):
    return budget.budget_roll_forward(t.budgets, budget.target_from_transactions(t.transactions))


@register("budget_roll_forward", with_clause("transactions", "budgets") + BUDGET_CTES + """
SELECT parent_category, yyyymm, budget_amount FROM rolled""")
def q_budget_roll_forward(spark, sf_dir):
    return _rolled(Tables(spark, sf_dir))


BTD_CTES = """,
lat AS (SELECT year(date) AS year, MAX(date) AS latest FROM transactions GROUP BY 1),
bj AS (SELECT r.parent_category, r.yyyymm // 100 AS year, make_date(r.yyyymm // 100, r.yyyymm % 100, 1) AS ms,
              r.budget_amount, l.latest FROM rolled r JOIN lat l ON l.year = r.yyyymm // 100),
btd AS (SELECT CAST(year AS INT) AS year, parent_category,
               COALESCE(SUM(CASE WHEN ms < date_trunc('month', latest) THEN budget_amount END), 0.0)
               + COALESCE(SUM(CASE WHEN ms = date_trunc('month', latest) THEN budget_amount END), 0.0)
                 * (CAST(MAX(day(latest)) AS DOUBLE) / CAST(MAX(day(last_day(latest))) AS DOUBLE)) AS budget_to_date
        FROM bj GROUP BY 1, 2)"""


@register("budget_to_date", with_clause("transactions", "budgets") + BUDGET_CTES + BTD_CTES + f"""
SELECT year, parent_category, {_money_sql('budget_to_date')} AS budget_to_date FROM btd""")
def q_budget_to_date(spark, sf_dir):
    t = Tables(spark, sf_dir)
    b = budget.budget_to_date(t.transactions, _rolled(t))
    return b.select(F.col("year").cast("int").alias("year"), "parent_category",
                    round_to("budget_to_date", M).alias("budget_to_date"))


# The spend-vs-budget page's excluded parent categories.
EXCLUDED_PARENTS = ["Cash", "Income", "Personal Payment", "Taxes", "Transfers", "Transportation", "Insurance"]
L4_YEAR = 1998


@register("spend_vs_budget", with_clause(*TWC_FIXTURES, "category_dim", "budgets") + "," + DEDUP_CTES + ","
          + CATEGORIZE_CTES + "," + NON_TRANSFER_CTE
          + BUDGET_CTES + BTD_CTES + f""",
act AS (SELECT cd.parent_category, -CAST(SUM(t.amount_cents) AS DOUBLE) / 100.0 AS actual_spend
        FROM twc_nt t JOIN category_dim cd ON cd.category = t.category
        WHERE year(t.date) = {L4_YEAR} AND cd.parent_category NOT IN ({", ".join(f"'{p}'" for p in EXCLUDED_PARENTS)})
        GROUP BY 1),
bud AS (SELECT parent_category, budget_to_date FROM btd WHERE year = {L4_YEAR}
        AND parent_category NOT IN ({", ".join(f"'{p}'" for p in EXCLUDED_PARENTS)}))
SELECT COALESCE(a.parent_category, b.parent_category) AS parent_category, {_money_sql('b.budget_to_date')} AS budget_to_date,
       {_money_sql('a.actual_spend')} AS actual_spend,
       {_money_sql('b.budget_to_date - COALESCE(a.actual_spend, 0.0)')} AS budget_variance
FROM act a FULL JOIN bud b ON a.parent_category = b.parent_category""")
def q_spend_vs_budget(spark, sf_dir):
    """L-4 for one year of context."""
    t = Tables(spark, sf_dir)
    twc = twc_frame(t).filter(F.year("date") == L4_YEAR)
    btd = budget.budget_to_date(t.transactions, _rolled(t)).filter(F.col("year") == L4_YEAR).drop("year")
    r = reports.spend_vs_budget(twc, t.category_dim, btd, EXCLUDED_PARENTS)
    return r.select("parent_category", *[round_to(c, M).alias(c) for c in ("budget_to_date", "actual_spend", "budget_variance")])


@register("avg_monthly_amount", TWC_SQL + """,
m AS (SELECT strftime(date, '%Y-%m') AS month, SUM(amount_cents) AS c FROM twc GROUP BY 1 HAVING SUM(amount_cents) IS NOT NULL)
SELECT ROUND(AVG(CAST(c AS DOUBLE) / 100.0) * 100) / 100 AS avg_monthly_amount FROM m""")
def q_avg_monthly_amount(spark, sf_dir):
    """L-3 / F-9: average of per-month totals (empty months ignored)."""
    m = twc_frame(Tables(spark, sf_dir)).groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(
        F.sum("amount_cents").alias("c")).filter(F.col("c").isNotNull())
    return m.agg(round_to(F.avg(F.col("c").cast("double") / 100.0), M).alias("avg_monthly_amount"))


# ------------------------------------------------------------ tax ---------
def _tax_case(x):
    return (f"CASE WHEN {x} <= 0 THEN 0.0 WHEN {x} <= 23850 THEN {x} * 0.10 "
            f"WHEN {x} <= 96950 THEN 2385.0 + ({x} - 23850.0) * 0.12 WHEN {x} <= 206700 THEN 11157.0 + ({x} - 96950.0) * 0.22 "
            f"WHEN {x} <= 394600 THEN 35302.0 + ({x} - 206700.0) * 0.24 WHEN {x} <= 501050 THEN 80398.0 + ({x} - 394600.0) * 0.32 "
            f"WHEN {x} <= 751600 THEN 114462.0 + ({x} - 501050.0) * 0.35 ELSE 191011.0 + ({x} - 751600.0) * 0.37 END")


@register("federal_tax", with_clause("filers") + f"""
SELECT filer_id, taxable_income, {_money_sql(_tax_case('taxable_income'))} AS federal_tax FROM filers""")
def q_federal_tax(spark, sf_dir):
    f = Tables(spark, sf_dir).filers
    return f.select("filer_id", "taxable_income", round_to(tax.progressive_tax(F.col("taxable_income")), M).alias("federal_tax"))


@register("tax_summary", with_clause("positions", "security_dim", "account_dim", "annual_tax_est") + "," + PE_CTE + f""",
ti AS (SELECT MAX(CASE WHEN metric = 'w2_income' THEN CAST(value AS DOUBLE) END) AS w2,
              MAX(CASE WHEN metric = 'deductions' THEN CAST(value AS DOUBLE) END) AS ded,
              MAX(CASE WHEN metric = 'w2_taxes' THEN CAST(value AS DOUBLE) END) AS w2t,
              MAX(CASE WHEN metric = 'est_tax_payments' THEN CAST(value AS DOUBLE) END) AS est,
              MAX(CASE WHEN metric = 'loss_offset_ordinary' THEN CAST(value AS DOUBLE) END) AS loss FROM annual_tax_est),
dv AS (SELECT SUM(CASE WHEN pe.tax_bucket = 'Taxable' THEN pe.value * s.dividend_yield * s.qualified_ratio * s.federal_taxable_ratio END) AS q,
              SUM(CASE WHEN pe.tax_bucket = 'Taxable' THEN pe.value * s.dividend_yield * s.federal_taxable_ratio END)
              - SUM(CASE WHEN pe.tax_bucket = 'Taxable' THEN pe.value * s.dividend_yield * s.qualified_ratio * s.federal_taxable_ratio END) AS o
       FROM pe LEFT JOIN security_dim s USING (symbol)),
x AS (SELECT COALESCE(w2, 0.0) AS w2, COALESCE(ded, 0.0) AS ded, COALESCE(loss, 0.0) AS loss,
             COALESCE(q, 0.0) AS q, COALESCE(o, 0.0) AS o, COALESCE(w2t, 0.0) + COALESCE(est, 0.0) AS paid FROM ti, dv),
y AS (SELECT *, w2 + o + loss + ded AS base FROM x)
SELECT {_money_sql('w2 + o + q + loss')} AS agi, {_money_sql('base')} AS ordinary_income_base,
       {_money_sql(_tax_case('base'))} AS federal_ordinary_tax, {_money_sql('q * 0.188')} AS federal_qualified_tax,
       {_money_sql(_tax_case('base') + ' + q * 0.188')} AS projected_federal_tax,
       {_money_sql(_tax_case('base') + ' + q * 0.188 - paid')} AS remaining_federal_liability,
       {_money_sql('paid')} AS total_taxes_paid
FROM y""")
def q_tax_summary(spark, sf_dir):
    t = Tables(spark, sf_dir)
    d = allocation.estimated_dividends(_pe(t), t.security_dim)
    s = tax.tax_summary(t.annual_tax_est, d)
    return s.select(*[round_to(c, M).alias(c) for c in s.columns])
