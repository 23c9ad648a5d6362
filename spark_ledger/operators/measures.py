"""Report measures (K) as DataFrame functions with explicit context.

A measure takes the frames it reads plus the report axis; filter context
becomes arguments, BLANK becomes null, and DAX's BLANK-as-0 in +/- becomes
``coalesce(x, 0)``.  The year axis is a small generated frame (one row per
year), so range joins against per-year aggregates stay bounded by the
horizon, never by the fact tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


# The model's year axis.
YEAR_AXIS_START, YEAR_AXIS_END = 2024, 2100


def year_axis(spark: SparkSession, lo: int = YEAR_AXIS_START, hi: int = YEAR_AXIS_END) -> DataFrame:
    return spark.range(lo, hi + 1).select(F.col("id").cast("int").alias("year"))


def divide(a: Column, b: Column) -> Column:
    """DAX DIVIDE: null when the denominator is 0 or null."""
    return F.when(b.isNotNull() & (b != 0), a / b)


def global_value(globals_df: DataFrame, name: str) -> Column:
    """Scalar subquery: MAX(Value) of a named global."""
    return globals_df.agg(F.max(F.when(F.col("Variable") == name, F.col("Value").cast("double")))).scalar()


def nominal_return(globals_df: DataFrame) -> Column:
    r = F.coalesce(global_value(globals_df, "real_return_rate"), F.lit(0.0))
    i = F.coalesce(global_value(globals_df, "inflation_rate"), F.lit(0.0))
    return (F.lit(1.0) + r) * (F.lit(1.0) + i) - F.lit(1.0)


def base_year(globals_df: DataFrame, today_year: int) -> Column:
    return F.coalesce(global_value(globals_df, "current_year"), F.lit(float(today_year))).cast("int")


def flows_by_year(cashflows: DataFrame, div_by_year: DataFrame) -> DataFrame:
    """Per year: inflows (+), outflows (signed, <= 0), net dividends and the
    projected portfolio value — each a pre-aggregate over its fact table."""
    t = F.lower(F.col("Type"))
    c = cashflows.groupBy(F.col("Year").cast("int").alias("year")).agg(
        F.sum(F.when(t == "inflows", F.col("SignedValue"))).alias("inflows"),
        F.sum(F.when(t == "outflows", F.col("SignedValue"))).alias("outflows"))
    d = div_by_year.groupBy(F.col("year").cast("int").alias("year")).agg(
        F.sum("dividends_net_by_year").alias("dividends"), F.sum("portfolio_value").alias("portfolio_value"))
    return c.join(d, "year", "full")


def end_balance_by_year(years: DataFrame, cashflows: DataFrame, div_by_year: DataFrame,
                        start_balance: Column, globals_df: DataFrame, today_year: int) -> DataFrame:
    """End Balance (EOY) for each year y of the axis:
    S*(1+r_y)^(y-base) + sum_{t<=y} (flow_t + div_t) * (1+r_y)^(y-t), with
    r_y = (1+nominal)/(1+net dividend yield of year y) - 1.

    r_y changes with y, so this is not a running sum: the per-year
    aggregates (bounded by the horizon) are range-joined to the axis.  The
    output keeps that year's flows for the pivot."""
    f = flows_by_year(cashflows, div_by_year)
    x = f.select(F.col("year").alias("t"),
                 (F.coalesce(F.col("inflows"), F.lit(0.0)) + F.coalesce(F.col("outflows"), F.lit(0.0))
                  + F.coalesce(F.col("dividends"), F.lit(0.0))).alias("x"))
    nom = nominal_return(globals_df)
    ax = (years.join(f, "year", "left")
               .withColumn("r", (F.lit(1.0) + nom)
                           / (F.lit(1.0) + F.coalesce(divide(F.col("dividends"), F.col("portfolio_value")), F.lit(0.0)))
                           - F.lit(1.0))
               .withColumn("base", base_year(globals_df, today_year))
               .withColumn("S", F.coalesce(start_balance, F.lit(0.0))))
    # x has one row per year of the flows (bounded by the assumption horizon,
    # not by any fact table), so it is broadcast for the range join.
    j = ax.join(F.broadcast(x), F.col("t") <= F.col("year"), "left")
    term = F.coalesce(F.col("x") * F.pow(F.lit(1.0) + F.col("r"), F.col("year") - F.col("t")), F.lit(0.0))
    keep = ["year", "r", "base", "S", "inflows", "outflows", "dividends"]
    return j.groupBy(*keep).agg(F.sum(term).alias("__flows")).select(
        *keep, (F.col("S") * F.pow(F.lit(1.0) + F.col("r"), F.col("year") - F.col("base")) + F.col("__flows"))
        .alias("end_balance"))


def retirement_table(years: DataFrame, cashflows: DataFrame, div_by_year: DataFrame, start_balance: Column,
                     globals_df: DataFrame, today_year: int) -> DataFrame:
    """Year x {Beg Balance, Inflows, Dividends, Outflows, End Balance}.

    Beg Balance = Start Balance in the base year, else the previous year's
    End Balance (a lag over the year axis)."""
    e = end_balance_by_year(years, cashflows, div_by_year, start_balance, globals_df, today_year)
    w = Window.orderBy("year")  # the axis holds at most a few dozen years
    beg = F.when(F.col("year") == F.col("base"), F.col("S")).otherwise(F.lag("end_balance").over(w))
    return e.select("year", beg.alias("beg_balance"), F.col("inflows"), F.col("dividends"),
                    F.col("outflows"), F.col("end_balance"))


def return_measures(years: DataFrame, cashflows: DataFrame, div_by_year: DataFrame, globals_df: DataFrame) -> DataFrame:
    """K13, K14, K16 per year: dividends, inflows, outflows, net flows (blank only
    where all operands are), returns and the net dividend yield."""
    f = years.join(flows_by_year(cashflows, div_by_year), "year", "left")
    real = F.coalesce(global_value(globals_df, "real_return_rate"), F.lit(0.0))
    f = f.withColumn("real", real).withColumn("nominal_total_return", nominal_return(globals_df))
    f = f.withColumn("dividend_yield", divide(F.col("dividends"), F.col("portfolio_value")))

    def total(*columns):
        known = F.coalesce(*columns)
        return F.when(known.isNotNull(), sum((F.coalesce(F.col(c), F.lit(0.0)) for c in columns), F.lit(0.0)))
    ex = 1 + F.coalesce("dividend_yield", F.lit(0.0))
    return f.select("year", F.col("dividends").alias("dividends_net"), "inflows", (-F.col("outflows")).alias("outflows"),
                    total("inflows", "outflows").alias("net_flow"), total("inflows", "outflows", "dividends").alias("net_flow_with_dividends"),
                    "nominal_total_return", "dividend_yield", ((1 + F.col("real")) / ex - 1).alias("return_ex_div_real"),
                    ((1 + F.col("nominal_total_return")) / ex - 1).alias("return_ex_div_nominal"))


# The TypeDim members and their sort keys.
TYPE_DIM = [("Beg Balance", 1), ("Inflows", 2), ("Dividends", 3), ("Outflows", 4), ("End Balance", 5)]


def type_dim(spark: SparkSession) -> DataFrame:
    """H-9: the literal dimension of amount types."""
    return spark.createDataFrame(TYPE_DIM, "type string, sort_key int")


def amount_by_type(years: DataFrame, cashflows: DataFrame, div_by_year: DataFrame, start_balance: Column,
                   globals_df: DataFrame, today_year: int) -> DataFrame:
    """K19: ``year, type, sort_key, amount`` for every member of TypeDim: a union of
    typed series (signed flows, net dividends, balances), joined to the dimension."""
    table = retirement_table(years, cashflows, div_by_year, start_balance, globals_df, today_year)
    column = {t: t.lower().replace(" ", "_") for t, _ in TYPE_DIM}
    series = F.array(*(F.struct(F.lit(t).alias("type"), F.col(c).cast("double").alias("amount")) for t, c in column.items()))
    return table.select("year", F.inline(series)).join(type_dim(years.sparkSession), "type")


def type_pivot(amounts: DataFrame) -> DataFrame:
    """L-11 / F-11: the typed series as one row per year, one column per type."""
    return amounts.groupBy("year").pivot("type", [t for t, _ in TYPE_DIM]).agg(F.sum("amount"))


def withdrawal_rates(table: DataFrame) -> DataFrame:
    """Avg Withdrawal Rate (Weighted) and Initial Withdrawal Rate over years
    with outflows and a positive beginning balance (one row, one pass:
    the first eligible year's pair comes from ``min_by``)."""
    o = F.abs(F.col("outflows"))
    elig = table.filter((o > 0) & (F.col("beg_balance") > 0))
    first = F.min_by(F.struct(o.alias("o"), F.col("beg_balance").alias("b")), F.col("year"))
    return elig.agg(
        divide(F.sum(o), F.sum("beg_balance")).alias("avg_withdrawal_rate"),
        divide(first.getField("o"), first.getField("b")).alias("initial_withdrawal_rate"))


def cumulative_net_flow(years: DataFrame, cashflows: DataFrame) -> DataFrame:
    """Net Flow (inflows - outflows of Value) per year and its running total
    over the selected years."""
    t = F.upper(F.trim(F.col("Type")))
    norm = F.when(t.isin("INFLOW", "INFLOWS"), "INFLOW").when(t.isin("OUTFLOW", "OUTFLOWS"), "OUTFLOW")
    c = cashflows.groupBy(F.col("Year").cast("int").alias("year")).agg(
        F.sum(F.when(norm == "INFLOW", F.col("Value"))).alias("i"),
        F.sum(F.when(norm == "OUTFLOW", F.col("Value"))).alias("o"))
    j = years.join(c, "year", "left").select(
        "year", (F.coalesce(F.col("i"), F.lit(0.0)) - F.coalesce(F.col("o"), F.lit(0.0))).alias("net_flow"))
    w = Window.orderBy("year").rowsBetween(Window.unboundedPreceding, 0)
    return j.withColumn("cumulative_net_flow", F.sum("net_flow").over(w))


def net_worth_with_growth(years: DataFrame, cashflows: DataFrame, start_balance: Column,
                          globals_df: DataFrame, today_year: int) -> DataFrame:
    """Net Worth (with growth): start and every flow up to y compounded at
    the constant nominal rate.  With one rate the sum is a running window:
    (1+r)^(y-base) * (S + sum_{t<=y} s_t * (1+r)^(base-t))."""
    t = F.upper(F.trim(F.col("Type")))
    sign = F.when(t.isin("INFLOW", "INFLOWS"), 1.0).otherwise(-1.0)
    nom = nominal_return(globals_df)
    base = base_year(globals_df, today_year)
    c = cashflows.groupBy(F.col("Year").cast("int").alias("year")).agg(F.sum(sign * F.col("Value")).alias("s"))
    j = years.join(c, "year", "left").withColumn("one_r", F.lit(1.0) + nom).withColumn("base", base)
    disc = F.coalesce(F.col("s"), F.lit(0.0)) * F.pow(F.col("one_r"), F.col("base") - F.col("year"))
    w = Window.orderBy("year").rowsBetween(Window.unboundedPreceding, 0)
    S = F.coalesce(start_balance, F.lit(0.0))
    return j.select("year", (F.pow(F.col("one_r"), F.col("year") - F.col("base")) * (S + F.sum(disc).over(w)))
                    .alias("net_worth_with_growth"))
