"""Calendar and month dimensions (J-17, J-18).

The date range comes from distributed MIN/MAX aggregates over whichever
date-bearing tables exist; the day series is generated from that one-row
result with ``explode(sequence(...))`` — nothing passes through the driver.
The output has one row per day (bounded by the span of the data).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from spark_ledger.operators.common import union_all


def _date_span(sources: list[tuple[DataFrame, str]]) -> DataFrame:
    """One row: (lo, hi) over every (frame, date column) given."""
    parts = [df.select(F.col(c).cast("date").alias("d")).agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
             for df, c in sources]
    return union_all(parts).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def calendar_columns(d: Column, fiscal_start: int = 1) -> list[Column]:
    """The 22 calendar columns for a DATE column ``d``."""
    fs = fiscal_start if 1 <= fiscal_start <= 12 else 1
    month = F.month(d)
    month_end = F.last_day(d)
    fm = ((month - F.lit(fs) + 12) % 12) + 1
    return [
        d.alias("date"),
        F.year(d).alias("year"),
        month.alias("month_num"),
        F.dayofmonth(d).alias("day_num"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        (F.year(d) * 100 + month).cast("int").alias("yyyymm"),
        F.trunc(d, "month").alias("month_start"),
        month_end.alias("month_end"),
        F.quarter(d).alias("quarter_num"),
        F.trunc(d, "quarter").alias("quarter_start"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.weekofyear(d).alias("iso_week"),
        F.extract(F.lit("YEAROFWEEK"), d).cast("int").alias("iso_year"),
        F.trunc(d, "week").alias("week_start_monday"),
        F.date_format(d, "MMM").alias("month_short"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_label"),
        (d == month_end).alias("is_eom"),
        F.dayofmonth(month_end).alias("days_in_month"),
        F.when(month >= fs, F.year(d)).otherwise(F.year(d) - 1).alias("fiscal_year"),
        F.ceil(fm / F.lit(3.0)).cast("int").alias("fiscal_quarter"),
        fm.cast("int").alias("fiscal_month_num"),
    ]


def calendar_dim(spark: SparkSession, sources: list[tuple[DataFrame, str]], fiscal_start: int = 1,
                 today: _dt.date | None = None) -> DataFrame:
    """J-17: one row per day from the earliest to the latest source date.

    With no source dates the range is ``today`` +/- 365 days (``today`` is an
    argument so results repeat)."""
    today = today or _dt.date.today()
    span = _date_span(sources) if sources else spark.range(1).select(
        F.lit(None).cast("date").alias("lo"), F.lit(None).cast("date").alias("hi"))
    lo = F.coalesce(F.col("lo"), F.date_sub(F.lit(today), 365))
    hi = F.coalesce(F.col("hi"), F.date_add(F.lit(today), 365))
    days = span.select(F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(*calendar_columns(F.col("d"), fiscal_start))


def month_dim_from_sources(sources: list[tuple[DataFrame, str]]) -> DataFrame:
    """J-18 (first form): distinct month starts found in the sources."""
    return union_all([df.select(F.trunc(F.col(c).cast("date"), "month").alias("month")) for df, c in sources]).distinct()


def month_dim(calendar: DataFrame) -> DataFrame:
    """J-18 (rebuilt form): distinct month starts of the calendar."""
    return calendar.select(F.col("month_start").alias("month")).distinct()


def month_date(month) -> Column:
    """First day of a 'YYYY-MM' text month (T-26: rollups name months by text, the
    model joins them by date)."""
    return F.to_date(F.concat(F.col(month) if isinstance(month, str) else month, F.lit("-01")), "yyyy-MM-dd")


def month_dim_columns(month: Column) -> list[Column]:
    """Model columns on month_dim: MonthStart, yyyymm, MonthEnd, Year, Quarter Year."""
    return [
        month.alias("month"),
        F.trunc(month, "month").alias("MonthStart"),
        (F.year(month) * 100 + F.month(month)).cast("int").alias("yyyymm"),
        F.last_day(month).alias("MonthEnd"),
        F.year(month).alias("Year"),
        F.concat(F.lit("Q"), F.quarter(month).cast("string"), F.lit(" "), F.year(month).cast("string")).alias("QuarterYear"),
    ]
