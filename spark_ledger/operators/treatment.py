"""Yields and tax treatment of dividends (J-20, documented formulas)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Taxable shares by treatment (federal, state), and the
# qualified-ratio code that means no tax at all.
TREATMENTS = [("muni", 0.0, 0.0), ("treasury", 1.0, 0.0), ("standard", 1.0, 1.0)]
DEFAULT_TREATMENT = "standard"
NO_TAX_CODE = 999.0
LIQUID_GROUP = "Liquid"


def preferred_yield() -> Column:
    """The forward yield where it is known, else the trailing one."""
    return F.coalesce("yield_forward", "yield_trailing")


def treated_dividends(holdings: DataFrame, yields: DataFrame, account_dim: DataFrame, ordinary_rate: float, qualified_rate: float,
                      state_rate: float, treatments: list[tuple] | None = None) -> DataFrame:
    """Per holding (account_id, symbol, value): gross dividend, federal and state
    tax, net, and the part that can be spent before retirement (liquid accounts).

    The treatment table says which share of a dividend each tax sees; the
    qualified part is taxed at its own federal rate; code 999 means no tax.
    Securities without any yield pay nothing and are left out."""
    table = holdings.sparkSession.createDataFrame(treatments or TREATMENTS, "treatment string, federal double, state double")
    named = F.lower(F.trim(F.coalesce("tax_treatment", F.lit(DEFAULT_TREATMENT))))
    y = yields.withColumn("treatment", named).withColumn("yield", preferred_yield()).where("yield is not null")
    y = y.join(table, "treatment", "left").select("symbol", "treatment", "yield", "federal", "state", "qualified_ratio")
    groups = account_dim.select("account_id", "acct_group")
    j = holdings.join(y, "symbol").join(groups, "account_id", "left")
    free = F.col("qualified_ratio") == NO_TAX_CODE
    q = F.coalesce("qualified_ratio", F.lit(0.0))
    gross = F.col("value") * F.col("yield")
    federal = F.when(free, 0.0).otherwise(gross * F.coalesce("federal", F.lit(1.0)) * ((1 - q) * ordinary_rate + q * qualified_rate))
    state = F.when(free, 0.0).otherwise(gross * F.coalesce("state", F.lit(1.0)) * state_rate)
    spendable = F.coalesce(F.col("acct_group") == LIQUID_GROUP, F.lit(False))
    out = j.select("account_id", "symbol", "treatment", spendable.alias("spendable"), gross.alias("gross"), federal.alias("federal_tax"), state.alias("state_tax"))
    out = out.withColumn("net", F.col("gross") - F.col("federal_tax") - F.col("state_tax"))
    return out.withColumn("spendable_net", F.when(F.col("spendable"), F.col("net")).otherwise(0.0))
