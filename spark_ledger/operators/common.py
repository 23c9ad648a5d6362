"""Small building blocks shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

# Explicit broadcast hints are only given behind a checked row bound.
DIM_BROADCAST_MAX_ROWS = 2_000_000


def maybe_broadcast(dim: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Join side for a dimension table.

    By default no hint is added: Spark's planner broadcasts the side only when
    its size estimate is under ``spark.sql.autoBroadcastJoinThreshold`` (exact
    for literal tables), and adaptive execution re-checks the measured size
    at run time; anything larger stays a shuffled sort-merge join.  That keeps
    the check lazy — no job runs while the plan is built.

    With ``max_rows`` the caller asks for an explicit hint behind an eager
    bound check (at most ``max_rows + 1`` rows are counted).
    """
    if max_rows is None:
        return dim
    n = dim.limit(max_rows + 1).count()
    return F.broadcast(dim) if n <= max_rows else dim


def keep_first(df: DataFrame, keys: list, order: list[Column], rn_col: str | None = None) -> DataFrame:
    """Keep the first row per key under ``order``.

    ``row_number() = 1`` is planned as a partial WindowGroupLimit before the
    shuffle, so even a key holding a third of all rows is cut to one row per
    map task before it is exchanged (no hot reducer).
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    name = rn_col or "__rn"
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) == 1)
    return out if rn_col else out.drop(name)


def first_n(df: DataFrame, keys: list, order: list[Column], n: int) -> DataFrame:
    """G-5: the first ``n`` rows of each key under ``order`` (up to a thousand are
    cut per map task before the shuffle)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """H-2 / H-3: the first ``n`` rows of the whole frame (TakeOrdered: each task
    sends at most ``n`` rows).  ``order`` should end in a key, so ties are defined."""
    return df.orderBy(*order).limit(n)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def has_cols(df: DataFrame, *cols: str) -> bool:
    return all(c in df.columns for c in cols)


def first_present(df: DataFrame, candidates) -> list[str]:
    return [c for c in candidates if c in df.columns]


def require_columns(df: DataFrame, cols, what: str = "input") -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} missing columns: {missing}")
