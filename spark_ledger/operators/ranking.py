"""Running numbers and running totals without a window over a whole group.

Rows are dealt to ranges of ``(group, order)``, so a group that holds a third of
all rows spreads over many partitions.  Each partition numbers its own rows; the
counts per (group, partition), a few rows for a group, give every partition its
offset.  The ranges are written once (reliable checkpoint): range bounds come
from a sample, so a frame that is evaluated again could be cut elsewhere.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spark_ledger.session import cut_lineage

#: a total: its input, the aggregate, and how two parts combine (either may be null: no rows)
Total = tuple[Column, Callable[[Column], Column], Callable[[Column, Column], Column]]


def _either(join: Callable[[Column, Column], Column], nothing: int) -> Callable[[Column, Column], Column]:
    return lambda a, b: join(F.coalesce(a, F.lit(nothing)), F.coalesce(b, F.lit(nothing)))


def sums(value: Column) -> Total:
    """0 over no rows."""
    return value, F.sum, _either(lambda a, b: a + b, 0)


def xors(value: Column) -> Total:
    """0 over no rows."""
    return value, F.bit_xor, _either(lambda a, b: a.bitwiseXOR(b), 0)


def largest(value: Column) -> Total:
    """Null over no rows; nulls are passed over."""
    return value, F.max, F.greatest


def running(df: DataFrame, group: list[str], order: list[Column], totals: dict[str, Total], inclusive: bool = True) -> DataFrame:
    """Add each total over the rows of the group up to this one, itself included
    unless ``inclusive`` is false.

    ``order`` must be total within a group where the result depends on it; null
    group keys form groups, as in a window."""
    names = list(totals)
    key = F.struct(*(F.col(c) for c in group))          # nulls are equal inside a struct
    parts = df.withColumn("__g", key)
    for n in names:
        parts = parts.withColumn(f"__v_{n}", totals[n][0])
    parts = cut_lineage(parts.repartitionByRange("__g", *order).withColumn("__part", F.spark_partition_id()))
    inside = Window.partitionBy("__g", "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    before = Window.partitionBy("__g").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sub = parts.groupBy("__g", "__part").agg(*(totals[n][1](f"__v_{n}").alias(f"__t_{n}") for n in names))
    sub = sub.select("__g", "__part", F.lag("__part").over(Window.partitionBy("__g").orderBy("__part")).alias("__earlier"),
                     *(totals[n][1](f"__t_{n}").over(before).alias(f"__o_{n}") for n in names))
    sub = sub.where("__earlier is not null").drop("__earlier")      # groups within one range need no offset
    for n in names:
        parts = parts.withColumn(f"__i_{n}", totals[n][1](f"__v_{n}").over(inside))
    out = parts.join(sub, ["__g", "__part"], "left")
    keep = [F.col(c) for c in df.columns if c not in names]
    return out.select(*keep, *(totals[n][2](F.col(f"__i_{n}"), F.col(f"__o_{n}")).alias(n) for n in names))


def numbered(df: DataFrame, group: list[str], order: list[Column], name: str, base: int = 1) -> DataFrame:
    """Running number within each group, from ``base``."""
    out = running(df, group, order, {name: sums(F.lit(1).cast("long"))})
    return out.withColumn(name, F.col(name) + F.lit(base - 1))
