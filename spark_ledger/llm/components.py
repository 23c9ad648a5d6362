"""Connected components by alternating large and small stars.

Every step is a grouped minimum and a join on written tables (plain exchanges,
so a node with very many edges is split at run time); nothing is collected but
a count and a checksum of the edges, which stop changing when every node hangs
on the smallest id of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_ledger.llm.common import cut_lineage


def _sum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node that has an edge to another one;
    repeated edges, loops and nulls are ignored."""
    e = cut_lineage(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
                    .select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
                    .where("u != v").distinct())
    now = _sum(e)
    while now[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut_lineage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = cut_lineage(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = cut_lineage(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut_lineage(small.unionByName(least.withColumnRenamed("m", "v")).distinct())
        before, now = now, _sum(e)
        if now == before:
            break
    roots = e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
