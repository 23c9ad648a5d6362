"""Distributed running numbers against a plain window."""

import random

from pyspark.sql import Window, functions as F

from spark_ledger.operators.ranking import largest, numbered, running, sums, xors


def test_equals_window_on_a_hot_group(spark):
    rnd = random.Random(1)
    rows = [("hot" if rnd.random() < .4 else rnd.choice(["a", "b", None]), i, rnd.randint(-9, 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, o long, v long").repartition(7)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")       # several ranges though the data are small
        got = running(df, ["g"], [F.col("o").desc()], {"s": sums(F.col("v")), "x": xors(F.col("v")), "m": largest(F.col("v"))}, inclusive=False)
        num = numbered(df, ["g"], [F.col("o")], "rn", 0)
        assert got.select(F.spark_partition_id()).distinct().count() > 1
        w = Window.partitionBy("g").orderBy(F.col("o").desc()).rowsBetween(Window.unboundedPreceding, -1)
        want = df.select("*", F.coalesce(F.sum("v").over(w), F.lit(0)).alias("s"), F.coalesce(F.bit_xor("v").over(w), F.lit(0)).alias("x"),
                         F.max("v").over(w).alias("m"), (F.row_number().over(Window.partitionBy("g").orderBy("o")) - 1).alias("rn"))
        a = {r.o: (r.s, r.x, r.m) for r in got.collect()}
        n = {r.o: r.rn for r in num.collect()}
        b = want.collect()
        assert a == {r.o: (r.s, r.x, r.m) for r in b} and n == {r.o: r.rn for r in b}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert numbered(df.limit(0), ["g"], [F.col("o")], "rn").count() == 0
