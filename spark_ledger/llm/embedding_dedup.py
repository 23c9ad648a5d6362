"""Embedding near-dedup by E8 lattice hashing.

Unit vectors are turned by a seeded random rotation; ``blocks`` runs of eight
turned coordinates are each decoded to the nearest point of a scaled E8 lattice,
and the points together are the cell of one table.  Near vectors fall into the
same or a neighbouring cell, so every vector is kept in its own cell and also
looks into the ``probes`` neighbouring cells that are nearest to it.  Vectors
that meet in a cell of any table are compared by cosine in double precision.

The tables' number follows from the wanted chance of missing a pair that lies
exactly at the threshold (pairs above it are missed more rarely still), measured
on a fixed set of random displacements, not on the data.

Equal vectors are one class that is compared once.  Cells with more than ``ROWS``
vectors are compared block by block.  Vectors that are null, zero, or hold null
or non-finite components link with nothing; vectors of different length do not
link; rows that share an id are one vector if equal and are otherwise told apart
by their vectors; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_ledger.llm.common import cut_lineage, shared_path
from spark_ledger.llm.components import components

THRESHOLD = 0.95
SCALE = 0.30               # lattice scale for unit vectors of 64 components; grows with sqrt(64 / length)
ROWS = 2048
MISS = 1e-5                # chance of missing a pair at the threshold


def e8_decode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Twice the nearest E8 point of each row, and for each of the sixteen cosets'
    candidates its distance: nearest point of D8 and of D8 + 1/2, the nearer one."""
    def d8(y):
        r = np.rint(y)
        off = y - r
        odd = r.sum(axis=1).astype(np.int64) % 2 != 0
        worst = np.abs(off).argmax(axis=1)
        at = np.flatnonzero(odd)
        step = np.where(off[at, worst[at]] >= 0, 1.0, -1.0)
        r[at, worst[at]] += step
        return r
    a, b = d8(x), d8(x - 0.5) + 0.5
    da, db = ((x - a) ** 2).sum(axis=1), ((x - b) ** 2).sum(axis=1)
    best = np.where((da <= db)[:, None], a, b)
    return np.rint(2 * best).astype(np.int64), np.minimum(da, db)


def shortest_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: steps to the neighbouring points."""
    out = []
    for i in range(8):
        for j in range(i):
            for s in (1, -1):
                for t in (1, -1):
                    v = np.zeros(8)
                    v[i], v[j] = s, t
                    out.append(v)
    for k in range(256):
        signs = np.array([1 if k >> i & 1 else -1 for i in range(8)])
        if (signs < 0).sum() % 2 == 0:
            out.append(signs * 0.5)
    return np.array(out)


STEPS = shortest_vectors()


def rotations(dim: int, tables: int, blocks: int, seed: int) -> list[np.ndarray]:
    """For each table ``blocks`` x 8 orthonormal directions; a rotation is used up
    before the next one is drawn."""
    rnd, out, left = np.random.default_rng(seed), [], np.zeros((0, dim))
    width = 8 * blocks
    if width > dim:
        raise ValueError(f"{blocks} blocks need at least {width} components")
    while len(out) < tables:
        if len(left) < width:
            left = np.linalg.qr(rnd.standard_normal((dim, dim)))[0]
        out.append(left[:width])
        left = left[width:]
    return out


def cells(x: np.ndarray, table: np.ndarray, scale: float, probes: int) -> np.ndarray:
    """Key of each row's cell (column 0) and of its ``probes`` nearest
    neighbouring cells."""
    y = (x @ table.T) / scale
    n, blocks = len(x), table.shape[0] // 8
    points, costs, steps = [], [], []
    for b in range(blocks):
        z = y[:, 8 * b:8 * b + 8]
        twice, base = e8_decode(z)
        off = z - twice / 2
        more = 2.0 - 2 * off @ STEPS.T                 # squared distance gained by each step
        near = np.argpartition(more, min(probes, 239), axis=1)[:, :max(probes, 1)]
        points.append(twice)
        costs.append(np.take_along_axis(more, near, axis=1))
        steps.append(near)
    mult = np.random.default_rng(8).integers(1, 2**62, (blocks, 8), dtype=np.int64) * 2 + 1
    with np.errstate(over="ignore"):
        part = [(p * m).sum(axis=1) for p, m in zip(points, mult)]
        own = np.sum(part, axis=0)
        if not probes:
            return own[:, None]
        every = np.concatenate(costs, axis=1)          # one step in one block
        pick = np.argsort(every, axis=1, kind="stable")[:, :probes]
        delta = np.concatenate([(np.rint(2 * STEPS)[s].astype(np.int64) * m).sum(axis=2) for s, m in zip(steps, mult)], axis=1)
        return np.concatenate([own[:, None], own[:, None] + np.take_along_axis(delta, pick, axis=1)], axis=1)


def meeting_chance(dim: int, blocks: int, scale: float, probes: int, cosine: float, n: int = 4000) -> float:
    """Chance that two unit vectors of this cosine meet in one table."""
    rnd = np.random.default_rng(88)
    x = rnd.standard_normal((n, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    d = rnd.standard_normal((n, dim))
    d -= (d * x).sum(axis=1)[:, None] * x
    d /= np.linalg.norm(d, axis=1)[:, None]
    y = cosine * x + np.sqrt(1 - cosine**2) * d
    t = rotations(dim, 1, blocks, 9)[0]
    a, b = cells(x, t, scale, probes), cells(y, t, scale, probes)
    return float(((a == b[:, :1]).any(axis=1) | (b == a[:, :1]).any(axis=1)).mean())


def plan_tables(dim: int, blocks: int, probes: int, cosine: float = THRESHOLD, miss: float = MISS) -> tuple[int, float]:
    """Number of tables and the lattice scale."""
    scale = SCALE * np.sqrt(64 / dim)
    p = min(meeting_chance(dim, blocks, scale, probes, cosine), 0.999)
    return max(1, int(np.ceil(np.log(miss) / np.log1p(-p)))), scale


def _keys(tables: int, blocks: int, probes: int, scale: float, dim: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotations(dim, tables, blocks, seed)
        for batch in batches:
            for first in range(0, batch.num_rows, 4000):
                some = batch.slice(first, 4000)
                x = some.column(1).flatten().to_numpy().reshape(len(some), dim)
                x = x / np.linalg.norm(x, axis=1)[:, None]
                ids = some.column(0).to_numpy()
                for t, table in enumerate(turn):
                    keys = cells(x, table, scale, probes)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(keys.size, t, np.int32)), pa.array(keys.ravel()), pa.array(np.repeat(ids, keys.shape[1])),
                        pa.array(np.tile(np.arange(keys.shape[1]) == 0, len(ids)))], ["t", "key", "rep", "own"])
    return run


def _compare(threshold: float):
    def links(group: pa.Table) -> pa.Table:
        ids, own, side = (group.column(c).to_numpy() for c in ("rep", "own", "side"))
        x = np.array(group.column("v").to_pylist(), float)
        x /= np.linalg.norm(x, axis=1)[:, None]
        a, b = [], []
        left, right = np.flatnonzero(own & (side != 1)), np.flatnonzero(side != 0)
        for i in range(0, len(left), 512):
            p, q = np.nonzero(x[left[i:i + 512]] @ x[right].T >= threshold)
            a.append(ids[left[i:i + 512][p]])
            b.append(ids[right[q]])
        a, b = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in (a, b))
        some = a != b
        pair = np.unique(np.stack([np.minimum(a, b)[some], np.maximum(a, b)[some]], axis=1), axis=0)
        return pa.table({"a": pa.array(pair[:, 0], pa.int64()), "b": pa.array(pair[:, 1], pa.int64())})
    return links


def near_vectors(table: DataFrame, threshold: float = THRESHOLD, blocks: int = 2, probes: int = 4,
                 id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 1) -> DataFrame:
    """``(id, n_links, component_id, kept)`` of every row."""
    spark = table.sparkSession
    v = F.col(vector_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    fine = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                      & F.exists("v", lambda x: x != 0), F.lit(False))
    good = rows.where(fine)
    # equal vectors are one class, named by its smallest id
    classes = cut_lineage(good.groupBy("v").agg(F.min("id").alias("low"), F.count("*").alias("n"))
                          .withColumn("rep", F.xxhash64("low", "v")))
    sizes = [r[0] for r in classes.select(F.size("v").alias("d")).distinct().collect()]       # vector lengths
    found = None
    for dim in sorted(sizes):
        mine = classes.where(F.size("v") == dim).select("rep", "v")
        use = min(blocks, dim // 8)
        if use == 0:                                   # too short for the lattice: pad with zeros
            mine, width, use = mine.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), 8 - dim))), 8, 1
        else:
            width = dim
        tables, scale = plan_tables(width, use, probes, threshold)
        path = shared_path(spark, "cells")
        mine.mapInArrow(_keys(tables, use, probes, float(scale), width, seed), "t int, key long, rep long, own boolean").write.parquet(path)
        cell = spark.read.parquet(path)
        full = cut_lineage(cell.groupBy("t", "key").agg(F.count("*").alias("m"), F.max("own").alias("any"))
                           .where("m > 1 and any").withColumn("blocks", F.ceil(F.col("m") / ROWS).cast("int")).drop("any", "m"))
        met = cell.join(full, ["t", "key"])
        i = F.expr("pmod(xxhash64(rep), blocks)").cast("int")
        split = (met.withColumn("i", i).withColumn("j", F.explode(F.expr("sequence(0, blocks - 1)")))
                 .withColumn("x", F.least("i", "j")).withColumn("y", F.greatest("i", "j")))
        # in a pair of blocks (x, y) rows of x stand left and rows of y right, and both ways round for probing rows
        one = split.where("i = j").withColumn("side", F.lit(2))
        two = split.where("i != j").withColumn("side", F.when(F.col("i") == F.col("x"), 0).otherwise(1))
        turned = two.withColumn("side", 1 - F.col("side")).withColumn("y", F.col("y") + F.col("blocks"))
        sides = one.unionByName(two).unionByName(turned).select("t", "key", "x", "y", "rep", "own", "side")
        links = (sides.join(mine, "rep").groupBy("t", "key", "x", "y").applyInArrow(_compare(threshold), "a long, b long"))
        found = links if found is None else found.unionByName(links)
    if found is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    links = cut_lineage(found.distinct())
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = (both.join(classes.select(F.col("rep").alias("b"), "n"), "b").groupBy("a").agg(F.sum("n").alias("others")))
    comp = components(links)
    named = classes.join(comp.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep"))
    least = named.groupBy("component").agg(F.min("low").alias("component_id"))
    facts = cut_lineage(named.join(least, "component").join(counts.withColumnRenamed("a", "rep"), "rep", "left")
                        .select("v", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"))
    out = (rows.withColumn("w", F.when(fine, F.col("v"))).join(facts.withColumnRenamed("v", "w"), "w", "left")
           .select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                   F.coalesce("component_id", "id").alias("component_id")))
    return out.withColumn("kept", F.col(id_col) == F.col("component_id"))


def oracle_sql(threshold: float = THRESHOLD) -> str:
    """The same rows from all pairs, in DuckDB."""
    return f"""
WITH RECURSIVE r AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
g AS (SELECT vec_id, v FROM r WHERE v IS NOT NULL AND len(v) > 0 AND len([x for x in v if x IS NULL OR NOT isfinite(x)]) = 0
      AND len([x for x in v if x <> 0]) > 0),
e AS (SELECT x.vec_id AS a, y.vec_id AS b FROM g x JOIN g y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
      AND list_cosine_similarity(x.v, y.v) >= {threshold}),
n AS (SELECT a, count(*) AS n FROM e GROUP BY a),
reach(a, b) AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b),
c AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM r LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.a = vec_id"""
