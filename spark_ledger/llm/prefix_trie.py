"""Conversation prefix trie in double arrays, one per prefix shard.

1. ``rebuilt``: turns are numbered in their conversation and conversations are
   rebuilt (head of another one, then their own rest), all by joins and
   distributed running numbers; a turn is identified by the MD5 of role and text,
   a prefix by its depth and 128 bits combined from its turns and their places.
2. Conversations with equal turns become one sequence: smallest id, number and
   the digest of their ids, which are joined in sorted runs.
3. A node under which more than ``shard_turns`` turns of distinct sequences hang is
   an upper node, so a first turn that a third of all conversations share, or the
   beginning of a very long conversation, is never handled in one task.  The
   subtrees below the upper nodes are dealt to tasks and packed, some shards
   together, into BASE and CHECK arrays over dense turn ids.
4. The arrays are written as Parquet rows (the operator's files), read again and
   traversed for the nodes.  Upper nodes, shared by many shards, get their
   aggregates in a global merge: the sums under an upper node are collected
   along the path of its subtree's smallest members.

Turns of one number are ordered by their digest; a null turn comes first, null
role or text counts as empty, rows without a conversation id belong to no
conversation and are left out.  Repeated rows are turns of their own, other
columns are not looked at, and an empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_ledger.llm.common import cut_lineage, shared_path
from spark_ledger.operators.ranking import numbered, running, sums, xors

SHARD_TURNS = 50_000       # turns of distinct sequences in a shard at most
RUN_IDS = 4096             # ids joined into one run
NODE = ["depth", "p1", "p2"]
_EMPTY = hashlib.sha256(b"").hexdigest()


def head_length(conv_id):
    """Turns that a conversation takes from the first of its five."""
    return F.crc32(F.col(conv_id).cast("string").cast("binary")) % 9


def rebuilt(convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(turns, conversations)``: ``conv_id, depth, length, key, bytes`` of each
    rebuilt turn, and ``conv_id, length`` of each conversation."""
    key = F.md5(F.concat_ws(":", F.length("role"), "role", "text"))
    src = convs.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn",
                                                    F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    src = src.select("conv_id", "turn", key.alias("key"), F.octet_length("text").cast("long").alias("bytes"))
    turns = cut_lineage(numbered(src, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("key")], "i", 0).drop("turn"))
    n = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    info = n.select("conv_id", "n", head_length("conv_id").alias("h"), F.expr("conv_id - conv_id % 5").alias("parent"))
    info = info.join(n.select(F.col("conv_id").alias("parent"), F.col("n").alias("parent_n")), "parent", "left")
    info = info.withColumn("head", F.least("h", F.coalesce("parent_n", F.lit(0))))
    info = cut_lineage(info.withColumn("length", F.expr("head + greatest(n - h, 0)")))
    own = turns.join(info.select("conv_id", "h", "head", "length"), "conv_id").where("i >= h")
    own = own.select("conv_id", F.expr("head + i - h + 1").alias("depth"), "length", "key", "bytes")
    taken = info.select(F.col("conv_id").alias("child"), F.col("parent").alias("conv_id"), "h", "length")
    taken = turns.where("i < 8").join(taken, "conv_id").where("i < h")
    taken = taken.select(F.col("child").alias("conv_id"), F.expr("i + 1").alias("depth"), "length", "key", "bytes")
    return own.unionByName(taken), info.select("conv_id", "length")


def member_digests(ends: DataFrame) -> DataFrame:
    """``node, conv_id, n, ends_sha256`` per node at which conversations end: the
    smallest, their number and the digest of all ids.  Sorted runs of ids are joined
    first, so the task that digests a very common node reads few rows."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3).to_numpy()
            node = np.stack([batch.column(i).to_numpy() for i in range(3)])
            new = np.ones(len(ids), bool)
            new[1:] = (node[:, 1:] != node[:, :-1]).any(axis=0)
            at = np.flatnonzero(new)
            cuts = np.concatenate([np.arange(a, b, RUN_IDS) for a, b in zip(at, [*at[1:], len(ids)], strict=True)]) if len(ids) else at
            joined = [",".join(map(str, x)) for x in np.split(ids, cuts[1:])] if len(ids) else []
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(pa.array(cuts)) for i in range(4)),
                                              pa.array(np.diff(cuts, append=len(ids))), pa.array(joined, pa.string())],
                                             [*NODE, "conv_id", "n", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, n, sha = None, None, 0, None
        names = [*NODE, "conv_id", "n", "ends_sha256"]
        for batch in batches:
            done = []
            for *at, conv, count, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != node:
                    if node is not None:
                        done.append((*node, first, n, sha.hexdigest()))
                    node, first, n, sha = at, conv, 0, hashlib.sha256()
                sha.update((b"," if n else b"") + ids.encode())
                n += count
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names)
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*node, first, n, sha.hexdigest())], names)

    rows = ends.select(*NODE, "conv_id").repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    rows = rows.mapInArrow(runs, "depth long, p1 long, p2 long, conv_id long, n long, ids string")
    return rows.repartition(*NODE).sortWithinPartitions(*NODE, "conv_id").mapInArrow(
        digest, "depth long, p1 long, p2 long, conv_id long, n long, ends_sha256 string")


class DoubleArray:
    """A static trie over sorted sequences of dense ids: state ``s`` goes to ``t =
    base[s] + id`` if ``check[t] == s``.  State 0 is the start."""

    def __init__(self, base: np.ndarray, check: np.ndarray):
        self.base, self.check = base, check

    def go(self, state: int, symbol: int) -> int:
        t = int(self.base[state]) + symbol
        return t if 0 < t < len(self.check) and self.check[t] == state else -1

    @classmethod
    def build(cls, sequences: list[list[int]]) -> DoubleArray:
        """From sorted, distinct sequences, level by level."""
        base, check, free = [0], [0], 1                    # check of a free place is -1

        def grow(size):
            base.extend([0] * (size - len(base)))
            check.extend([-1] * (size - len(check)))

        level, depth = [(0, 0, len(sequences))], 0
        while level:
            below = []
            for state, lo, hi in level:
                while lo < hi and len(sequences[lo]) == depth:
                    lo += 1
                kids = []
                while lo < hi:
                    symbol, at = sequences[lo][depth], lo
                    while lo < hi and sequences[lo][depth] == symbol:
                        lo += 1
                    kids.append((symbol, at, lo))
                if not kids:
                    continue
                symbols = [k[0] for k in kids]
                while free < len(check) and check[free] >= 0:
                    free += 1
                at = free if len(kids) <= 8 else len(check)      # wide nodes go behind all others
                while any(at + s - symbols[0] < len(check) and check[at + s - symbols[0]] >= 0 for s in symbols):
                    at += 1
                base[state] = at - symbols[0]
                grow(at + symbols[-1] - symbols[0] + 1)
                for symbol, a, b in kids:
                    check[base[state] + symbol] = state
                    below.append((base[state] + symbol, a, b))
            level, depth = below, depth + 1
        return cls(np.array(base, np.int64), np.array(check, np.int64))


_PACKED = ("base binary, check binary, symbols binary, roots binary, conv binary, members binary, bytes binary, depth binary, "
           "end_states binary, end_shas binary")


def pack(rows: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Whole shards, about ``shard_turns`` turns together, as double arrays.

    Input: sorted by shard, sequence and depth.  The first symbol of a sequence
    stands for the upper node above its shard, so shards under one upper node meet
    there; dense ids are given in order of sequence."""

    def pack_rows(parts: list[dict]) -> pa.RecordBatch:
        col = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
        conv, depth, size = col["conv_id"], col["depth"], len(col["conv_id"])
        first = np.ones(size, bool)
        first[1:] = conv[1:] != conv[:-1]
        roots, root = np.unique(np.stack([col["depth"] - 1, col["q1"], col["q2"]])[:, first], axis=1, return_inverse=True)
        keys, turn = np.unique(col["key"], return_inverse=True)
        turn = turn.reshape(-1) + roots.shape[1]            # ids of upper nodes come first
        cuts = np.append(np.flatnonzero(first), size)
        order = sorted(range(len(cuts) - 1), key=lambda i: (root.flat[i], turn[cuts[i]:cuts[i + 1]].tolist()))
        sequences = [[int(root.flat[i]), *turn[cuts[i]:cuts[i + 1]].tolist()] for i in order]
        trie = DoubleArray.build(sequences)
        states = len(trie.check)
        least, members, size_of, depth_of, ends = np.full(states, np.iinfo(np.int64).max), np.zeros(states, np.int64), \
            np.zeros(states, np.int64), np.full(states, -1, np.int64), []
        for i, sequence in zip(order, sequences, strict=True):
            state, c, n = trie.go(0, sequence[0]), int(conv[cuts[i]]), int(col["n"][cuts[i]])
            depth_of[state] = depth[cuts[i]] - 1
            for j, symbol in enumerate(sequence[1:], int(cuts[i])):
                state = trie.go(state, symbol)
                least[state] = min(least[state], c)
                members[state] += n
                size_of[state], depth_of[state] = col["bytes"][j], depth[j]
            ends.append((state, col["sha"][cuts[i + 1] - 1]))
        cells = (trie.base, trie.check, b"".join(keys.tolist()), roots.T, least, members, size_of, depth_of,
                 np.array([s for s, _ in ends], np.int64), b"".join(s for _, s in ends))
        cells = [pa.array([c if isinstance(c, bytes) else np.ascontiguousarray(c, np.int64).tobytes()], pa.binary()) for c in cells]
        return pa.RecordBatch.from_arrays(cells, [c.split()[0] for c in _PACKED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, last = [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            col = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("conv_id", "depth", "n", "bytes", "q1", "q2", "r1", "r2")}
            col |= {c: np.array(batch.column(c).to_pylist(), object) for c in ("key", "sha")}
            new = np.ones(batch.num_rows, bool)
            new[1:] = (col["r1"][1:] != col["r1"][:-1]) | (col["r2"][1:] != col["r2"][:-1])
            new[0] = last is None or last != (col["r1"][0], col["r2"][0])
            at = 0
            for cut in [*np.flatnonzero(new), batch.num_rows]:
                if cut > at:
                    held.append({c: v[at:cut] for c, v in col.items()})
                    count, at = count + cut - at, cut
                if count >= shard_turns and cut < batch.num_rows:
                    yield pack_rows(held)
                    held, count = [], 0
            last = (col["r1"][-1], col["r2"][-1])
        if held:
            yield pack_rows(held)

    return rows.mapInArrow(run, _PACKED)


def traverse(tries: DataFrame) -> DataFrame:
    """Nodes of packed shards: a state's children are the places that check it,
    sums go from the deepest level to the shallowest.  Rows with null ``conv_id``
    are what the shards give the upper nodes above them."""
    schema = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
              "ends_sha256 string, turn_key string, q1 long, q2 long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                a = {k: np.frombuffer(v, np.int64) for k, v in row.items() if k not in ("symbols", "end_shas")}
                check, depth, roots = a["check"], a["depth"], a["roots"].reshape(-1, 3)
                live = np.flatnonzero(depth >= 0)
                up = check[live]
                kids = np.bincount(up, minlength=len(check))
                leaves = (kids == 0).astype(np.int64)
                saved = np.where(a["members"] > 0, (a["members"] - 1) * a["bytes"], 0)
                by_depth = live[np.argsort(-depth[live], kind="stable")]
                for level in np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1):
                    level = level[check[level] != 0]
                    np.add.at(leaves, check[level], leaves[level])
                    np.add.at(saved, check[level], saved[level])
                above = np.flatnonzero(check[live] == 0)             # states of upper nodes
                of_root = np.full(len(check), -1, np.int64)
                of_root[live[above]] = live[above] - a["base"][0]
                is_root = of_root[live] >= 0
                is_top = ~is_root & (of_root[check[live]] >= 0)
                upper = np.where(is_root, of_root[live], np.where(is_top, of_root[check[live]], 0))
                sha = np.full(len(check), _EMPTY, object)
                for i, s in enumerate(a["end_states"]):
                    sha[s] = row["end_shas"][64 * i:64 * i + 64].decode()
                symbol = live - a["base"][check[live]] - len(roots)
                key = [None if r else row["symbols"][32 * s:32 * s + 32].decode() for r, s in zip(is_root, symbol, strict=True)]
                outer = is_root | is_top
                yield pa.RecordBatch.from_arrays([
                    pa.array(a["conv"][live], mask=is_root), pa.array(depth[live]), pa.array(a["conv"][check[live]], mask=outer),
                    pa.array(a["members"][live]), pa.array(kids[live]), pa.array(leaves[live]), pa.array(saved[live]),
                    pa.array(sha[live], pa.string()), pa.array(key, pa.string()),
                    pa.array(roots[upper, 1], mask=~outer), pa.array(roots[upper, 2], mask=~outer)], [c.split()[0] for c in schema.split(", ")])

    return tries.mapInArrow(run, schema)


def prefix_nodes(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations; ``turn_key`` is
    the digest of its last turn (null at the root)."""
    turns, every = rebuilt(convs)
    turns = turns.withColumn("x1", F.xxhash64("depth", "key")).withColumn("x2", F.xxhash64(F.lit("second"), "key", "depth"))
    turns = cut_lineage(running(turns, ["conv_id"], [F.col("depth")], {"p1": xors(F.col("x1")), "p2": xors(F.col("x2"))})
                        .withColumn("q1", F.col("p1").bitwiseXOR(F.col("x1"))).withColumn("q2", F.col("p2").bitwiseXOR(F.col("x2"))).drop("x1", "x2"))
    zero = F.lit(0).cast("long")
    ends = turns.where("depth = length").select(*NODE, "conv_id").unionByName(
        every.where("length = 0").select(zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), "conv_id"))
    reps = cut_lineage(member_digests(ends))                # one row per distinct sequence
    chosen = reps.select("conv_id", "n", F.col("depth").alias("last"), F.col("ends_sha256").alias("sha"))
    rows = turns.join(chosen, "conv_id").withColumn("sha", F.when(F.col("depth") == F.col("last"), F.col("sha")))
    root = chosen.select("conv_id", zero.alias("depth"), F.col("last").alias("length"), F.lit(None).cast("string").alias("key"), zero.alias("bytes"),
                         zero.alias("p1"), zero.alias("p2"), zero.alias("q1"), zero.alias("q2"), "n", "last",
                         F.when(F.col("last") == 0, F.col("sha")).alias("sha"))
    heavy = rows.groupBy(*NODE).agg(F.sum(F.col("length") - F.col("depth") + 1).alias("w")).where(F.col("w") > shard_turns).select(*NODE)
    rows = cut_lineage(rows.join(heavy.withColumn("upper", F.lit(True)), NODE, "left"))

    # below the upper nodes: shards, packed and traversed in their tasks
    below = rows.where("upper is null")
    tops = below.groupBy("conv_id").agg(F.min_by(F.struct("depth", "p1", "p2", "q1", "q2"), "depth").alias("top"))
    below = below.drop("q1", "q2").join(tops, "conv_id")
    below = below.select("conv_id", "depth", "n", "bytes", F.col("key").cast("binary").alias("key"),
                         F.coalesce("sha", F.lit("")).cast("binary").alias("sha"),
                         F.col("top.q1").alias("q1"), F.col("top.q2").alias("q2"), F.col("top.p1").alias("r1"), F.col("top.p2").alias("r2"))
    path = shared_path(convs.sparkSession, "tries")
    pack(below.repartition("r1", "r2").sortWithinPartitions("r1", "r2", "conv_id", "depth"), shard_turns).write.parquet(path)
    nodes = traverse(convs.sparkSession.read.parquet(path))

    # upper nodes: shared by shards, merged globally
    upper = rows.where("upper").drop("upper").unionByName(root)
    at = [F.col("depth"), F.col("p1"), F.col("p2")]
    own = upper.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"), F.max("bytes").alias("bytes"), F.max("sha").alias("sha"),
                                   F.max("q1").alias("q1"), F.max("q2").alias("q2"), F.max("key").alias("turn_key"))
    given = nodes.where("conv_id is null").select("depth", F.col("q1").alias("p1"), F.col("q2").alias("p2"), "n_children", "n_leaves", "saved_tokens")
    among = own.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2"),
                                          F.lit(1).cast("long").alias("n_children"), zero.alias("n_leaves"), zero.alias("saved_tokens"))
    given = given.unionByName(among).groupBy(*at).agg(F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("leaves"),
                                                      F.sum("saved_tokens").alias("saved"))
    own = own.join(given, NODE, "left").fillna(0, ["n_children", "leaves", "saved"])
    own = cut_lineage(own.withColumn("leaves", F.when(F.col("n_children") == 0, 1).otherwise(F.col("leaves")))
                      .withColumn("saved", F.col("saved") + (F.col("n_convs") - 1) * F.col("bytes")))
    owners = own.select("conv_id").distinct()
    paths = upper.join(owners, "conv_id", "leftsemi").select(*NODE, "conv_id").join(own.select(*NODE, "conv_id", "leaves", "saved"), [*NODE, "conv_id"], "left")
    paths = running(paths.fillna(0, ["leaves", "saved"]), ["conv_id"], [F.col("depth").desc()],
                    {"n_leaves": sums(F.col("leaves")), "saved_tokens": sums(F.col("saved"))})
    total = paths.groupBy(*NODE).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    names = own.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("above"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "turn_key"]
    top = own.join(total, NODE).join(names, ["depth", "q1", "q2"], "left").select(
        "conv_id", "depth", F.col("above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("sha", F.lit(_EMPTY)).alias("ends_sha256"), "turn_key")
    low = nodes.where("conv_id is not null").join(names, ["depth", "q1", "q2"], "left")
    low = low.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above")).select(*out)
    return top.select(*out).unionByName(low)


def oracle_sql() -> str:
    """The same nodes in DuckDB from the lists of all prefixes."""
    crc = ("xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(c::VARCHAR) + 1), "
           "lambda i: ord((c::VARCHAR)[i])::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), "
           "lambda x, k: xor(x >> 1, (x & 1) * 3988292384))))")
    return f"""
WITH t AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id AS c, list({{'r': role, 't': text}} ORDER BY turn NULLS FIRST, md5(concat_ws(':', length(role)::VARCHAR, role, text))) AS turns FROM t GROUP BY 1),
h AS (SELECT c, turns, ({crc}) % 9 AS h FROM o),
r AS (SELECT a.c, list_concat(COALESCE(b.turns, [])[1:a.h], a.turns[a.h + 1:]) AS path FROM h a LEFT JOIN o b ON b.c = a.c - a.c % 5),
p AS (SELECT c, path, unnest(range(0, len(path) + 1)) AS depth FROM r),
node AS (SELECT depth, path[1:depth] AS path, MIN(c) AS conv_id, COUNT(*) AS n_convs,
  COALESCE(string_agg(CASE WHEN len(path) = depth THEN c::VARCHAR END, ',' ORDER BY c), '') AS ends FROM p GROUP BY ALL),
kids AS (SELECT depth - 1 AS depth, path[1:depth - 1] AS path, COUNT(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
n AS (SELECT node.*, COALESCE(n_children, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * strlen(path[depth].t) ELSE 0 END AS saved
  FROM node LEFT JOIN kids USING (depth, path)),
sub AS (SELECT d AS depth, path[1:d] AS path, SUM((n_children = 0)::BIGINT) AS n_leaves, SUM(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM n) GROUP BY ALL)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN sub USING (depth, path) LEFT JOIN node u ON u.depth = n.depth - 1 AND u.path = n.path[1:n.depth - 1]"""
