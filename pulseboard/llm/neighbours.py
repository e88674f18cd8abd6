"""Nearest neighbours by inner product: graphs from NN-descent, searched greedily.

Every vector is indexed. Equal vectors are one node, so that a vector with very many copies is no
hub. Nodes are dealt by a hash into shards of about SHARD nodes; more rows make more shards, not larger
ones. In each shard a graph of DEGREE neighbours per node starts at random and is improved in
ROUNDS rounds: Spark joins the lists of neighbours (and of those that have the node as a neighbour) with
each other to neighbours of neighbours, and the tasks of the shards keep the nearest. For vectors
of different length, nearness in the graph is that of vectors made equally long by one more
coordinate, whose order for any query is that of the inner product.

A query visits all shards. In each it starts from STARTS nodes spread over the shard, and from one more in
each part of the graph that no arcs lead to from these; so clusters whose nearest are all their own are
found, too. It goes on from the best nodes found that it has not gone on from, and stops when the BEAM
best have all been used. What the shards found is merged, and copies are put back in.

Recall against brute force is measured in the tests, at these parameters on the table of embeddings and
on clustered vectors of 64 numbers: at least 0.9.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no
part, neither do rows without an id, or of another length than most vectors have (of equally
frequent lengths, the largest). Repeated rows (id and vector) are one row. Ties go to the smaller id.
With fewer candidates than asked for, all are returned. No rows give an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseboard.sources.scratch import written

SHARD = 8192
DEGREE = 32
ROUNDS = 5
JOINED = 24
BEAM = 160
EXPANDED = 8
STARTS = 512
QUERIES = 1024
SALTS = 64


def valid(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, v, h1, h2) of the rows that take part."""
    x = F.col(vector)
    fine = (
        F.col(vec_id).isNotNull()
        & x.isNotNull()
        & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
        & F.exists(x, lambda c: c != 0)
    )
    # Of the two zeros, one.
    clean = F.transform(x.cast("array<float>"), lambda c: c + F.lit(0.0).cast("float"))
    rows = vectors.where(fine).select(F.col(vec_id).cast("long").alias("id"), clean.alias("v"))
    most = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    rows = rows.where(F.size("v") == (most[0]["d"] if most else 0))
    hashed = rows.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v")})
    return hashed.dropDuplicates(["id", "h1", "h2"])


def members(rows: DataFrame, most: int) -> DataFrame:
    """(h1, h2, id): the ``most`` smallest ids of each distinct vector; first within salted parts."""
    salted = rows.select("h1", "h2", "id", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt"))
    for part in (["h1", "h2", "salt"], ["h1", "h2"]):
        rank = F.row_number().over(Window.partitionBy(*part).orderBy("id"))
        salted = salted.withColumn("rank", rank).where(F.col("rank") <= most).drop("rank")
    return salted.select("h1", "h2", "id")


def nodes(rows: DataFrame, shard: int) -> DataFrame:
    """(shard, node, size, h1, h2, v): distinct vectors, numbered in their shards."""
    distinct = written(rows.groupBy("h1", "h2").agg(F.first("v").alias("v")), "distinct")
    shards = max(1, -(-distinct.count() // shard))
    dealt = distinct.withColumn("shard", F.pmod(F.xxhash64("h1", "h2"), F.lit(shards)).cast("int"))
    order = Window.partitionBy("shard").orderBy("h1", "h2")
    numbered = dealt.withColumns(
        {"node": (F.row_number().over(order) - 1).cast("short"), "size": F.count("*").over(Window.partitionBy("shard")).cast("int")}
    )
    return written(numbered.select("shard", "node", "size", "h1", "h2", "v"), "nodes")


def _matrix(table: pa.Table) -> np.ndarray:
    """The vectors of a shard's nodes, by number."""
    order = np.argsort(table.column("node").to_numpy())
    flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(table.num_rows, -1)[order]


def _even(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with one more coordinate, so that all have the greatest length."""
    rest = np.sqrt(np.maximum(longest**2 - np.einsum("ij,ij->i", x, x), 0))
    return np.concatenate([x, rest[:, None]], 1)


def _padded(lists: pa.ChunkedArray, own: np.ndarray, n: int) -> np.ndarray:
    """Lists of node numbers as rows of a matrix by the owner's number; -1 where a list has ended."""
    array = lists.combine_chunks()
    offsets = array.offsets.to_numpy()
    flat = array.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    out = np.full((n, max(int(sizes.max(initial=0)), 1)), -1, np.int32)
    row = np.repeat(own, sizes)
    out[row, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = flat
    return out


def _nearest(x: np.ndarray, asked: np.ndarray, degree: int) -> np.ndarray:
    """Of the candidates of each node the nearest, best first; -1 where there are fewer."""
    out = np.full((len(x), degree), -1, np.int32)
    for i in range(0, len(x), 128):
        some = np.sort(asked[i : i + 128], 1)
        again = np.zeros(some.shape, bool)
        again[:, 1:] = some[:, 1:] == some[:, :-1]
        mine = np.arange(i, i + len(some))
        scores = np.einsum("ijk,ik->ij", x[some], x[mine])
        scores[again | (some < 0) | (some == mine[:, None])] = -np.inf
        best = np.argsort(-scores, 1, kind="stable")[:, :degree]
        found = np.take_along_axis(some, best, 1)
        found[np.isneginf(np.take_along_axis(scores, best, 1))] = -1
        out[i : i + len(some), : found.shape[1]] = found
    return out


def _lists(shard: int, near: np.ndarray) -> pa.Table:
    n = len(near)
    keep = near >= 0
    offsets = np.concatenate([[0], np.cumsum(keep.sum(1))]).astype(np.int32)
    return pa.table(
        {
            "shard": pa.array(np.full(n, shard, np.int32)),
            "node": pa.array(np.arange(n, dtype=np.int16)),
            "near": pa.ListArray.from_arrays(pa.array(offsets), pa.array(near[keep].astype(np.int16))),
        }
    )


def _improved(every: DataFrame, asked: DataFrame, longest: float, degree: int) -> DataFrame:
    """(shard, node, near): the nearest of each node's candidates."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        shard = left.column("shard")[0].as_py()
        x = _even(_matrix(left), longest).astype(np.float32)
        candidates = _padded(right.column("asked"), right.column("node").to_numpy(), len(x))
        return _lists(shard, _nearest(x, candidates, degree))

    return (
        every.groupBy("shard")
        .cogroup(asked.groupBy("shard"))
        .applyInArrow(run, "shard int, node short, near array<short>")
    )


def graph(every: DataFrame, *, degree: int = DEGREE, rounds: int = ROUNDS, joined: int = JOINED) -> DataFrame:
    """(shard, node, near): lists of neighbours by NN-descent."""
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda total, c: total + c.cast("double") * c.cast("double")))
    longest = every.agg(F.max(length)).first()[0] or 0.0
    by_chance = F.transform(
        F.sequence(F.lit(1), F.lit(4 * degree)),
        lambda i: F.pmod(F.xxhash64("shard", "node", i), F.col("size")).cast("short"),
    )
    asked = every.select("shard", "node", by_chance.alias("asked"))
    near = written(_improved(every, asked, longest, degree), "graph")
    for turn in range(rounds):
        mixed = lambda x: F.transform(
            F.array_sort(F.transform(x, lambda c: F.struct(F.xxhash64(F.lit(turn), "node", c).alias("h"), c.alias("c")))),
            lambda s: s["c"],
        )
        arcs = near.select("shard", "node", F.explode("near").alias("other"))
        back = arcs.groupBy("shard", F.col("other").alias("node")).agg(F.collect_list(F.col("node")).alias("back"))
        known = near.join(back, ["shard", "node"], "left").select(
            "shard", "node", "near", F.coalesce("back", F.array().cast("array<short>")).alias("back")
        )
        both = written(
            known.select("shard", "node", "near", F.array_union("near", F.slice(mixed(F.col("back")), 1, degree)).alias("both")),
            "both",
        )
        lists = both.select(
            "shard", F.col("node").alias("other"), F.slice(mixed(F.col("both")), 1, joined).alias("list")
        )
        steps = both.select("shard", "node", F.explode(F.slice(mixed(F.col("both")), 1, degree)).alias("other"))
        reached = (
            steps.join(lists, ["shard", "other"])
            .groupBy("shard", "node")
            .agg(F.array_distinct(F.flatten(F.collect_list("list"))).alias("reached"))
        )
        asked = both.join(reached, ["shard", "node"], "left").select(
            "shard",
            "node",
            F.concat("both", F.coalesce("reached", F.array().cast("array<short>"))).alias("asked"),
        )
        near = written(_improved(every, asked, longest, degree), "graph")
    return near


def _starts(arcs: np.ndarray) -> np.ndarray:
    """Nodes spread over the shard, and more until all nodes can be reached."""
    n = len(arcs)
    starts = np.unique(np.linspace(0, n - 1, min(STARTS, n)).astype(np.int64))
    reached = np.zeros(n, bool)
    more, new = [], starts
    while True:
        while len(new):
            reached[new] = True
            new = np.unique(arcs[new])
            new = new[new >= 0]
            new = new[~reached[new]]
        if reached.all():
            return np.concatenate([starts, np.array(more, np.int64)])
        new = np.flatnonzero(~reached)[:1]
        more.append(int(new[0]))


def _greedy(
    x: np.ndarray, arcs: np.ndarray, starts: np.ndarray, queries: np.ndarray, top: int, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each query the best nodes found and their scores, best first; -1 where there are fewer."""
    n, q = len(x), len(queries)
    rows = np.arange(q)[:, None]
    seen = np.zeros((q, n), bool)
    seen[:, starts] = True
    best = np.broadcast_to(starts, (q, len(starts))).copy()
    scores = queries @ x[starts].T
    used = np.zeros(best.shape, bool)
    while True:
        order = np.argsort(-scores, 1, kind="stable")[:, :beam]
        best, scores, used = (np.take_along_axis(a, order, 1) for a in (best, scores, used))
        # The best that have not been used, some at a time.
        open_ = ~used & np.isfinite(scores)
        place = np.cumsum(open_, 1)
        go = open_ & (place <= EXPANDED)
        if not go.any():
            return best[:, :top], scores[:, :top]
        used |= go
        who, col = np.nonzero(go)
        found = arcs[best[who, col]]
        slot = place[who, col] - 1
        wide = np.full((q, EXPANDED, arcs.shape[1]), -1, np.int64)
        wide[who, slot] = found
        some = np.sort(wide.reshape(q, -1), 1)
        fresh = some >= 0
        fresh[:, 1:] &= some[:, 1:] != some[:, :-1]
        fresh &= ~seen[rows, some]
        width = int(fresh.sum(1).max())
        if width == 0:
            continue
        # Those that are new go to the front of each row.
        front = np.argsort(~fresh, 1, kind="stable")[:, :width]
        some, fresh = np.take_along_axis(some, front, 1), np.take_along_axis(fresh, front, 1)
        at = np.where(fresh, some, 0)
        got = np.einsum("ijk,ik->ij", x[at], queries)
        got[~fresh] = -np.inf
        seen[np.broadcast_to(rows, some.shape)[fresh], some[fresh]] = True
        best = np.concatenate([best, at], 1)
        scores = np.concatenate([scores, got], 1)
        used = np.concatenate([used, ~fresh], 1)


def search(every: DataFrame, near: DataFrame, queries: DataFrame, *, top: int, beam: int = BEAM) -> DataFrame:
    """(query_id, h1, h2, score): for each query (id, v) the ``top`` best nodes of every shard."""
    blocks = max(1, -(-queries.count() // QUERIES))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    placed = queries.select(block.alias("block"), F.col("id").alias("query_id"), F.col("v").alias("q"))
    # A block of queries meets each shard, and a shard each block.
    all_blocks = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    there = every.join(near, ["shard", "node"]).select("shard", all_blocks, "node", "h1", "h2", "v", "near")
    count = every.agg(F.max("shard")).first()[0]
    asked = placed.select("*", F.explode(F.sequence(F.lit(0), F.lit(0 if count is None else count))).alias("shard"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(left.column("node").to_numpy())
        exact = _matrix(left).astype(np.float64)
        n = len(exact)
        out = _padded(left.column("near"), left.column("node").to_numpy(), n)
        # Arcs go both ways: each node also gets some of those that have it as a neighbour.
        node, at = np.nonzero(out >= 0)
        other = out[node, at]
        by = np.lexsort((at, other))
        node, other = node[by], other[by]
        rank = np.arange(len(other)) - np.searchsorted(other, other)
        back = np.full(out.shape, -1, np.int32)
        some = rank < out.shape[1]
        back[other[some], rank[some]] = node[some]
        arcs = np.concatenate([out, back], 1)
        starts = _starts(arcs)
        flat = right.column("q").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        q = flat.reshape(right.num_rows, -1).astype(np.float64)
        ids = right.column("query_id").to_numpy()
        h1, h2 = (left.column(c).to_numpy()[order] for c in ("h1", "h2"))
        tables = []
        for i in range(0, len(q), 64):
            best, scores = _greedy(exact.astype(np.float32), arcs, starts, q[i : i + 64].astype(np.float32), top, beam)
            row, col = np.nonzero(np.isfinite(scores))
            found = best[row, col]
            tables.append(
                pa.table(
                    {
                        "query_id": ids[i + row],
                        "h1": h1[found],
                        "h2": h2[found],
                        "score": np.einsum("ij,ij->i", exact[found], q[i + row]),
                    }
                )
            )
        return pa.concat_tables(tables)

    return (
        there.groupBy("shard", "block")
        .cogroup(asked.groupBy("shard", "block"))
        .applyInArrow(_both_sides(run), "query_id long, h1 long, h2 long, score double")
    )


def _both_sides(run):
    """A function of two tables, called where both have rows."""

    def guarded(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows and right.num_rows:
            return run(left, right)
        schema = pa.schema([("query_id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("score", pa.float64())])
        return schema.empty_table()

    return guarded


def nearest(
    vectors: DataFrame,
    queries: DataFrame | None = None,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    top: int = 20,
    shard: int = SHARD,
    beam: int = BEAM,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` vectors of largest inner product found for each
    query, its own id left out. ``queries`` has the columns of ``vectors``."""
    rows = written(valid(vectors, vec_id, vector), "vectors")
    asked = rows if queries is None else written(valid(queries, vec_id, vector), "queries")
    every = nodes(rows, shard)
    found = search(every, graph(every), asked.select("id", "v"), top=top + 1, beam=max(beam, top + 1))
    # The best nodes of each query are enough, however many copies they have.
    place = F.rank().over(Window.partitionBy("query_id").orderBy(F.desc("score")))
    kept = found.withColumn("place", place).where(F.col("place") <= top + 1)
    ranked = (
        kept.join(members(rows, top + 1), ["h1", "h2"])
        .where("id <> query_id")
        .withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id")))
        .where(F.col("rank") <= top)
    )
    return ranked.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
