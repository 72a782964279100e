"""Approximate nearest neighbours: one hierarchical small-world graph per shard.

Equal vectors are one node, which holds the smallest ids that have it (only these can be among
the nearest, as ties go to the smaller id). Nodes are dealt to shards of about ``SHARD`` nodes by a
hash. A shard's graph is one row: vectors, levels, and for each level a flat array of neighbours.

A level is built from the nearest neighbours of each of its nodes within the shard, thinned by the
selection rule of small-world graphs (a neighbour is dropped if a closer kept one is nearer to
it than the node is), and made symmetric. Each node of a level reaches the next one up with
probability 1/``FANOUT``. Links along a ring keep a level connected.

A search descends greedily to the ground level and explores it with a list of ``EF`` best nodes.
Queries visit all shards in blocks, and the results of the shards are merged. The distance of
what is found is then computed on the original vectors in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import saved

K = 10
SHARD = 4096
LINKS = 16
FANOUT = 16
EF = 96
QUERY_BLOCK = 512


def usable(vector: Column) -> Column:
    """Neither null, empty nor zero, and no component null, infinite or not a number."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(good & F.exists(vector, lambda x: x != 0), F.lit(False))


def _nearest(vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row its ``k`` nearest other rows, nearest first, and squared distances."""
    n = len(vectors)
    k = min(k, n - 1)
    squares = (vectors**2).sum(axis=1)
    ids, distances = np.zeros((n, k), np.int32), np.zeros((n, k), np.float32)
    for a in range(0, n, 512):
        d = squares[a : a + 512, None] + squares[None] - 2 * vectors[a : a + 512] @ vectors.T
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
        top = np.argpartition(d, k - 1, axis=1)[:, :k] if k < n - 1 else np.argsort(d, axis=1)[:, :k]
        near = np.take_along_axis(d, top, axis=1)
        order = np.argsort(near, axis=1, kind="stable")
        ids[a : a + 512] = np.take_along_axis(top, order, axis=1)
        distances[a : a + 512] = np.take_along_axis(near, order, axis=1)
    return ids, distances


def build_level(vectors: np.ndarray, links: int) -> np.ndarray:
    """Neighbours of each node as a flat array, ``2 * links + 2`` places a node, -1 where empty."""
    n, width = len(vectors), 2 * links + 2
    out = np.full((n, width), -1, np.int32)
    if n == 1:
        return out.reshape(-1)
    near, distance = _nearest(vectors, 3 * links)
    kept = np.zeros(near.shape, bool)
    held = np.zeros(n, np.int64)
    # Candidate j of all nodes at a time: is it nearer to the node than to every kept neighbour?
    for j in range(near.shape[1]):
        ok = held < links
        mine = vectors[near[:, j]]
        for i in range(j):
            rows = np.flatnonzero(ok & kept[:, i])
            if len(rows):
                d = ((vectors[near[rows, i]] - mine[rows]) ** 2).sum(axis=1)
                ok[rows] &= d > distance[rows, j]
        kept[:, j] = ok
        held += ok
    source, column = np.nonzero(kept)
    target = near[source, column]
    ring = np.arange(n)
    # Forward links first, then links back, up to the width less the ring.
    first = np.concatenate([source, target])
    second = np.concatenate([target, source])
    rank = np.concatenate([column, column + near.shape[1]])
    order = np.lexsort((rank, first))
    first, second = first[order], second[order]
    new = np.ones(len(first), bool)
    seen = np.unique(first.astype(np.int64) * n + second, return_index=True)[1]
    new[:] = False
    new[seen] = True
    first, second = first[new], second[new]
    place = np.arange(len(first)) - np.searchsorted(first, first)
    fits = place < width - 2
    out[first[fits], place[fits]] = second[fits]
    out[:, -2], out[:, -1] = (ring + 1) % n, (ring - 1) % n
    return out.reshape(-1)


def build(vectors: np.ndarray, ids: np.ndarray, links: int = LINKS, fanout: int = FANOUT) -> tuple[np.ndarray, list[np.ndarray]]:
    """Level of each node, and the flat neighbour array of each level over the nodes that reach it."""
    spread = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)
    draw = (spread.astype(np.float64) + 0.5) / (1 << 53)
    levels = np.floor(-np.log(draw) / np.log(fanout)).astype(np.int32)
    levels[np.argmax(levels)] = max(0, levels.max(initial=0))
    out = []
    for level in range(levels.max(initial=0) + 1):
        out.append(build_level(vectors[levels >= level], links))
    return levels, out


def search(
    vectors: np.ndarray, levels: np.ndarray, graph: list[np.ndarray], queries: np.ndarray, ef: int = EF
) -> tuple[np.ndarray, np.ndarray]:
    """For each query, node numbers and squared distances of the ``ef`` best found; -1 where fewer."""
    n, m = len(vectors), len(queries)
    members = [np.flatnonzero(levels >= level) for level in range(len(graph))]
    squares = (vectors**2).sum(axis=1)

    def distance(rows: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Up to the query's own square, which is the same for all its nodes."""
        return squares[nodes] - 2 * np.einsum("rkd,rd->rk", vectors[nodes], queries[rows])

    all_rows = np.arange(m)
    current = np.full(m, members[-1][0])
    best = distance(all_rows, current[:, None])[:, 0]
    for level in range(len(graph) - 1, 0, -1):
        local = np.full(n, -1)
        local[members[level]] = np.arange(len(members[level]))
        links = graph[level].reshape(len(members[level]), -1)
        moving = all_rows
        while len(moving):
            around = links[local[current[moving]]]
            nodes = members[level][np.maximum(around, 0)]
            d = np.where(around >= 0, distance(moving, nodes), np.inf)
            j = d.argmin(axis=1)
            better = d[np.arange(len(moving)), j] < best[moving]
            moved = moving[better]
            current[moved] = nodes[better, j[better]]
            best[moved] = d[better, j[better]]
            moving = moved
    links = graph[0].reshape(n, -1)
    ef = min(ef, n)
    found = np.full((m, ef), -1, np.int64)
    score = np.full((m, ef), np.inf, np.float32)
    open_ = np.zeros((m, ef), bool)
    seen = np.zeros((m, n), bool)
    found[:, 0], score[:, 0], open_[:, 0] = current, best, True
    seen[all_rows, current] = True
    active = all_rows
    while len(active):
        waiting = np.where(open_[active], score[active], np.inf)
        j = waiting.argmin(axis=1)
        go = np.isfinite(waiting[np.arange(len(active)), j])
        active, j = active[go], j[go]
        if not len(active):
            break
        open_[active, j] = False
        around = links[found[active, j]]
        valid = around >= 0
        nodes = np.maximum(around, 0)
        valid &= ~seen[active[:, None], nodes]
        rows, cols = np.nonzero(valid)
        seen[active[rows], nodes[rows, cols]] = True
        # A node named twice in one list counts once.
        sorted_nodes = np.where(valid, nodes, -1)
        order = np.sort(sorted_nodes, axis=1)
        order[:, 1:][order[:, 1:] == order[:, :-1]] = -1
        valid, nodes = order >= 0, np.maximum(order, 0)
        d = np.where(valid, distance(active, nodes), np.inf).astype(np.float32)
        merged = np.concatenate([score[active], d], axis=1)
        keep = np.argsort(merged, axis=1, kind="stable")[:, :ef]
        score[active] = np.take_along_axis(merged, keep, axis=1)
        found[active] = np.take_along_axis(np.concatenate([found[active], np.where(valid, nodes, -1)], axis=1), keep, axis=1)
        open_[active] = np.take_along_axis(np.concatenate([open_[active], valid], axis=1), keep, axis=1)
    return found, score


def index(df: DataFrame, key: str, vector: str, k: int = K, shard: int = SHARD) -> tuple[DataFrame, int]:
    """The table of shards (shard, ids, vectors, width, levels, graph), written to the shared folder, and their number.

    ids: for each node, the up to ``k + 1`` smallest keys of its vector.
    """
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.filter(usable(F.col("v")) & F.col("id").isNotNull()).distinct()
    # The window limit is applied before the shuffle too, so a vector of many rows is not gathered.
    by_vector = Window.partitionBy("v").orderBy("id")
    few = rows.withColumn("nth", F.row_number().over(by_vector)).filter(F.col("nth") <= k + 1)
    nodes = saved(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "vectors")
    n = max(1, -(-nodes.count() // shard))

    def make(table: pa.Table) -> pa.Table:
        vectors = table["v"].to_pylist()
        widths = sorted({len(v) for v in vectors})
        held = table["ids"].to_pylist()
        out = []
        for width in widths:  # vectors of other widths are never near one another
            of = [i for i, v in enumerate(vectors) if len(v) == width]
            of.sort(key=lambda i: held[i][0])
            exact = np.array([vectors[i] for i in of], np.float64)
            levels, graph = build(exact.astype(np.float32), np.array([held[i][0] for i in of]))
            out.append(
                {
                    "shard": table["shard"][0].as_py(),
                    "width": width,
                    "ids": [held[i] for i in of],
                    "vectors": exact.tobytes(),
                    "levels": levels.tobytes(),
                    "graph": [g.tobytes() for g in graph],
                }
            )
        kinds = [
            ("shard", pa.int32()),
            ("width", pa.int32()),
            ("ids", pa.list_(pa.list_(pa.int64()))),
            ("vectors", pa.binary()),
            ("levels", pa.binary()),
            ("graph", pa.list_(pa.binary())),
        ]
        return pa.Table.from_pylist(out, pa.schema(kinds))

    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(n)).cast("int"))
    schema = "shard int, width int, ids array<array<long>>, vectors binary, levels binary, graph array<binary>"
    return saved(dealt.groupBy("shard").applyInArrow(make, schema), "graphs"), n


def nearest(
    df: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, ef: int = EF, shard: int = SHARD
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` its ``k`` nearest rows of ``df`` found.

    Nearest by Euclidean distance, ties to the smaller key, never the query's own key. Rows with a null key or
    a vector that is null, empty, zero, or has null or non-finite components take no part, on either side;
    vectors of other widths are not compared. A key that comes twice with other vectors is found at
    its nearest. Fewer candidates than ``k``: all. An empty table gives an empty result.
    """
    shards, n = index(df, key, vector, k, shard)
    asked = queries.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    asked = asked.filter(usable(F.col("v")) & F.col("id").isNotNull()).distinct()
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    # One row per block, as wide as QUERY_BLOCK queries, goes to each shard: that is the number of
    # queries times the number of shards, in blocks.
    grouped = dealt.groupBy("block").agg(F.collect_list(F.struct("id", "v")).alias("queries"))
    sent = grouped.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                width = row["width"]
                chosen = [q for q in row["queries"] if len(q["v"]) == width]
                if not chosen:
                    continue
                exact = np.frombuffer(row["vectors"], np.float64).reshape(-1, width)
                wanted = np.array([q["v"] for q in chosen], np.float64)
                levels = np.frombuffer(row["levels"], np.int32)
                graph = [np.frombuffer(g, np.int32) for g in row["graph"]]
                found, _ = search(exact.astype(np.float32), levels, graph, wanted.astype(np.float32), ef)
                out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
                for q, v, nodes in zip(chosen, wanted, found, strict=True):
                    nodes = nodes[nodes >= 0]
                    scores = np.sqrt(((exact[nodes] - v) ** 2).sum(axis=1))
                    best = sorted(
                        (score, i) for node, score in zip(nodes.tolist(), scores.tolist(), strict=True)
                        for i in row["ids"][node] if i != q["id"]
                    )[:k]
                    out["query_id"] += [q["id"]] * len(best)
                    out["vec_id"] += [i for _, i in best]
                    out["score"] += [s for s, _ in best]
                yield pa.RecordBatch.from_pydict(
                    {
                        "query_id": pa.array(out["query_id"], pa.int64()),
                        "vec_id": pa.array(out["vec_id"], pa.int64()),
                        "score": pa.array(out["score"], pa.float64()),
                    }
                )

    # Spark sizes the blocks before they are repeated for each shard, so it would broadcast them at any size.
    pairs = sent.hint("merge").join(shards, "shard").select("queries", "width", "ids", "vectors", "levels", "graph")
    hits = pairs.mapInArrow(ask, "query_id long, vec_id long, score double")
    # At most k rows per query and shard.
    once = hits.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every hundredth one."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 100 == 0))
