"""Hard negatives by inner product, found in cover trees over norm-augmented vectors.

A vector x gets one more component, sqrt(M^2 - |x|^2) with M the largest norm in its tree, so that all points lie on
a sphere and the inner product with a query (q, 0) falls with the angle. A tree is one row of flat arrays: nodes
level by level, each with a centre and a covering radius, the largest angle from the centre to any point below.
A level's radius is the one above divided by ``BASE``, and centres of one parent lie farther apart than that.

By the radius a node's products with q lie between |q| M cos(angle + radius) and |q| M cos(angle - radius). A search
opens nodes best bound first, a growing wave per round for a block of anchors at once; nodes outside all of an anchor's
score windows, or below what its full windows already hold, are skipped. At the leaves products are exact.

Rows are sorted into trees by (label, hash). Trees and anchors meet in tiles: a group of trees and a part of the
anchors, both bounded, so a tree is sent once per part and an anchor once per group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import saved

POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95
#: Points of a tree, of a group of trees, and anchors of a part; at least so many groups and parts where there are enough points.
SHARD, GROUP, PART = 2048, 1 << 16, 1 << 14
LEAST_GROUPS, LEAST_PARTS = 24, 4
BASE = 1.3
LEAF = 16
WAVE = 8
BLOCK = 256


@dataclass
class Tree:
    """Points in the order of the leaves; children of a node follow one another, as do the points of a leaf."""

    points: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    parent: np.ndarray
    first: np.ndarray
    last: np.ndarray
    leaf: np.ndarray
    norm: float


def _angles(products: np.ndarray, scale: np.ndarray | float) -> np.ndarray:
    return np.arccos(np.clip(np.divide(products, scale, out=np.ones_like(products), where=np.greater(scale, 0)), -1, 1))


def _spread(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers from each start to before its end, one after the other."""
    sizes = ends - starts
    return np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())


def build(points: np.ndarray, ids: np.ndarray, labels: np.ndarray, leaf: int = LEAF) -> Tree:
    """A tree over the rows of ``points``, whole numbers."""
    exact = points.astype(np.float64)
    squares = (exact**2).sum(axis=1)
    top = squares.max()
    augmented = np.column_stack([exact, np.sqrt(np.maximum(top - squares, 0))])
    nodes: list[list] = [[0, 0.0, -1, 0, 0, False]]  # centre, radius, parent, first, last, leaf
    members = [np.arange(len(points))]
    order: list[np.ndarray] = []
    held = at = 0
    while at < len(nodes):
        centre, of = nodes[at][0], members[at]
        angle = _angles(augmented[of] @ augmented[centre], top)
        radius = nodes[at][1] = float(angle.max())
        if len(of) <= leaf or radius <= 1e-7:
            nodes[at][3:] = [held, held + len(of), True]
            order.append(of)
            held += len(of)
        else:
            nodes[at][3] = len(nodes)
            left, rest = of, angle
            while len(left):
                near = rest <= radius / BASE
                nodes.append([centre, 0.0, at, 0, 0, False])
                members.append(left[near])
                left = left[~near]
                if len(left):
                    centre = left[0]
                    rest = _angles(augmented[left] @ augmented[centre], top)
                    rest[0] = 0.0
            nodes[at][4] = len(nodes)
        members[at] = of[:0]
        at += 1
    chosen = np.concatenate(order)
    centre, radius, parent, first, last, is_leaf = (np.array(x) for x in zip(*nodes, strict=True))
    place = np.empty(len(chosen), np.int64)
    place[chosen] = np.arange(len(chosen))
    return Tree(points[chosen], ids[chosen], labels[chosen], place[centre], radius, parent, first, last, is_leaf, float(np.sqrt(top)))


class Best:
    """The ``k`` best (score, id) of each row: higher scores first, then smaller ids."""

    def __init__(self, rows: int, k: int):
        self.k = k
        self.score = np.full((rows, k), -np.inf)
        self.id = np.full((rows, k), np.iinfo(np.int64).max)

    def add(self, row: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        touched = np.unique(row)
        row = np.concatenate([np.repeat(touched, self.k), row])
        score = np.concatenate([self.score[touched].ravel(), score])
        id_ = np.concatenate([self.id[touched].ravel(), id_])
        order = np.lexsort((id_, -score, row))
        row, score, id_ = row[order], score[order], id_[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        keep = nth < self.k
        self.score[row[keep], nth[keep]] = score[keep]
        self.id[row[keep], nth[keep]] = id_[keep]


def search(
    tree: Tree, queries: np.ndarray, ids: np.ndarray, labels: np.ndarray, same: bool, low: np.ndarray, high: np.ndarray, best: Best
) -> int:
    """Add to ``best`` what the tree holds for each query and score window, and count the products made at leaves.

    ``low`` and ``high`` are queries x windows, both included; row q * windows + w of ``best`` belongs to window w of
    query q. Points of the query's label count if ``same``, else those of other labels; its own id never does.
    """
    rows, windows = low.shape
    n = len(tree.centre)
    exact, asked = tree.points.astype(np.float64), queries.astype(np.float64)
    scale = np.sqrt((asked**2).sum(axis=1))[:, None] * tree.norm
    slack = 1e-6 * scale + 1e-6
    upper, lower = np.full((rows, n), np.inf), np.full((rows, n), -np.inf)
    open_ = np.zeros((rows, n), bool)
    open_[:, 0] = True
    wave, made = WAVE, 0
    while True:
        at, here = np.nonzero(open_)
        if not len(at):
            return made
        bound = np.full(len(at), -np.inf)
        most, least = upper[at, here], lower[at, here]
        for w in range(windows):
            reach = np.minimum(most, high[at, w])
            useful = (most >= low[at, w]) & (least <= high[at, w]) & (low[at, w] <= high[at, w])
            useful &= reach >= best.score[at * windows + w, -1]
            bound = np.where(useful, np.maximum(bound, reach), bound)
        open_[at[bound == -np.inf], here[bound == -np.inf]] = False
        rank = np.full((rows, n), -np.inf)
        rank[at, here] = bound
        if wave < n:
            rank = np.where(rank >= -np.partition(-rank, wave - 1, axis=1)[:, wave - 1 : wave], rank, -np.inf)
        taken = rank > -np.inf
        open_ &= ~taken
        wave *= 4
        used = np.nonzero(taken.any(axis=0))[0]
        inner = used[~tree.leaf[used]]
        if len(inner):
            children = _spread(tree.first[inner], tree.last[inner])
            above = tree.parent[children]
            angle = _angles(asked @ exact[tree.centre[children]].T, scale)
            radius = tree.radius[children] + 1e-7
            upper[:, children] = np.minimum(scale * np.cos(np.maximum(angle - radius, 0)) + slack, upper[:, above])
            lower[:, children] = np.maximum(scale * np.cos(np.minimum(angle + radius, np.pi)) - slack, lower[:, above])
            open_[:, children] |= taken[:, above]
        leaves = used[tree.leaf[used]]
        if len(leaves):
            points = _spread(tree.first[leaves], tree.last[leaves])
            owner = np.repeat(leaves, tree.last[leaves] - tree.first[leaves])
            active = np.nonzero(taken[:, leaves].any(axis=1))[0]
            valid = taken[np.ix_(active, owner)]
            made += int(valid.sum())
            scores = asked[active] @ exact[points].T
            valid &= ((tree.labels[points] == labels[active, None]) == same) & (tree.ids[points] != ids[active, None])
            for w in range(windows):
                row = active * windows + w
                fits = valid & (scores >= low[active, w, None]) & (scores <= high[active, w, None])
                fits &= scores >= best.score[row, -1][:, None]
                if fits.shape[1] > best.k:
                    value = np.where(fits, scores, -np.inf)
                    fits &= scores >= -np.partition(-value, best.k - 1, axis=1)[:, best.k - 1 : best.k]
                i, j = np.nonzero(fits)
                if len(i):
                    best.add(row[i], scores[i, j], tree.ids[points[j]])


def _packed(values: np.ndarray) -> tuple[bytes, str]:
    """Whole numbers in the narrowest type that holds them."""
    most = int(np.abs(values).max(initial=0))
    kind = "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<i8"
    return values.astype(kind).tobytes(), kind


_TREE = (
    "tree int, width int, kind string, points binary, ids binary, labels binary, centre binary, radius binary, "
    "parent binary, first binary, last binary, leaf binary, norm double"
)
_FLAT = {"ids": "<i8", "labels": "<i8", "centre": "<i4", "radius": "<f8", "parent": "<i4", "first": "<i4", "last": "<i4", "leaf": "?"}


def index(rows: DataFrame, shard: int = SHARD) -> tuple[DataFrame, int]:
    """The table of trees over (id, label, v), written to the shared folder, and the number of rows."""
    n = rows.count()
    dealt = rows.repartitionByRange(max(1, -(-n // shard)), "label", F.xxhash64("v"), "id")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        width = np.diff(np.asarray(table["v"].chunk(0).offsets))
        vectors = table["v"].chunk(0)
        ids, labels = np.asarray(table["id"]), np.asarray(table["label"])
        for w in np.unique(width).tolist():  # vectors of other widths are never compared
            of = np.nonzero(width == w)[0]
            points = np.asarray(vectors.take(pa.array(of)).flatten(), np.int64).reshape(len(of), w)
            # Runs of one label stay together, so that a tree has few of them; its size is bounded in any case.
            for a in range(0, len(of), 2 * shard):
                part = of[a : a + 2 * shard]
                tree = build(points[a : a + 2 * shard], ids[part], labels[part])
                packed, kind = _packed(tree.points)
                row = {"tree": TaskContext.get().partitionId(), "width": w, "kind": kind, "points": packed, "norm": tree.norm}
                row |= {name: getattr(tree, name).astype(t).tobytes() for name, t in _FLAT.items()}
                yield pa.RecordBatch.from_pylist([row], schema)

    schema = pa.schema(
        [
            (name, {"int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64()}[kind])
            for name, kind in (x.split() for x in _TREE.split(", "))
        ]
    )
    return saved(dealt.mapInArrow(make, _TREE), "trees"), n


def _unpacked(row: dict) -> Tree:
    flat = {name: np.frombuffer(row[name], t) for name, t in _FLAT.items()}
    points = np.frombuffer(row["points"], row["kind"]).astype(np.int64).reshape(len(flat["ids"]), row["width"])
    return Tree(points=points, norm=row["norm"], **flat)


def _found(trees: DataFrame, n: int, anchors: DataFrame, count: int, k: int, same: bool) -> DataFrame:
    """(anchor, window, id, score): the ``k`` best of each group of trees for each window of each anchor.

    ``anchors``: id, label, v, and low and high, arrays of as many numbers as the anchor has windows.
    """
    groups = max(-(-n // GROUP), min(LEAST_GROUPS, -(-n // SHARD)), 1)
    parts = max(-(-count // PART), min(LEAST_PARTS, -(-count // BLOCK)), 1)
    numbers = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    left = anchors.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")).withColumn("group", numbers(groups))
    right = trees.withColumn("group", F.pmod("tree", F.lit(groups)).cast("int")).withColumn("part", numbers(parts))

    def meet(asked: pa.Table, held: pa.Table) -> pa.Table:
        given = [_unpacked(x) for x in held.to_pylist()]
        rows = asked.to_pylist()
        out: list[tuple] = []
        for width in sorted({len(r["v"]) for r in rows}):
            of = sorted((r for r in rows if len(r["v"]) == width), key=lambda r: (r["label"], r["id"]))
            for a in range(0, len(of), BLOCK):
                block = of[a : a + BLOCK]
                queries = np.array([r["v"] for r in block], np.int64).reshape(len(block), width)
                ids = np.array([r["id"] for r in block])
                labels = np.array([r["label"] for r in block])
                windows = max(len(r["low"]) for r in block)
                low, high = np.full((len(block), windows), 1.0), np.full((len(block), windows), 0.0)  # none
                for i, r in enumerate(block):
                    low[i, : len(r["low"])], high[i, : len(r["high"])] = r["low"], r["high"]
                best = Best(len(block) * windows, k)
                for tree in given:
                    if tree.points.shape[1] != width:
                        continue
                    mine = np.nonzero(np.isin(labels, tree.labels))[0] if same else np.arange(len(block))
                    if len(mine):
                        part = Best(len(mine) * windows, k)
                        at = (mine[:, None] * windows + np.arange(windows)).ravel()
                        part.score, part.id = best.score[at], best.id[at]
                        search(tree, queries[mine], ids[mine], labels[mine], same, low[mine], high[mine], part)
                        best.score[at], best.id[at] = part.score, part.id
                i, j = np.nonzero(best.score > -np.inf)
                out += zip(ids[i // windows].tolist(), (i % windows).tolist(), best.id[i, j].tolist(), best.score[i, j].tolist(), strict=True)
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        kinds = [("anchor", pa.int64()), ("nth", pa.int32()), ("id", pa.int64()), ("score", pa.int64())]
        return pa.table({name: pa.array(c).cast(t) if len(c) else pa.array([], t) for (name, t), c in zip(kinds, columns, strict=True)})

    keys = ("part", "group")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "anchor long, nth int, id long, score long")


def mine(
    df: DataFrame,
    anchors: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    shard: int = SHARD,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), exactly.

    Vectors are arrays of whole numbers, labels whole numbers, scores inner products; higher scores come first, ties by the
    smaller key. Anchors are the rows where ``anchors`` holds; their positives the first ``positives`` other rows of their
    label, all if there are fewer. The negatives of a positive are the first ``negatives`` rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score; a positive without any has no row.

    Rows with a null key, label, vector or component take no part; of rows with one key that with the smallest (label, vector)
    does. Vectors of other widths are not compared; zero and empty ones are vectors. An empty table gives an empty result. Other
    columns of ``df`` are ignored. Products are exact below 2**53.
    """
    v = F.col(vector).cast("array<long>")
    whole = F.col(key).isNotNull() & F.col(label).isNotNull() & F.coalesce(F.forall(v, lambda x: x.isNotNull()), F.lit(False))
    rows = df.filter(whole).select(
        F.col(key).cast("long").alias("id"), F.struct(F.col(label).cast("long").alias("label"), v.alias("v")).alias("row"),
        F.coalesce(anchors, F.lit(False)).alias("asks"),
    )
    once = rows.groupBy("id").agg(F.min(F.struct("row", "asks")).alias("row"))
    once = saved(once.select("id", "row.row.label", "row.row.v", "row.asks"), "vectors")
    # Of equal vectors of a label only the smallest keys can be among the first, next to the anchor's own.
    copies = Window.partitionBy("label", "v").orderBy("id")
    few = once.drop("asks").withColumn("nth", F.row_number().over(copies)).filter(F.col("nth") <= max(positives + 1, negatives))
    trees, n = index(few.drop("nth"), shard)
    asked = once.filter("asks").drop("asks")
    count = asked.count()
    widest = float(1 << 62)
    every = asked.withColumn("low", F.array(F.lit(-widest))).withColumn("high", F.array(F.lit(widest)))
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    near = _found(trees, n, every, count, positives, same=True).withColumn("place", F.row_number().over(first))
    near = saved(near.filter(F.col("place") <= positives), "positives")
    # Windows as whole numbers: the least and the largest negative score that a positive allows.
    least = F.expr(f"-(({-low} * score - pmod({-low} * score, 100)) div 100)")
    most = F.expr(f"({high} * score - pmod({high} * score, 100)) div 100")
    limits = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", least.alias("low"), most.alias("high")))).alias("w"))
    windows = asked.join(limits, asked["id"] == limits["anchor"]).select(
        "id", "label", "v", F.col("w.low").cast("array<double>").alias("low"), F.col("w.high").cast("array<double>").alias("high")
    )
    hits = _found(trees, n, windows, count, negatives, same=False)
    order = Window.partitionBy("anchor", "nth").orderBy(F.desc("score"), "id")
    hits = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    named = near.select("anchor", (F.col("place") - 1).alias("nth"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return hits.join(named, ["anchor", "nth"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of the five nearest positives of every fiftieth vector."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) != float("inf")))
    rows = table.filter(F.coalesce(finite, F.lit(False))).select(
        "vec_id",
        F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform(x, lambda y: F.floor(y * 256)).alias("embedding"),
    )
    return mine(rows, F.col("vec_id") % 50 == 0)
