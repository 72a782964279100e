"""Cover trees: covering radii, and mined negatives against all inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import hard_negatives as hard

SCHEMA = "vec_id long, embedding array<double>, label int, score long, part int, tree string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, l, 5, 1, "t") for i, v, l in rows], SCHEMA)


def plain(rows, anchors, positives=5, negatives=3, low=50, high=95):
    best = {}
    for i, v, l in rows:
        if i is None or v is None or l is None or None in v:
            continue
        row = (l, [int(x) for x in v])
        best[i] = min(best.get(i, row), row)
    out = set()
    for a in anchors:
        if a not in best:
            continue
        la, va = best[a]
        scored = [
            (-sum(x * y for x, y in zip(va, v, strict=True)), i, l) for i, (l, v) in best.items() if i != a and len(v) == len(va)
        ]
        scored.sort()
        for s, p, _ in [x for x in scored if x[2] == la][:positives]:
            fit = [(n, i) for n, i, l in scored if l != la and -low * s <= -100 * n <= -high * s][:negatives]
            out |= {(a, p, rank, i, -s, -n) for rank, (n, i) in enumerate(fit, 1)}
    return out


def clustered(n, seed, width=8, spread=20):
    random = np.random.default_rng(seed)
    centres = random.integers(-200, 200, (6, width))
    return [
        (i, (centres[random.integers(6)] + random.integers(-spread, spread + 1, width)).astype(float).tolist(), int(random.integers(4)))
        for i in range(n)
    ]


def mined(spark, rows, shard=64, **how):
    df = table(spark, rows).repartition(3)
    got = hard.mine(df, F.col("vec_id") % 10 == 0, shard=shard, **how)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found))
    return set(found)


def anchors(rows):
    return sorted({i for i, *_ in rows if i is not None and i % 10 == 0})


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_products(spark, seed):
    rows = clustered(500, seed)
    assert mined(spark, rows) == plain(rows, anchors(rows))


def test_one_hot_label_and_vector(spark):
    rows = clustered(300, 3)
    rows += [(1000 + i, [100.0] * 8, 2) for i in range(400)] + [(2000 + i, [100.0] * 8, 1) for i in range(50)]
    assert mined(spark, rows) == plain(rows, anchors(rows))


def test_other_windows_and_counts(spark):
    rows = clustered(200, 4)
    how = {"positives": 2, "negatives": 7, "low": 10, "high": 100}
    assert mined(spark, rows, **how) == plain(rows, anchors(rows), **how)


def test_edges(spark):
    rows = clustered(60, 5)
    rows += [(70, None, 1), (80, [1.0, None] * 4, 1), (90, [3.0] * 8, None), (None, [3.0] * 8, 1), (100, [0.0] * 8, 1)]
    rows += [(110, [5.0] * 3, 1), (111, [4.0] * 3, 1), (112, [3.0] * 3, 2), (120, [], 1), (121, [], 1), (122, [], 3)]
    rows += [rows[10], (20, [7.0] * 8, 3), (130, [9.0] * 8, 9)]
    assert mined(spark, rows) == plain(rows, anchors(rows))
    assert mined(spark, []) == set()
    assert mined(spark, [(i, [1.0, 2.0], 1) for i in range(30)]) == set()


def test_radii_cover_and_separate():
    points = np.array([v for _, v, _ in clustered(700, 6)], np.int64)
    tree = hard.build(points, np.arange(700), np.zeros(700, int))
    assert sorted(tree.ids.tolist()) == list(range(700))
    top = (points.astype(float) ** 2).sum(axis=1).max()
    held = tree.points.astype(float)
    augmented = np.column_stack([held, np.sqrt(np.maximum(top - (held**2).sum(axis=1), 0))])

    def below(node):
        if tree.leaf[node]:
            return list(range(tree.first[node], tree.last[node]))
        return [p for child in range(tree.first[node], tree.last[node]) for p in below(child)]

    def angle(p, q):
        return np.arccos(np.clip(augmented[p] @ augmented[q] / top, -1, 1))

    for node in range(len(tree.centre)):
        assert max(angle(p, tree.centre[node]) for p in below(node)) <= tree.radius[node] + 1e-6
        if not tree.leaf[node]:
            children = tree.centre[tree.first[node] : tree.last[node]]
            assert (tree.parent[tree.first[node] : tree.last[node]] == node).all()
            apart = min((angle(a, b) for i, a in enumerate(children) for b in children[:i]), default=np.inf)
            assert apart > tree.radius[node] / hard.BASE - 1e-6
    assert sorted(below(0)) == list(range(700))


def test_a_search_skips_nodes():
    rows = clustered(2000, 7, spread=3)
    points = np.array([v for _, v, _ in rows], np.int64)
    labels = np.array([l for *_, l in rows])
    tree = hard.build(points, np.arange(2000), labels)
    best = hard.Best(20, 5)
    every = np.full((20, 1), 2.0**60)
    made = hard.search(tree, points[:20], np.arange(20), labels[:20], True, -every, every, best)
    assert made < 0.5 * 20 * 2000
    for q in range(20):
        score = points @ points[q]
        ok = (labels == labels[q]) & (np.arange(2000) != q)
        assert [(-s, i) for s, i in sorted(zip(-score[ok], np.nonzero(ok)[0], strict=True))[:5]] == list(
            zip(best.score[q].astype(int), best.id[q], strict=True)
        )
