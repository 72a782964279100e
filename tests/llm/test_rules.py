"""The rule ensemble: statistics, rules as columns, the lasso, and accuracy on rows not learned from."""

import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import rules

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, score double, key string, words double, quality string"


def table(spark, rows):
    return spark.createDataFrame([(k, t, 0.5, "k", 1.0, "q") for k, t in rows], SCHEMA)


def test_statistics_by_hand():
    text = "Ab ab ab! 12\n\nÉ #c.\nÉ #c."
    got = dict(zip(rules.STATISTICS, rules.measure(text.encode()), strict=True))
    words = re.findall(r"\S+", text)
    inner = sum(len(w.encode()) for w in words)
    assert got["words"] == len(words) == 8 and got["lines"] == 3 and got["bytes"] == len(text.encode())
    assert got["upper"] == 1 / inner and got["digit"] == 2 / inner and got["symbol"] == 2 / inner
    assert got["distinct_words"] == 6 / 8 and got["top_word"] == 2 / 8
    assert got["equal_pairs"] == 0 and got["distinct_pairs"] == 6 / 7
    assert got["equal_lines"] == pytest.approx(1 / 3) and got["ended_lines"] == 2 / 3
    assert rules.measure(None) == rules.measure(b"") == (0.0,) * len(rules.STATISTICS)


def plain_score(model, x):
    odds = model.bias
    for rule, weight in zip(model.rules, model.weights, strict=True):
        if all(x[s] > t if above else x[s] <= t for s, above, t in rule):
            odds += weight
    return 1 / (1 + math.exp(-odds))


def test_query_against_plain_rules_and_labels(spark, monkeypatch):
    models = []
    real = rules.learn
    monkeypatch.setattr(rules, "learn", lambda *a: models.append((real(*a), a)) or models[-1][0])
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    got = {r["doc_id"]: r for r in rules.op12_quality_rules(spark, SF_DIR).collect()}
    model, (x, y, _) = models[0]
    held = {d for d in docs if zlib.crc32(str(d).encode()) % 5 == 0}
    assert set(got) == set(docs) and {d for d, r in got.items() if r["held_out"]} == held
    assert len(y) == len([d for d in labels if d in docs and d not in held])
    for d, t in docs.items():
        assert got[d]["score"] == pytest.approx(plain_score(model, rules.measure((t or "").encode())), abs=1e-12)
        assert got[d]["predicted"] == (got[d]["score"] >= 0.3)
    unseen = [d for d in held if d in labels and d in docs]
    assert sum(got[d]["predicted"] == labels[d] for d in unseen) >= 0.95 * len(unseen)
    assert 0 < len(model.rules) < 200 and max(len(r) for r in model.rules) <= rules.DEPTH


def test_rules_are_tree_paths():
    random = np.random.default_rng(5)
    x = random.random((600, len(rules.STATISTICS)))
    label = ((x[:, 2] > 0.6) & (x[:, 5] <= 0.5)).astype(float)
    found = rules.grow(x, label, np.ones(600), trees=12)
    assert len(found) == len(set(found))
    a = rules.activations(x, found)
    for j, rule in enumerate(found):
        want = np.all([(x[:, s] > t) if above else (x[:, s] <= t) for s, above, t in rule], axis=0)
        assert (a[:, j] == want).all()
    model = rules.learn(x, label, np.ones(600))
    chance = np.array([plain_score(model, row) for row in x])
    assert ((chance > 0.5) == label).mean() > 0.97


def test_lasso_is_optimal():
    random = np.random.default_rng(3)
    a = (random.random((400, 12)) < 0.4).astype(float)
    label = (random.random(400) < 1 / (1 + np.exp(-(2 * a[:, 0] - 3 * a[:, 1] + 0.5)))).astype(float)
    weight = random.random(400) + 0.5
    penalty = 0.01
    bias, w = rules.fit_lasso(a, label, weight, penalty, steps=4000)
    off = weight / weight.sum() * (1 / (1 + np.exp(-(a @ w + bias))) - label)
    slope = a.T @ off
    assert abs(off.sum()) < 1e-5
    assert np.all(np.abs(slope[w == 0]) <= penalty + 1e-5) and (w == 0).any()
    assert np.allclose(slope[w != 0], -penalty * np.sign(w[w != 0]), atol=1e-5)


ROWS = [(i, "plain words here and there again " * (i % 7 + 1)) for i in range(40)]
ROWS += [(100 + i, "## $$ %% ## $$ " * (i % 5 + 1)) for i in range(40)]
EDGES = [(None, "some text"), (900, None), (901, ""), (902, " \n "), (903, "w " * 200_000), (3, ROWS[3][1]), (3, "other text")]


def test_edges(spark):
    measured = rules.statistics(table(spark, ROWS + EDGES).repartition(3)).cache()
    labels = spark.createDataFrame(
        [(d, int(d < 100)) for d, _ in ROWS] + [(5, 0), (5, 1), (None, 1), (6, None), (7, 1), (7, 1), (8, 9)], "doc_id long, quality int"
    )
    model = rules.fit(measured, labels)
    got = rules.score(measured, model).collect()
    assert len(got) == len(ROWS) + len(EDGES)
    assert all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r["predicted"] for r in got}
    assert all(by[d] == int(d < 100) for d, _ in ROWS if d != 3)
    assert rules.score(measured, model).columns == ["doc_id", "score", "predicted"]


def test_labels_of_one_class_or_none(spark):
    measured = rules.statistics(table(spark, ROWS))
    ones = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    assert rules.score(measured, rules.fit(measured, ones)).filter("predicted = 0").count() == 0
    for labels in (ones.filter("false"), ones.filter("doc_id < 1").withColumn("doc_id", F.lit(77).cast("long"))):
        model = rules.fit(measured, labels)
        assert {r["score"] for r in rules.score(measured, model).collect()} == {0.5}
    none = rules.statistics(table(spark, []))
    assert rules.score(none, rules.fit(none, ones)).collect() == []


def test_sample_is_bounded_and_weighted(spark):
    measured = rules.statistics(table(spark, ROWS))
    labels = spark.createDataFrame([(d, int(d < 100)) for d, _ in ROWS], "doc_id long, quality int")
    seen = []
    real = rules.learn
    try:
        rules.learn = lambda *a: seen.append(a) or real(*a)
        rules.fit(measured, labels, fit_rows=15)
    finally:
        rules.learn = real
    _, y, weight = seen[0]
    assert 10 <= len(y) <= 50 and np.allclose(weight, 40 / 15)
