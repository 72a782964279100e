"""Quality by a sparse ensemble of rules over statistics of a text.

A rule is the path to a node of a small decision tree: up to ``DEPTH`` conditions on statistics, all of which
must hold. Trees are grown one after the other on what the ones before leave unexplained, each on half of the sample and on
some of the statistics. Their paths, without repetitions, are the inputs of a logistic regression with an
absolute-value penalty, so most weights are 0. What is left becomes one Spark column expression.

The statistics of all texts are one narrow table, read by the fit (rows with a drawn label) and by the scores.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import as_bytes, documents, saved, slices, unit_hash

#: Most labelled rows of each class that are learned from, drawn by a hash.
FIT_ROWS = 8192
TREES = 40
DEPTH = 3
BINS = 32
MOST_RULES = 400
LEAST_SUPPORT = 0.002
PENALTIES = (0.03, 0.01, 0.003, 0.001, 0.0003)
CUTOFF = 0.3
FOLDS = 5

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_SYMBOL = b"#*$%&|<>"
_SHOUT = b"!?"
_STOP = b".,;:"
_BEYOND = bytes(range(128, 256))

STATISTICS = (
    "bytes", "words", "lines", "word_bytes", "longest_word", "upper", "digit", "symbol", "shout", "stop", "beyond", "other",
    "distinct_words", "top_word", "equal_pairs", "distinct_pairs", "equal_lines", "line_words", "ended_lines", "short_words",
)


def measure(text: bytes | None) -> tuple[float, ...]:
    """The ``STATISTICS`` of a text, all 0 without words; shares are of bytes, words or lines."""
    words = text.split() if text else []
    if not words:
        return (float(len(text or b"")), *[0.0] * (len(STATISTICS) - 1))
    size, n = len(text), len(words)
    classes = (_UPPER, _DIGIT, _SYMBOL, _SHOUT, _STOP, _BEYOND, _LOWER + b" \n")
    upper, digit, symbol, shout, stop, beyond, plain = (size - len(text.translate(None, x)) for x in classes)
    inner = sum(map(len, words))
    lines = [x for x in text.split(b"\n") if x.strip()]
    counts = Counter(words)
    pairs = list(zip(words, words[1:], strict=False))
    return (
        float(size),
        float(n),
        float(len(lines)),
        inner / n,
        float(max(map(len, words))),
        upper / inner,
        digit / inner,
        symbol / inner,
        shout / inner,
        stop / inner,
        beyond / inner,
        (size - upper - digit - symbol - shout - stop - beyond - plain) / size,
        len(counts) / n,
        max(counts.values()) / n,
        sum(a == b for a, b in pairs) / n,
        len(set(pairs)) / max(1, len(pairs)),
        1 - len(set(lines)) / len(lines),
        n / len(lines),
        sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / len(lines),
        sum(c for w, c in counts.items() if len(w) <= 2) / n,
    )


def statistics(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, one column per statistic) for each row; a null text counts as empty, other columns are ignored."""
    given = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            columns = zip(*map(measure, as_bytes(batch["text"])), strict=True)
            yield pa.RecordBatch.from_arrays([batch["key"], *(pa.array(c, pa.float64()) for c in columns)], names=["key", *STATISTICS])

    kind = given.schema["key"].dataType.simpleString()
    return given.mapInArrow(run, f"key {kind}, " + ", ".join(f"{s} double" for s in STATISTICS))


#: A condition is (statistic, above, threshold): above or at most. A rule is a sorted tuple of them.
Condition = tuple[int, bool, float]
Rule = tuple[Condition, ...]


@dataclass
class Ensemble:
    """Log odds of a good document: the bias plus the weights of the rules that hold."""

    bias: float
    rules: list[Rule]
    weights: list[float]

    def column(self, statistic=F.col) -> Column:
        """The score as an expression over the columns of ``statistics``."""

        def holds(rule: Rule) -> Column:
            return reduce(
                lambda a, b: a & b,
                (statistic(STATISTICS[s]) > t if above else statistic(STATISTICS[s]) <= t for s, above, t in rule),
            )

        odds = F.lit(self.bias)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            odds = odds + F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def activations(x: np.ndarray, rules: list[Rule]) -> np.ndarray:
    """Rows by rules: 1 where a rule holds."""
    out = np.ones((len(x), len(rules)), np.float32)
    for j, rule in enumerate(rules):
        for s, above, t in rule:
            out[:, j] *= (x[:, s] > t) if above else (x[:, s] <= t)
    return out


def _tightest(rule: list[Condition]) -> Rule:
    """One condition per statistic and side."""
    held: dict[tuple[int, bool], float] = {}
    for s, above, t in rule:
        held[s, above] = t if (s, above) not in held else (max if above else min)(held[s, above], t)
    return tuple(sorted((s, above, t) for (s, above), t in held.items()))


def grow(x: np.ndarray, label: np.ndarray, weight: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 12) -> list[Rule]:
    """The paths of boosted trees, each once, in the order they were found."""
    random = np.random.default_rng(seed)
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, s], np.linspace(0, 1, BINS + 1)[1:-1])) for s in range(m)]
    binned = np.column_stack([np.searchsorted(cuts[s], x[:, s]) for s in range(m)])
    odds = np.zeros(n)
    found: dict[Rule, None] = {}
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-odds))
        pull, curve = weight * (label - chance), weight * chance * (1 - chance)
        part = random.random(n) < 0.5
        tried = random.choice(m, max(1, m // 2), replace=False)
        leaves: list[np.ndarray] = []
        waiting: list[tuple[np.ndarray, list[Condition]]] = [(np.ones(n, bool), [])]
        while waiting:
            inside, path = waiting.pop()
            best, split = 1e-6 * weight.sum(), None
            rows = np.nonzero(inside & part)[0]
            total, mass = pull[rows].sum(), curve[rows].sum() + 1e-9
            for s in tried if len(path) < depth else ():
                left = np.cumsum(np.bincount(binned[rows, s], pull[rows], BINS + 1))[:-1]
                below = np.cumsum(np.bincount(binned[rows, s], curve[rows], BINS + 1))[:-1] + 1e-9
                gain = left**2 / below + (total - left) ** 2 / np.maximum(mass - below, 1e-9) - total**2 / mass
                gain[len(cuts[s]) :] = 0
                gain[(below < 1e-3 * mass) | (mass - below < 1e-3 * mass)] = 0
                at = int(gain.argmax())
                if gain[at] > best:
                    best, split = gain[at], (int(s), float(cuts[s][at]))
            if path:
                found.setdefault(_tightest(path))
            if split is None:
                leaves.append(inside)
                continue
            s, t = split
            above = x[:, s] > t
            waiting.append((inside & above, [*path, (s, True, t)]))
            waiting.append((inside & ~above, [*path, (s, False, t)]))
        for inside in leaves:
            odds[inside] += 0.3 * pull[inside].sum() / (curve[inside].sum() + 1e-3 * weight.sum())
    return list(found)


def fit_lasso(a: np.ndarray, label: np.ndarray, weight: np.ndarray, penalty: float, steps: int = 600) -> tuple[float, np.ndarray]:
    """Bias and weights that minimize the mean log loss plus ``penalty`` times the sum of absolute weights (FISTA)."""
    n, m = a.shape
    share = weight / weight.sum()
    direction = np.ones(m) / np.sqrt(m)
    for _ in range(30):  # the largest curvature, by power iteration
        direction = a.T @ (share * (a @ direction)) + 1e-12
        size = np.linalg.norm(direction)
        direction /= size
    step = 1 / (0.25 * (size + 1))
    bias = old_bias = 0.0
    w, old = np.zeros(m), np.zeros(m)
    for k in range(1, steps + 1):
        ahead = (k - 1) / (k + 2)
        v, b = w + ahead * (w - old), bias + ahead * (bias - old_bias)
        off = share * (1 / (1 + np.exp(-(a @ v + b))) - label)
        old, old_bias = w, bias
        moved = v - step * (a.T @ off)
        w = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        bias = b - step * off.sum()
    return float(bias), w


def _loss(a: np.ndarray, label: np.ndarray, weight: np.ndarray, bias: float, w: np.ndarray) -> float:
    odds = a @ w + bias
    return float((weight * np.logaddexp(0, np.where(label > 0, -odds, odds))).sum() / weight.sum())


def learn(x: np.ndarray, label: np.ndarray, weight: np.ndarray) -> Ensemble:
    """The ensemble for rows of statistics with labels 0 and 1. The penalty is the largest whose loss on a fifth of the
    rows, left out, is near the least; without both classes the score is the smoothed share of label 1."""
    if len(label) == 0 or label.min() == label.max():
        ones = weight[label == 1].sum() if len(label) else 0.0
        total = weight.sum() if len(label) else 0.0
        share = (ones + 1) / (total + 2)
        return Ensemble(float(np.log(share / (1 - share))), [], [])
    paths = grow(x, label, weight)
    a = activations(x, paths)
    # Of rules that hold for the same rows one stays, and none that holds nearly always or nearly never.
    support = (a * weight[:, None]).sum(axis=0) / weight.sum()
    useful = np.nonzero((support >= LEAST_SUPPORT) & (support <= 1 - LEAST_SUPPORT))[0]
    seen = {a[:, j].tobytes(): j for j in useful[::-1]}
    chosen = sorted(seen.values())[:MOST_RULES]
    if not chosen:
        return learn(x, np.ones_like(label), weight)
    paths, a = [paths[j] for j in chosen], a[:, chosen].astype(np.float64)
    out = np.arange(len(label)) % 5 == 0
    tried = []
    for penalty in PENALTIES:
        bias, w = fit_lasso(a[~out], label[~out], weight[~out], penalty)
        tried.append(_loss(a[out], label[out], weight[out], bias, w))
    best = next(p for p, loss in zip(PENALTIES, tried, strict=True) if loss <= min(tried) * 1.1 + 0.002)
    bias, w = fit_lasso(a, label, weight, best)
    kept = [j for j in range(len(w)) if abs(w[j]) > 1e-4]
    return Ensemble(bias, [paths[j] for j in kept], [float(w[j]) for j in kept])


def fit(
    measured: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", fit_rows: int = FIT_ROWS
) -> Ensemble:
    """Learn from a bounded sample of the labelled rows of ``statistics``.

    Labels other than 0 and 1 and null keys are left out, as are keys with both labels. Of rows with one key, the one with the
    smallest statistics is learned from. At most about ``fit_rows`` keys of each class are drawn by a hash of the key; each
    counts for as many as it stands for.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(key).alias("key"))
    known = known.agg(F.min(label).cast("int").alias("label"), F.max(label).alias("_most")).filter("label = _most").drop("_most")
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    shares = {c: min(1.0, fit_rows / n) for c, n in counts.items()}
    limit = F.when(F.col("label") == 1, shares.get(1, 1.0)).otherwise(shares.get(0, 1.0))
    drawn = known.filter(unit_hash(F.col("key"), F.lit("quality")) < limit)
    rows = measured.join(drawn, "key").groupBy("key", "label").agg(F.min(F.struct(*STATISTICS)).alias("x")).collect()
    rows.sort(key=lambda r: (str(r["key"]), r["label"]))
    x = np.array([tuple(r["x"]) for r in rows], float).reshape(len(rows), len(STATISTICS))
    y = np.array([r["label"] for r in rows], float)
    return learn(x, y, np.array([1 / shares[r["label"]] for r in rows]))



def fold(key: str, folds: int) -> Column:
    """The fold of a row: the CRC-32 of its key as text, modulo ``folds``; a null key counts as empty."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds


def score(measured: DataFrame, model: Ensemble, key: str = "doc_id", cutoff: float = CUTOFF) -> DataFrame:
    """(key, score, predicted) for each row of ``statistics``; an empty text has statistics, and so a score, like any other."""
    scored = measured.select("key", model.column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= cutoff).cast("int")).withColumnRenamed("key", key)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learned from the labels of four folds out of five."""
    measured = saved(statistics(documents(spark, sf_dir)), "statistics")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(fold("doc_id", FOLDS) != 0)
    scored = score(measured, fit(measured, labels))
    return scored.select("doc_id", (fold("doc_id", FOLDS) == 0).alias("held_out"), "score", "predicted")
