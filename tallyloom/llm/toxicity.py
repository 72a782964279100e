"""Toxicity as an ordinal grade: cumulative-link regression on sparse word features.

The model has one weight per word and ordered thresholds t1 < t2 < ...: the probability of a grade
above k is sigmoid(w.x - t(k+1)). All thresholds share the weights, so a document moves through the
grades in one direction. The expected severity is the sum of these probabilities.

Labels say toxic or not. Grades of toxic training documents follow the number of their features that are
cues (significantly more frequent in toxic documents): 2 above the median, else 1.

The model is fitted on a sample of labelled rows of at most about ``FIT_ROWS`` per class, drawn by a
hash of the key; its words are those that differ significantly between the classes, ``MOST_WORDS``
at most. The model that is broadcast is bounded by this number. Every document is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import documents, slices, unit_hash, word_hashes

FIT_ROWS = 3000
MOST_WORDS = 2000
#: Standard errors by which a word's share of documents differs between the classes.
SIGNIFICANT = 5.0
GRADES = 3
RIDGE = 1e-4
#: Lengths in bytes of the word beginnings that are features too: they hold for inflected words.
BEGINNINGS = (4, 5, 6)
STEPS = 600
#: A clean document called toxic counts as so many toxic ones missed.
FALSE_ALARM = 10
#: ASCII punctuation and digits separate words.
BREAKS = bytes(c if not 33 <= c <= 126 or chr(c).isalpha() else 32 for c in range(256))


def features_of(batch: pa.RecordBatch, text: str = "text") -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's words and word beginnings, lower-cased."""
    for value in pc.utf8_lower(batch[text]).cast(pa.binary()).to_pylist():
        words = value.translate(BREAKS).split() if value else []
        distinct = set(words)
        for n in BEGINNINGS:
            distinct |= {w[:n] + b"*" for w in distinct if len(w) > n and w[-1] != 42}
        yield np.sort(word_hashes(distinct, len(distinct)))


@dataclass(frozen=True)
class Model:
    words: np.ndarray  # sorted hashes
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades
    cutoff: float  # probability of a grade above 0 from which a document is called toxic

    def severity(self, found: np.ndarray) -> np.ndarray:
        """Probabilities of a grade above 0, above 1, ... for a sorted set of word hashes."""
        if not len(self.words):
            return np.zeros(len(self.thresholds))
        at = np.searchsorted(self.words, found)
        at[at == len(self.words)] = 0
        hit = at[self.words[at] == found]
        return sigmoid(self.weights[hit].sum() - self.thresholds)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_ordinal(x: np.ndarray, grade: np.ndarray, grades: int, ridge: float = RIDGE, steps: int = STEPS):
    """Weights and thresholds of the proportional-odds model, by accelerated gradient descent."""
    n, m = x.shape
    thresholds = np.linspace(1.0, 2.0, grades - 1)
    weights = np.zeros(m)
    values = np.concatenate([weights, [thresholds[0]], np.log(np.diff(thresholds))])
    first, second = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, steps + 1):
        weights = values[:m]
        gaps = np.exp(values[m + 1 :])
        thresholds = values[m] + np.concatenate([[0.0], np.cumsum(gaps)])
        below = np.concatenate([[-np.inf], thresholds, [np.inf]])
        s = x @ weights
        low, high = sigmoid(below[grade] - s), sigmoid(below[grade + 1] - s)
        chance = np.maximum(high - low, 1e-12)
        d_score = (1 - high - low) / n
        d_high, d_low = -high * (1 - high) / chance / n, low * (1 - low) / chance / n
        d_below = np.bincount(grade + 1, d_high, grades + 1) + np.bincount(grade, d_low, grades + 1)
        d_thresholds = d_below[1:grades]
        tail = np.cumsum(d_thresholds[::-1])[::-1]
        gradient = np.concatenate([x.T @ d_score + ridge * weights, [tail[0]], tail[1:] * gaps])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        values = values - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return values[:m], values[m] + np.concatenate([[0.0], np.cumsum(np.exp(values[m + 1 :]))])


def _z_scores(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """By how many standard errors the share of documents with a word differs."""
    p = (toxic + clean + 1) / (n_toxic + n_clean + 2)
    return (toxic / n_toxic - clean / n_clean) / np.sqrt(p * (1 - p) * (1 / n_toxic + 1 / n_clean))


def best_cutoff(chance: np.ndarray, label: np.ndarray) -> float:
    """The cutoff with the most toxic documents found, less ``FALSE_ALARM`` times the share of clean ones, in the
    middle of the gap it falls into."""
    values, back = np.unique(chance, return_inverse=True)
    toxic, clean = np.bincount(back, label, len(values)), np.bincount(back, 1 - label, len(values))
    gain = np.cumsum((toxic / label.sum() - FALSE_ALARM * clean / (1 - label).sum())[::-1])[::-1]
    at = int(gain.argmax())
    return float(values[at] + values[at - 1]) / 2 if at else float(values[0])


def fit(
    df: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    fit_rows: int = FIT_ROWS,
) -> Model:
    """Fit on a bounded sample of the labelled rows. Without both classes, nothing is ever toxic.

    Keys with both labels are left out; rows of one key are all learned from. Of drawn rows with the same label and equal features
    one stays, as the others say nothing new. The cutoff is the best on every fifth row, by a model of the other rows.
    """
    empty = Model(np.zeros(0, np.uint64), np.zeros(0), np.zeros(GRADES - 1), 1.0)
    known = labels.select(F.col(key).alias("key"), F.col(toxic).cast("int").alias("toxic")).filter(
        F.col("key").isNotNull() & F.col("toxic").isin(0, 1)
    )
    known = known.groupBy("key").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
    known = known.filter(F.col("toxic") == F.col("most")).drop("most")
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if set(counts) != {0, 1}:
        return empty
    share = F.when(F.col("toxic") == 1, min(1.0, fit_rows / counts[1])).otherwise(min(1.0, fit_rows / counts[0]))
    drawn = known.filter(unit_hash(F.col("key"), F.lit("toxicity")) < share)
    texts = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).filter(F.col("text").isNotNull())
    # The drawn labels are at most about two times fit_rows.
    sample = texts.join(F.broadcast(drawn), "key").select("key", "toxic", "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = list(features_of(batch))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["toxic"],
                    pa.array([x.tobytes() for x in sets], pa.binary()),
                ],
                names=["toxic", "words"],
            )

    rows = sample.mapInArrow(features, "toxic int, words binary").collect()
    rows.sort(key=lambda r: (r["toxic"], r["words"]))
    rows = list({(r["toxic"], bytes(r["words"])): r for r in rows}.values())
    label = np.array([r["toxic"] for r in rows], int)
    if not 0 < label.sum() < len(label):
        return empty
    sets = [np.frombuffer(r["words"], np.uint64) for r in rows]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    words, back = np.unique(np.concatenate(sets), return_inverse=True)
    n_toxic, n_clean = int(label.sum()), int((1 - label).sum())
    in_toxic = np.bincount(back, label[owner], len(words))
    z = _z_scores(in_toxic, np.bincount(back, minlength=len(words)) - in_toxic, n_toxic, n_clean)
    strong = np.argsort(-np.abs(z), kind="stable")[:MOST_WORDS]
    chosen = np.sort(strong[np.abs(z[strong]) >= SIGNIFICANT])
    if not len(chosen):
        return empty
    place = np.full(len(words), -1)
    place[chosen] = np.arange(len(chosen))
    x = np.zeros((len(sets), len(chosen)), np.float64)
    used = place[back] >= 0
    x[owner[used], place[back][used]] = 1.0
    cues = x[:, z[chosen] > 0].sum(axis=1)
    grade = np.where(label == 1, np.where(cues > np.median(cues[label == 1]), 2, 1), 0)
    weights, thresholds = fit_ordinal(x, grade, GRADES)
    out = np.arange(len(label)) % 5 == 0
    if not 0 < label[out].sum() < out.sum():
        return Model(words[chosen], weights, thresholds, best_cutoff(sigmoid(x @ weights - thresholds[0]), label))
    some, first = fit_ordinal(x[~out], grade[~out], GRADES)
    return Model(words[chosen], weights, thresholds, best_cutoff(sigmoid(x[out] @ some - first[0]), label[out]))


def grade(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, severity (expected grade), p_toxic (of a grade above 0), grade (the most probable), toxic.

    A null text counts as empty. Repeated rows are graded alike; an empty table gives an empty result.
    Other columns of ``df`` are ignored.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    given = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            above = np.array([shared.value.severity(found) for found in features_of(batch)])
            each = np.hstack([np.ones((len(above), 1)), above]) - np.hstack([above, np.zeros((len(above), 1))])
            yield pa.RecordBatch.from_arrays(
                [
                    batch["key"],
                    pa.array(above.sum(axis=1), pa.float64()),
                    pa.array(above[:, 0], pa.float64()),
                    pa.array(each.argmax(axis=1), pa.int32()),
                    pa.array(above[:, 0] >= shared.value.cutoff, pa.bool_()),
                ],
                names=["key", "severity", "p_toxic", "grade", "toxic"],
            )

    kind = given.schema["key"].dataType.simpleString()
    result = given.mapInArrow(run, f"key {kind}, severity double, p_toxic double, grade int, toxic boolean")
    return result.withColumnRenamed("key", key)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity and verdict for every document."""
    docs = documents(spark, sf_dir)
    return grade(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
