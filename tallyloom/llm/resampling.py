"""Importance resampling towards a target: hashed features of words, drawn by perturbed scores.

Features are runs of up to ``n`` words, each in a bucket by the CRC-32 of its bytes. A document's weight is
the mean over its features of how much likelier the bucket is in the target than in the documents; the
documents with the highest weight plus Gumbel noise are drawn.

A head vocabulary saves most of the hashing: the CRC states of the frequent words (a state is the CRC of the
word and the blank behind it, from which the CRC of a longer run goes on) and the buckets of the frequent
pairs are broadcast. What is not in the head, the tail, gets its CRC directly. Both give the same bucket, so the
totals are exact and the head changes the time only. It is bounded: ``HEAD`` words and pairs of at most
``LONGEST`` bytes.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import as_bytes, documents, saved, slices

HEAD = 16_384
LONGEST = 64
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024

#: Bytes of UTF-8 to what words are made of: A-Z to a-z, other ASCII than letters and digits to a blank.
_WORD_BYTES = bytes(b if b >= 128 or chr(b).islower() or chr(b).isdigit() else b + 32 if chr(b).isupper() else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a text, A-Z lowered: runs of letters, digits and all beyond ASCII."""
    return text.translate(_WORD_BYTES).split() if text else []


class _States(dict):
    """The CRC of a word and the blank behind it."""

    def __missing__(self, word: bytes) -> int:
        return zlib.crc32(word + b" ")


class _Buckets(dict):
    """The bucket of a word."""

    def __init__(self, known: dict[bytes, int], buckets: int):
        super().__init__(known)
        self.buckets = buckets

    def __missing__(self, word: bytes) -> int:
        return zlib.crc32(word) % self.buckets


class _Runs(dict):
    """The bucket of a run of two words or more, from the state of its first."""

    def __init__(self, known: dict[tuple[bytes, ...], int], states: _States, buckets: int):
        super().__init__(known)
        self.states, self.buckets = states, buckets

    def __missing__(self, run: tuple[bytes, ...]) -> int:
        return zlib.crc32(b" ".join(run[1:]), self.states[run[0]]) % self.buckets


@dataclass
class Vocabulary:
    """The head, as it is broadcast: frequent words and frequent pairs."""

    n: int
    buckets: int
    words: list[bytes] = field(default_factory=list)
    pairs: list[tuple[bytes, ...]] = field(default_factory=list)

    def lookup(self) -> tuple[_Buckets, _Runs]:
        states = _States({w: zlib.crc32(w + b" ") for w in self.words}) if self.n > 1 else _States()
        of_word = _Buckets({w: zlib.crc32(w) % self.buckets for w in self.words}, self.buckets)
        known = {p: zlib.crc32(b" ".join(p[1:]), states[p[0]]) % self.buckets for p in self.pairs}
        return of_word, _Runs(known, states, self.buckets)


def buckets_of(words: list[bytes], n: int, of_word: _Buckets, of_run: _Runs) -> np.ndarray:
    """The bucket of every run of 1 to ``n`` words."""
    parts = [np.fromiter(map(of_word.__getitem__, words), np.int32, len(words))]
    for size in range(2, min(n, len(words)) + 1):
        runs = zip(*(words[i:] for i in range(size)), strict=False)
        parts.append(np.fromiter(map(of_run.__getitem__, runs), np.int32, len(words) - size + 1))
    return np.concatenate(parts)


def _prune(counts: Counter, keep: int) -> None:
    """Back to ``keep`` entries, all less the largest count that goes: no entry is ever overrated, and none
    with more than 1 in ``keep`` of all counts is lost."""
    if len(counts) > keep:
        cut = sorted(counts.values(), reverse=True)[keep]
        for x in [x for x, c in counts.items() if c <= cut]:
            del counts[x]
        for x in counts:
            counts[x] -= cut


def vocabulary(df: DataFrame, text: str = "text", n: int = 1, buckets: int = BUCKETS, head: int = HEAD) -> Vocabulary:
    """The frequent words and pairs of all texts: each task's heaviest, added up."""
    orders = range(1, min(n, 2) + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {order: Counter() for order in orders}
        for batch in slices(batches, "text"):
            for words in map(words_of, as_bytes(batch["text"])):
                for order in orders:
                    found[order].update(words if order == 1 else zip(words, words[1:], strict=False))
            for counts in found.values():
                if len(counts) > 16 * head:
                    _prune(counts, head)
        for order, counts in found.items():
            _prune(counts, head)
            kept = [(x if order == 1 else b" ".join(x), c) for x, c in counts.items() if c > 1]
            kept = [x for x in kept if len(x[0]) <= LONGEST]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([order] * len(kept), pa.int32()),
                    pa.array([x for x, _ in kept], pa.binary()),
                    pa.array([c for _, c in kept], pa.int64()),
                ],
                names=["size", "feature", "n"],
            )

    heavy = df.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "size int, feature binary, n long")
    total = heavy.groupBy("size", "feature").agg(F.sum("n").alias("n"))
    result = Vocabulary(n, buckets)
    for order in orders:
        top = total.filter(F.col("size") == order).orderBy(F.desc("n"), "feature").limit(head).select("feature").collect()
        if order == 1:
            result.words = [bytes(r["feature"]) for r in top]
        else:
            result.pairs = [tuple(bytes(r["feature"]).split(b" ")) for r in top]
    return result


def totals(df: DataFrame, head: Vocabulary, text: str = "text") -> np.ndarray:
    """How many features of all texts are in each bucket, exactly."""
    shared = df.sparkSession.sparkContext.broadcast(head)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_word, of_run = shared.value.lookup()
        held = np.zeros(shared.value.buckets, np.int64)
        for batch in slices(batches, "text"):
            for words in map(words_of, as_bytes(batch["text"])):
                if words:
                    held += np.bincount(buckets_of(words, shared.value.n, of_word, of_run), minlength=len(held))
        at = np.nonzero(held)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(held[at], pa.int64())], names=["bucket", "n"])

    parts = df.select(F.col(text).cast("string").alias("text")).mapInArrow(add, "bucket int, n long")
    out = np.zeros(head.buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most one row per bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(ours: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket 1000 times the log ratio of smoothed shares, target over ours, floored."""
    m, s, t = len(ours), int(ours.sum()), int(target.sum())
    ratio = ((target + 1).astype(float) * (s + m)) / ((ours + 1).astype(float) * (t + m))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio.tolist()], np.int64)


def weigh(
    df: DataFrame, head: Vocabulary, gain: np.ndarray, key: str = "doc_id", text: str = "text", seed: int = SEED, whole: bool = False
) -> DataFrame:
    """Per row: the key, n_words, n_features, weight (floored mean gain; 0 without features), and score.

    The score is the weight plus noise that only the key and the seed decide, so reruns agree; equal keys get equal noise, a
    null key that of an empty one. A null text counts as empty. Other columns of ``df`` are ignored, or, with
    ``whole``, come along in a struct ``row``, where no name can clash.
    """
    shared = df.sparkSession.sparkContext.broadcast((head, gain))
    given = df.select(
        F.col(key).alias("key"), F.col(text).cast("string").alias("text"), *([F.struct("*").alias("row")] if whole else [])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, gain = shared.value
        of_word, of_run = vocabulary.lookup()
        for batch in slices(batches, "text"):
            found = np.zeros((3, batch.num_rows), np.int64)
            for i, words in enumerate(map(words_of, as_bytes(batch["text"]))):
                if words:
                    each = gain[buckets_of(words, vocabulary.n, of_word, of_run)]
                    found[:, i] = len(words), len(each), int(each.sum()) // len(each)
            yield pa.RecordBatch.from_arrays(
                [batch["key"], *(pa.array(x, pa.int64()) for x in found), *([batch["row"]] if whole else [])],
                names=["key", "n_words", "n_features", "weight", *(["row"] if whole else [])],
            )

    kind = given.schema["key"].dataType.simpleString()
    row = f", row {given.schema['row'].dataType.simpleString()}" if whole else ""
    weighed = given.mapInArrow(run, f"key {kind}, n_words long, n_features long, weight long{row}")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256)
    chance = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 32))
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log(chance)))
    return weighed.withColumn("score", F.col("weight") + noise)


def draw(weighed: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``weighed``, a table, with the column rank: 1, 2, 3... for the drawn rows, null for the others.

    Of the N rows of ``least_words`` words or more the floor(percent * N / 100) with the highest score are drawn, ties to the
    smaller key, a null key last; rows that agree in both are drawn in any order. Where the cut lies is read off the counts
    per score: scores are whole numbers within the logarithm of the table's size, so there are some 100,000 at most.
    Only the rows above the cut are put in order, by ranges of (score, key, row), so that no score and no key is hot.
    """
    enough = F.col("n_words") >= least_words
    counts = weighed.filter(enough).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()
    left = quota = sum(r["n"] for r in counts) * percent // 100
    cut = None
    for r in sorted(counts, key=lambda r: -r["score"]):
        if left <= 0:
            break
        cut, left = r["score"], left - r["n"]
    if cut is None:
        return weighed.withColumn("rank", F.lit(None).cast("long"))
    above = enough & (F.col("score") >= cut)
    # Row numbers of a table's files, spread: rows of one key and score may then lie in several ranges.
    named = weighed.filter(above).withColumn("_row", F.xxhash64(F.monotonically_increasing_id()))
    order = [F.desc("score"), F.asc_nulls_last("key"), F.asc("_row")]
    ordered = named.repartitionByRange(*order).sortWithinPartitions(*order).drop("_row")
    ordered = saved(ordered.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33)
    held = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per partition
    offsets, before = [], 0
    for r in sorted(held, key=lambda r: r["_part"]):
        offsets.append((r["_part"], before))
        before += r["n"]
    starts = weighed.sparkSession.createDataFrame(offsets, "_part long, _before long")
    place = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    ranked = ordered.withColumn("_part", part).join(starts, "_part").withColumn("rank", F.when(place <= quota, place))
    rest = weighed.filter(~above).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*weighed.columns, "rank").unionByName(rest)


def resample(
    df: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    n: int = 1,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    head: int = HEAD,
    whole: bool = False,
) -> DataFrame:
    """Every row of ``df`` with n_words, n_features, weight, score and rank (see ``weigh`` and ``draw``).

    An empty target gives every feature the gain of an unseen one; an empty ``df`` gives an empty result.
    """
    frequent = vocabulary(df, text, n, buckets, head)
    gain = gains(totals(df, frequent, text), totals(target, frequent, target_text))
    weighed = saved(weigh(df, frequent, gain, key, text, seed, whole), "weighed")
    return draw(weighed, percent, least_words).withColumnRenamed("key", key)


def sample(df: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The drawn rows of ``df`` themselves, with all their columns and nothing else."""
    return resample(df, target, whole=True, **how).filter("rank IS NOT NULL").select("row.*")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, the tenth of them that is most like the benchmark's texts ranked."""
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return resample(documents(spark, sf_dir), target).select("doc_id", "n_features", "weight", "score", "rank")
