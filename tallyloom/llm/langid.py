"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are folded to lower-case letters with single spaces between words. Each n-gram of one to three characters
counts in one of ``BUCKETS`` buckets. The matrix of log probabilities (buckets x languages) is
broadcast: 256 KB for each distinct label of the learned rows, so labels should be languages. They are
not capped: thousands of stray labels make a matrix of GBs. A batch of texts is scored in numpy as a
sparse product: the matrix rows of all n-grams, summed per text.

The model is fitted on a sample of labelled rows of at most about ``FIT_ROWS`` per language, drawn
by a hash of the key. Counts of labelled rows, and predictions, cover all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import documents, slices, unit_hash

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
FIT_ROWS = 4000
SMOOTHING = 0.5
#: Neighbouring n-grams tell much the same, so a text counts as evidence of at most so many.
EVIDENCE = 100
#: Bytes of text whose n-grams are held at a time.
SLICE = 1 << 20
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
SPACE = 0x20


@cache
def folding() -> np.ndarray:
    """For each code point: its lower-case letter, or a space if it is no letter."""
    table = np.full(0x110000, SPACE, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def ngram_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all n-grams of all texts, and the text of each, by text."""
    codes = [folding()[np.frombuffer(f" {t} ".encode("utf-32-le", "replace"), "<u4")] for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(c) for c in codes])
    flat = np.concatenate(codes) if codes else np.zeros(0, np.uint32)
    again = np.zeros(len(flat), bool)  # a space after a space of the same text
    again[1:] = (flat[1:] == SPACE) & (flat[:-1] == SPACE) & (owner[1:] == owner[:-1])
    flat, owner = flat[~again], owner[~again]
    found, owners = [], []
    for n in ORDERS:
        last = len(flat) - n + 1
        if last <= 0:
            continue
        value = np.full(last, n, np.uint32)
        for k in range(n):
            value = (value ^ flat[k : last + k]) * np.uint32(0x01000193)
        value = (value ^ (value >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        inside = owner[:last] == owner[n - 1 :]
        if n == 1:
            inside &= flat != SPACE
        found.append((value >> np.uint32(16))[inside])
        owners.append(owner[:last][inside])
    if not found:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    return np.concatenate(found) % BUCKETS, np.concatenate(owners)


def held_out(key: Column) -> Column:
    """Rows never learned from: those whose crc32 of the key's decimal text is 2 modulo 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_prior: np.ndarray
    log_likelihood: np.ndarray  # buckets x languages


def fit(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", fit_rows: int = FIT_ROWS) -> Model:
    """Fit on rows with a text and a language whose key is not held out."""
    labelled = df.select(
        F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("key")))
    # One number per language comes to the driver.
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros(0), np.zeros((BUCKETS, 0), np.float32))
    share = F.create_map(*[F.lit(x) for name in languages for x in (name, min(1.0, fit_rows / counts[name]))])
    sample = labelled.filter(unit_hash(F.col("key"), F.lit("langid")) < share[F.col("lang")]).repartition(8)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(languages), BUCKETS), np.int64)
        for batch in batches:
            for part in slices([batch], "text", SLICE):
                buckets, owner = ngram_buckets(part["text"].to_pylist())
                of = np.array([languages.index(x) for x in part["lang"].to_pylist()])
                sums += np.bincount(of[owner] * BUCKETS + buckets, minlength=sums.size).reshape(sums.shape)
        yield pa.RecordBatch.from_pydict({"sums": pa.array([sums.tobytes()], pa.binary())})

    totals = np.zeros((len(languages), BUCKETS), np.int64)
    for row in sample.mapInArrow(count, "sums binary").collect():  # eight rows of fixed size
        totals += np.frombuffer(row["sums"], np.int64).reshape(totals.shape)
    smooth = totals + SMOOTHING
    likelihood = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32)
    prior = np.log(np.array([counts[x] for x in languages], float) / sum(counts.values()))
    return Model(languages, prior, np.ascontiguousarray(likelihood))


def score(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """The predicted language of each text and its posterior probability."""
    has_letter = [bool(t and LETTER.search(t)) for t in texts]
    best, value = [UNKNOWN] * len(texts), np.zeros(len(texts))
    chosen = [i for i, ok in enumerate(has_letter) if ok]
    if not chosen or not model.languages:
        return best, value
    buckets, owner = ngram_buckets([texts[i] for i in chosen])
    many = np.bincount(owner, minlength=len(chosen))
    sums = np.stack(
        [np.bincount(owner, model.log_likelihood[buckets, k], len(chosen)) for k in range(len(model.languages))], axis=1
    )
    evidence = sums * np.minimum(1.0, EVIDENCE / np.maximum(many, 1))[:, None] + model.log_prior
    odds = np.exp(evidence - evidence.max(axis=1, keepdims=True))
    posterior = odds / odds.sum(axis=1, keepdims=True)
    top = posterior.argmax(axis=1)
    for i, k, p in zip(chosen, top.tolist(), posterior.max(axis=1).tolist(), strict=True):
        best[i], value[i] = model.languages[k], p
    return best, value


def predict(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add lang_pred and score to the columns ``keep`` (default: all), replacing columns of these names.

    ``und`` with score 0 for a text that is null or has no letter, and for all texts if the model has
    no language. The best of equal posteriors is the first by name. Repeated rows are scored alike; an
    empty table gives an empty result.
    """
    keep = [c for c in (keep or df.columns) if c not in ("lang_pred", "score")]
    given = df.select(*keep, df[text].cast("string").alias("__text"))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text", SLICE):
            best, value = score(shared.value, batch["__text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in keep] + [pa.array(best, pa.string()), pa.array(value, pa.float64())],
                names=[*keep, "lang_pred", "score"],
            )

    kept = "".join(f"`{c}` {given.schema[c].dataType.simpleString()}, " for c in keep)
    return given.mapInArrow(run, f"{kept}lang_pred string, score double")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by a model that has not seen the held-out fourth."""
    docs = documents(spark, sf_dir)
    result = predict(docs, fit(docs), keep=["doc_id"])
    return result.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
