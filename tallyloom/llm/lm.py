"""Stupid-backoff language-model scores, computed against the rest of the corpus.

The hashes of all words are kept once, in chunks of documents. A chunk explodes its n-grams to rows (row, hash, many):
``row`` is the number of the chunk, ``many`` how often its texts hold the n-gram. These rows are partitioned by the hash; a
table of counts by hash is made there and joined to the same rows, so that they are shuffled once. What is found
in another chunk goes back to its chunk with its total; an n-gram without a total is held by that chunk alone. In a chunk
each word takes the longest n-gram that other rows hold, and words are summed by document.

n-grams are several times the text. They are dealt with order by order and in shares of their hashes, chunks are
scored in shares as well, and the shuffle files of a share go before the next, so that the disk holds one share at a time.
A hash has one row for each chunk at most, however frequent it is.

A document's own occurrences are taken off every count (leave one out): its score says how well
the rest of the corpus predicts it.
"""

from __future__ import annotations

from collections.abc import Iterator

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import as_bytes, documents, hashed_words, mix64, saved, slices

ORDER = 3
ALPHA = 0.4
#: Kept for callers: no counts are broadcast.
FREQUENT = 1 << 18
#: Bytes of text that are hashed at a time, and words of a chunk.
HASH_BYTES, CHUNK_WORDS = 4 << 20, 3 << 19
#: Shares of the hashes of an order (pairs and words count as one), and of the chunks that are scored, one after another.
SHARES, SCORE_SHARES = 3, 6
#: Words of the corpus for each partition of the n-grams.
PART_WORDS = 1 << 20
GROUP_BYTES = 4 << 20
BATCH_ROWS = 1 << 16
CHUNK_BITS = 33


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` consecutive words, other for each ``n``."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.full(len(hashes) - n + 1, n, np.uint64)
    for k in range(n):
        out = mix64(out + hashes[k : len(hashes) - n + 1 + k])
    return out


def _hashed(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, the text of each, and the number of words of each text."""
    hashes, sizes = hashed_words(t.lower() if t else t for t in texts)
    return hashes, np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), sizes


def _ngrams(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of the last word of each n-gram inside a text."""
    found = ngram_hashes(hashes, n)
    last = np.arange(n - 1, n - 1 + len(found), dtype=np.int32)
    inside = doc[n - 1 :] == doc[: len(found)] if len(found) else np.zeros(0, bool)
    return found[inside], last[inside]


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a row of sorted columns differs from the one before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _chunked(given: DataFrame) -> DataFrame:
    """(chunk, key, n_words, words): hashes of the lower-cased words of each text. Chunks of a task are numbered in a row."""

    def hash_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, chunk, held = TaskContext.get().partitionId() << CHUNK_BITS, 0, 0
        for batch in slices(batches, "text", HASH_BYTES):
            hashes, _, sizes = _hashed(as_bytes(batch["text"]))
            if held and held + len(hashes) > CHUNK_WORDS:
                chunk, held = chunk + 1, 0
            held += len(hashes)
            ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
            words = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.view(np.int64)))
            numbers = pa.array(np.full(len(sizes), first + chunk))
            yield pa.RecordBatch.from_arrays([numbers, batch["key"], pa.array(sizes), words], names=["chunk", "key", "n_words", "words"])

    return given.select("key", "text").mapInArrow(hash_, "chunk long, key long, n_words long, words array<long>")


def _share(chunk: Column) -> Column:
    """The share a chunk is scored in: chunks that follow one another, and first chunks of tasks, are in different ones."""
    return (F.shiftright(chunk, CHUNK_BITS) + chunk.bitwiseAND(F.lit((1 << CHUNK_BITS) - 1))) % SCORE_SHARES


def _listed(words: pa.ListArray | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All hashes of a column of lists, and the length of each list."""
    words = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words
    return np.asarray(words.flatten()).view(np.uint64), np.asarray(words.value_lengths()).astype(np.int64)


def _by_row(batches: Iterator[pa.RecordBatch], row: str, column: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rows that follow one another with one number: the number, the hashes of their words, and the text of each word."""
    number, held, texts = None, [], 0

    def whole() -> tuple[int, np.ndarray, np.ndarray]:
        return number, *(np.concatenate(x) for x in zip(*held, strict=True))

    for batch in batches if column == "words" else slices(batches, "text", HASH_BYTES):
        rows = np.asarray(batch[row])
        starts = _runs(rows)
        for a, z in zip(starts, np.append(starts[1:], len(rows)), strict=True):
            part = batch[column].slice(a, z - a)
            hashes, sizes = _listed(part) if column == "words" else _hashed(as_bytes(part))[::2]
            if held and (rows[a] != number or sum(len(x) for x, _ in held) + len(hashes) > CHUNK_WORDS):
                yield whole()
                held, texts = [], 0
            number = int(rows[a])
            held.append((hashes, np.repeat(np.arange(texts, texts + len(sizes), dtype=np.int32), sizes)))
            texts += len(sizes)
    if held:
        yield whole()


def _exploded(
    texts: DataFrame, order: int, least: int = 1, share: int = 0, shares: int = 1, row: str = "row", column: str = "text"
) -> DataFrame:
    """(row, hash, many): the n-grams of orders ``least`` to ``order`` and how often they are in each run of texts of one row number.

    ``row`` is the column of the number. ``column`` holds texts, or, as ``words``, lists of hashes. Only one share of all
    hashes is sent.
    """

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, hashes, doc in _by_row(batches, row, column):
            for n in range(least, order + 1):
                found = _ngrams(hashes, doc, n)[0]
                if shares > 1:
                    found = found[(found >> np.uint64(32)) * np.uint64(shares) >> np.uint64(32) == share]
                found = np.sort(found)
                starts = _runs(found)
                many = np.diff(np.append(starts, len(found)))
                found = found[starts].view(np.int64)
                for a in range(0, len(found), BATCH_ROWS):
                    part = slice(a, a + BATCH_ROWS)
                    columns = [np.full(len(found[part]), number), found[part], many[part].astype(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["row", "hash", "many"])

    return texts.select(row, column).mapInArrow(explode, "row long, hash long, many long")


def _counted(texts: DataFrame, order: int, exploded: DataFrame | None = None) -> DataFrame:
    """(hash, total, holders): how often all rows hold each n-gram that comes twice or more, and how many exploded rows it has."""
    if exploded is None:
        exploded = _exploded(texts.select(F.lit(0).cast("long").alias("row"), "text"), order)
    counts = exploded.groupBy("hash").agg(F.sum("many").alias("total"), F.count("row").alias("holders"))
    return counts.filter(F.col("total") > 1)


def _found(words: DataFrame, order: int, least: int, share: int, parts: int) -> DataFrame:
    """(chunk, hash, total): the n-grams of orders ``least`` to ``order`` of each chunk that another chunk holds as well."""
    # Both sides read the same three columns under the same filter, the one that the join would put on its side, so that Spark shuffles once.
    exploded = _exploded(words, order, least, share, SHARES, "chunk", "words").filter("many IS NOT NULL AND hash IS NOT NULL")
    exploded = exploded.repartition(parts, "hash")
    counts = _counted(words, order, exploded).filter(F.col("holders") > 1).select("hash", "total")
    joined = exploded.join(counts.hint("shuffle_hash"), "hash").filter(F.col("total") > F.col("many"))
    return joined.select(F.col("row").alias("chunk"), "hash", "total")


def _others(grams: np.ndarray, owner: np.ndarray, hashes: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """How often the other rows hold each n-gram. ``hashes`` (sorted) and ``totals``: of those that other chunks hold."""
    by_gram = np.argsort(grams).astype(np.int32)
    in_order = grams[by_gram]
    starts = _runs(in_order)
    many = np.diff(np.append(starts, len(grams)))
    distinct = in_order[starts]
    del in_order
    total = many
    if len(hashes) and len(starts):
        at = np.minimum(np.searchsorted(hashes, distinct), len(hashes) - 1)
        total = np.where(hashes[at] == distinct, totals[at], many)
        del at
    del distinct
    own = np.ones(len(grams), np.int32)
    twice = np.flatnonzero(np.repeat(many > 1, many)).astype(np.int32)
    if len(twice):
        both = np.repeat(np.flatnonzero(many > 1), many[many > 1]) << 32 | owner[by_gram[twice]]
        by_both = np.argsort(both).astype(np.int32)
        runs = _runs(both[by_both])
        held = np.diff(np.append(runs, len(both))).astype(np.int32)
        own[twice[by_both]] = np.repeat(held, held)
        del both, by_both, runs, held
    out = np.empty(len(grams), np.int64)
    out[by_gram] = np.repeat(total, many) - own
    return out


def _scored(words: DataFrame, found: DataFrame, corpus: int, order: int, alpha: float) -> DataFrame:
    """The scores of the texts of each chunk, from its words and the totals of what other chunks hold."""

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        hashes, sizes = _listed(left["words"])
        rows, n = len(sizes), len(hashes)
        doc = np.repeat(np.arange(rows, dtype=np.int32), sizes)
        known, totals = right["hash"].to_numpy().view(np.uint64), right["total"].to_numpy()
        by_hash = np.argsort(known)
        known, totals = known[by_hash], totals[by_hash]
        del right, by_hash
        value, used = np.full(n, 1.0 / (corpus + 1)), np.zeros(n, np.int8)
        under = corpus - sizes[doc]  # words of the other rows, then counts of the next lower order
        for k in range(1, order + 1):
            grams, last = _ngrams(hashes, doc, k)
            others = np.zeros(n, np.int64)
            others[last] = _others(grams, doc[last], known, totals)
            hit = np.flatnonzero(others > 0)
            value[hit] = others[hit] / (under[hit] if k == 1 else under[hit - 1])
            used[hit] = k
            under = others
        place = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        open_to = np.minimum(place + 1, order)
        logs = np.log(value) + (open_to - np.maximum(used, 1)) * np.log(alpha)
        return pa.table(
            {
                "key": left["key"],
                "n_words": pa.array(sizes),
                "log_score": pa.array(np.bincount(doc, logs, rows)),
                "backed_off": pa.array(np.bincount(doc, used < open_to, rows).astype(np.int64)),
                "unseen": pa.array(np.bincount(doc, used == 0, rows).astype(np.int64)),
            }
        )

    both = words.select("chunk", "key", "words").groupBy("chunk").cogroup(found.groupBy("chunk"))
    return both.applyInArrow(score, "key long, n_words long, log_score double, backed_off long, unseen long")


def stupid_backoff(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    alpha: float = ALPHA,
    frequent: int = FREQUENT,
) -> DataFrame:
    """Per row: key, n_words, log_score (natural log, summed over words), backed_off (words scored
    below the full order open to them), unseen (words that no other row holds).

    A word's score is count(n-gram) / count(context) for the longest n-gram ending there that other
    rows hold, times ``alpha`` for each order skipped; the context of one word is all words of
    the other rows. A word found nowhere else counts 1 / (words of all rows + 1) as its lowest order.
    A-Z are lower-cased. n-grams do not cross rows. Null and empty texts: 0 words and 0.0. Repeated rows
    are other rows to one another, also with equal or null keys. An empty table gives an empty result.
    n-grams are equal if their 64-bit hashes are, at every size of the corpus. ``frequent`` was the
    number of counts that are broadcast; now none are, and the result does not depend on it.
    """
    given = df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    # Written, so that a text is in one chunk in every later pass; in small groups, as n-grams are many times the text.
    words = saved(_chunked(given), "words", group_bytes=GROUP_BYTES)
    corpus = words.agg(F.sum("n_words")).first()[0] or 0
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), corpus // PART_WORDS + 1)
    found = []
    for n in range(order, min(order, 2) - 1, -1):  # the words of a chunk are few: with its pairs
        least = n if n > 2 else 1
        found += [saved(_found(words, n, least, share, parts), "ngrams", free=True) for share in range(SHARES)]
    found = reduce(DataFrame.unionByName, found)
    scores = []
    for share in range(SCORE_SHARES):
        mine = [x.filter(_share(F.col("chunk")) == share) for x in (words, found)]
        scores.append(saved(_scored(*mine, corpus, order, alpha), "scores", free=True))
    return reduce(DataFrame.unionByName, scores).withColumnRenamed("key", key)


def op10_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document against all others, and its mean a word."""
    return stupid_backoff(documents(spark, sf_dir)).select(
        "doc_id",
        "n_words",
        "backed_off",
        "unseen",
        F.round("log_score", 3).alias("log_score"),
        F.round(F.try_divide("log_score", "n_words"), 6).alias("mean_log_score"),
    )
