"""Substring dedup: words that repeat, as a long window, a document with a smaller id.

Every window of ``width`` consecutive words gets a Rabin-Karp hash over the hashes of its words.
Spark merges the hashes of all blocks of documents to the smallest id that holds each window
(``blocks.exchange``); a window with a smaller holder than its own document is repeated, and
repeated windows merge into maximal removal intervals.

Two different windows count as equal if their 64-bit hashes agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import blocks
from tallyloom.llm.common import documents, hashed_words, mix64

WIDTH = 50
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
#: Stands for "no document": ids are compared as unsigned values after this shift.
SHIFT = np.uint64(1 << 63)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """The Rabin-Karp hash, modulo 2**64, of each window of ``width`` consecutive values."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.uint64)
    inverse = pow(BASE, -1, 1 << 64)
    down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, inverse, np.uint64)]), dtype=np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * down, dtype=np.uint64)])
    up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, BASE, np.uint64)]), dtype=np.uint64)
    return mix64((sums[width:] - sums[: n - width + 1]) * up[width - 1 :])


def _windows(keys: pa.Array, texts: list[bytes | None], width: int):
    """The number of words of each document, and hash, position and id of all windows inside one document.

    Documents without an id have no windows.
    """
    hashes, sizes = hashed_words(texts)
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    known = np.asarray(keys.is_valid())
    found = window_hashes(hashes, width)
    inside = doc[: len(found)] == doc[width - 1 :] if len(found) else np.zeros(0, bool)
    at = np.flatnonzero(inside & known[doc[: len(found)]]) if len(found) else np.zeros(0, np.int64)
    ids = np.asarray(keys.fill_null(0)).astype(np.int64).view(np.uint64) ^ SHIFT
    return sizes, found[at], at, ids[doc[at]]


def _first_holders(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, the smallest id of each, and for each window the place of its hash."""
    found, back = np.unique(hashes, return_inverse=True)
    least = np.full(len(found), np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, back, ids)
    return found, least, back


def repeated_words(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """Per row: key, n_words, spans (start, end of the removed word runs, end exclusive), kept_text.

    A word goes if a window of ``width`` words covers it whose words also start in a row with a
    smaller key. Kept words are joined by one space. Null and empty texts have no words; a text
    shorter than the window keeps all. Rows with the same key do not remove one another; rows
    without a key remove nothing and keep all. An empty table gives an empty result. Other
    columns of ``df`` are ignored.
    """
    packed = blocks.pack(df, key, text)
    parts = blocks.n_parts(packed.agg(F.sum("n_bytes")).first()[0] or 0)

    def keys_of(keys, texts):
        _, hashes, _, ids = _windows(keys, texts, width)
        found, least, _ = _first_holders(hashes, ids)
        return found, least

    def finish(keys, texts, answers):
        sizes, hashes, at, ids = _windows(keys, texts, width)
        found, least, back = _first_holders(hashes, ids)
        first = blocks.merged_values(found, least, parts, answers)
        begins = at[first[back] < ids]
        change = np.zeros(int(sizes.sum()) + 1, np.int64)
        np.add.at(change, begins, 1)
        np.add.at(change, begins + width, -1)
        gone = np.cumsum(change[:-1]) > 0
        kept, spans, start = [], [], 0
        for text, size in zip(texts, sizes.tolist(), strict=True):
            doc = text.split() if text else []
            mask = gone[start : start + size]
            start += size
            edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
            spans.append([{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)])
            if len(edges):
                doc = [w for w, drop in zip(doc, mask.tolist(), strict=True) if not drop]
            kept.append(b" ".join(doc))
        return pa.table(
            {
                "key": keys,
                "n_words": pa.array(sizes, pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
            }
        )

    answers = blocks.exchange(packed, parts, keys_of, lambda values, starts: np.minimum.reduceat(values, starts))
    schema = "key long, n_words long, spans array<struct<start:long,end:long>>, kept_text string"
    return blocks.answered(packed, answers, finish, schema).withColumnRenamed("key", key)


def removed(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    return repeated_words(documents(spark, sf_dir)).select(
        "doc_id",
        "n_words",
        removed(F.col("spans")).alias("n_removed"),
        F.sha2(F.col("kept_text"), 256).alias("kept_sha256"),
    )
