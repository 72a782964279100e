"""Helpers shared by the training-data operators.

A word is a maximal run of characters other than space and the five ASCII controls from tab
to carriage return. ``bytes.split()`` cuts UTF-8 at exactly these, at C speed, so tasks work
on the bytes of a text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tallyloom.session import work_dir

#: The characters that separate words, as a class of Java's and Python's regular expressions.
BLANKS = r"\x20\x09-\x0D"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Whether a query's shuffle files go as soon as it has ended, not when the driver happens to collect its garbage.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str, compression: str = "zstd", group_bytes: int = 128 << 20, free: bool = False) -> DataFrame:
    """Write ``df`` below the cluster's shared folder and read it back.

    Cuts the lineage: a lost executor costs the tasks that were running, not the work before.
    ``group_bytes`` is the size of a row group before compression, the least that a later task reads.
    ``free`` drops the shuffle files of this write when it has ended.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    before = spark.conf.get(FREED, None)
    if free:
        spark.conf.set(FREED, "true")
    try:
        # A frame that is made now: an older one keeps the setting it was made with.
        df.select("*").write.option("compression", compression).option("parquet.block.size", group_bytes).parquet(path)
    finally:
        if free and before is None:
            spark.conf.unset(FREED)
        elif free:
            spark.conf.set(FREED, before)
    return spark.read.schema(df.schema).parquet(path)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    return column.cast(pa.binary()).to_pylist()


def word_hashes(words: Iterable[bytes], n: int) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, n)


def hashed_words(texts: Iterable[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of all texts in a row, and the number of words of each text."""
    each = []
    for text in texts:
        words = text.split() if text else []
        each.append(word_hashes(words, len(words)))
    sizes = np.array([len(x) for x in each], np.int64)
    return (np.concatenate(each) if each else np.zeros(0, np.uint64)), sizes


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts stay near ``most_bytes``; a longer text is alone."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch[text].cast(pa.binary())), 0))
        start, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def n_words(text: Column) -> Column:
    """Number of words, 0 for null, on the JVM."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{BLANKS}]+")), F.lit(0)).cast("long")


def unit_hash(*columns: Column) -> Column:
    """A value in the open interval (0, 1) that depends only on the given columns."""
    bits = F.shiftrightunsigned(F.xxhash64(*columns), 12).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))
