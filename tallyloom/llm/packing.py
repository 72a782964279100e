"""Best-fit packing with large-item matching, planned on the histogram of lengths.

Every document becomes pieces of at most ``capacity`` tokens. How pieces fit together depends on
their lengths only, and there are at most ``capacity`` of these, so the whole corpus is planned
at once from one count per length, however many pieces there are:

1. Pieces above one third of the capacity are matched: greedily, the longest first, each takes the
   longest other large piece that still fits, so a sequence holds one or two of them (a third
   would not leave room).
2. Smaller pieces, the longest first, go where they leave the smallest gap.
3. What fits nowhere opens new sequences.

The plan is a list of sequence shapes with multiplicities, of a size bounded by the capacity. A
piece's rank among those of its length then names its place. Ranks are counted per bucket
of pieces, so a length that a third of all pieces share is spread like any other.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import documents, saved, slices

CAPACITY = 2048
VOCABULARY = "byte_bpe_50k"
#: Characters whose classes all versions of Unicode since 4.0 agree on: both tokenizer libraries split them alike.
LATIN = regex.compile(r"[^\x00-ɏ]")
#: Pieces a bucket: ranks are counted in buckets of about this many pieces.
RANKED = 50_000


@cache
def encoder(vocabulary: str):
    """A function from texts to ids, as ``tokenizers`` gives them with add_special_tokens=False.

    Texts in Latin letters without a special token go through ``tiktoken`` with the ranks of the same
    vocabulary, which gives the same ids in a quarter of the time; all others through ``tokenizers``.
    """
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
    specials = [t.content for t in full.get_added_tokens_decoder().values()]
    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if LATIN.search(text) or any(s in text for s in specials):
            return full.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def pieces(
    df: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, vocabulary: str = VOCABULARY
) -> DataFrame:
    """Per piece: key, piece, start, length, ids_crc32.

    A document's ids are its tokens and a final id 0; null and empty texts are that id alone. A longer
    document is cut so that all its pieces but the first are full.
    """
    given = df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in slices(batches, "text"):
            keys, numbers, starts, lengths, sums = [], [], [], [], []
            for k, value in zip(batch["key"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ids = np.array([*encode(value or ""), 0], "<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(min(first, len(ids)), len(ids) + 1, capacity)]
                for number, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    keys.append(k)
                    numbers.append(number)
                    starts.append(a)
                    lengths.append(b - a)
                    sums.append(zlib.crc32(ids[a:b].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array(numbers, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                names=["key", "piece", "start", "length", "ids_crc32"],
            )

    return given.mapInArrow(run, "key long, piece int, start long, length long, ids_crc32 long")


def shapes(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """Sequence shapes (how many, lengths in order) that hold ``counts[length]`` pieces of each length."""
    left = {n: c for n, c in counts.items() if c > 0}
    lengths = sorted(left)
    bins: dict[int, list[list]] = {}  # by gap: [how many, lengths]
    gaps: list[int] = []  # sorted

    def add(many: int, held: tuple[int, ...]) -> None:
        gap = capacity - sum(held)
        if gap not in bins:
            insort(gaps, gap)
            bins[gap] = []
        bins[gap].append([many, held])

    large = [n for n in lengths if 3 * n > capacity]
    while large:
        one = large[-1]
        # The longest other large length that fits; the same length needs two pieces.
        at = bisect_left(large, capacity - one + 1) - 1
        while at >= 0 and large[at] == one and left[one] < 2:
            at -= 1
        if at < 0:
            many, held = left[one], (one,)
        elif large[at] == one:
            many, held = left[one] // 2, (one, one)
        else:
            many, held = min(left[one], left[large[at]]), (one, large[at])
        add(many, held)
        for n in held:
            left[n] -= many
        large = [n for n in large if left[n]]

    for one in reversed([n for n in lengths if 3 * n <= capacity]):
        while left[one]:
            at = bisect_left(gaps, one)
            if at == len(gaps):  # fits nowhere: new sequences, each with as many as fit
                fit = capacity // one
                full, rest = divmod(left[one], fit)
                if full:
                    add(full, (one,) * fit)
                if rest:
                    add(1, (one,) * rest)
                left[one] = 0
                break
            gap = gaps[at]
            many, held = bins[gap][-1]
            fit = gap // one  # the best place stays the best until its gap is too small
            if left[one] >= fit * many:
                used, placed = many, held + (one,) * fit
            elif left[one] >= fit:
                used, placed = left[one] // fit, held + (one,) * fit
            else:
                used, placed = 1, held + (one,) * left[one]
            left[one] -= used * (len(placed) - len(held))
            if used == many:
                bins[gap].pop()
            else:
                bins[gap][-1][0] -= used
            if not bins[gap]:
                gaps.pop(at)
                del bins[gap]
            add(used, placed)
    return [(many, held) for found in bins.values() for many, held in found]


def slots(plan: list[tuple[int, tuple[int, ...]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: the first rank of each run of places, its first sequence, and the offset in it."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    first = 0
    for many, held in plan:
        offset = 0
        for n in held:
            runs.setdefault(n, []).append((used.get(n, 0), first, offset))
            used[n] = used.get(n, 0) + many
            offset += n
        first += many
    return {n: tuple(np.array(x, np.int64) for x in zip(*found, strict=True)) for n, found in runs.items()}


def packed(
    df: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, vocabulary: str = VOCABULARY
) -> DataFrame:
    """Per piece: key, piece, start, length, ids_crc32, sequence_id, offset.

    Null texts are empty ones; repeated rows and null keys are packed as rows of their own. An empty
    table gives an empty result. Other columns of ``df`` are ignored.
    """
    rows = saved(pieces(df, key, text, capacity, vocabulary), "pieces")
    buckets = 1 + rows.count() // RANKED
    spread = rows.withColumn("bucket", F.pmod(F.xxhash64("key", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    cells = saved(spread.groupBy("length", "bucket").agg(F.count("*").alias("n")), "piece_counts")
    histogram = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = slots(shapes(histogram, capacity))
    cells = cells.withColumn(
        "before",
        F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)),
    ).select("length", "bucket", F.coalesce("before", F.lit(0)).alias("before"))

    ordered = Window.partitionBy("length", "bucket").orderBy("key", "piece", "ids_crc32", "start")
    ranked = (
        spread.withColumn("nth", F.row_number().over(ordered) - 1)
        .join(cells, ["length", "bucket"])
        .withColumn("rank", F.col("nth") + F.col("before"))
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = np.asarray(batch["length"]), np.asarray(batch["rank"])
            sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for n in np.unique(lengths).tolist():
                of = np.flatnonzero(lengths == n)
                start, first, at = places[n]
                run = np.searchsorted(start, ranks[of], "right") - 1
                sequence[of] = first[run] + ranks[of] - start[run]
                offset[of] = at[run]
            kept = [batch[c] for c in ("key", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)],
                names=["key", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    schema = "key long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    result = ranked.select("key", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(place, schema)
    return result.withColumnRenamed("key", key)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of at most 2048 tokens."""
    return packed(documents(spark, sf_dir))
