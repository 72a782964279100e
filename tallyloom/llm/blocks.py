"""Counting over all documents by blocks: one message per block, partition and direction.

Documents are packed into blocks of a few MB (one compressed row each). A block reduces what
it counts to its distinct 64-bit keys, sorted, and sends each key range to one partition. The
partition merges the ranges of all blocks and answers each block. A key is in a message once
per block however often its documents hold it, so the most frequent key of the corpus costs a
partition no more than one entry per block: there is no hot key to split. What is moved is
five to seven bytes per distinct key of a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import as_bytes, saved

CODEC = pa.Codec("zstd", compression_level=1)
BLOCK_BYTES = 8 << 20
PART_BYTES = 12 << 20


def pack(df: DataFrame, key: str, text: str, block_bytes: int = BLOCK_BYTES, *, level: int = 1) -> DataFrame:
    """Rows (block, n_bytes, n_words, payload): each is some documents as compressed Arrow data.

    The table is written to the shared folder, so a block is the same in every later pass. A
    document longer than ``block_bytes`` is a block of its own. ``level`` is that of zstd.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        size = 0

        def row() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            sink = pa.BufferOutputStream()
            options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=level))
            with pa.ipc.new_stream(sink, table.schema, options=options) as out:
                out.write_table(table)
            words = sum(len(t.split()) for t in as_bytes(table["text"].combine_chunks()) if t)
            return pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([task << 32 | number], pa.int64()),
                    "n_bytes": pa.array([size], pa.int64()),
                    "n_words": pa.array([words], pa.int64()),
                    "payload": pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                }
            )

        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch["text"].cast(pa.binary())), 0)
            start = 0
            for i, length in enumerate(lengths.to_pylist()):
                if size and size + length > block_bytes:
                    held.append(batch.slice(start, i - start))
                    yield row()
                    held, size, start, number = [], 0, i, number + 1
                size += length
            held.append(batch.slice(start))
        if any(b.num_rows for b in held):
            yield row()

    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return saved(
        rows.mapInArrow(build, "block long, n_bytes long, n_words long, payload binary"), "blocks", "uncompressed"
    )


def unpack(payload: bytes) -> tuple[pa.Array, list[bytes | None]]:
    """The keys and the texts of a block."""
    table = pa.ipc.open_stream(payload).read_all().combine_chunks()
    if not table.num_rows:
        return pa.array([], pa.int64()), []
    return table["key"].combine_chunks(), as_bytes(table["text"].combine_chunks())


def n_parts(n_bytes: int) -> int:
    """Partitions such that each holds the keys of a bounded share of the text."""
    return max(1, -(-n_bytes // PART_BYTES))


def bounds(parts: int) -> np.ndarray:
    """The first key of each key range but the first."""
    return np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)


def narrow(values: np.ndarray) -> bytes:
    """Unsigned values as byte planes (all lowest bytes, then the next), each compressed on its own; as many
    planes as needed.

    Differences of sorted hashes are random in their low planes; the top plane and small counts compress well.
    """
    values = values.astype(np.uint64, copy=False)
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    columns = values.view(np.uint8).reshape(-1, 8)
    planes = [CODEC.compress(np.ascontiguousarray(columns[:, k]).tobytes(), asbytes=True) for k in range(width)]
    head = np.array([len(values), *[len(p) for p in planes]], np.uint32)
    return bytes([width]) + head.tobytes() + b"".join(planes)


def widen(data: bytes) -> np.ndarray:
    width = data[0]
    n, *lengths = np.frombuffer(data, np.uint32, width + 1, 1).tolist()
    out = np.zeros((n, 8), np.uint8)
    at = 1 + 4 * (width + 1)
    for k, length in enumerate(lengths):
        out[:, k] = np.frombuffer(CODEC.decompress(data[at : at + length], decompressed_size=n, asbytes=True), np.uint8)
        at += length
    return out.reshape(-1).view(np.uint64)


def exchange(
    blocks: DataFrame,
    parts: int,
    keys_of: Callable[[pa.Array, list[bytes | None]], tuple[np.ndarray, np.ndarray]],
    merge: Callable[[np.ndarray, np.ndarray], np.ndarray],
) -> DataFrame:
    """Send each block's keys with a value, merge over all blocks, and answer each block.

    ``keys_of(keys, texts)`` gives a block's distinct 64-bit keys, sorted, and a value each (unsigned).
    ``merge(values, starts)`` gets the values of a key range, grouped by key, and where each key
    begins, and gives one value a key. Rows of the result: (block, part, payload), the payload
    being a bit for each of the block's keys in the range (is the merged value another than the
    block's own?) and the merged values that are.
    """
    at = bounds(parts)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload in zip(batch["block"].to_pylist(), batch["payload"], strict=True):
                found, values = keys_of(*unpack(payload.as_py()))
                cuts = [0, *np.searchsorted(found, at).tolist(), len(found)]
                full = [p for p in range(parts) if cuts[p] < cuts[p + 1]]
                pairs = [(cuts[p], cuts[p + 1]) for p in full]
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array(full, pa.int32()),
                        "block": pa.array([block] * len(full), pa.int64()),
                        "keys": pa.array([narrow(np.diff(found[a:b], prepend=np.uint64(0))[1:]) for a, b in pairs], pa.binary()),
                        "first": pa.array([int(found[a].view(np.int64)) for a, _ in pairs], pa.int64()),
                        "least": pa.array([int(values[a:b].min().view(np.int64)) for a, b in pairs], pa.int64()),
                        "vals": pa.array([narrow(values[a:b] - values[a:b].min()) for a, b in pairs], pa.binary()),
                    }
                )

    def answer(table: pa.Table) -> pa.Table:
        rows = table.select(["block", "keys", "first", "least", "vals"]).to_pydict()
        lists = []
        for data, first in zip(rows["keys"], rows["first"], strict=True):
            start = np.array([first], np.int64).view(np.uint64)
            lists.append(np.cumsum(np.concatenate([start, widen(data)]), dtype=np.uint64))
        found = np.concatenate(lists)
        least = np.array(rows["least"], np.int64).view(np.uint64)
        own = np.concatenate([widen(x) + low for x, low in zip(rows["vals"], least, strict=True)])
        order = np.argsort(found, kind="stable")
        ordered = found[order]
        starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        merged = merge(own[order], starts).astype(np.uint64)
        back = np.empty_like(own)
        back[order] = np.repeat(merged, np.diff(np.append(starts, len(found))))
        differs = back != own
        ends = np.cumsum([len(x) for x in lists])
        out = []
        for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            bits = np.packbits(differs[a:b]).tobytes()
            out.append(bits + narrow(back[a:b][differs[a:b]]))
        return pa.table(
            {
                "block": pa.array(rows["block"], pa.int64()),
                "part": table["part"].combine_chunks().cast(pa.int32()),
                "payload": pa.array(out, pa.binary()),
            }
        )

    sent = blocks.select("block", "payload").mapInArrow(
        send, "part int, block long, keys binary, first long, least long, vals binary"
    )
    return sent.groupBy("part").applyInArrow(answer, "block long, part int, payload binary")


def merged_values(found: np.ndarray, own: np.ndarray, parts: int, answers: pa.Table) -> np.ndarray:
    """The merged value of each of a block's keys, from the answers to that block."""
    at = bounds(parts)
    cuts = [0, *np.searchsorted(found, at).tolist(), len(found)]
    out = own.astype(np.uint64, copy=True)
    for part, payload in zip(answers["part"].to_pylist(), answers["payload"].to_pylist(), strict=True):
        a, b = cuts[part], cuts[part + 1]
        n_bits = (b - a + 7) // 8
        differs = np.unpackbits(np.frombuffer(payload, np.uint8, n_bits), count=b - a).astype(bool)
        out[a:b][differs] = widen(payload[n_bits:])
    return out


def answered(
    blocks: DataFrame,
    answers: DataFrame,
    finish: Callable[[pa.Array, list[bytes | None], pa.Table], pa.Table],
    schema: str,
) -> DataFrame:
    """Bring the answers to their blocks: ``finish(keys, texts, answers)`` gives a block's result rows."""

    def one(left: pa.Table, right: pa.Table) -> pa.Table:
        return finish(*unpack(left["payload"][0].as_py()), right)

    return (
        blocks.select("block", "payload").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(one, schema)
    )
