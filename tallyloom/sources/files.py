"""Event batches from files: one JSON event per line, or one JSON array per file.

A file stands for one request. Gzip files are read through the codec of the file source.
Nothing is dropped here: a line that does not parse stays as a row with ``parse_error``, so
that ``operators.ingest`` can send it to the dead letters.
"""

from __future__ import annotations

import gc
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.schema import WIRE_EVENT
from tallyloom.session import work_dir
from tallyloom.sinks.loads import filesystem

REQUEST_COLUMNS = {
    "batch_id": "string",
    "api_key": "string",
    "forwarded_for": "string",
    "remote_addr": "string",
    "header_user_agent": "string",
}
# Optional column: the unpacked size of the whole request, where the source knows it.
REQUEST_BYTES = "request_bytes"
# Fixed value: the request limit if no other is given.
MAX_REQUEST_BYTES = 1_048_576
# Names of files that a codec of the file source unpacks.
COMPRESSED = r"\.(gz|gzip|bz2|deflate|lz4|snappy|zst|zstd)$"
# Names of files that ``read_json_arrays`` unpacks itself, piece by piece.
GZIP = r"\.(gz|gzip)$"
PIECE_BYTES = 1 << 16
HEAD_BYTES = 4096
# Tasks for each core that read the small files of a partition folder.
TASKS_PER_CORE = 3
# The driver keeps so many bytes of file listings of readers that are gone.
LISTINGS = "spark.sql.hive.filesourcePartitionFileCacheSize"

_BAD = "_bad"


def _with_bad(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(_BAD, T.StringType(), True)])


def _request_columns(df: DataFrame) -> DataFrame:
    """Add the request columns a source does not provide, as NULLs."""
    missing = {
        name: F.lit(None).cast(kind)
        for name, kind in REQUEST_COLUMNS.items()
        if name not in df.columns
    }
    return df.withColumns(missing) if missing else df


def parse_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Parse one JSON event per row of a text column; blank lines are skipped.

    Other columns (the request columns) are kept.
    """
    rest = [c for c in lines.columns if c != value]
    text = F.trim(F.col(value))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    parsed = lines.filter(text != "").select(
        *rest,
        text.alias("raw"),
        F.octet_length(F.col(value)).alias("raw_bytes"),
        F.from_json(text, _with_bad(WIRE_EVENT), options).alias("e"),
    )
    return _request_columns(_flatten(parsed, rest))


def _flatten(parsed: DataFrame, rest: list[str]) -> DataFrame:
    fields = [F.col(f"e.{f.name}").alias(f.name) for f in WIRE_EVENT.fields]
    error = F.col("e").isNull() | F.col(f"e.{_BAD}").isNotNull()
    return parsed.select(*rest, "raw", "raw_bytes", error.alias("parse_error"), *fields)


def _plain_size() -> Column:
    """The size of an uncompressed file; NULL for a compressed one, whose lines must be added up."""
    packed = F.col("_metadata.file_name").rlike(COMPRESSED)
    return F.when(~packed, F.col("_metadata.file_size")).alias(REQUEST_BYTES)


def read_ndjson(spark: SparkSession, path: str) -> DataFrame:
    """Newline-delimited events; the file path is the batch id.

    The size of a request is that of the unpacked file: ``operators.ingest`` adds up the lines of
    compressed files.
    """
    columns = ["value", F.col("_metadata.file_path").alias("batch_id"), _plain_size()]
    return parse_lines(spark.read.text(path).select(*columns))


def gunzip(data: bytes, most_bytes: int) -> tuple[bytes, int, bool]:
    """(content, size, whole): the content of gzip members, its first ``HEAD_BYTES`` if it is longer than ``most_bytes``.

    ``size`` counts all of it; what is over is unpacked in pieces and dropped. Not ``whole`` if it is over or
    the data is cut off or not gzip.
    """
    held, size = bytearray(), 0
    while data:
        member = zlib.decompressobj(31)
        try:
            while data and not member.eof:
                piece = member.decompress(data, PIECE_BYTES)
                data = member.unconsumed_tail
                size += len(piece)
                if size <= most_bytes or len(held) < HEAD_BYTES:
                    held += piece
            while not member.eof and (piece := member.decompress(b"", PIECE_BYTES)):
                size += len(piece)
                if size <= most_bytes or len(held) < HEAD_BYTES:
                    held += piece
        except zlib.error:
            return bytes(held[:HEAD_BYTES]), size, False
        if not member.eof:
            return bytes(held[:HEAD_BYTES]), size, False
        data = member.unused_data.lstrip(b"\0")  # members may follow, or padding
    whole = size <= most_bytes
    return bytes(held if whole else held[:HEAD_BYTES]), size, whole


def _unpacked(packed: DataFrame, most_bytes: int) -> DataFrame:
    """(value, head, batch_id, request_bytes) of gzip files, a few at a time and none above ``most_bytes`` in memory."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                data, size, whole = gunzip(content.as_py(), most_bytes)
                text = data.decode("utf-8", "replace")
                row = {"value": [text if whole else None], "head": [None if whole else text], "batch_id": [path], REQUEST_BYTES: [size]}
                kinds = [pa.string(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row.values(), kinds, strict=True)], names=list(row))

    return packed.select("path", "content").mapInArrow(unpack, f"value string, head string, batch_id string, {REQUEST_BYTES} long")


def _parts(spark: SparkSession, path: str) -> list[str]:
    """The partition folders (``name=value``) of a folder that holds nothing else; none for any other path."""
    where, fs = filesystem(spark, path)
    if not fs.exists(where):
        return []
    found, listed = [], fs.listStatusIterator(where)
    while listed.hasNext():
        status = listed.next()
        name = status.getPath().getName()
        if name.startswith(("_", ".")) and "=" not in name:
            continue
        if not status.isDirectory() or "=" not in name:
            return []
        found.append(status.getPath().toString())
    return sorted(found)


def read_json_arrays(spark: SparkSession, path: str, max_request_bytes: int = MAX_REQUEST_BYTES) -> DataFrame:
    """Files that hold one JSON array of events each; the file path is the batch id.

    The reader takes a file as one value. Files above ``max_request_bytes`` on disk come back as one row
    with their size and without their content: pass the limit of the rules that ``operators.ingest``
    applies, which refuse these requests. The size of the others is that of the unpacked text. Gzip files are
    unpacked in pieces: one that grows above the limit, or is broken, is a row with its unpacked size and
    the head of its text as ``raw``.

    The driver knows each file it lists, and many are small. Partition folders (``name=value``) are read one after another, and their
    events are kept as a table meanwhile, so it knows the files of one folder at a time; a folder should hold some
    ten thousand files. A folder without them is read as a whole when the result is used.
    """
    parts = _parts(spark, path)
    if parts:
        kept = work_dir(spark, "array_events")
        tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
        before = spark.conf.get(LISTINGS)
        spark.conf.set(LISTINGS, "0")
        try:
            for part in parts:
                rows = _array_rows(spark, part, max_request_bytes)
                rows.coalesce(tasks).write.mode("append").parquet(kept)
                gc.collect()  # the reader of the folder before, with all its files, hangs on a cycle of Python objects
        finally:
            spark.conf.set(LISTINGS, before)
        rows = spark.read.schema(rows.schema).parquet(kept)
    else:
        rows = _array_rows(spark, path, max_request_bytes)
    rows = rows.withColumn(REQUEST_BYTES, F.coalesce(REQUEST_BYTES, F.lit(0).cast("long")))  # it is never NULL
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    parsed = rows.select(
        "batch_id",
        REQUEST_BYTES,
        F.coalesce("value", "head").alias("raw"),
        F.octet_length("value").alias("raw_bytes"),
        F.from_json("value", _with_bad(WIRE_EVENT), options).alias("e"),
    )
    return _request_columns(_flatten(parsed, ["batch_id", REQUEST_BYTES]))


def _array_rows(spark: SparkSession, path: str, max_request_bytes: int) -> DataFrame:
    """(batch_id, request_bytes, head, value) of the events in the files of one folder; ``value`` is NULL for a file without an array."""
    no_text = F.lit(None).cast("string")
    plain = spark.read.text(path, wholetext=True).filter(
        (F.col("_metadata.file_size") <= max_request_bytes) & ~F.col("_metadata.file_name").rlike(GZIP)
    )
    small = plain.select(
        "value",
        no_text.alias("head"),
        F.col("_metadata.file_path").alias("batch_id"),
        F.octet_length("value").cast("long").alias(REQUEST_BYTES),
    )
    # By their metadata files are left out when they are listed, and no task opens them.
    size, packs = F.col("_metadata.file_size"), F.col("_metadata.file_name").rlike(GZIP)
    binary = spark.read.format("binaryFile").load(path)
    large = binary.filter(size > max_request_bytes).select(
        no_text.alias("value"), no_text.alias("head"), F.col("path").alias("batch_id"), F.col("length").alias(REQUEST_BYTES)
    )
    packed = binary.filter((size <= max_request_bytes) & packs)
    texts = small.unionByName(large).unionByName(_unpacked(packed, max_request_bytes))
    items = F.try_variant_get(F.try_parse_json("value"), "$", "array<variant>")
    one = F.when(items.isNull(), F.array(F.lit(None).cast("string"))).otherwise(
        F.transform(items, lambda item: F.to_json(item))
    )
    return texts.select("batch_id", REQUEST_BYTES, "head", F.explode(one).alias("value"))


def stream_ndjson(spark: SparkSession, path: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """The streaming form of ``read_ndjson`` before parsing; new files in ``path`` are new requests.

    A file is in one micro-batch as a whole, where ``streaming.jobs.ingest_lines`` parses its lines and adds
    up the size of compressed ones.
    """
    return (
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(path)
        .select("value", F.col("_metadata.file_path").alias("batch_id"), _plain_size())
    )
