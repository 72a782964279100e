"""Stream records as Avro payloads of messages, with or without the frame of a schema registry.

A frame is a zero byte and an id of four or eight bytes. One byte does not tell whether there is one: a record whose first text is
empty begins with zero as well. So each reading that the first byte allows is tried, and the one counts that
takes the payload to its last byte, with texts that are UTF-8 and required fields present.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.schema import STREAM_RECORD

# Fields that are never null, the places of a decimal, the lengths of a frame.
ALWAYS = {"event_id", "event_name", "project_id", "device_id", "ts_client"}
SCALE = 4
FRAMES = (5, 9)

_FIELDS = [(f.name, f.dataType.typeName(), f.name in ALWAYS) for f in STREAM_RECORD.fields]
_ARROW = {"string": pa.string(), "long": pa.int64(), "decimal": pa.decimal128(18, SCALE)}


def _put_long(value: int) -> bytes:
    value = (value << 1) ^ (value >> 63)
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def _long(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return (value >> 1) ^ -(value & 1), at
        shift += 7
        if shift > 63:
            raise ValueError("number too long")


def _bytes(data: bytes, at: int) -> tuple[bytes, int]:
    size, at = _long(data, at)
    if not 0 <= size <= len(data) - at:
        raise ValueError("text past the end")
    return data[at : at + size], at + size


def to_payload(row: dict) -> bytes:
    """One record as Avro writes it."""
    out = bytearray()
    for name, kind, always in _FIELDS:
        value = row[name]
        if not always:
            out += b"\0" if value is None else b"\2"
            if value is None:
                continue
        if kind == "long":
            out += _put_long(value)
            continue
        if kind == "string":
            data = value.encode()
        else:
            number = int(value.scaleb(SCALE))
            data = number.to_bytes(number.bit_length() // 8 + 1, "big", signed=True)
        out += _put_long(len(data)) + data
    return bytes(out)


def _record(data: bytes, at: int) -> list | None:
    """The values of a record that begins at ``at`` and ends with the payload; None if there is none."""
    values = []
    try:
        for _, kind, always in _FIELDS:
            if not always:
                branch, at = _long(data, at)
                if branch not in (0, 1):
                    return None
                if branch == 0:
                    values.append(None)
                    continue
            if kind == "long":
                value, at = _long(data, at)
                if not -(1 << 63) <= value < 1 << 63:
                    return None
            else:
                value, at = _bytes(data, at)
                if kind == "string":
                    value = value.decode()
                else:
                    value = Decimal(int.from_bytes(value, "big", signed=True)).scaleb(-SCALE)
                    if abs(value) >= 10 ** (18 - SCALE):
                        return None
            values.append(value)
    except (IndexError, ValueError):  # also a text that is no UTF-8
        return None
    return values if at == len(data) else None


def from_payload(data: bytes | None) -> list | None:
    """The values of a message, framed or not; None if it is no record."""
    if not data:
        return None
    starts = (*FRAMES, 0) if data[0] == 0 else (0,)
    return next((values for at in starts if (values := _record(data, at)) is not None), None)


def decode(messages: DataFrame, value: str = "value") -> DataFrame:
    """The fields of a record for each message, and ``payload``: NULL for a record, the message itself where it is none."""
    out = T.StructType([*STREAM_RECORD.fields, T.StructField("payload", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch[0].to_pylist()
            rows = [from_payload(x) for x in given]
            columns = [
                pa.array([None if r is None else r[i] for r in rows], _ARROW[kind]) for i, (_, kind, _) in enumerate(_FIELDS)
            ]
            bad = pa.array([(x or b"") if r is None else None for x, r in zip(given, rows, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*columns, bad], names=out.fieldNames())

    return messages.select(value).mapInArrow(run, out)


def encode(records: DataFrame) -> DataFrame:
    """Each record as ``value``, without a frame. Required fields must be there."""
    names = STREAM_RECORD.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(map(to_payload, batch.to_pylist()), pa.binary())], names=["value"])

    return records.select(*[F.col(f.name).cast(f.dataType) for f in STREAM_RECORD.fields]).select(*names).mapInArrow(run, "value binary")


def framed(value: Column, schema_id: int, wide: bool = False) -> Column:
    """A payload behind the frame of a registry with ids of four bytes, or of eight."""
    return F.concat(F.unhex(F.lit("00" + f"{schema_id:x}".rjust(16 if wide else 8, "0"))), value)
