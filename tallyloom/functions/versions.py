"""Dotted version numbers as comparable arrays of integers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _parts(version: Column, number) -> Column:
    return F.transform(F.split(version, r"\."), lambda p: F.coalesce(number(p).try_cast("long"), F.lit(0)))


def client_parts(version: Column) -> Column:
    """Client rule: the leading digits of each part; ``2b7`` counts as 2, ``b7`` as 0."""
    return _parts(version, lambda p: F.regexp_extract(p, r"^\s*([+-]?\d+)", 1))


def server_parts(version: Column) -> Column:
    """Server rule: all digits of each part; ``2b7`` counts as 27."""
    return _parts(version, lambda p: F.regexp_replace(p, r"[^0-9]", ""))


def _padded(left: Column, right: Column) -> tuple[Column, Column]:
    width = F.greatest(F.size(left), F.size(right))

    def pad(parts: Column) -> Column:
        return F.concat(parts, F.array_repeat(F.lit(0).cast("long"), width - F.size(parts)))

    return pad(left), pad(right)


def widened(parts: Column, width: int = 4) -> Column:
    """``parts`` with zeros up to ``width``, which every comparison here ignores: most need no padding then."""
    missing = F.array_repeat(F.lit(0).cast("long"), F.greatest(F.lit(0), F.lit(width) - F.size(parts)))
    return F.concat(parts, missing)


def parts_gte(left: Column, right: Column) -> Column:
    """Of two arrays of parts; only arrays of different lengths are padded."""
    a, b = _padded(left, right)
    return F.when(F.size(left) == F.size(right), left >= right).otherwise(a >= b)


def gte(left: Column, right: Column, parts=client_parts) -> Column:
    return parts_gte(parts(left), parts(right))


def lte(left: Column, right: Column, parts=client_parts) -> Column:
    return gte(right, left, parts)
