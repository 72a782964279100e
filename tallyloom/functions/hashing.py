"""FNV-1a hashing, variant choice and the deterministic session id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the 32-bit FNV-1a hash.
FNV_OFFSET = 2166136261
FNV_PRIME = 16777619
MASK_32 = 4294967295


def _fold(state: Column, unit: Column) -> Column:
    return state.bitwiseXOR(unit).__mul__(F.lit(FNV_PRIME)).bitwiseAND(F.lit(MASK_32))


def hash32(text: Column, start: Column | None = None) -> Column:
    """Unsigned FNV-1a over the UTF-16 units of ``text``, as a long.

    ``start`` continues a hash: ``hash32(b, start=hash32(a))`` equals ``hash32(a || b)``,
    so a prefix shared by many rows is hashed once.
    """
    seed = F.lit(FNV_OFFSET).cast("long") if start is None else start

    def step(state: Column, ch: Column) -> Column:
        code = F.ascii(ch).cast("long")
        above = code - 65536
        high = F.shiftright(above, 10) + 55296
        low = above.bitwiseAND(F.lit(1023)) + 56320
        return F.when(code < 65536, _fold(state, code)).otherwise(_fold(_fold(state, high), low))

    return F.when(text == "", seed).otherwise(F.aggregate(F.split(text, ""), seed, step))


# An ASCII unit changes the low 7 bits of a state by themselves, and the others only by the multiplications.
ASCII = 128


def hash32_start(start: Column) -> Column:
    """The part of a state on which the hash of an ASCII text depends: at most ``ASCII`` values."""
    return start.bitwiseAND(F.lit(ASCII - 1)).cast("int")


def _is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def hash32_starts(text: Column, starts: Column) -> Column:
    """The hashes of an ASCII ``text`` behind each of the ``starts`` (``hash32_start``), by start; NULL for other texts."""
    def behind(start: Column) -> Column:
        return F.when(F.array_contains(starts, start), hash32(text, start=start.cast("long")))

    return F.when(_is_ascii(text), F.transform(F.sequence(F.lit(0), F.array_max(starts)), behind))


def hash32_power(text: Column) -> Column:
    """What the high bits of a state are multiplied by over an ASCII ``text``."""
    one = F.lit(1).cast("long")
    power = F.aggregate(F.sequence(F.lit(1), F.char_length(text)), one, lambda p, _: (p * FNV_PRIME).bitwiseAND(F.lit(MASK_32)))
    return F.when(text == "", one).otherwise(power)


def hash32_quick(start: Column, hashes: Column, power: Column) -> Column:
    """``hash32(text, start)`` from ``hash32_starts`` and ``hash32_power`` of an ASCII ``text``; NULL for other texts."""
    low = hash32_start(start)
    # The high bits are below 2^32 and so is the power, so they are cut to 25 bits to stay within a long.
    high = F.shiftright(start - low, 7) * power.bitwiseAND(F.lit((1 << 25) - 1))
    return (F.get(hashes, low) + F.shiftleft(high, 7)).bitwiseAND(F.lit(MASK_32))


def hash32_from(text: Column, start: Column, hashes: Column, power: Column) -> Column:
    """``hash32_quick``; texts that are not ASCII are hashed."""
    return F.when(hashes.isNotNull(), hash32_quick(start, hashes, power)).otherwise(hash32(text, start=start))


def hash32_hex(text: Column) -> Column:
    return F.lpad(F.lower(F.hex(hash32(text))), 8, "0")


def session_id(project: Column, actor: Column, start: Column) -> Column:
    """Upper hex of the first 12 bytes of SHA-1 over ``project:actor:startMillis``."""
    key = F.concat_ws(":", project, actor, F.unix_millis(start).cast("string"))
    return F.upper(F.substring(F.sha1(key.cast("binary")), 1, 24))
