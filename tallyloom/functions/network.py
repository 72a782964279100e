"""Client addresses: choice, coarsening, and the numeric form used by range lookups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_IPV4 = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"
_SHORT_IPV4 = r"^\d{1,10}(\.\d{1,8}){0,2}$"


def client_ip(forwarded_for: Column, remote: Column) -> Column:
    """First element of the forwarding header, else the remote address."""
    first = F.trim(F.split(forwarded_for, ",")[0])
    return F.when(forwarded_for != "", first).otherwise(remote)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _dotted_tail_as_groups(ip: Column) -> Column:
    """An IPv6 text whose last 32 bits are written as IPv4, with two groups in their place."""

    def replaced(tail: Column) -> Column:
        return F.when(tail.rlike(_IPV4), F.concat(F.regexp_replace(ip, r"[^:]*$", ""), _ipv4_digits(tail, ":"))).otherwise(ip)

    return F.when(ip.contains("."), let(F.substring_index(ip, ":", -1), replaced)).otherwise(ip)


def _expanded(bare: Column) -> Column:
    """The groups of an IPv6 text, with zeros in place of ``::``; of another number than eight for bad text."""

    def filled(halves: Column) -> Column:
        def side(i: int) -> Column:
            return F.filter(F.split(F.get(halves, F.lit(i)), ":"), lambda g: g != "")

        def joined(sides: Column) -> Column:
            gap = F.greatest(F.lit(8) - F.size(sides["l"]) - F.size(sides["r"]), F.lit(0))
            return F.concat(sides["l"], F.array_repeat(F.lit("0"), gap), sides["r"])

        both = F.struct(side(0).alias("l"), side(1).alias("r"))
        return F.when(F.size(halves) == 2, let(both, joined)).otherwise(F.split(bare, ":"))

    single = (F.regexp_count(bare, F.lit("::")) <= 1) & ~bare.contains(":::")
    return F.when(single, let(F.split(bare, "::"), filled))


def _with_ipv6_groups(ip: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of the eight groups of an IPv6 text, in lower case without leading zeros; NULL for other text."""

    def checked(found: Column) -> Column:
        good = (F.size(found) == 8) & F.forall(found, lambda g: g.rlike(r"^[0-9A-Fa-f]{1,4}$"))
        plain = F.transform(found, lambda g: F.lower(F.regexp_replace(g, r"^0+(?=.)", "")))
        return F.when(good, let(plain, use))

    bare = let(F.regexp_replace(ip, r"%.*$", ""), _dotted_tail_as_groups)
    return F.when(ip.contains(":"), let(let(bare, _expanded), checked))


def _is_mapped(groups: Column) -> Column:
    """Is it an IPv4 address in IPv6 form (80 zero bits, 16 one bits)?"""
    zeros = F.forall(F.slice(groups, 1, 5), lambda g: g == "0")
    return zeros & (F.get(groups, F.lit(5)) == "ffff")


def coarse_ip(ip: Column) -> Column:
    """IPv4 to /24, IPv6 to /48 in the uncompressed form; NULL when it is no address.

    An IPv4 address in IPv6 form counts as IPv4: its dotted form loses the last number, and
    its hexadecimal form stays as it is.
    """

    def coarse(groups: Column) -> Column:
        mapped = F.when(ip.contains("."), F.regexp_replace(ip, r"\d+$", "0")).otherwise(ip)
        wide = F.concat(F.concat_ws(":", F.slice(groups, 1, 3)), F.lit(":0:0:0:0:0"))
        return F.when(_is_mapped(groups), mapped).otherwise(wide)

    return (
        F.when(ip.rlike(_IPV4), F.regexp_replace(ip, r"\d+$", "0"))
        .when(ip.rlike(_SHORT_IPV4), ip)
        .otherwise(_with_ipv6_groups(ip, coarse))
    )


def apply_ip_mode(ip: Column, mode: Column) -> Column:
    """Mode ``allow`` keeps, ``drop`` removes, everything else coarsens."""
    return (
        F.when(ip.isNull() | (ip == "") | (mode == "drop"), F.lit(None).cast("string"))
        .when(mode == "allow", ip)
        .otherwise(coarse_ip(ip))
    )


def address_key(ip: Column) -> Column:
    """An address as hexadecimal digits that sort like addresses: 8 for IPv4, also in IPv6 form, and 32
    for IPv6. NULL for anything else.

    IPv4 takes text functions alone. IPv6 groups are filled up to eight, each with zeros to four digits, and what
    is then not 32 digits was no address.
    """

    def digits(text: Column) -> Column:
        left, right = F.substring_index(text, "::", 1), F.substring_index(text, "::", -1)
        present = F.regexp_count(F.concat(left, F.lit(":"), right), F.lit("[^:]+"))
        filled = F.regexp_replace(F.concat(left, F.lit(":"), F.repeat(F.lit("0:"), 8 - present), right), "^:|:$", "")
        groups = F.when(~text.contains("::"), text).when(~text.rlike("::.*::|:::"), filled)
        wide = F.regexp_replace(F.concat(F.lit(":"), groups), ":", ":000")
        packed = F.lower(F.regexp_replace(wide, r":[0-9A-Fa-f]{0,3}([0-9A-Fa-f]{4})(?=:|$)", "$1"))
        whole = F.nullif(F.regexp_extract(packed, "^[0-9a-f]{32}$", 0), F.lit(""))
        # Of an IPv4 address in IPv6 form (80 zero bits, 16 one bits) the last 32 bits.
        return F.regexp_replace(whole, "^0{20}ffff", "")

    bare = let(F.regexp_replace(ip, r"%.*$", ""), _dotted_tail_as_groups)
    narrow = F.lower(_ipv4_digits(ip, ""))
    return F.when(ip.rlike(_IPV4), narrow).when(ip.contains(":"), let(bare, digits))


def _ipv4_digits(ip: Column, separator: str) -> Column:
    """The four numbers of a checked IPv4 text as two groups of four hexadecimal digits."""

    def octet(i: int) -> Column:
        number = F.substring_index(F.substring_index(ip, ".", i), ".", -1).cast("long")
        return F.lpad(F.hex(number), 2, "0")

    return F.concat(octet(1), octet(2), F.lit(separator), octet(3), octet(4))
