"""Secret scan: pattern candidates, confirmed by decoding and parsing them.

Base spans come from three patterns. The scan adds a span only where structure proves a key:

* ``der``: base64 that decodes to a whole DER value with a known key layout, lengths nested
  without remainder (private keys of RSA and EC, wrapped private keys, public keys);
* ``hexder``: the same in hexadecimal;
* ``openssh``: base64 of a private key in the format of OpenSSH, all its fields within bounds;
* ``jwt``: three base64url parts whose first is a JSON object with ``alg`` and whose second is
  a JSON object.

A span is text between code points, end exclusive.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm.common import documents, slices

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_RUN = re.compile(r"[0-9a-f]{24,}")  # the runs of HEX that are long enough
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "der", "hexder", "openssh", "jwt")

#: How a key may begin: base64 of a DER sequence ("M") or of the magic word of OpenSSH ("b3BlbnNzaC1rZXkt").
FIRST = r"(?:M[A-Za-z0-9+/]{31,}|b3BlbnNzaC1rZXkt[A-Za-z0-9+/]{16,})"
#: A line break, real or escaped as in JSON, with the blanks around it.
BREAK = r"[\x20\t]*+(?:\r\n?|\n|(?:\\+r)?\\+n)(?:[\x20\t]|\\+t)*+"
#: The letter of an escaped break or tab is no part of what follows it.
ESCAPED = r"(?<=\\[nrt])"
#: A run of base64 lines of which the first may begin a key; later ones may as well.
ENCODED = re.compile(rf"(?:(?<![A-Za-z0-9+/_-])|{ESCAPED}){FIRST}(?:{BREAK}[A-Za-z0-9+/]+)*={{0,2}}")
BEGIN, BREAKS = re.compile(FIRST), re.compile(BREAK)
HEX_DER = re.compile(r"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{62,}")
SIGNED = re.compile(rf"(?:(?<![A-Za-z0-9_-])|{ESCAPED})(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
OPENSSH_MAGIC = b"openssh-key-v1\0"

# Tags of DER values.
INTEGER, BITS, OCTETS, OID, SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30


def der_values(data: bytes, most: int = 64) -> list[tuple[int, bytes]] | None:
    """The tags and contents of values that fill ``data`` exactly; None if lengths do not fit."""
    out, at = [], 0
    while at < len(data):
        if len(out) == most or at + 2 > len(data):
            return None
        tag, length, at = data[at], data[at + 1], at + 2
        if length & 0x80:
            n = length & 0x7F
            if not 1 <= n <= 4 or at + n > len(data) or data[at] == 0:
                return None
            length, at = int.from_bytes(data[at : at + n], "big"), at + n
            if length < 128:
                return None
        if at + length > len(data):
            return None
        out.append((tag, data[at : at + length]))
        at += length
    return out


def is_der_key(data: bytes) -> bool:
    """Is ``data`` one DER sequence laid out as a key?"""
    whole = der_values(data)
    if not whole or len(whole) != 1 or whole[0][0] != SEQUENCE:
        return False
    parts = der_values(whole[0][1])
    if not parts:
        return False
    tags = [t for t, _ in parts]
    if tags[0] == INTEGER and len(parts) >= 9 and set(tags) == {INTEGER}:  # RSA private key
        return True
    if tags[:2] == [INTEGER, OCTETS] and parts[0][1] == b"\x01":  # EC private key
        return len(parts[1][1]) >= 16
    algorithm = next((der_values(v) for t, v in parts[:2] if t == SEQUENCE), None)
    if not algorithm or algorithm[0][0] != OID:
        return False
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS]:  # private key with its algorithm
        return bool(der_values(parts[2][1]))
    if tags == [SEQUENCE, OCTETS]:  # encrypted private key
        return len(parts[1][1]) >= 16
    return tags == [SEQUENCE, BITS] and parts[1][1][:1] == b"\0" and len(parts[1][1]) > 16  # public key


def der_size(head: bytes) -> int | None:
    """The size of the DER sequence that begins with ``head`` (6 bytes); None if it is none."""
    if len(head) < 6 or head[0] != SEQUENCE:
        return None
    n = head[1] & 0x7F if head[1] & 0x80 else 0
    return None if n > 4 else 2 + n + (int.from_bytes(head[2 : 2 + n], "big") if n else head[1])


def is_openssh_key(data: bytes) -> bool:
    """Fields: cipher, derivation, its options, a number of keys, public keys, private part."""
    if not data.startswith(OPENSSH_MAGIC):
        return False
    at = len(OPENSSH_MAGIC)

    def field() -> bytes | None:
        nonlocal at
        if at + 4 > len(data):
            return None
        size = int.from_bytes(data[at : at + 4], "big")
        at += 4 + size
        return data[at - size : at] if at <= len(data) else None

    if None in (field(), field(), field()) or at + 4 > len(data):
        return False
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    if not 1 <= keys <= 16:
        return False
    return all(field() is not None for _ in range(keys + 1))


def openssh_size(data: bytes) -> int | None:
    """The size of the key that begins with ``data``, or, if that is more than ``data``, how many bytes must be
    known to tell it; None if it is none."""
    if not data.startswith(OPENSSH_MAGIC):
        return None
    at, nth, last, cipher = len(OPENSSH_MAGIC), 0, 4, b""
    while at + 4 <= len(data):
        value, at = int.from_bytes(data[at : at + 4], "big"), at + 4
        if nth == 3:
            if not 1 <= value <= 16:
                return None
            last = 4 + value
        else:
            cipher, at = data[at : at + value] if nth == 0 else cipher, at + value
            if nth == last:  # these ciphers put 16 bytes behind the private part
                return at + 16 * (b"gcm" in cipher or b"poly1305" in cipher)
        nth += 1
    return at + 4


def decode64(text: str) -> bytes | None:
    """Base64 or base64url, padded or not; None if it is neither."""
    text = text.rstrip("=")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text.replace("-", "+").replace("_", "/") + "=" * (-len(text) % 4), validate=True)
    except binascii.Error:
        return None


def json_object(text: str) -> dict | None:
    data = decode64(text)
    try:
        value = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _openssh_chars(text: str, begin: int) -> int | None:
    """How many characters of ``text`` from ``begin`` on are a key of OpenSSH."""
    there = (len(text) - begin) * 3 // 4
    known, need = 0, len(OPENSSH_MAGIC) + 4
    while known < need <= there:
        known = need
        need = openssh_size(decode64(text[begin : begin + -(-known * 4 // 3)]) or b"") or 0
    if need - 16 > there:
        return None
    chars = -(-min(need, there) * 4 // 3)
    return chars if is_openssh_key(decode64(text[begin : begin + chars]) or b"") else None


def _keys(run: re.Match) -> Iterator[tuple[int, str, int]]:
    """The keys in a run of lines. A key begins with a line and is as long as its own lengths tell, so where it
    ends is known before it is decoded; the next one is looked for behind it, or at the next line."""
    text = run.string
    breaks = [m.span() for m in BREAKS.finditer(text, *run.span())]
    lines = list(zip([run.start(), *(b for _, b in breaks)], [*(a for a, _ in breaks), run.end()], strict=True))
    whole = "".join(text[a:b] for a, b in lines).rstrip("=")
    ends = [min(x, len(whole)) for x in accumulate(b - a for a, b in lines)]
    i = 0
    while i < len(lines):
        begin, found = ends[i - 1] if i else 0, None
        if not BEGIN.match(text, *lines[i]):
            pass
        elif whole[begin] == "M":
            size = der_size(decode64(whole[begin : begin + 8]) or b"")
            end = begin + -(-size * 4 // 3) if size else 0
            j = bisect_left(ends, end, i)
            if size and j < len(lines) and ends[j] == end and is_der_key(decode64(whole[begin:end]) or b""):
                found = "der"
        elif chars := _openssh_chars(whole, begin):
            found, j = "openssh", bisect_left(ends, begin + chars, i)
        if found:
            yield lines[i][0], found, lines[j][1]
            i = j
        i += 1


def structural(text: str) -> list[tuple[int, str, int]]:
    """Spans (start, kind, end) that decode to a key or a signed token."""
    out = []
    if "M" in text or "b3Bl" in text:
        for m in ENCODED.finditer(text):
            out += _keys(m)
    if "30" in text:
        for m in HEX_DER.finditer(text):
            if len(m[0]) % 2 == 0 and is_der_key(bytes.fromhex(m[0])):
                out.append((m.start(), "hexder", m.end()))
    if "eyJ" in text:
        for m in SIGNED.finditer(text):
            head = json_object(m[1])
            if head and isinstance(head.get("alg"), str) and json_object(m[2]) is not None:
                out.append((m.start(), "jwt", m.end()))
    return out


def base(text: str) -> list[tuple[int, str, int]]:
    out = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return out + [(m.start(), "hex", m.end()) for m in HEX_RUN.finditer(text)]


def joined(spans: list[tuple[int, str, int]]) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in ordered)


def redacted(text: str, spans: list[tuple[int, str, int]]) -> str:
    """The text with overlapping spans merged and each replaced by ``[kind]`` of its first span."""
    out, at = [], 0
    for start, kind, end in sorted(spans, key=lambda s: (s[0], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


SCHEMA = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, clean_text string"


def scan(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add to the columns ``keep`` (default: all) of each row the secrets of its text.

    Added: n_assign, n_access, n_hex, base_sha256 (of the base spans), spans (all, as
    ``kind:start:end`` by start and then kind), clean_text (spans replaced by their kind). They
    take the place of input columns with the same names. A null text counts as empty: no spans, and
    clean_text is null. Repeated rows are scanned alike; an empty table gives an empty result.
    """
    added = [field.split()[0] for field in SCHEMA.split(", ")]
    keep = [c for c in (keep or df.columns) if c not in added]
    given = df.select(*keep, df[text].cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            rows: dict[str, list] = {name: [] for name in added}
            for value in batch["__text"].to_pylist():
                content = value or ""
                plain = base(content)
                spans = plain + structural(content)
                for kind in BASE_KINDS:
                    rows[f"n_{kind}"].append(sum(s[1] == kind for s in plain))
                rows["base_sha256"].append(hashlib.sha256(joined(plain).encode()).hexdigest())
                rows["spans"].append(joined(spans))
                rows["clean_text"].append(redacted(content, spans) if spans else value)
            kinds = [pa.int64()] * 3 + [pa.string()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in keep] + [pa.array(rows[n], k) for n, k in zip(added, kinds, strict=True)],
                names=[*keep, *added],
            )

    kept = ", ".join(f"`{c}` {given.schema[c].dataType.simpleString()}" for c in keep)
    return given.mapInArrow(run, f"{kept}{', ' if keep else ''}{SCHEMA}")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, counts of the base kinds, their digest, and all spans of every document."""
    return scan(documents(spark, sf_dir), keep=["doc_id"]).drop("clean_text")
