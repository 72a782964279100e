"""Reading from and adding to JSON text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_fields(json: Column, *names: str, strict: bool = False) -> Column:
    """A struct of string members, read in one parse; a missing member is ''.

    A number is rendered as text. ``strict`` gives '' for a member that is not a string.
    """
    if strict:
        doc = F.try_parse_json(json)
        parts = []
        for n in names:
            member = F.try_variant_get(doc, f"$.{n}", "variant")
            text = F.when(F.schema_of_variant(member) == "STRING", member.cast("string"))
            parts.append(F.coalesce(text, F.lit("")).alias(n))
        return F.struct(*parts)
    parsed = F.from_json(json, ", ".join(f"`{n}` string" for n in names))
    return F.struct(*[F.coalesce(parsed[n], F.lit("")).alias(n) for n in names])


def _quoted(value: Column) -> Column:
    safe = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), safe, F.lit('"'))


def put_if_absent(json: Column, members: dict[str, Column]) -> Column:
    """Add string members to a JSON object unless the key is there already.

    NULL and '' count as the empty object; other text that is no JSON object is unchanged.
    Members with a NULL or empty value are not added.
    """
    base = F.coalesce(F.nullif(json, F.lit("")), F.lit("{}"))
    keys = F.json_object_keys(base)
    pairs = F.array_compact(
        F.array(
            *[
                F.when(
                    (value != "") & ~F.array_contains(keys, name),
                    F.concat(F.lit(f'"{name}":'), _quoted(value)),
                )
                for name, value in members.items()
            ]
        )
    )
    added = F.concat_ws(",", pairs)
    body = F.regexp_replace(base, r"\}\s*$", "")
    joint = F.when(F.size(keys) > 0, F.lit(",")).otherwise(F.lit(""))
    return (
        F.when(keys.isNull(), json)
        .when(F.size(pairs) == 0, base)
        .otherwise(F.concat(body, joint, added, F.lit("}")))
    )
