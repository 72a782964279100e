"""Personal-data masking of text and of nested event properties, all on the JVM side.

Properties are handled as VARIANT values. The nesting that survives is bounded, so the
walk over a value is unrolled into one column expression instead of a Python function.
Object members come back in the key order of VARIANT, which is alphabetical.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The e-mail pattern, the digit count that makes a phone number, the digits
# that stay readable, the mask, the depth and the list length that survive.
EMAIL_LOCAL = "[A-Z0-9._%+-]"
EMAIL_DOMAIN = r"@[A-Z0-9.-]+\.[A-Z]{2,}"
# A match can only start where a run of local characters starts, or where the last match
# ended; saying so keeps the search linear in long runs without an address.
EMAIL_PATTERN = rf"(?i)(?:\G|(?<!{EMAIL_LOCAL})){EMAIL_LOCAL}++({EMAIL_DOMAIN})"
PHONE_DIGITS = 10
MASK = "***"
MAX_DEPTH = 3
MAX_ITEMS = 50


def has_email(text: Column) -> Column:
    return text.contains("@") & text.rlike(EMAIL_PATTERN)


def mask_email(text: Column) -> Column:
    """Every address becomes ``***@domain``."""
    masked = F.regexp_replace(text, EMAIL_PATTERN, r"***$1")
    return F.when(text.contains("@"), masked).otherwise(text)


def has_phone(text: Column) -> Column:
    """At least ten digits anywhere in the text."""
    return text.rlike(rf"\d(?:\D*+\d){{{PHONE_DIGITS - 1}}}")


def mask_phone(text: Column) -> Column:
    """Every digit but the last two of the text becomes ``x``."""
    return F.regexp_replace(text, r"\d(?=(?:\D*+\d){2})", "x")


def mask_text(text: Column, email_mode: Column, phone_mode: Column) -> Column:
    """Apply the e-mail rule, then the phone rule. Text with a masked e-mail stops there."""
    email, phone = has_email(text), has_phone(text)
    nothing = F.lit(None).cast("string")
    return (
        F.when((email_mode == "drop") & email, nothing)
        .when((email_mode == "mask") & email, mask_email(text))
        .when((phone_mode == "drop") & phone, nothing)
        .when((phone_mode == "mask") & phone, mask_phone(text))
        .otherwise(text)
    )


def mask_member(
    key: Column, text: Column, mask_keys: Column, email_mode: Column, phone_mode: Column
) -> Column:
    """``mask_text`` for a named value; a key on the mask list hides the value whole."""
    return F.when(F.array_contains(mask_keys, F.lower(key)), F.lit(MASK)).otherwise(
        mask_text(text, email_mode, phone_mode)
    )


def _walk(value: Column, key: Column, depth: int, trimmed: Column, text: Callable) -> Column:
    if depth >= MAX_DEPTH:
        return F.lit(None).cast("variant")

    def clean(kind: Column, value: Column) -> Column:
        def child(name: Column, item: Column) -> Column:
            return _walk(item, name, depth + 1, trimmed, text)

        members = F.map_filter(
            F.transform_values(value.cast("map<string,variant>"), child),
            lambda _, item: item.isNotNull(),
        )
        array = value.cast("array<variant>")
        numbers = value.cast("array<bigint>")
        if depth + 1 < MAX_DEPTH:
            present = F.filter(array, lambda item: ~F.is_variant_null(item))
            first = F.slice(F.when(trimmed, present).otherwise(array), 1, MAX_ITEMS)
            items = F.filter(
                F.transform(first, lambda item: child(key, item)), lambda item: item.isNotNull()
            )
            whole = F.when(trimmed, F.slice(F.array_compact(numbers), 1, MAX_ITEMS)).otherwise(
                F.array_compact(F.slice(numbers, 1, MAX_ITEMS))
            )
        else:
            items, whole = F.slice(array, 1, 0), F.slice(numbers, 1, 0)
        return (
            F.when(kind.isin("BIGINT", "BOOLEAN", "DOUBLE"), value)
            .when(kind == "STRING", text(key, value.cast("string")).cast("variant"))
            .when(kind == "VOID", F.lit(None).cast("variant"))
            .when(kind.startswith("OBJECT"), F.to_variant_object(members))
            .when(kind == "ARRAY<BIGINT>", F.to_variant_object(whole))
            .when(kind.startswith("ARRAY"), F.to_variant_object(items))
            .otherwise(value)
        )

    # The one-element array binds the kind, so it is computed once per value.
    bound = F.array(F.schema_of_variant(value))
    return F.get(F.transform(bound, lambda kind: clean(kind, value)), F.lit(0))


def props_map(props: Column) -> Column:
    """A VARIANT object as a map of its members; NULL for anything but an object."""
    return props.try_cast("map<string,variant>")


def keep_keys(members: Column, allowlist: Column) -> Column:
    """Members on the allowlist; an empty or NULL allowlist keeps all."""
    active = F.coalesce(F.size(allowlist) > 0, F.lit(False))
    return F.when(
        active, F.map_filter(members, lambda k, _: F.array_contains(allowlist, k))
    ).otherwise(members)


def has_denied_key(members: Column, deny_keys: Column) -> Column:
    lowered = F.transform(F.map_keys(members), F.lower)
    return F.coalesce(F.arrays_overlap(lowered, deny_keys), F.lit(False))


def clean_members(
    members: Column,
    allowlist: Column,
    mask_keys: Column,
    email_mode: Column,
    phone_mode: Column,
) -> Column:
    """Mask strings, drop NULLs and deep values, cut long lists in a map of members.

    With an active allowlist a list keeps its first 50 items that are not NULL, else what is
    not NULL among its first 50.
    """
    trimmed = F.coalesce(F.size(allowlist) > 0, F.lit(False))

    def text(key: Column, value: Column) -> Column:
        return mask_member(key, value, mask_keys, email_mode, phone_mode)

    cleaned = F.transform_values(members, lambda k, v: _walk(v, k, 0, trimmed, text))
    return F.map_filter(cleaned, lambda _, v: v.isNotNull())


def members_json(members: Column) -> Column:
    """The members as JSON text; '{}' for NULL."""
    return F.coalesce(F.to_json(F.to_variant_object(members)), F.lit("{}"))
