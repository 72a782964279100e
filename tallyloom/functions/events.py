"""Column rules shared by every operator: actor key, event time, ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uid(user_id: str = "user_id", device_id: str = "device_id") -> Column:
    """The actor: the user id when it is set and not empty, else the device id."""
    return F.when(F.col(user_id) != "", F.col(user_id)).otherwise(F.col(device_id))


def event_time(ts_server: str = "ts_server", ts_client: str = "ts_client") -> Column:
    """Server time, else client time, else now; all three are microseconds."""
    return F.timestamp_micros(
        F.coalesce(F.col(ts_server), F.col(ts_client), F.unix_micros(F.current_timestamp()))
    )


def to_millis(ts: Column) -> Column:
    """The timestamp cut to milliseconds, the precision of the fact table."""
    return F.date_trunc("millisecond", ts)


def rate(numerator: str, denominator: str, digits: int = 4) -> Column:
    """Rounded ratio; NULL when the denominator is zero."""
    top = F.col(numerator).cast("double")
    return F.round(top / F.nullif(F.col(denominator), F.lit(0)), digits)


def blank_if_null(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")).alias(name)


def micros_from_text(text: Column) -> Column:
    """Microseconds from epoch milliseconds written as a number, or from an ISO-8601 string.

    NULL when the text is neither.
    """
    numeric = text.rlike(r"^-?\d+(\.\d+)?([eE][+]?\d+)?$")
    millis = F.floor(text.try_cast("double")).cast("long")
    return F.when(numeric, millis * 1000).otherwise(F.unix_micros(text.try_cast("timestamp")))
