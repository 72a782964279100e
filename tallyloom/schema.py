"""Schemas of the tables the operators read and write."""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# One client event as it arrives, one JSON object per line. ``ts_client`` and
# ``ts_server`` are read as text because a number and an ISO string are both valid.
WIRE_EVENT = _struct(
    ("event_id", _S),
    ("event_name", _S),
    ("project_id", _S),
    ("user_id", _S),
    ("device_id", _S),
    ("session_id", _S),
    ("ts_client", _S),
    ("ts_server", _S),
    ("platform", _S),
    ("app_version", _S),
    ("country", _S),
    ("client_ip", _S),
    ("user_agent", _S),
    ("revenue_amount", T.DecimalType(18, 4)),
    ("revenue_currency", _S),
    ("props", T.VariantType()),
)

# The normalized record on the topic; times are microseconds since the epoch.
STREAM_RECORD = _struct(
    ("event_id", _S),
    ("event_name", _S),
    ("project_id", _S),
    ("user_id", _S),
    ("device_id", _S),
    ("session_id", _S),
    ("ts_client", T.LongType()),
    ("ts_server", T.LongType()),
    ("platform", _S),
    ("app_version", _S),
    ("country", _S),
    ("client_ip", _S),
    ("user_agent", _S),
    ("revenue_amount", T.DecimalType(18, 4)),
    ("revenue_currency", _S),
    ("props_json", _S),
)

EVENTS = _struct(
    ("project_id", _S),
    ("event_date", T.DateType()),
    ("ts_server", T.TimestampType()),
    ("event_id", _S),
    ("event_name", _S),
    ("user_id", _S),
    ("device_id", _S),
    ("session_id", _S),
    ("platform", _S),
    ("app_version", _S),
    ("country", _S),
    ("props_json", _S),
    ("revenue_amount", T.DecimalType(18, 4)),
    ("revenue_currency", _S),
)

SESSIONS = _struct(
    ("project_id", _S),
    ("session_id", _S),
    ("user_id", _S),
    ("device_id", _S),
    ("session_start", T.TimestampType()),
    ("session_end", T.TimestampType()),
    ("duration", T.LongType()),
    ("country", _S),
    ("events", T.LongType()),
)

POLICY = _struct(
    ("api_key", _S),
    ("rpm", T.IntegerType()),
    ("ip_rpm", T.IntegerType()),
    ("props_allowlist", T.ArrayType(_S)),
    ("pii_email", _S),
    ("pii_phone", _S),
    ("pii_ip", _S),
    ("deny_keys", T.ArrayType(_S)),
    ("mask_keys", T.ArrayType(_S)),
)

EXPERIMENT_CONFIG = (
    "variants array<struct<name: string, weight: int>>, "
    "targeting struct<platform: array<string>, appVersionMin: string, "
    "appVersionMax: string, countries: array<string>>, "
    "metrics struct<primary: string, secondary: array<string>>"
)

DEAD_LETTER = _struct(("event_id", _S), ("reason", _S), ("raw", _S))
