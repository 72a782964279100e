"""Check, clean and normalize raw events; one reason per refused event.

``classify`` keeps every input row and adds ``reason`` (NULL = accepted). ``accepted`` and
``rejected`` split it, so both always come from the same checks and add up to the input.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import masking
from tallyloom.functions.events import micros_from_text
from tallyloom.functions.network import apply_ip_mode, client_ip
from tallyloom.schema import STREAM_RECORD
from tallyloom.session import work_dir
from tallyloom.sources.files import MAX_REQUEST_BYTES

# Reasons, sizes in bytes, lengths in characters, default key lists.
INVALID_SCHEMA = "invalid_schema"
PII_BLOCKED = "pii_blocked"
PAYLOAD_TOO_LARGE = "payload_too_large"
REQUEST_TOO_LARGE = "request_too_large"
DUPLICATE = "duplicate"
MAX_LENGTH = {
    "event_id": 64,
    "event_name": 64,
    "project_id": 32,
    "user_id": 64,
    "device_id": 64,
    "session_id": 64,
    "platform": 32,
    "app_version": 32,
    "country": 2,
    "revenue_currency": 3,
}
MIN_EVENT_ID = 8
REQUIRED = ["event_id", "event_name", "project_id", "device_id"]


@dataclass(frozen=True)
class IngestDefaults:
    """Rules for events without a policy of their own."""

    allowlist: tuple[str, ...] = ()
    email: str = "mask"
    phone: str = "mask"
    ip: str = "coarse"
    deny_keys: tuple[str, ...] = ("password", "pass", "passwd", "credit_card", "ssn")
    mask_keys: tuple[str, ...] = ("email", "phone", "mobile")
    max_event_bytes: int = 65_536
    max_request_bytes: int = MAX_REQUEST_BYTES


def _text_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _mode(value: Column, default: str, fallback: str) -> Column:
    """A mode word of a policy; unknown words mean ``fallback``, no word the default."""
    word = F.lower(value)
    known = F.when(word.isin("allow", "drop"), word).otherwise(F.lit(fallback))
    return F.when(value.isNull(), F.lit(default)).otherwise(known)


def _lowered(keys: Column) -> Column:
    return F.transform(keys, F.lower)


def with_policy(
    events: DataFrame, policies: DataFrame | None, defaults: IngestDefaults = IngestDefaults()
) -> DataFrame:
    """Add the effective rules of each event as ``rule_*`` columns.

    Key lists of a policy replace the default lists as soon as the policy sets any masking
    rule at all; an empty list then switches the default list off.
    """
    deny, mask = _text_array(defaults.deny_keys), _text_array(defaults.mask_keys)
    allow = _text_array(defaults.allowlist)
    if policies is None:
        return events.withColumns(
            {
                "rule_allow": allow,
                "rule_email": F.lit(defaults.email),
                "rule_phone": F.lit(defaults.phone),
                "rule_ip": F.lit(defaults.ip),
                "rule_deny": _lowered(deny),
                "rule_mask": _lowered(mask),
            }
        )
    own = (
        F.col("pii_email").isNotNull()
        | F.col("pii_phone").isNotNull()
        | F.col("pii_ip").isNotNull()
        | F.coalesce(F.size("deny_keys") > 0, F.lit(False))
        | F.coalesce(F.size("mask_keys") > 0, F.lit(False))
    )

    def keys(name: str, default: Column) -> Column:
        return _lowered(F.when(own, F.coalesce(F.col(name), default)).otherwise(default))

    rules = policies.select(
        F.col("api_key"),
        F.when(F.size("props_allowlist") > 0, F.col("props_allowlist")).otherwise(allow).alias("rule_allow"),
        _mode(F.col("pii_email"), defaults.email, "mask").alias("rule_email"),
        _mode(F.col("pii_phone"), defaults.phone, "mask").alias("rule_phone"),
        _mode(F.col("pii_ip"), defaults.ip, "coarse").alias("rule_ip"),
        keys("deny_keys", deny).alias("rule_deny"),
        keys("mask_keys", mask).alias("rule_mask"),
    )
    joined = events.join(rules, "api_key", "left")
    return joined.withColumns(
        {
            "rule_allow": F.coalesce("rule_allow", allow),
            "rule_email": F.coalesce("rule_email", F.lit(defaults.email)),
            "rule_phone": F.coalesce("rule_phone", F.lit(defaults.phone)),
            "rule_ip": F.coalesce("rule_ip", F.lit(defaults.ip)),
            "rule_deny": F.coalesce("rule_deny", _lowered(deny)),
            "rule_mask": F.coalesce("rule_mask", _lowered(mask)),
        }
    )


def with_request_size(events: DataFrame, above: int | None = None) -> DataFrame:
    """Fill ``request_bytes``, the unpacked bytes of a request, where the source does not know it: the bytes of
    all lines of a batch. A row without a batch id is a request of its own.

    Only the batch id and the line size are aggregated, map side first; the join adds one
    number per event and leaves the split of a large batch to AQE. Rows whose size is known match
    nothing and carry spread keys. A source that never lacks the size says so by a column without NULLs.

    With ``above`` all requests are added up, and only those with more bytes are joined: rows of the others get the bytes of
    their line. Those requests are few, and written first, so that Spark knows it and does not shuffle the events.
    """
    if "request_bytes" in events.columns and not events.schema["request_bytes"].nullable:
        return events
    known = F.col("request_bytes") if "request_bytes" in events.columns else F.lit(None).cast("long")
    if events.isStreaming:
        raise ValueError("sizes are added up per micro-batch: use streaming.jobs.ingest_lines")
    line = F.col("raw_bytes") + 1
    asks = known.isNull() & F.col("batch_id").isNotNull()
    sizes = events.filter(asks).groupBy(F.col("batch_id").alias("_batch")).agg(F.sum(line).alias("_bytes"))
    if above is not None:
        path = work_dir(events.sparkSession, "sizes")
        sizes.filter(F.col("_bytes") > above).write.parquet(path)
        sizes = events.sparkSession.read.schema(sizes.schema).parquet(path)
    spread = F.concat(F.lit("\0"), F.pmod(F.xxhash64("raw"), F.lit(1_000_000)).cast("string"))
    key = F.when(asks, F.col("batch_id")).otherwise(spread)
    joined = events.withColumn("_key", key).join(sizes, F.col("_key") == F.col("_batch"), "left")
    return joined.withColumn("request_bytes", F.coalesce(known, F.col("_bytes"), line)).drop("_key", "_batch", "_bytes")


def _schema_error() -> Column:
    """The first schema rule an event breaks, as text; NULL when it keeps them all."""
    error = F.when(F.col("parse_error"), F.lit("unparsable"))
    for name in REQUIRED:
        error = error.when(F.col(name).isNull(), F.lit(f"{name} required"))
    return error


def _length_error() -> Column:
    error = F.when(F.char_length("event_id") < MIN_EVENT_ID, F.lit("event_id too short"))
    for name, limit in MAX_LENGTH.items():
        error = error.when(F.char_length(name) > limit, F.lit(f"{name} too long"))
    return error.when(F.col("ts_client_us").isNull(), F.lit("ts_client invalid")).when(
        F.col("props_present") & F.col("members").isNull(), F.lit("props must be an object")
    )


def classify(
    events: DataFrame,
    policies: DataFrame | None = None,
    defaults: IngestDefaults = IngestDefaults(),
) -> DataFrame:
    """Apply the checks in their fixed order and add ``reason`` and ``detail``.

    Order: request size, required fields, denied keys, event size, schema. The first failing
    check gives the reason. Cleaned values replace the raw ones; ``raw`` keeps the line.
    """
    sized = with_request_size(events, above=defaults.max_request_bytes)
    ruled = with_policy(sized, policies, defaults)
    filled = ruled.withColumns(
        {
            "user_agent": F.coalesce("user_agent", "header_user_agent"),
            "client_ip": F.coalesce(
                F.col("client_ip"), client_ip(F.col("forwarded_for"), F.col("remote_addr"))
            ),
            "props_present": F.col("props").isNotNull() & ~F.is_variant_null("props"),
            "members": masking.keep_keys(masking.props_map(F.col("props")), F.col("rule_allow")),
        }
    )
    blocked = masking.has_denied_key(F.col("members"), F.col("rule_deny"))
    modes = (F.col("rule_email"), F.col("rule_phone"))
    cleaned = filled.withColumns(
        {
            "blocked": blocked,
            "props_json": masking.members_json(
                masking.clean_members(
                    F.col("members"), F.col("rule_allow"), F.col("rule_mask"), *modes
                )
            ),
            "client_ip": apply_ip_mode(F.col("client_ip"), F.col("rule_ip")),
            "user_id": masking.mask_member(
                F.lit("user_id"), F.col("user_id"), F.col("rule_mask"), *modes
            ),
            "ts_client_us": micros_from_text(F.col("ts_client")),
            "ts_server_us": micros_from_text(F.col("ts_server")),
            # Not deterministic, never negative: a filter on the reason stays above this
            # projection, so the cleaning runs once per event and not once more per filter.
            "partition": F.spark_partition_id(),
        }
    )
    body = F.to_json(
        F.struct(
            "event_id", "event_name", "project_id", "user_id", "device_id", "session_id",
            "ts_client", "ts_server", "platform", "app_version", "country", "client_ip",
            "user_agent", "revenue_amount", "revenue_currency",
        ),
        {"ignoreNullFields": "false"},
    )
    # The props are an object of the event, not a text in it.
    body_bytes = F.octet_length(body) + F.octet_length(F.lit(',"props":')) + F.octet_length(F.coalesce("props_json", F.lit("null")))
    required = _schema_error()
    lengths = _length_error()
    too_large = body_bytes > defaults.max_event_bytes
    oversize = F.col("request_bytes") > defaults.max_request_bytes
    reason = (
        F.when(oversize | (F.col("partition") < 0), F.lit(REQUEST_TOO_LARGE))
        .when(required.isNotNull(), F.lit(INVALID_SCHEMA))
        .when(F.col("blocked"), F.lit(PII_BLOCKED))
        .when(too_large, F.lit(PAYLOAD_TOO_LARGE))
        .when(lengths.isNotNull(), F.lit(INVALID_SCHEMA))
    )
    detail = F.when(reason == INVALID_SCHEMA, F.coalesce(required, lengths))
    return cleaned.select(
        "batch_id",
        "api_key",
        "event_id",
        "event_name",
        "project_id",
        "user_id",
        "device_id",
        "session_id",
        F.col("ts_client_us").alias("ts_client"),
        F.col("ts_server_us").alias("ts_server"),
        "platform",
        "app_version",
        "country",
        "client_ip",
        "user_agent",
        "revenue_amount",
        "revenue_currency",
        "props_json",
        "raw",
        reason.alias("reason"),
        detail.alias("detail"),
    )


def accepted(classified: DataFrame) -> DataFrame:
    """Accepted events as normalized records; times are microseconds."""
    return classified.filter("reason IS NULL").select(*STREAM_RECORD.fieldNames())


def rejected(classified: DataFrame) -> DataFrame:
    """Refused events as dead letters."""
    return classified.filter("reason IS NOT NULL").select("event_id", "reason", "raw", "detail")


def batch_report(classified: DataFrame) -> DataFrame:
    """Per batch the accepted ids and the refused ``{event_id, reason}`` pairs.

    A batch is one request, so its lists are bounded by the request size limit. Requests
    above the limit are refused whole and get a row without lists. A row without a batch id is a
    request of its own.
    """
    refused = F.col("reason") == REQUEST_TOO_LARGE
    known = F.col("reason").isNotNull() & ~refused
    pair = F.struct(F.coalesce("event_id", F.lit("")).alias("event_id"), "reason")
    alone = F.when(F.col("batch_id").isNull(), F.monotonically_increasing_id())
    return classified.groupBy("batch_id", alone.alias("_row")).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("reason").isNull()).alias("accepted_events"),
        F.count_if(F.col("reason").isNotNull()).alias("rejected_events"),
        F.sort_array(F.collect_list(F.when(F.col("reason").isNull(), F.col("event_id")))).alias("accepted"),
        F.sort_array(F.collect_list(F.when(known, pair))).alias("rejected"),
        F.coalesce(F.bool_or(refused), F.lit(False)).alias("refused"),
    ).drop("_row")
