"""Key usage, key health, quotas and the rate-limit audit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.operators.tenants import tier_quota

# Requests per minute for a key and for an address, days until rotation.
KEY_RPM = 600
IP_RPM = 300


def key_usage(requests: DataFrame) -> DataFrame:
    """Requests, events, last use and the address of the last use per key.

    ``requests`` has ``api_key, request_id, ts, client_ip, events``.
    """
    last = F.max(F.struct("ts", "request_id", "client_ip")).alias("last")
    return requests.groupBy("api_key").agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.sum("events").alias("total_events"),
        last,
    ).select(
        "api_key",
        "total_requests",
        "total_events",
        F.col("last.ts").alias("last_used_at"),
        F.col("last.client_ip").alias("last_used_ip"),
    )


def key_health(keys: DataFrame, as_of: str, high_usage: int, unused_days: int) -> DataFrame:
    """One row per key with a flag per health list."""
    now = F.lit(as_of).cast("timestamp")
    active = F.col("status") == "ACTIVE"

    def days(n):
        return F.make_dt_interval(n)

    def flag(test):
        return F.coalesce(test, F.lit(False))

    expires = F.col("expires_at")
    rotation = now - days(F.col("rotation_days"))
    idle = F.col("last_used_at").isNull() | (F.col("last_used_at") < now - days(F.lit(unused_days)))
    return keys.select(
        "api_key",
        "total_requests",
        flag(active & (expires.isNull() | (expires > now)) & F.col("revoked_at").isNull()).alias("is_active"),
        flag(active & (expires <= now)).alias("is_expired"),
        flag(active & F.col("auto_rotate") & (F.col("created_at") <= rotation)).alias("rotation_due"),
        flag(F.col("total_requests") > high_usage).alias("is_high_usage"),
        flag(active & idle).alias("is_unused"),
    )


def high_usage_keys(health: DataFrame) -> DataFrame:
    """Keys above the usage threshold, busiest first."""
    return (
        health.filter("is_high_usage")
        .select("api_key", "total_requests")
        .orderBy(F.desc("total_requests"), "api_key")
    )


def quota_report(events: DataFrame, games: DataFrame, orgs: DataFrame) -> DataFrame:
    """Events per organization and month against the quota of its tier.

    Events are counted per project before the small tables are joined.
    """
    counts = events.groupBy("project_id", F.date_format("event_date", "yyyyMM").alias("month")).agg(
        F.count(F.lit(1)).alias("n")
    )
    projects = games.select(F.col("id").alias("project_id"), "org_id")
    limits = orgs.select(
        F.col("id").alias("org_id"),
        "tier",
        F.coalesce("max_events_per_month", tier_quota("tier", 1)).alias("max_events"),
        F.coalesce("max_data_retention_days", tier_quota("tier", 2)).alias("retention_days"),
    )
    per_org = (
        counts.join(projects, "project_id").groupBy("org_id", "month").agg(F.sum("n").alias("events"))
    )
    over = (F.col("max_events") >= 0) & (F.col("events") > F.col("max_events"))
    return per_org.join(limits, "org_id").select(
        "org_id", "tier", "month", "events", "max_events", "retention_days", over.alias("over_quota")
    )


def game_quota_report(orgs: DataFrame, games: DataFrame) -> DataFrame:
    """Games per organization against its limit; at the limit no game may be added."""
    counts = games.groupBy(F.col("org_id").alias("id")).agg(F.count(F.lit(1)).alias("games"))
    limit = F.coalesce("max_games", tier_quota("tier", 0))
    n = F.coalesce("games", F.lit(0).cast("long"))
    return orgs.join(counts, "id", "left").select(
        F.col("id").alias("org_id"), "tier", limit.alias("max_games"), n.alias("games"), (n >= limit).alias("at_limit")
    )


def key_quota_report(usage_by_day: DataFrame, keys: DataFrame) -> DataFrame:
    """Days on which a key went above its daily quota; a NULL quota means no limit.

    ``usage_by_day`` has ``api_key, event_date, events``.
    """
    quota = keys.select("api_key", "daily_quota")
    return (
        usage_by_day.join(quota, "api_key")
        .filter(F.col("events") > F.col("daily_quota"))
        .select("api_key", "event_date", "events", "daily_quota")
    )


def _with_limit(requests: DataFrame, key: str, default: int, overrides: DataFrame | None) -> DataFrame:
    if overrides is None:
        return requests.withColumn("allowed_rpm", F.lit(default))
    own = overrides.select(key, F.col("rpm").alias("own_rpm"))
    return (
        requests.join(own, key, "left")
        .withColumn("allowed_rpm", F.coalesce("own_rpm", F.lit(default)))
        .drop("own_rpm")
    )


def rate_limit_report(
    requests: DataFrame, key: str = "api_key", default: int = KEY_RPM, overrides: DataFrame | None = None
) -> DataFrame:
    """Per key and minute the requests, those let through and those refused.

    Refused requests count too, so the first ``limit`` of a minute pass and no others: plain
    counts are enough. Limits are joined to the counts, not to the requests.
    """
    counts = requests.groupBy(key, F.date_trunc("minute", "ts").alias("minute")).agg(
        F.count(F.lit(1)).alias("requests")
    )
    limited = _with_limit(counts, key, default, overrides)
    passed = F.least(F.col("requests"), F.col("allowed_rpm").cast("long"))
    return limited.select(
        key, "minute", "requests", passed.alias("passed"), (F.col("requests") - passed).alias("refused")
    )


def refused_requests(
    requests: DataFrame, key: str = "api_key", default: int = KEY_RPM, overrides: DataFrame | None = None
) -> DataFrame:
    """The refused requests with their ordinal in the minute, in ``(ts, request_id)`` order.

    Only minutes above their limit are looked at. In those the requests are counted per
    millisecond first; the ordinal is the count of earlier milliseconds plus the rank within
    the own one, so a window never holds more than a minute of milliseconds, or the requests
    of one millisecond, however busy the key is.
    """
    timed = requests.select(
        key, "request_id", "ts", F.date_trunc("minute", "ts").alias("minute"),
        F.date_trunc("millisecond", "ts").alias("ms"),
    )
    cells = timed.groupBy(key, "minute", "ms").agg(F.count(F.lit(1)).alias("n"))
    over = (
        _with_limit(cells.groupBy(key, "minute").agg(F.sum("n").alias("total")), key, default, overrides)
        .filter(F.col("total") > F.col("allowed_rpm"))
        .select(key, "minute", "allowed_rpm")
    )
    order = W.partitionBy(key, "minute").orderBy("ms").rowsBetween(W.unboundedPreceding, -1)
    starts = cells.join(over, [key, "minute"]).withColumn(
        "earlier", F.coalesce(F.sum("n").over(order), F.lit(0).cast("long"))
    )
    late = starts.filter(F.col("earlier") + F.col("n") > F.col("allowed_rpm"))
    inside = W.partitionBy(key, "minute", "ms").orderBy("ts", "request_id")
    ranked = timed.join(
        late.select(key, "minute", "ms", "earlier", "allowed_rpm"), [key, "minute", "ms"]
    ).withColumn("ordinal", F.col("earlier") + F.row_number().over(inside))
    return ranked.filter(F.col("ordinal") > F.col("allowed_rpm")).select(
        key, "request_id", "ts", "ordinal"
    )
