"""Daily counts, active users, revenue and agent shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.events import uid

SKETCH_LG_K = 12


def events_by_day(events: DataFrame) -> DataFrame:
    return events.groupBy("project_id", "event_date", "event_name").agg(
        F.count(F.lit(1)).alias("events")
    )


def dau(events: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct actors per project and day; ``approximate`` trades exactness for one shuffle
    of sketches instead of actors."""
    count = F.approx_count_distinct(uid(), 0.02) if approximate else F.count_distinct(uid())
    return events.groupBy("project_id", "event_date").agg(count.alias("dau"))


def revenue_by_day(events: DataFrame) -> DataFrame:
    return (
        events.filter(F.col("revenue_amount") > 0)
        .groupBy("project_id", "event_date", "revenue_currency")
        .agg(F.sum("revenue_amount").alias("revenue"))
    )


def agents_by_day(events: DataFrame) -> DataFrame:
    """Base rollup by browser and system; ``ua_by_day`` and ``os_by_day`` sum it up."""
    return events.groupBy("project_id", "event_date", "ua_family", "os_family").agg(
        F.count(F.lit(1)).alias("events")
    )


def ua_by_day(agents: DataFrame) -> DataFrame:
    return agents.groupBy("project_id", "event_date", "ua_family").agg(
        F.sum("events").alias("events")
    )


def os_by_day(agents: DataFrame) -> DataFrame:
    return agents.groupBy("project_id", "event_date", "os_family").agg(
        F.sum("events").alias("events")
    )


def top_families(
    events: DataFrame, family: str, as_of: str, days: int = 7, limit: int = 20
) -> DataFrame:
    """The most frequent families since ``days`` before ``as_of``, ties by name."""
    since = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))
    return (
        events.filter(F.col("ts_server") >= since)
        .groupBy(family)
        .agg(F.count(F.lit(1)).alias("c"))
        .orderBy(F.desc("c"), family)
        .limit(limit)
    )


def device_classes(events: DataFrame) -> DataFrame:
    return events.groupBy("device_class").agg(F.count(F.lit(1)).alias("c"))


def ua_trend(events: DataFrame) -> DataFrame:
    return events.groupBy("event_date", "ua_family").agg(F.count(F.lit(1)).alias("events"))


def dau_state(events: DataFrame) -> DataFrame:
    """Mergeable state per project and day: an HLL sketch of the actors and the event count."""
    return events.groupBy("project_id", "event_date").agg(
        F.hll_sketch_agg(uid(), SKETCH_LG_K).alias("actors"), F.count(F.lit(1)).alias("events")
    )


def merge_state(state: DataFrame, *keys: str) -> DataFrame:
    """Merge states to any coarser grain: distinct actors estimated, events added."""
    return state.groupBy(*keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg("actors")).alias("actors"),
        F.sum("events").alias("events"),
    )
