"""Cohort retention. Events shrink to one row per actor and day before any window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.functions.events import rate, uid

DAYS = (0, 1, 7, 30)


def active_days(events: DataFrame) -> DataFrame:
    """Distinct days per actor."""
    return events.select("project_id", uid().alias("uid"), "event_date").distinct()


def _with_cohort(days: DataFrame) -> DataFrame:
    first = F.min("event_date").over(W.partitionBy("project_id", "uid"))
    return days.withColumn("cohort_date", first)


def d1_retention(events: DataFrame) -> DataFrame:
    """Users of each first day, those back the day after, and the rate."""
    offset = F.datediff("event_date", "cohort_date")
    counts = (
        _with_cohort(active_days(events))
        .groupBy("project_id", F.col("cohort_date").alias("cohort_day"))
        .agg(
            F.count_if(offset == 0).alias("d0_users"),
            F.count_if(offset == 1).alias("d1_return"),
        )
    )
    return counts.withColumn("d1_retention", rate("d1_return", "d0_users"))


def retention_daily(
    events: DataFrame, days: tuple[int, ...] = DAYS, ttl_days: int | None = None
) -> DataFrame:
    """Users per project, first day and day offset.

    With ``ttl_days`` a user active that many days after the first day, or later, starts a new
    cohort; without it the first day is kept for ever.
    """
    active = active_days(events)
    cohorts = _with_cohort(active) if ttl_days is None else _restarting(active, ttl_days)
    return (
        cohorts.withColumn("d", F.datediff("event_date", "cohort_date"))
        .filter(F.col("d").isin(*days))
        .groupBy("project_id", "cohort_date", "d")
        .agg(F.count(F.lit(1)).alias("users"))
    )


def _restarting(active: DataFrame, ttl_days: int) -> DataFrame:
    """Cohort day of every active day when cohorts end after ``ttl_days``.

    An actor has at most one row per calendar day here, so the list of days is short.
    """
    days = active.groupBy("project_id", "uid").agg(
        F.sort_array(F.collect_list("event_date")).alias("days")
    )
    empty = F.lit(None).cast("array<struct<event_date:date,cohort_date:date>>")

    def step(seen, day):
        last = F.element_at(seen, -1)["cohort_date"]
        cohort = F.when(F.datediff(day, last) < ttl_days, last).otherwise(day)
        first = F.array(F.struct(day.alias("event_date"), day.alias("cohort_date")))
        more = F.array(F.struct(day.alias("event_date"), cohort.alias("cohort_date")))
        return F.when(seen.isNull(), first).otherwise(F.concat(seen, more))

    walked = F.aggregate("days", empty, step)
    return days.select("project_id", "uid", F.inline(walked))


def retention_pivot(retention: DataFrame, days: tuple[int, ...] = DAYS) -> DataFrame:
    """Cohorts as rows, day offsets as columns ``d0, d1, ...``; the values are given, so the
    pivot needs no extra pass over the data."""
    sums = [F.sum(F.when(F.col("d") == d, F.col("users"))).alias(f"d{d}") for d in days]
    return retention.groupBy("cohort_date").agg(*sums)
