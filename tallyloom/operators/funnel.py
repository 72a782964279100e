"""Two-step funnels, all-time and by day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.functions.events import rate, uid

STEP1, STEP2 = "level_start", "level_complete"
DAY_MS = 86_400_000


def all_time_funnel(events: DataFrame, step1: str = STEP1, step2: str = STEP2) -> DataFrame:
    """Users who did step 1, and those whose first step 2 is not before their first step 1.

    One pass: the first time of each step per actor is a conditional minimum.
    """
    name, ts = F.col("event_name"), F.col("ts_server")
    firsts = (
        events.filter(name.isin(step1, step2))
        .groupBy("project_id", uid().alias("uid"))
        .agg(F.min(F.when(name == step1, ts)).alias("t1"), F.min(F.when(name == step2, ts)).alias("t2"))
    )
    counts = (
        firsts.filter("t1 IS NOT NULL")
        .groupBy("project_id")
        .agg(F.count(F.lit(1)).alias("started"), F.count_if(F.col("t2") >= F.col("t1")).alias("completed"))
    )
    return counts.withColumn("cr", rate("completed", "started"))


def cell_millis(timeout_ms: int) -> int:
    """The longest part of a day that divides it evenly and is not above the timeout."""
    part = -(-DAY_MS // max(1, min(timeout_ms, DAY_MS)))
    while DAY_MS % part:
        part += 1
    return DAY_MS // part


def daily_funnel(
    events: DataFrame, step1: str = STEP1, step2: str = STEP2, timeout_hours: float = 24
) -> DataFrame:
    """Per day the actors who did step 1, and those with a step 2 on that day at most
    ``timeout_hours`` after their latest step 1.

    At equal times step 1 counts as the earlier one. A day is cut into cells no longer than
    the timeout and only the first and last time of each step per actor and cell is kept:
    inside a cell any step 2 at or after a step 1 is in time, and across cells the closest
    pair is the last step 1 before the cell and the first step 2 in it. The window therefore
    runs over cells, not over events.
    """
    timeout_ms = int(timeout_hours * 3_600_000)
    cell_ms = cell_millis(timeout_ms)
    ms = F.unix_millis("ts_server")
    is1 = F.col("event_name") == step1
    is2 = (F.col("event_name") == step2) & ~is1
    cells = (
        events.filter(F.col("event_name").isin(step1, step2))
        .groupBy("project_id", uid().alias("uid"), F.floor(ms / cell_ms).alias("cell"))
        .agg(
            F.min(F.when(is1, ms)).alias("first1"),
            F.max(F.when(is1, ms)).alias("last1"),
            F.min(F.when(is2, ms)).alias("first2"),
            F.max(F.when(is2, ms)).alias("last2"),
        )
    )
    before = (
        W.partitionBy("project_id", "uid").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    )
    inside = F.col("last2") >= F.col("first1")
    across = F.col("first2") - F.col("prior1") <= timeout_ms
    event_date = F.date_from_unix_date(F.floor(F.col("cell") * cell_ms / DAY_MS).cast("int"))
    users = (
        cells.withColumn("prior1", F.max("last1").over(before))
        .groupBy("project_id", "uid", event_date.alias("event_date"))
        .agg(
            F.max(F.col("first1").isNotNull().cast("long")).alias("started"),
            F.max(F.coalesce(inside | across, inside, across, F.lit(False)).cast("long")).alias("completed"),
        )
    )
    return (
        users.groupBy("project_id", "event_date")
        .agg(F.sum("started").alias("started"), F.sum("completed").alias("completed"))
        .filter("started + completed > 0")
        .select(
            "project_id",
            "event_date",
            F.lit(step1).alias("step1"),
            F.lit(step2).alias("step2"),
            "started",
            "completed",
        )
    )
