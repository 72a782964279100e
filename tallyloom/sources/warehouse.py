"""The events fact table: Parquet files by project and month, sorted inside."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SORT_KEY = ["project_id", "user_id", "device_id", "ts_server", "event_name", "event_id"]


def write_events(events: DataFrame, path: str, mode: str = "append") -> None:
    """Write events by project and month.

    The rebalance hint splits a project or month that holds most rows over several tasks and
    merges small ones, so neither one task nor one file takes a whole project.
    """
    month = F.date_format("event_date", "yyyyMM")
    (
        events.withColumn("event_month", month)
        .hint("rebalance", "project_id", "event_month")
        .sortWithinPartitions("project_id", "event_month", *SORT_KEY[1:])
        .write.mode(mode)
        .partitionBy("project_id", "event_month")
        .parquet(path)
    )


def read_events(
    spark: SparkSession,
    path: str,
    project: str | None = None,
    first_day: str | None = None,
    last_day: str | None = None,
) -> DataFrame:
    """Scan the fact table. A day range also prunes the month folders."""
    df = spark.read.option("recursiveFileLookup", False).parquet(path)
    df = df.withColumn("event_month", F.col("event_month").cast("string"))
    if project is not None:
        df = df.filter(F.col("project_id") == project)
    if first_day is not None:
        day = F.lit(first_day).cast("date")
        df = df.filter(F.col("event_date") >= day)
        df = df.filter(F.col("event_month") >= F.date_format(day, "yyyyMM"))
    if last_day is not None:
        day = F.lit(last_day).cast("date")
        df = df.filter(F.col("event_date") <= day)
        df = df.filter(F.col("event_month") <= F.date_format(day, "yyyyMM"))
    return df.drop("event_month")
