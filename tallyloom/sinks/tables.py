"""Writing batches so that a repeated write of the same batch changes nothing."""

from __future__ import annotations

from datetime import date, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: days the fact table keeps events if no tier says otherwise.
EVENT_DAYS = 365


def write_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """Append a micro-batch as partition ``load_id``; a retry overwrites its own partition."""
    (
        df.withColumn("load_id", F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("load_id")
        .parquet(path)
    )


def overwrite_days(df: DataFrame, path: str, day: str) -> None:
    """Replace the day partitions present in ``df`` and leave the others.

    The rebalance hint keeps one file per small day and splits a large one.
    """
    (
        df.hint("rebalance", day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def publish_by_project(records: DataFrame, path: str, mode: str = "append") -> None:
    """Normalized records in folders per project; a large project is split over tasks."""
    records.hint("rebalance", "project_id").write.mode(mode).partitionBy("project_id").parquet(path)


def keep_days(df: DataFrame, day: str, as_of: str, days: int) -> DataFrame:
    """Rows whose day is not older than ``days`` before ``as_of``."""
    return df.filter(F.col(day) >= F.date_sub(F.lit(as_of).cast("date"), days))


def drop_expired_days(spark: SparkSession, path: str, day: str, as_of: str, days: int) -> int:
    """Delete day folders older than the limit; returns how many went.

    Only folder names are listed on the driver, one per calendar day.
    """
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    limit = spark.sql("SELECT date_sub(:d, :n) AS d", args={"d": as_of, "n": days}).first()["d"]
    dropped = 0
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(f"{day}=") and name.split("=", 1)[1] < limit.isoformat():
            fs.delete(status.getPath(), True)
            dropped += 1
    return dropped


def expire_events(spark: SparkSession, path: str, limits: DataFrame, as_of: str, default_days: int = EVENT_DAYS) -> None:
    """Delete events of the fact table (``sources.warehouse``) older than the limit of their project.

    ``limits`` has (project_id, days); other projects keep ``default_days``. Whole months go as folders; of
    the month that holds the limit the younger rows are written again. Only folder names and one
    number per project come to the driver. Running it again changes nothing.
    """
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    own = {r["project_id"]: r["days"] for r in limits.collect()}
    today = date.fromisoformat(as_of)
    cut: dict[tuple[str, str], date] = {}
    for project in fs.listStatus(root):
        name = project.getPath().getName()
        if not name.startswith("project_id="):
            continue
        project_id = unquote(name.split("=", 1)[1])
        first = today - timedelta(days=int(own.get(project_id, default_days)))
        for month in fs.listStatus(project.getPath()):
            value = month.getPath().getName().split("=", 1)[-1]
            if value < first.strftime("%Y%m"):
                fs.delete(month.getPath(), True)
            elif value == first.strftime("%Y%m"):
                cut[project_id, value] = first
    if not cut:
        return
    rows = [(project, month, first) for (project, month), first in cut.items()]
    edges = spark.createDataFrame(rows, "_project string, _month string, _first date")
    stored = spark.read.parquet(path).withColumn("event_month", F.col("event_month").cast("string"))
    here = stored.filter(F.col("project_id").isin([p for p, _ in cut]) & F.col("event_month").isin([m for _, m in cut]))
    same = (F.col("project_id") == F.col("_project")) & (F.col("event_month") == F.col("_month"))
    kept = here.join(edges, same).filter(F.col("event_date") >= F.col("_first")).drop("_project", "_month", "_first")
    left = {(r["project_id"], r["event_month"]) for r in kept.select("project_id", "event_month").distinct().collect()}
    (
        kept.hint("rebalance", "project_id", "event_month")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("project_id", "event_month")
        .parquet(path)
    )
    for project, month in cut.keys() - left:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/project_id={project}/event_month={month}"), True)
