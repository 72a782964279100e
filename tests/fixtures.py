"""Hand-worked events and exposures."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

# (event_id, user, device, name, time)
ACTIVITY = [
    ("e01", "uA", "dA", "level_start", "2024-01-01 00:00:00"),
    ("e02", "uA", "dA", "level_complete", "2024-01-01 00:30:00"),
    ("e03", "uA", "dA", "level_start", "2024-01-01 01:00:00.001"),
    ("e04", "uA", "dA", "level_complete", "2024-01-02 01:00:00"),
    ("e05", "uA", "dA", "login", "2024-01-08 12:00:00"),
    ("e06", "", "dB", "level_complete", "2024-01-01 10:00:00"),
    ("e07", "", "dB", "level_start", "2024-01-01 11:00:00"),
    ("e08", "", "dB", "level_complete", "2024-01-02 11:00:00"),
    ("e09", "", "dB", "level_complete", "2024-01-02 11:00:00.001"),
    ("e10", "uC", "dC", "level_start", "2024-01-02 00:00:00"),
    ("e11", "uC", "dC", "level_complete", "2024-01-03 00:00:00.001"),
    ("e10", "uC", "dC", "level_start", "2024-01-02 00:00:00"),
]
EXPOSURES = [
    ("x1", "uA", "dA", "A", "2024-01-01 00:00:00"),
    ("x2", "uA", "dA", "A", "2024-01-01 00:10:00"),
    ("x3", "", "dB", "B", "2024-01-01 10:00:00"),
    ("x4", "uC", "dC", "B", "2024-01-01 20:00:00"),
]


def make_events(spark, rows):
    """Fact rows of project p1 from (id, user, device, name, time, props)."""
    schema = "event_id string, user_id string, device_id string, event_name string, ts string, props_json string"
    df = spark.createDataFrame([r if len(r) == 6 else (*r, "{}") for r in rows], schema)
    ts = F.col("ts").cast("timestamp")
    return df.select(
        F.lit("p1").alias("project_id"),
        F.to_date(ts).alias("event_date"),
        ts.alias("ts_server"),
        "event_id", "event_name", "user_id", "device_id",
        F.lit("").alias("session_id"), F.lit("ios").alias("platform"), F.lit("1.0.0").alias("app_version"),
        F.lit("US").alias("country"), "props_json",
        F.lit(0).cast("decimal(18,4)").alias("revenue_amount"), F.lit("USD").alias("revenue_currency"),
    )


def activity(spark):
    return make_events(spark, ACTIVITY)


def with_exposures(spark):
    shown = [
        (i, u, d, "experiment_exposure", t, json.dumps({"exp": "e1", "variant": v}))
        for i, u, d, v, t in EXPOSURES
    ]
    return make_events(spark, [*ACTIVITY[:-1], *shown])


def tuples(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())
