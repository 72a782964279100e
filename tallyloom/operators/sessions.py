"""Sessions by inactivity gap.

Time is cut into cells as long as the gap. Two events of one actor in one cell are closer than
the gap, so a cell never holds a session border and can be aggregated before anything is
ordered. The window then runs over cells, at most one per gap and actor, not over events: an
actor with most events of the table costs one task only its cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.functions.events import uid
from tallyloom.functions.hashing import session_id

ACTOR = ["project_id", "uid"]


def _cells(events: DataFrame, gap_ms: int, *detail: str) -> DataFrame:
    """First and last time and count per actor and cell, and per value of ``detail``.

    The buffers are numbers and the strings are keys, so the map side is a hash aggregate.
    """
    ms = F.unix_millis("ts_server")
    return (
        events.select(
            "project_id",
            uid().alias("uid"),
            F.floor(ms / gap_ms).alias("cell"),
            ms.alias("ms"),
            *[F.coalesce(c, F.lit("")).alias(c) for c in detail],
        )
        .groupBy(*ACTOR, "cell", *detail)
        .agg(F.min("ms").alias("low"), F.max("ms").alias("high"), F.count(F.lit(1)).alias("n"))
    )


def _numbered(cells: DataFrame, gap_ms: int) -> DataFrame:
    """Cells with the number of their session; a session starts after a longer pause."""
    order = W.partitionBy(*ACTOR).orderBy("cell")
    pause = F.col("low") - F.lag("high").over(order)
    opens = F.coalesce(pause > gap_ms, F.lit(True)).cast("int")
    return cells.withColumn("opens", opens).withColumn(
        "session_no", F.sum("opens").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    )


def spans(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """One row per actor and cell: ``low`` and ``high`` (ms), ``n``, and what is known of the earliest event and the
    earliest country, however many devices an actor has. Spans of one session can be joined in any order."""
    named = F.when(F.col("country") != "", F.struct("low", "country"))
    return (
        _cells(events, gap_minutes * 60_000, "user_id", "device_id", "country")
        .groupBy(*ACTOR, "cell")
        .agg(
            F.min(F.struct("low", "user_id", "device_id")).alias("first"),
            F.min(named).alias("named"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.sum("n").alias("n"),
        )
    )


def _joined(numbered: DataFrame) -> DataFrame:
    """The spans of each numbered session as one."""
    return numbered.groupBy(*ACTOR, "session_no").agg(
        F.min("first").alias("first"),
        F.min("named").alias("named"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum("n").alias("n"),
    )


def join_spans(rows: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """Spans that may overlap, joined where no pause between them is longer than the gap: one row per session."""
    order = W.partitionBy(*ACTOR).orderBy("low", "high")
    before = F.max("high").over(order.rowsBetween(W.unboundedPreceding, -1))
    opens = F.coalesce(F.col("low") - before > gap_minutes * 60_000, F.lit(True)).cast("int")
    numbered = rows.withColumn("opens", opens).withColumn(
        "session_no", F.sum("opens").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    )
    return _joined(numbered).drop("session_no")


def as_sessions(joined: DataFrame) -> DataFrame:
    """Joined spans as rows of the sessions table."""
    start, end = F.timestamp_millis("low"), F.timestamp_millis("high")
    return joined.select(
        "project_id",
        session_id(F.col("project_id"), F.col("uid"), start).alias("session_id"),
        F.col("first.user_id").alias("user_id"),
        F.col("first.device_id").alias("device_id"),
        start.alias("session_start"),
        end.alias("session_end"),
        F.floor((F.col("high") - F.col("low")) / 1000).alias("duration"),
        F.coalesce("named.country", F.lit("")).alias("country"),
        F.col("n").alias("events"),
    )


def sessions(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """One row per session. The earliest event gives user and device, the earliest one with a
    country gives the country; at equal times the smaller value counts."""
    return as_sessions(_joined(_numbered(spans(events, gap_minutes), gap_minutes * 60_000)))


def session_of_events(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """Each event with the number of its session per actor, as a client counts them.

    The join back uses the cell as part of the key, which also splits a busy actor.
    """
    gap_ms = gap_minutes * 60_000
    numbered = _numbered(_cells(events, gap_ms), gap_ms).select(*ACTOR, "cell", "session_no")
    return (
        events.select(
            "project_id",
            uid().alias("uid"),
            F.floor(F.unix_millis("ts_server") / gap_ms).alias("cell"),
            "event_id",
        )
        .join(numbered, [*ACTOR, "cell"])
        .select("project_id", "uid", "event_id", "session_no")
    )
