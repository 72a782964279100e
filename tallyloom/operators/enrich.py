"""From normalized records to rows of the events fact table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.events import blank_if_null, to_millis
from tallyloom.functions.json_text import put_if_absent
from tallyloom.functions.network import let
from tallyloom.operators.ingest import INVALID_SCHEMA, REQUIRED
from tallyloom.schema import EVENTS
from tallyloom.session import work_dir
from tallyloom.sources.dimensions import (
    AGENT_RULES,
    DEVICE_RULES,
    OS_RULES,
    keyed_ranges,
    match_rules,
    place,
    range_key,
    steps,
    text_array,
)

DEFAULT_CURRENCY = "USD"
REVENUE_EVENT = "revenue"
# Address ranges up to this number become a constant of the query; about so many keys are merged by one task.
FEW_RANGES = 4096
PER_TASK = 250_000


def has_required() -> Column:
    """Are all required fields there?"""
    complete = F.lit(True)
    for name in REQUIRED:
        complete = complete & F.col(name).isNotNull()
    return complete


def invalid_letters(records: DataFrame) -> DataFrame:
    """A dead letter for each incomplete record."""
    return records.select(F.coalesce("event_id", F.lit("")).alias("event_id"), F.lit(INVALID_SCHEMA).alias("reason"))


def split_required(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records with all required fields, and dead letters for the others."""
    return records.filter(has_required()), invalid_letters(records.filter(~has_required()))


def fill_server_time(records: DataFrame) -> DataFrame:
    """A missing server time becomes now, which is the start of the query or of the micro-batch."""
    now = F.unix_micros(F.current_timestamp())
    return records.withColumn("ts_server", F.coalesce("ts_server", now))


def add_country(events: DataFrame, ranges: DataFrame, few: int = FEW_RANGES) -> DataFrame:
    """Fill an empty country from the address range that holds the client address.

    Where ranges overlap, that which begins last and, of these, ends first answers: the narrowest of nested ones. Up to
    ``few`` ranges are read by the driver and become a constant staircase that each event searches by
    halving, without a join. A larger table is merged with the distinct addresses (``merge_ranges``).
    """
    needs = (F.coalesce("country", F.lit("")) == "") & (F.coalesce("client_ip", F.lit("")) != "")
    keyed = keyed_ranges(ranges)
    head = [(r["low"], r["high"], r["geo"]) for r in keyed.limit(few + 1).collect()]
    if len(head) <= few:
        stairs = steps(head)
        starts = text_array([key for key, _ in stairs])
        values = text_array([value or "" for _, value in stairs])
        # Before the first step there is no range: index -1 gives NULL.
        found = let(range_key(F.col("client_ip")), lambda key: F.get(values, place(starts, len(stairs), key) - 1))
        found = F.when(needs, found)
        return events.withColumn("country", F.coalesce(F.nullif(F.col("country"), F.lit("")), found, F.lit("")))
    key = F.when(needs, range_key(F.col("client_ip")))
    asked = events.select(key.alias("address")).filter("address IS NOT NULL").distinct()
    found = merge_ranges(asked, keyed).withColumnRenamed("address", "_found")
    # Events that need no lookup match nothing and carry spread keys, so they are not shuffled to one task.
    spread = F.concat(F.lit("-"), F.pmod(F.xxhash64("event_id"), F.lit(1_000_000)).cast("string"))
    country = F.coalesce(F.nullif(F.col("country"), F.lit("")), F.col("_geo"), F.lit(""))
    return (
        events.withColumn("_address", F.coalesce(key, spread))
        .join(found, F.col("_address") == F.col("_found"), "left")
        .withColumn("country", country)
        .drop("_address", "_found", "_geo")
    )


def merge_ranges(asked: DataFrame, keyed: DataFrame, per_task: int = PER_TASK) -> DataFrame:
    """``(address, _geo)``: for each distinct ``address`` (a ``range_key``) inside a range of ``keyed`` its answer.

    Both tables are dealt to the same spans of keys, a range to every span it touches, and each span is swept in the order of the
    keys with a stack of open ranges. The spans are cut at every 64th key of a sample drawn by hash from both
    tables, about 64 keys per span, so they are even whatever is in them; only the cuts come to the driver.
    """
    spark = asked.sparkSession
    path = work_dir(spark, "addresses")
    asked.write.parquet(f"{path}/asked")
    keyed.write.parquet(f"{path}/ranges")
    asked, keyed = spark.read.parquet(f"{path}/asked"), spark.read.parquet(f"{path}/ranges")
    keys = asked.select(F.col("address").alias("key")).unionByName(keyed.select(F.col("low").alias("key")))
    spans = max(1, -(-keys.count() // per_task))
    one_in = max(1, per_task // 64)
    sample = keys.filter(F.pmod(F.xxhash64("key"), F.lit(one_in)) == 0).distinct() if spans > 1 else keys.limit(0)
    drawn = sorted(r["key"] for r in sample.collect())
    cuts = drawn[64::64]
    bounds = text_array(cuts)

    def span(key: str) -> Column:
        return place(bounds, len(cuts), F.col(key))

    left = asked.select(
        span("address").alias("span"), F.col("address").alias("key"), F.lit(None).cast("string").alias("high"),
        F.lit(None).cast("string").alias("geo"),
    )
    right = keyed.select(
        F.explode(F.sequence(span("low"), span("high"))).alias("span"), F.col("low").alias("key"), "high", "geo"
    )
    # A range comes before the addresses at its first key; of ranges that begin together the one that ends first is last.
    both = left.unionByName(right).repartitionById(len(cuts) + 1, F.col("span"))
    ordered = both.sortWithinPartitions("span", "key", F.desc_nulls_last("high"), F.asc_nulls_first("geo"))

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            addresses, answers = [], []
            for number, key, high, geo in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number != at:
                    at, held = number, []
                if high is not None:
                    held.append((high, geo))
                    continue
                while held and held[-1][0] < key:  # it ends before all that follows
                    held.pop()
                if held:
                    addresses.append(key)
                    answers.append(held[-1][1])
            yield pa.RecordBatch.from_arrays([pa.array(addresses, pa.string()), pa.array(answers, pa.string())], names=["address", "_geo"])

    return ordered.mapInArrow(sweep, "address string, _geo string")


def agent_columns(user_agent: str = "user_agent") -> dict[str, Column]:
    """Browser family, system family and device class of a user agent."""
    text = F.col(user_agent)
    return {
        "ua_family": match_rules(text, AGENT_RULES),
        "os_family": match_rules(text, OS_RULES),
        "device_class": match_rules(text, DEVICE_RULES),
    }


def revenue_columns(
    name: str = "event_name", props: str = "props_json", as_written: bool = False
) -> dict[str, Column]:
    """Amount and currency. They come from the columns, else from the props of a revenue
    event, else they are 0 and USD; ``as_written`` always gives 0 and USD."""
    zero = F.lit(0).cast("decimal(18,4)")
    if as_written:
        return {"revenue_amount": zero, "revenue_currency": F.lit(DEFAULT_CURRENCY)}
    is_revenue = F.col(name) == REVENUE_EVENT
    amount = F.when(is_revenue, F.get_json_object(props, "$.amount").try_cast("decimal(18,4)"))
    currency = F.when(is_revenue, F.get_json_object(props, "$.currency"))
    return {
        "revenue_amount": F.coalesce(F.col("revenue_amount"), amount, zero),
        "revenue_currency": F.coalesce(
            F.col("revenue_currency"), currency, F.lit(DEFAULT_CURRENCY)
        ),
    }


def latest_user_props(user_props: DataFrame, order: str | None = None) -> DataFrame:
    """One row per user: the one with the largest ``order`` column, ties by the larger text."""
    rank = F.struct(*([order] if order else []), "user_props_json")
    newest = user_props.groupBy("project_id", "user_id").agg(F.max(rank).alias("row"))
    return newest.select("project_id", "user_id", F.col("row.user_props_json").alias("user_props_json"))


def merge_user_props(events: DataFrame, user_props: DataFrame, order: str | None = None) -> DataFrame:
    """Put the user properties of ``(project_id, user_id, user_props_json)`` under the event
    properties; the value of the event wins.

    Of several rows of a user the latest by ``order`` counts. Events without a user match nothing
    and carry spread keys.
    """
    own = F.from_json("props_json", "map<string,variant>")
    base = F.from_json("user_props_json", "map<string,variant>")
    under = F.map_filter(base, lambda k, _: ~F.array_contains(F.map_keys(own), k))
    merged = F.to_json(F.to_variant_object(F.map_concat(under, own)))
    latest = latest_user_props(user_props.filter("user_id <> ''"), order)
    named = F.nullif(F.col("user_id"), F.lit(""))
    spread = F.concat(F.lit("\0"), F.pmod(F.xxhash64("event_id"), F.lit(1_000_000)).cast("string"))
    return (
        events.withColumn("_user", F.coalesce(named, spread))
        .join(latest.withColumnRenamed("user_id", "_user"), ["project_id", "_user"], "left")
        .withColumn("props_json", F.coalesce(merged, F.col("props_json")))
        .select(*events.columns)
    )


def enrich(records: DataFrame, ranges: DataFrame | None = None, as_written: bool = False) -> DataFrame:
    """Records (times in microseconds) to fact rows, with the agent columns added.

    Country comes first so that its join sees few columns of work. The agent columns are a projection of their own: the
    properties name them several times, and their patterns would run as often.
    """
    timed = fill_server_time(records)
    located = timed if ranges is None else add_country(timed, ranges)
    agents = agent_columns()
    ts = to_millis(F.timestamp_micros("ts_server"))
    rows = located.withColumns(agents).withColumns(
        {
            **revenue_columns(as_written=as_written),
            "props_json": put_if_absent(F.col("props_json"), {name: F.col(name) for name in agents}),
            "ts_server": ts,
            "event_date": F.to_date(ts),
        }
    )
    blanks = {"user_id", "session_id", "platform", "app_version", "country"}
    columns = [
        blank_if_null(n) if n in blanks else F.col(n) for n in EVENTS.fieldNames()
    ]
    return rows.select(*columns, *[blank_if_null(n) for n in agents])
