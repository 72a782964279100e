"""Daily rollup tables, their refresh after new data, and the collapse of repeated keys."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.events import rate, uid
from tallyloom.operators import conversion as conv
from tallyloom.operators import metrics
from tallyloom.operators.experiments import DIMS, exposures, exposures_by_day
from tallyloom.schema import EVENTS
from tallyloom.sinks import loads
from tallyloom.sinks.tables import keep_days as keep_days_of
from tallyloom.sinks.tables import overwrite_days


@dataclass(frozen=True)
class Rollup:
    """A daily table: its day column, dimensions and conversion window (0 = exposures)."""

    name: str
    day: str
    dims: tuple[str, ...]
    hours: int

    @property
    def label(self) -> str:
        return "cr_24h" if self.hours == 24 else "cr_7d"

    def build(self, exposed: DataFrame, conversions: DataFrame) -> DataFrame:
        """The whole table straight from exposures and conversions."""
        if self.hours == 0:
            return exposures_by_day(exposed, self.dims)
        return conv.window_conversion(exposed, conversions, self.hours, self.label, self.dims)

    def from_counts(self, counts: DataFrame) -> DataFrame:
        """A conversion table from counts at the finest grain: rows add up, users would not."""
        keys = ["project_id", "exposure_date", "exp", "variant", *self.dims]
        summed = counts.groupBy(*keys).agg(
            F.sum("exposed_users").alias("exposed_users"),
            F.sum(f"converted_{self.hours}h").alias("converted_users"),
        )
        return summed.withColumn(self.label, rate("converted_users", "exposed_users"))


ROLLUPS = [
    Rollup("exp_daily_exposures", "event_date", (), 0),
    Rollup("exp_daily_exposures_dim", "event_date", DIMS, 0),
    Rollup("exp_daily_conv_24h", "exposure_date", (), 24),
    Rollup("exp_daily_conv_24h_dim", "exposure_date", DIMS, 24),
    Rollup("exp_daily_conv_7d", "exposure_date", (), 168),
    Rollup("exp_daily_conv_7d_dim", "exposure_date", DIMS, 168),
]
# Fixed value: days the stored daily rows are kept.
KEEP_DAYS = 400
LONGEST_WINDOW_DAYS = 7
# Folders that first conversions are dealt to by a hash of the actor.
BUCKETS = 32

# Stored state below the folder of the rollups, in loads (``sinks.loads``).
DETAIL, FIRSTS = "exp_exposure_detail", "exp_first_conversion"
ACTORS, ACTOR_SKETCHES = "actors_by_day", "actor_sketches_by_day"


@dataclass(frozen=True)
class State:
    """A stored table: the rows of a load, the folders by column, how rows of several loads become fewer, its day."""

    build: Callable[[DataFrame], DataFrame]
    by: tuple[str, ...]
    merge: Callable[[DataFrame], DataFrame]
    day: str | None


def _bucket() -> Column:
    return F.pmod(F.xxhash64("project_id", "uid"), F.lit(BUCKETS)).cast("int")


def _firsts(events: DataFrame) -> DataFrame:
    return conv.first_conversion(events).withColumn("bucket", _bucket())


def _earliest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("project_id", "uid", "bucket").agg(F.min("conv_ts").alias("conv_ts"))


def _sums(build: Callable[[DataFrame], DataFrame], value: str) -> State:
    def merge(rows: DataFrame) -> DataFrame:
        keys = [c for c in rows.columns if c != value]
        return collapse_sum(rows, keys, [value]).withColumn(value, F.col(value).cast(rows.schema[value].dataType))

    return State(build, (), merge, "event_date")


def _merged_sketches(rows: DataFrame) -> DataFrame:
    total = F.sum("events").cast("long").alias("events")
    return rows.groupBy("project_id", "event_date").agg(F.hll_union_agg("actors").alias("actors"), total)


STATE = {
    DETAIL: State(lambda e: exposures(e).withColumn("day", F.to_date("expose_ts")), ("day",), lambda rows: rows, "day"),
    FIRSTS: State(_firsts, ("bucket",), _earliest, None),
    "events_by_day": _sums(metrics.events_by_day, "events"),
    "revenue_by_day": _sums(metrics.revenue_by_day, "revenue"),
    "agents_by_day": _sums(metrics.agents_by_day, "events"),
    ACTORS: State(
        lambda e: e.select("project_id", "event_date", uid().alias("uid")).distinct(), (), lambda rows: rows.distinct(), "event_date"
    ),
    ACTOR_SKETCHES: State(metrics.dau_state, (), _merged_sketches, "event_date"),
}


_SCHEMAS: dict[str, T.StructType] = {}


def state_schema(spark: SparkSession, table: str) -> T.StructType:
    """The columns of a stored table, found once; nothing is run for it."""
    if table in _SCHEMAS:
        return _SCHEMAS[table]
    fields = [*EVENTS.fields, *(T.StructField(n, T.StringType()) for n in ("ua_family", "os_family", "device_class"))]
    schema = STATE[table].build(spark.createDataFrame([], T.StructType(fields))).schema
    _SCHEMAS[table] = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    return _SCHEMAS[table]


def read_state(spark: SparkSession, path: str, table: str, before: int | None = None) -> DataFrame:
    """The rows of a stored table as the loads wrote them (those before one), to be merged by the reader."""
    return loads.read(spark, f"{path}/{table}", state_schema(spark, table), before)


def read_firsts(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """First conversions stored by the loads (before one of them): the minimum per actor."""
    return _earliest(read_state(spark, path, FIRSTS, before)).select("project_id", "uid", "conv_ts")


def read_detail(spark: SparkSession, path: str) -> DataFrame:
    """The stored exposures, with their ``day``."""
    return read_state(spark, path, DETAIL)


def compact(spark: SparkSession, path: str, as_of: str | None = None, keep_days: int = KEEP_DAYS) -> dict[str, int | None]:
    """Merge the loads of all stored tables below ``path``; per table the last load that is in its new base.

    With a day ``as_of`` the rows of days more than ``keep_days`` before it go; first conversions have no day and stay. The tables
    give the same rows to readers before and after, but for these.
    """

    def merged(state: State) -> Callable[[DataFrame], DataFrame]:
        if as_of is None or state.day is None:
            return state.merge
        return lambda rows: keep_days_of(state.merge(rows), state.day, as_of, keep_days)

    return {
        name: loads.compact(spark, f"{path}/{name}", state_schema(spark, name), merged(state), *state.by)
        for name, state in STATE.items()
    }


def clean(spark: SparkSession, path: str) -> int:
    """Delete the loads and bases that ``compact`` has replaced, once their readers have ended."""
    return sum(loads.clean(spark, f"{path}/{name}") for name in STATE)


def buckets_of(actors: DataFrame) -> list[int]:
    """The folders that hold these actors: at most ``BUCKETS`` numbers."""
    return [r["bucket"] for r in actors.select(_bucket().alias("bucket")).distinct().collect()]


def touched_days(new: DataFrame, moved: DataFrame) -> DataFrame:
    """Exposure days whose rollups change with ``new`` events and ``moved`` first conversions
    (``new_ts``, and ``old_ts`` or NULL).

    These are the days of new exposures and the days within the longest window before the old
    and the new first conversion. A later conversion of a user who has one changes nothing.
    """
    days = exposures(new).select(F.to_date("expose_ts").alias("day"))
    ends = F.explode(F.array_compact(F.array("new_ts", "old_ts")))
    span = F.sequence(F.date_sub(F.to_date("ts"), LONGEST_WINDOW_DAYS), F.to_date("ts"))
    return days.unionByName(moved.select(ends.alias("ts")).select(F.explode(span).alias("day"))).distinct()


def refresh(new: DataFrame, path: str, load_id: int = 0, rollups: list[Rollup] = ROLLUPS) -> None:
    """Bring all stored tables below ``path`` up to date after a load of ``new`` events.

    Nothing earlier is read but the state: the folders of first conversions that hold actors concerned, and the stored
    exposures of the days whose numbers change (their folders alone). The additive daily tables get
    the sums of the load; readers add them up. Days and folders are listed on the driver, one value each.
    Loads must come with growing ids; the last one may be repeated.
    """
    spark = new.sparkSession
    fresh = conv.first_conversion(new).withColumnRenamed("conv_ts", "new_ts").persist(StorageLevel.MEMORY_AND_DISK)
    stored = read_state(spark, path, FIRSTS, load_id).filter(F.col("bucket").isin(buckets_of(fresh)))
    known = stored.join(fresh.select("project_id", "uid"), ["project_id", "uid"], "left_semi")
    old = known.groupBy("project_id", "uid").agg(F.min("conv_ts").alias("old_ts"))
    moved = fresh.join(old, ["project_id", "uid"], "left")
    moved = moved.filter(F.col("old_ts").isNull() | (F.col("new_ts") < F.col("old_ts")))
    moved = moved.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        days = [r["day"] for r in touched_days(new, moved).collect()]
        first = moved.select("project_id", "uid", F.col("new_ts").alias("conv_ts"), _bucket().alias("bucket"))
        loads.put(first, f"{path}/{FIRSTS}", load_id, *STATE[FIRSTS].by)
    finally:
        moved.unpersist()
        fresh.unpersist()
    others = [n for n in STATE if n != FIRSTS and (n != "agents_by_day" or "ua_family" in new.columns)]
    _together(lambda n: loads.put(STATE[n].build(new), f"{path}/{n}", load_id, *STATE[n].by), others)
    _rewrite_days(spark, path, days, rollups)


def _together(write: Callable, tables: list) -> None:
    """Write tables that do not depend on one another at the same time; the first failure is raised."""
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, tables))


def _rewrite_days(spark: SparkSession, path: str, days: list, rollups: list[Rollup]) -> None:
    """Recompute day partitions of the rollup tables from the stored state and replace them.

    One join gives the counts of all windows at the finest grain; the coarser conversion tables
    are sums of them.
    """
    exposed = read_detail(spark, path).filter(F.col("day").isin(days)).drop("day")
    exposed = exposed.persist(StorageLevel.MEMORY_AND_DISK)
    hours = tuple(sorted({r.hours for r in rollups if r.hours}))
    counts = None
    if hours:
        firsts = read_state(spark, path, FIRSTS).filter(F.col("bucket").isin(buckets_of(exposed)))
        firsts = firsts.join(exposed.select("project_id", "uid").distinct(), ["project_id", "uid"], "left_semi")
        firsts = firsts.groupBy("project_id", "uid").agg(F.min("conv_ts").alias("conv_ts"))
        counts = conv.window_counts(exposed, firsts, hours, DIMS).persist(StorageLevel.MEMORY_AND_DISK)
    try:

        def write(r: Rollup) -> None:
            table = r.from_counts(counts) if r.hours else exposures_by_day(exposed, r.dims)
            overwrite_days(table, f"{path}/{r.name}", r.day)

        _together(write, rollups)
    finally:
        exposed.unpersist()
        if counts is not None:
            counts.unpersist()


def rebuild(events: DataFrame, path: str, rollups: list[Rollup] = ROLLUPS) -> None:
    """All stored tables from all events, into an empty folder."""
    refresh(events, path, 0, rollups)


def stored_views(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The stored tables by the name of the view each answers."""
    sums = {n: STATE[n].merge(read_state(spark, path, n)) for n in ("events_by_day", "revenue_by_day", "agents_by_day")}
    actors = read_state(spark, path, ACTORS).groupBy("project_id", "event_date")
    return {
        "v_events_trend": sums["events_by_day"],
        "v_revenue_by_day": sums["revenue_by_day"],
        "v_ua_by_day": metrics.ua_by_day(sums["agents_by_day"]),
        "v_os_by_day": metrics.os_by_day(sums["agents_by_day"]),
        "v_dau_trend": actors.agg(F.count_distinct("uid").alias("dau")),
        "exp_exposure_users": read_detail(spark, path).drop("day"),
        "exp_first_level_complete": read_firsts(spark, path),
        **{r.name: read_rollup(spark, path, r) for r in ROLLUPS},
    }


# Versions of the stored tables side by side: one is current, another can be built, compared, and switched to.
CURRENT = "_current"
# What the stored views count or measure; their other columns are keys.
MEASURES = {"events", "revenue", "dau", "conv_ts", "exposures", "users", "exposed_users", "converted_users", "cr_24h", "cr_7d"}


def version_path(spark: SparkSession, root: str, version: str | None = None) -> str:
    """The folder of a version, or of the current one."""
    return f"{root}/{loads.pointed(spark, f'{root}/{CURRENT}') if version is None else version}"


def build_version(events: DataFrame, root: str, version: str) -> None:
    """Recompute everything aside; readers go on with the current version."""
    rebuild(events, version_path(events.sparkSession, root, version))


def verify_version(spark: SparkSession, root: str, version: str) -> dict[str, int]:
    """For each of the stored views the number of keys that differ from the current version; lists without
    a measure are compared by how often each row comes."""
    old = stored_views(spark, version_path(spark, root))
    new = stored_views(spark, version_path(spark, root, version))
    return {name: stored_differences(old[name], new[name]).count() for name in old}


def stored_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Keys of two forms of a stored view that differ."""
    keys = [c for c in left.columns if c not in MEASURES]
    if len(keys) == len(left.columns):
        left, right = (t.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")) for t in (left, right))
    return differences(left, right.select(*left.columns), keys)


def switch_version(spark: SparkSession, root: str, version: str) -> None:
    """Make a version the current one. The switch is the appearance of one small file: until it is
    there the version before it is current, whatever breaks off."""
    where, fs = loads.filesystem(spark, version_path(spark, root, version))
    if not fs.exists(where):
        raise ValueError(f"there is no version {version}")
    loads.point(spark, f"{root}/{CURRENT}", version)


def read_rollup(spark: SparkSession, path: str, rollup: Rollup) -> DataFrame:
    return spark.read.parquet(f"{path}/{rollup.name}").withColumn(
        rollup.day, F.col(rollup.day).cast("date")
    )


def collapse_sum(df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """One row per key with added measures."""
    return df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def collapse_replace(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """One row per key, that of the newest version; ties go to the largest other columns.

    A maximum over a struct combines on the map side, so a key with many versions is cheap.
    """
    rest = [c for c in df.columns if c not in keys and c != version]
    newest = F.max(F.struct(version, *rest)).alias("row")
    return df.groupBy(*keys).agg(newest).select(
        *[F.col(c) if c in keys else F.col(f"row.{c}").alias(c) for c in df.columns]
    )


def differences(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose rows differ or that only one side has."""
    values = [c for c in left.columns if c not in keys]
    a = left.select(*keys, F.struct(*values).alias("a"))
    b = right.select(*keys, F.struct(*values).alias("b"))
    return a.join(b, keys, "full_outer").filter(~F.col("a").eqNullSafe(F.col("b")))
