"""Conversion of exposed users: same day, and within a window after each exposure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.events import rate, uid
from tallyloom.functions.json_text import json_fields
from tallyloom.operators.experiments import EXPOSURE_EVENT, SALTS, TASKS

PRIMARY_EVENT = "level_complete"


def first_conversion(events: DataFrame, event_name: str = PRIMARY_EVENT) -> DataFrame:
    """Time of the first conversion per actor."""
    return (
        events.filter(F.col("event_name") == event_name)
        .groupBy("project_id", uid().alias("uid"))
        .agg(F.min("ts_server").alias("conv_ts"))
    )


def first_conversion_by_experiment(events: DataFrame, running: DataFrame) -> DataFrame:
    """First conversion per experiment and actor, on the primary metric of its config.

    Only events that are the primary metric of an experiment of their project are aggregated. The result has a row per
    pair, so actors are dealt to copies of the experiments and to a fixed number of tasks, as in ``experiments.assign``.
    """
    primary = running.select(
        "project_id",
        F.col("id").alias("exp"),
        F.coalesce("config.metrics.primary", F.lit(PRIMARY_EVENT)).alias("event_name"),
    )
    wanted = events.join(primary.select("project_id", "event_name").distinct(), ["project_id", "event_name"], "left_semi")
    firsts = wanted.groupBy("project_id", "event_name", uid().alias("uid")).agg(
        F.min("ts_server").alias("conv_ts")
    )
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt_")
    keys = ["project_id", "event_name", "salt_"]
    dealt = firsts.withColumn("salt_", F.pmod(F.xxhash64("uid"), F.lit(SALTS)).cast("int")).repartition(TASKS, *keys)
    return dealt.join(primary.select("*", salts).hint("merge"), keys).select(
        "project_id", "exp", "uid", "conv_ts"
    )


def same_day_conversion(events: DataFrame, event_name: str = PRIMARY_EVENT) -> DataFrame:
    """Distinct exposed users of a day and those who converted that day.

    Both sides are distinct per actor and day before the join.
    """
    fields = json_fields(F.col("props_json"), "exp", "variant")
    exposed = (
        events.filter(F.col("event_name") == EXPOSURE_EVENT)
        .withColumn("f", fields)
        .select("project_id", "event_date", F.col("f.exp").alias("exp"), F.col("f.variant").alias("variant"), uid().alias("uid"))
        .distinct()
    )
    converted = (
        events.filter(F.col("event_name") == event_name)
        .select("project_id", "event_date", uid().alias("uid"))
        .distinct()
        .withColumn("hit", F.lit(True))
    )
    counts = (
        exposed.join(converted, ["project_id", "event_date", "uid"], "left")
        .groupBy("project_id", "event_date", "exp", "variant")
        .agg(
            F.count(F.lit(1)).alias("exposed_users"),
            F.count_if(F.col("hit")).alias("converted_users"),
        )
    )
    return counts.withColumn("cr", rate("converted_users", "exposed_users"))


def _joined(
    exposed: DataFrame, conversions: DataFrame, hours: int, keys: list[str], flags: dict[str, int]
) -> DataFrame:
    """Exposures with a flag per window length: the user first converted within it.

    Each first conversion is repeated for the days on which an exposure could lead to it (two
    for a day, eight for a week) and joined on that day too: the join stays an equi join,
    exposures outside the window find no partner, and a user with very many exposures is
    split by day.
    """
    longest = F.make_dt_interval(F.lit(0), F.lit(hours))
    candidates = conversions.withColumn(
        "exposure_date",
        F.explode(F.sequence(F.to_date(F.col("conv_ts") - longest), F.to_date("conv_ts"))),
    )
    on = ["project_id", "uid", "exposure_date"]
    if "exp" in conversions.columns:
        on.append("exp")

    def hit(window: int) -> Column:
        start = F.col("conv_ts") - F.make_dt_interval(F.lit(0), F.lit(window))
        return F.coalesce(F.col("expose_ts").between(start, F.col("conv_ts")), F.lit(False))

    return (
        exposed.withColumn("exposure_date", F.to_date("expose_ts"))
        .join(candidates, on, "left")
        .select(*keys, "uid", *[hit(w).alias(name) for name, w in flags.items()])
    )


def window_counts(
    exposed: DataFrame, conversions: DataFrame, hours: tuple[int, ...], dims: tuple[str, ...] = ()
) -> DataFrame:
    """Exposure rows, and converted rows per window as ``converted_<hours>h``, from one join."""
    keys = ["project_id", "exposure_date", "exp", "variant", *dims]
    flags = {f"hit_{h}": h for h in hours}
    return (
        _joined(exposed, conversions, max(hours), keys, flags)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("exposed_users"),
            *[F.count_if(f"hit_{h}").alias(f"converted_{h}h") for h in hours],
        )
    )


def window_conversion(
    exposed: DataFrame,
    conversions: DataFrame,
    hours: int,
    rate_name: str,
    dims: tuple[str, ...] = (),
    distinct: bool = False,
) -> DataFrame:
    """Exposure rows, and those whose user first converted within ``hours`` after them.

    Both ends of the window count. ``distinct`` adds the counts of distinct users.
    """
    keys = ["project_id", "exposure_date", "exp", "variant", *dims]
    joined = _joined(exposed, conversions, hours, keys, {"hit": hours})
    rows, hits = F.count(F.lit(1)), F.count_if("hit")
    if distinct:
        users = joined.groupBy(*keys, "uid").agg(rows.alias("rows"), hits.alias("hits"))
        counts = users.groupBy(*keys).agg(
            F.sum("rows").alias("exposed_users"),
            F.sum("hits").alias("converted_users"),
            F.count(F.lit(1)).alias("exposed_users_distinct"),
            F.count_if(F.col("hits") > 0).alias("converted_users_distinct"),
        )
    else:
        counts = joined.groupBy(*keys).agg(
            rows.alias("exposed_users"), hits.alias("converted_users")
        )
    return counts.withColumn(rate_name, rate("converted_users", "exposed_users"))


def conversion_24h(exposed: DataFrame, conversions: DataFrame, dims: tuple[str, ...] = (), **kw) -> DataFrame:
    return window_conversion(exposed, conversions, 24, "cr_24h", dims, **kw)


def conversion_7d(exposed: DataFrame, conversions: DataFrame, dims: tuple[str, ...] = (), **kw) -> DataFrame:
    return window_conversion(exposed, conversions, 7 * 24, "cr_7d", dims, **kw)
