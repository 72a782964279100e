"""Experiment assignment, configuration checks and exposure counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import versions
from tallyloom.functions.events import uid
from tallyloom.functions.hashing import hash32, hash32_power, hash32_quick, hash32_start, hash32_starts
from tallyloom.functions.json_text import json_fields

EXPOSURE_EVENT = "experiment_exposure"
DIMS = ("platform", "app_version", "country")
DEFAULT_VARIANT = "A"
# Parts into which the users of a project are dealt for the join with its experiments.
SALTS = 64
# Tasks of a join whose result is far larger than its sides.
TASKS = 256
# Variants that are tried without a function over the array.
FEW_VARIANTS = 6


def exposures(events: DataFrame, strict: bool = False) -> DataFrame:
    """One row per exposure event: experiment, variant, actor, time and dimensions."""
    fields = json_fields(F.col("props_json"), "exp", "variant", strict=strict)
    return (
        events.filter(F.col("event_name") == EXPOSURE_EVENT)
        .withColumn("f", fields)
        .select(
            "project_id",
            F.col("f.exp").alias("exp"),
            F.col("f.variant").alias("variant"),
            uid().alias("uid"),
            F.col("ts_server").alias("expose_ts"),
            *DIMS,
        )
    )


def exposures_by_day(exposed: DataFrame, dims: tuple[str, ...] = ()) -> DataFrame:
    """Exposure rows and distinct users per day, experiment, variant and dimensions."""
    keys = ["project_id", F.to_date("expose_ts").alias("event_date"), "exp", "variant", *dims]
    return exposed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("exposures"), F.count_distinct("uid").alias("users")
    )


def _weight(variant: Column, mode: str) -> Column:
    """The share a variant takes on the wheel; a missing or zero weight counts as 1."""
    weight = F.coalesce(variant["weight"], F.lit(0)).cast("long")
    if mode == "android":
        return F.when(weight > 0, weight).otherwise(F.lit(1).cast("long"))
    return F.when(weight != 0, weight).otherwise(F.lit(1).cast("long"))


def prepare_variants(running: DataFrame, mode: str = "canonical") -> DataFrame:
    """Running experiments with the wheel of variants and the hash of ``id:salt:`` ready.

    ``mode`` selects the client rule: ``canonical`` (zero weights count as 1 in the sum and
    on the wheel), ``web`` (zero weights count as 0 in the sum) or ``android`` (signed hash).
    """
    variants = F.coalesce(F.col("config.variants"), F.array().cast("array<struct<name:string,weight:int>>"))
    zero = F.lit(0).cast("long")
    empty = F.array().cast("array<struct<name:string,upto:bigint>>")

    def add(wheel: Column, v: Column) -> Column:
        reached = F.coalesce(F.try_element_at(wheel, F.lit(-1))["upto"], zero)
        step = F.struct(v["name"].alias("name"), (reached + _weight(v, mode)).alias("upto"))
        return F.concat(wheel, F.array(step))

    wheel = F.aggregate(variants, empty, add)
    if mode == "web":
        plain = F.aggregate(
            variants, zero, lambda acc, v: acc + F.coalesce(v["weight"], F.lit(0)).cast("long")
        )
        total = F.when(plain != 0, plain).otherwise(F.size(variants).cast("long"))
    else:
        total = F.try_element_at(wheel, F.lit(-1))["upto"]
    return running.withColumns(
        {
            "wheel": wheel,
            "total": total,
            "prefix_hash": hash32(F.concat(F.col("id"), F.lit(":"), F.col("salt"), F.lit(":"))),
            "signed": F.lit(mode == "android"),
        }
    )


def variant_slot(hashed: Column) -> Column:
    """The place on the wheel of an unsigned hash; NULL for an experiment without variants."""
    signed = F.when(hashed >= 2**31, hashed - 2**32).otherwise(hashed)
    return F.when(F.size("wheel") > 0, F.pmod(F.when(F.col("signed"), signed).otherwise(hashed), F.col("total")))


def variant_at(slot: Column) -> Column:
    """The variant at a place on a wheel of at most ``FEW_VARIANTS``, tried one by one, without a function over the array."""
    names = [F.get("wheel", F.lit(i)) for i in range(FEW_VARIANTS)]
    hit = F.when(slot < names[0]["upto"], names[0]["name"])
    for v in names[1:]:
        hit = hit.when(slot < v["upto"], v["name"])
    return F.when(F.size("wheel") == 0, F.lit(DEFAULT_VARIANT)).otherwise(F.coalesce(hit, names[0]["name"]))


def choose_variant(key: Column, hashed: Column | None = None) -> Column:
    """The variant of ``key``, from the columns ``prepare_variants`` adds; ``hashed`` is its hash behind theirs, if it is known."""
    unsigned = hash32(key, start=F.col("prefix_hash"))
    slot = variant_slot(unsigned if hashed is None else F.coalesce(hashed, unsigned))
    first = F.get("wheel", F.lit(0))["name"]
    hit = F.get(F.filter("wheel", lambda v: slot < v["upto"]), F.lit(0))["name"]
    return F.when(F.size("wheel") > FEW_VARIANTS, F.coalesce(hit, first)).otherwise(variant_at(slot))


def is_targeted(
    platform: str = "platform", app_version: str = "app_version", country: str = "country"
) -> Column:
    """Whether the targeting of ``config`` admits a user; a rule only applies when both the
    rule and the value of the user are present."""
    rules, values = targeting_columns(), user_columns(platform, app_version, country)
    return _admits(lambda name: rules[name] if name in rules else values[name])


def targeting_columns() -> dict[str, Column]:
    """What ``is_targeted`` needs of an experiment, versions and countries ready to compare."""
    t = F.col("config.targeting")
    low, high = t["appVersionMin"], t["appVersionMax"]
    return {
        "for_platform": t["platform"],
        "for_countries": F.transform(t["countries"], F.upper),
        "for_min": F.when(low != "", versions.widened(versions.client_parts(low))),
        "for_max": F.when(high != "", versions.widened(versions.client_parts(high))),
    }


def user_columns(platform: str, app_version: str, country: str) -> dict[str, Column]:
    """What ``is_targeted`` needs of a user; an empty value is none."""
    p, v, c = F.col(platform), F.col(app_version), F.col(country)
    return {
        "of_platform": F.when(p != "", p),
        "of_version": F.when(v != "", versions.widened(versions.client_parts(v))),
        "of_country": F.when(c != "", F.upper(c)),
    }


def _admits(of: Callable[[str], Column] = F.col) -> Column:
    """The targeting of an experiment on a user, from ``targeting_columns`` and ``user_columns``: a rule that has no value, or
    meets no value of the user, lets all pass."""
    p, v, c = of("of_platform"), of("of_version"), of("of_country")
    platforms, countries, low, high = of("for_platform"), of("for_countries"), of("for_min"), of("for_max")

    def passes(rule: Column, value: Column, test: Column) -> Column:
        return ~F.coalesce(rule & value.isNotNull(), F.lit(False)) | F.coalesce(test, F.lit(False))

    return (
        passes(F.size(platforms) > 0, p, F.array_contains(platforms, p))
        & passes(F.size(countries) > 0, c, F.array_contains(countries, c))
        & passes(low.isNotNull(), v, versions.parts_gte(v, low))
        & passes(high.isNotNull(), v, versions.parts_gte(high, v))
    )


def assign(users: DataFrame, running: DataFrame, mode: str = "canonical") -> DataFrame:
    """The variant of each user in each running experiment of the same project.

    ``users`` has ``project_id, key`` and the targeting columns. The result has a row per pair, so all that depends on one
    side is worked out before the join: versions and countries of both, and the hash of a user from each of the starts the
    experiments of the project have (``hash32_starts``). A pair costs comparisons and one multiplication, in generated code.

    Experiments are repeated ``SALTS`` times and users are dealt to the copies, so the users of a large project do not meet in
    one task. The number of tasks is fixed: by the few bytes of both sides they would be too few for the pairs. Nor does their size
    tell that of the copies, so the joins are merge joins.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt_")
    prepared = prepare_variants(running, mode).withColumns(targeting_columns()).select(
        "project_id", "id", "wheel", "total", "prefix_hash", "signed", *targeting_columns()
    )
    starts = prepared.groupBy("project_id").agg(F.collect_set(hash32_start(F.col("prefix_hash"))).alias("starts"))
    dealt = users.select(
        "project_id", "key", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int").alias("salt_"),
        *[value.alias(name) for name, value in user_columns("platform", "app_version", "country").items()],
    ).repartition(TASKS, "project_id", "salt_")
    hashed = dealt.join(starts.select("*", salts).hint("merge"), ["project_id", "salt_"]).withColumns(
        {"hashes": hash32_starts(F.col("key"), F.col("starts")), "power": hash32_power(F.col("key"))}
    ).drop("starts")
    joined = hashed.join(prepared.select("*", salts).hint("merge"), ["project_id", "salt_"]).filter(_admits())
    # Functions over arrays end generated code: a pair would be copied for them with all its columns. Those that need none
    # are settled before, in steps that are each worked out once, and leave their wheel behind.
    hashed = joined.withColumn("hash", hash32_quick(F.col("prefix_hash"), F.col("hashes"), F.col("power")))
    placed = hashed.withColumn("slot", variant_slot(F.col("hash")))
    settled = F.col("hash").isNotNull() & (F.size("wheel") <= FEW_VARIANTS)
    quick = placed.select(
        "project_id", "id", "key", "total", "prefix_hash", "signed", "hash",
        F.when(settled, variant_at(F.col("slot"))).alias("quick"),
        F.when(~settled, F.col("wheel")).alias("wheel"),
    )
    slow = choose_variant(F.col("key"), F.col("hash"))
    return quick.select(
        "project_id",
        F.col("id").alias("exp"),
        "key",
        F.when(F.col("wheel").isNull(), F.col("quick")).otherwise(slow).alias("variant"),
    )


def exposure_events(assigned: DataFrame) -> DataFrame:
    """Assignments as exposure events, the props as a client sends them."""
    return assigned.select(
        "project_id",
        F.lit(EXPOSURE_EVENT).alias("event_name"),
        F.col("key").alias("user_id"),
        F.to_json(F.struct("exp", "variant")).alias("props_json"),
    )


def config_error(config_json: str = "config_json") -> Column:
    """The first rule a configuration breaks, as a message; NULL when it is valid. The messages
    and their order are fixed values.

    A missing configuration is valid. Types matter, so the text is read as VARIANT.
    """
    doc = F.try_parse_json(config_json)

    def member(path: str) -> Column:
        return F.try_variant_get(doc, path, "variant")

    def kind(value: Column) -> Column:
        return F.schema_of_variant(value)

    def present(value: Column) -> Column:
        return value.isNotNull() & ~F.is_variant_null(value)

    def is_text(value: Column) -> Column:
        return kind(value) == "STRING"

    def is_list(value: Column) -> Column:
        return kind(value).startswith("ARRAY")

    def is_object(value: Column) -> Column:
        return kind(value).startswith("OBJECT")

    def number(value: Column) -> Column:
        return kind(value).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")

    variants = F.try_variant_get(doc, "$.variants", "array<variant>")

    def name(v: Column) -> Column:
        return F.try_variant_get(v, "$.name", "variant")

    def weight(v: Column) -> Column:
        return F.try_variant_get(v, "$.weight", "variant")

    def share(v: Column) -> Column:
        return F.when(
            present(weight(v)), F.try_variant_get(v, "$.weight", "double").cast("long")
        ).otherwise(F.lit(1).cast("long"))

    def variant_error(v: Column) -> Column:
        return (
            F.when(~is_object(v), F.lit("variant must be object"))
            .when(
                name(v).isNull() | ~is_text(name(v)) | (name(v).cast("string") == ""),
                F.lit("variant.name required"),
            )
            .when(present(weight(v)) & ~number(weight(v)), F.lit("variant.weight must be number"))
            .when(present(weight(v)) & (share(v) < 0), F.lit("variant.weight must be >= 0"))
        )

    names = F.transform(variants, lambda v: F.trim(name(v).cast("string")))
    errors = F.transform(variants, variant_error)
    # A repeated name is reported at its own place in the list, after the name check and
    # before the weight checks of that variant.
    placed = F.transform(
        errors,
        lambda e, i: F.when(
            F.coalesce(~e.isin("variant must be object", "variant.name required"), F.lit(True))
            & F.array_contains(F.slice(names, F.lit(1), i), F.get(names, i)),
            F.lit("variant.name must be unique"),
        ).otherwise(e),
    )
    first_error = F.get(F.filter(placed, lambda e: e.isNotNull()), F.lit(0))
    total = F.aggregate(variants, F.lit(0).cast("long"), lambda acc, v: acc + share(v))

    targeting, metrics = member("$.targeting"), member("$.metrics")
    low, high = member("$.targeting.appVersionMin"), member("$.targeting.appVersionMax")
    ordered = versions.lte(low.cast("string"), high.cast("string"), versions.server_parts)
    wrong = (
        F.when(doc.isNull(), F.lit("invalid config JSON"))
        .when(member("$.variants").isNull() | ~is_list(member("$.variants")), F.lit("variants required (array)"))
        .when(F.size(variants) == 0, F.lit("variants must not be empty"))
        .when(F.size(variants) < 2, F.lit("at least 2 variants required"))
        .when(first_error.isNotNull(), first_error)
        .when(total <= 0, F.lit("sum of weights must be > 0"))
    )
    for value, test, message in [
        (targeting, is_object, "targeting must be object"),
        (member("$.targeting.platform"), is_list, "targeting.platform must be array"),
        (member("$.targeting.countries"), is_list, "targeting.countries must be array"),
        (low, is_text, "targeting.appVersionMin must be string"),
        (high, is_text, "targeting.appVersionMax must be string"),
    ]:
        wrong = wrong.when(present(value) & ~test(value), F.lit(message))
    wrong = wrong.when(
        present(low) & present(high) & ~ordered, F.lit("appVersionMin must be <= appVersionMax")
    )
    for value, test, message in [
        (metrics, is_object, "metrics must be object"),
        (member("$.metrics.primary"), is_text, "metrics.primary must be string"),
        (member("$.metrics.secondary"), is_list, "metrics.secondary must be array"),
    ]:
        wrong = wrong.when(present(value) & ~test(value), F.lit(message))
    return F.when(F.col(config_json).isNotNull(), wrong)


def uplift(by_day: DataFrame, metric: str, base: str = "A", other: str = "B") -> DataFrame:
    """Relative change of ``metric`` from variant ``base`` to ``other`` per day."""
    day = "exposure_date" if "exposure_date" in by_day.columns else "event_date"

    def value(variant: str) -> Column:
        return F.max(F.when(F.col("variant") == variant, F.col(metric)))

    sides = by_day.groupBy("project_id", day, "exp").agg(
        value(base).alias("base_value"), value(other).alias("other_value")
    )
    ratio = F.col("other_value") / F.nullif(F.col("base_value"), F.lit(0.0))
    return sides.withColumn("uplift", F.round(ratio - 1, 4))
