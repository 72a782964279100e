"""Assignment, configuration checks, exposures, conversions and their rollups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog.registry import query
from tallyloom.catalog.sql import CONV, DIMS, EV, EXPOSED, VIEWS, conversion_view, view_sql, with_
from tallyloom.operators import conversion as conv
from tallyloom.operators import experiments as exp
from tallyloom.operators import rollups
from tallyloom.plans.views import FAST_VIEWS, view
from tallyloom.session import work_dir
from tallyloom.sources import dimensions, testdata

_TIME = "%Y-%m-%d %H:%M:%S.%g"


@query("exposures_by_day", view_sql("v_exp_exposures_by_day"))
def exposures_by_day(spark, sf):
    return exp.exposures_by_day(exp.exposures(testdata.events(spark, sf)))


@query("exposures_by_day_dim", view_sql("v_exp_exposures_by_day_dim"))
def exposures_by_day_dim(spark, sf):
    return exp.exposures_by_day(exp.exposures(testdata.events(spark, sf)), exp.DIMS)


@query("conv_same_day", view_sql("v_exp_conversion_same_day"))
def conv_same_day(spark, sf):
    return conv.same_day_conversion(testdata.events(spark, sf))


def _conversion(name: str, build, dims: tuple[str, ...]) -> None:
    @query(name, view_sql(f"v_exp_{name.replace('conv_', 'conversion_')}"))
    def run(spark, sf):
        events = testdata.events(spark, sf)
        return build(exp.exposures(events), conv.first_conversion(events), dims)


_conversion("conv_24h", conv.conversion_24h, ())
_conversion("conv_24h_dim", conv.conversion_24h, exp.DIMS)
_conversion("conv_7d", conv.conversion_7d, ())
_conversion("conv_7d_dim", conv.conversion_7d, exp.DIMS)


@query(
    "conv_24h_distinct",
    with_(
        EV, EXPOSED, CONV,
        body="""SELECT project_id, CAST(event_date AS VARCHAR) AS exposure_date, exp, variant, exposed_users, converted_users,
        exposed_users_distinct, converted_users_distinct, round(CAST(converted_users AS DOUBLE) / exposed_users, 4) AS cr_24h FROM (
        SELECT e.project_id, e.event_date, e.exp, e.variant, count(*) AS exposed_users,
          count(*) FILTER (WHERE c.conv_ts BETWEEN e.expose_ts AND e.expose_ts + INTERVAL 24 HOUR) AS converted_users,
          count(DISTINCT e.uid) AS exposed_users_distinct,
          count(DISTINCT e.uid) FILTER (WHERE c.conv_ts BETWEEN e.expose_ts AND e.expose_ts + INTERVAL 24 HOUR) AS converted_users_distinct
        FROM exposed e LEFT JOIN conv c ON c.project_id = e.project_id AND c.uid = e.uid GROUP BY ALL)""",
    ),
)
def conv_24h_distinct(spark, sf):
    """Rows and distinct users side by side."""
    events = testdata.events(spark, sf)
    return conv.conversion_24h(exp.exposures(events), conv.first_conversion(events), distinct=True)


@query(
    "exposure_detail",
    with_(
        EV, EXPOSED,
        body=f"SELECT project_id, exp, variant, uid, strftime(expose_ts, '{_TIME}') AS expose_ts, {', '.join(DIMS)} FROM exposed",
    ),
)
def exposure_detail(spark, sf):
    return exp.exposures(testdata.events(spark, sf))


@query(
    "first_conversion",
    with_(EV, CONV, body=f"SELECT project_id, uid, strftime(conv_ts, '{_TIME}') AS conv_ts FROM conv"),
)
def first_conversion(spark, sf):
    return conv.first_conversion(testdata.events(spark, sf))


# Experiments of the supplier table, and their users, in SQL.
_RUNNING = """running AS (
  SELECT 'exp' || s_suppkey AS id, 'p' || (s_suppkey % 4) AS project_id, s_name AS name,
    CASE WHEN s_suppkey % 2 = 0 THEN 's' || s_suppkey ELSE '' END AS salt,
    s_suppkey % 4 * 10 AS wa, s_suppkey % 3 * 25 AS wb, s_suppkey % 5 AS target,
    CASE WHEN s_suppkey % 2 = 0 THEN 'level_complete' ELSE 'revenue' END AS primary_event,
    s_suppkey
  FROM supplier WHERE s_suppkey % 3 <> 2)"""
_USERS = f"users AS (SELECT DISTINCT project_id, uid AS key, {', '.join(DIMS)} FROM ev)"
_TARGETED = """targeted AS (
  SELECT r.*, u.key FROM running r JOIN users u ON u.project_id = r.project_id
  WHERE CASE target
    WHEN 0 THEN platform IN ('ios', 'web')
    WHEN 1 THEN CAST(split_part(app_version, '.', 2) AS INTEGER) BETWEEN 1 AND 2
      AND NOT (split_part(app_version, '.', 2) = '2' AND CAST(split_part(app_version, '.', 3) AS INTEGER) > 0)
    WHEN 2 THEN country IN ('US', 'DE', '')
    ELSE true END)"""
_FNV = (
    "list_reduce(list_prepend(2166136261::BIGINT, list_transform(string_split({0}, ''), lambda c: unicode(c)::BIGINT)), "
    "lambda h, x: (xor(h, x) * 16777619) & 4294967295)"
)


def _assigned(mode: str) -> str:
    key = _FNV.format("(id || ':' || salt || ':' || key)")
    plain = "CASE WHEN {0} > 0 THEN {0} ELSE 1 END"
    a, b = plain.format("wa"), plain.format("wb")
    total = f"({a} + {b} + 1)"
    slot = f"h % {total}"
    if mode == "web":
        slot = "h % (CASE WHEN wa + wb > 0 THEN wa + wb ELSE 3 END)"
    elif mode == "android":
        signed = "(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END)"
        slot = f"(({signed} % {total}) + {total}) % {total}"
    return with_(
        EV, _RUNNING, _USERS, _TARGETED,
        body=f"""SELECT project_id, id AS exp, key, CASE WHEN slot < {a} THEN 'A' WHEN slot < {a} + {b} THEN 'B'
          WHEN slot < {total} THEN 'C' ELSE 'A' END AS variant
        FROM (SELECT *, {slot} AS slot FROM (SELECT *, {key} AS h FROM targeted))""",
    )


def _assign(name: str, mode: str) -> None:
    @query(name, _assigned(mode))
    def run(spark, sf):
        running = dimensions.running_experiments(testdata.experiments(spark, sf))
        return exp.assign(testdata.experiment_users(spark, sf), running, mode)


_assign("assign", "canonical")
_assign("assign_web", "web")
_assign("assign_android", "android")


@query(
    "assigned_exposures",
    f"SELECT project_id, 'experiment_exposure' AS event_name, key AS user_id, "
    f"'{{\"exp\":\"' || exp || '\",\"variant\":\"' || variant || '\"}}' AS props_json FROM ({_assigned('canonical')})",
)
def assigned_exposures(spark, sf):
    """Assignments as the exposure events a client sends."""
    running = dimensions.running_experiments(testdata.experiments(spark, sf))
    return exp.exposure_events(exp.assign(testdata.experiment_users(spark, sf), running))


@query(
    "hash32",
    f"SELECT event_id, {_FNV.format('props')} AS h FROM events",
)
def hash32(spark, sf):
    """The hash of every props text."""
    from tallyloom.functions.hashing import hash32 as fnv

    return testdata.table(spark, sf, "events").select("event_id", fnv(F.col("props")).alias("h"))


@query(
    "first_conversion_by_experiment",
    with_(
        EV, _RUNNING,
        body=f"""SELECT r.project_id, r.id AS exp, e.uid, strftime(min(e.ts_server), '{_TIME}') AS conv_ts
        FROM ev e JOIN running r ON r.project_id = e.project_id AND r.primary_event = e.event_name GROUP BY ALL""",
    ),
)
def first_conversion_by_experiment(spark, sf):
    running = dimensions.running_experiments(testdata.experiments(spark, sf))
    return conv.first_conversion_by_experiment(testdata.events(spark, sf), running)


def _config_cases() -> str:
    cases = testdata.CONFIG_CASES
    whens = " ".join(f"WHEN {i} THEN '{m}'" for i, (_, m) in enumerate(cases) if m)
    return f"SELECT p_partkey AS config_id, CASE p_partkey % {len(cases)} {whens} END AS error FROM part"


@query("config_errors", _config_cases())
def config_errors(spark, sf):
    return testdata.config_texts(spark, sf).select("config_id", exp.config_error().alias("error"))


@query(
    "running_configs",
    with_(
        _RUNNING,
        body="""SELECT project_id, id, salt, name, 3 AS variants, primary_event AS primary_metric FROM running""",
    ),
)
def running_configs(spark, sf):
    running = dimensions.running_experiments(testdata.experiments(spark, sf))
    return running.select(
        "project_id", "id", "salt", "name",
        F.size("config.variants").alias("variants"),
        F.col("config.metrics.primary").alias("primary_metric"),
    )


@query(
    "list_experiments",
    f"""SELECT 'exp' || s_suppkey AS id, s_name AS name, 'running' AS status,
      strftime(TIMESTAMP '2024-01-01' + to_days(CAST(s_suppkey % 7 AS INTEGER)), '{_TIME}') AS updated_at
    FROM supplier WHERE s_suppkey % 4 = 1 AND s_suppkey % 3 <> 2""",
)
def list_experiments(spark, sf):
    listed = dimensions.list_experiments(testdata.experiments(spark, sf), "p1", "running")
    return listed.select("id", "name", "status", "updated_at")


@query(
    "uplift_24h",
    with_(
        EV, EXPOSED, CONV,
        body=f"""SELECT project_id, CAST(exposure_date AS VARCHAR) AS exposure_date, exp, base_value, other_value,
          round(other_value / nullif(base_value, 0) - 1, 4) AS uplift FROM (
          SELECT project_id, exposure_date, exp, max(cr_24h) FILTER (WHERE variant = 'A') AS base_value,
            max(cr_24h) FILTER (WHERE variant = 'B') AS other_value
          FROM ({conversion_view(24, False)}) GROUP BY ALL)""",
    ),
)
def uplift_24h(spark, sf):
    return exp.uplift(view(testdata.events(spark, sf), "v_exp_conversion_24h"), "cr_24h")


def _rollup(rollup: rollups.Rollup) -> None:
    """The stored table, built in two refreshes split by the parity of the day."""
    name = "rollup_" + rollup.name.removeprefix("exp_daily_")
    source = next(v for v, t in FAST_VIEWS.items() if t == rollup.name)

    @query(name, view_sql(source.removesuffix("_fast")))
    def run(spark, sf):
        path = work_dir(spark, name)
        events = testdata.events(spark, sf)
        odd = F.dayofmonth("event_date") % 2 == 1
        rollups.refresh(events.filter(odd), path, 0, [rollup])
        rollups.refresh(events.filter(~odd), path, 1, [rollup])
        return rollups.read_rollup(spark, path, rollup).select(*view(events, source).columns)


for _r in rollups.ROLLUPS:
    _rollup(_r)


@query(
    "fast_equals_raw",
    with_(
        EV, EXPOSED, CONV,
        body=" UNION ALL ".join(
            f"SELECT '{table}' AS table_name, count(*) AS rows, 0 AS mismatches FROM ({VIEWS[v]})"
            for v, table in FAST_VIEWS.items()
        ),
    ),
)
def fast_equals_raw(spark, sf):
    """All stored rollups, built from three arrivals with late conversions, against the views."""
    path = work_dir(spark, "fast")
    events = testdata.events(spark, sf)
    part = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for i in range(3):
        rollups.refresh(events.filter(part == i), path, i)
    result = None
    for rollup in rollups.ROLLUPS:
        raw = view(events, rollup.name)
        stored = rollups.read_rollup(spark, path, rollup).select(*raw.columns)
        measures = 2 if rollup.hours == 0 else 3
        wrong = rollups.differences(raw, stored, raw.columns[:-measures])
        count = raw.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(rollup.name).alias("table_name"), "rows")
        row = count.join(
            wrong.agg(F.count(F.lit(1)).alias("mismatches")).withColumn("table_name", F.lit(rollup.name)),
            "table_name",
        )
        result = row if result is None else result.unionByName(row)
    return result


@query("rollup_versions", view_sql("v_exp_conversion_24h_dim"))
def rollup_versions(spark, sf):
    """A version of the stored tables that lacks late events, one recomputed aside, compared and switched to."""
    root = work_dir(spark, "versions")
    events = testdata.events(spark, sf)
    rollups.build_version(events.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) > 0), root, "v1")
    rollups.switch_version(spark, root, "v1")
    rollups.build_version(events, root, "v2")
    if any(rollups.verify_version(spark, root, "v2").values()):
        rollups.switch_version(spark, root, "v2")
    rollup = next(r for r in rollups.ROLLUPS if r.name == "exp_daily_conv_24h_dim")
    table = rollups.read_rollup(spark, rollups.version_path(spark, root), rollup)
    return table.select(*view(events, rollup.name).columns)
