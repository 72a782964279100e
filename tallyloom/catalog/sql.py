"""Shared parts of the SQL twins: the test tables as analytics tables, and the views."""

from __future__ import annotations

from tallyloom.sources.testdata import AGENTS, AS_OF, EVENT_NAMES

_NAME = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in EVENT_NAMES.items())


def _pick(index: str, values) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} {cases} END"


EV = f"""base AS (
  SELECT *, date_trunc('millisecond', ts) AS t, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events),
ev AS (
  SELECT 'p' || (user_id % 4) AS project_id, CAST(t AS DATE) AS event_date, t AS ts_server,
    CAST(event_id AS VARCHAR) AS event_id, CASE event_type {_NAME} END AS event_name,
    CASE WHEN user_id % 10 = 0 THEN '' ELSE 'u' || user_id END AS user_id,
    'd' || user_id AS device_id,
    CASE WHEN user_id % 10 = 0 THEN 'd' || user_id ELSE 'u' || user_id END AS uid,
    {_pick('user_id % 3', ['android', 'ios', 'web'])} AS platform,
    '1.' || (user_id % 4) || '.0' AS app_version,
    {_pick('user_id % 5', ['US', 'CN', 'JP', 'DE', ''])} AS country,
    'exp' || (k % 3) AS exp, CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS variant,
    CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,4)) ELSE 0 END AS revenue_amount,
    CASE WHEN user_id % 2 = 0 THEN 'USD' ELSE 'EUR' END AS revenue_currency,
    {_pick(f'user_id % {len(AGENTS)}', [a[0] for a in AGENTS])} AS ua_family,
    {_pick(f'user_id % {len(AGENTS)}', [a[1] for a in AGENTS])} AS os_family,
    {_pick(f'user_id % {len(AGENTS)}', [a[2] for a in AGENTS])} AS device_class
  FROM base)"""

CONV = """conv AS (
  SELECT project_id, uid, min(ts_server) AS conv_ts FROM ev
  WHERE event_name = 'level_complete' GROUP BY ALL)"""
EXPOSED = """exposed AS (
  SELECT *, ts_server AS expose_ts FROM ev WHERE event_name = 'experiment_exposure')"""

DIMS = ["platform", "app_version", "country"]


def with_(*parts: str, body: str) -> str:
    return f"WITH {', '.join(parts)} {body}"


def ratio(top: str, bottom: str, digits: int = 4) -> str:
    return f"round(CAST({top} AS DOUBLE) / nullif({bottom}, 0), {digits})"


def exposures_view(dims: bool) -> str:
    cols = ", ".join(["project_id", "event_date", "exp", "variant", *(DIMS if dims else [])])
    return (
        f"SELECT {cols}, count(*) AS exposures, count(DISTINCT uid) AS users "
        f"FROM exposed GROUP BY {cols}"
    )


def conversion_view(hours: int, dims: bool) -> str:
    cols = ["exp", "variant", *(DIMS if dims else [])]
    picked = ", ".join(f"e.{c}" for c in cols)
    label = "cr_24h" if hours == 24 else "cr_7d"
    hit = f"c.conv_ts >= e.expose_ts AND c.conv_ts <= e.expose_ts + INTERVAL {hours} HOUR"
    return (
        f"SELECT *, {ratio('converted_users', 'exposed_users')} AS {label} FROM ("
        f"SELECT e.project_id, e.event_date AS exposure_date, {picked}, "
        f"count(*) AS exposed_users, count(*) FILTER (WHERE {hit}) AS converted_users "
        f"FROM exposed e LEFT JOIN conv c ON c.project_id = e.project_id AND c.uid = e.uid "
        f"GROUP BY ALL)"
    )


SAME_DAY = f"""SELECT *, {ratio('converted_users', 'exposed_users')} AS cr FROM (
  SELECT x.project_id, x.event_date, x.exp, x.variant, count(*) AS exposed_users,
    count(c.uid) AS converted_users
  FROM (SELECT DISTINCT project_id, event_date, exp, variant, uid FROM exposed) x
  LEFT JOIN (SELECT DISTINCT project_id, event_date, uid FROM ev WHERE event_name = 'level_complete') c
    ON c.project_id = x.project_id AND c.event_date = x.event_date AND c.uid = x.uid
  GROUP BY ALL)"""

RETENTION = """SELECT project_id, cohort_date, datediff('day', cohort_date, event_date) AS d, count(*) AS users
FROM (SELECT project_id, uid, event_date, min(event_date) OVER (PARTITION BY project_id, uid) AS cohort_date
      FROM (SELECT DISTINCT project_id, uid, event_date FROM ev))
WHERE datediff('day', cohort_date, event_date) IN (0, 1, 7, 30) GROUP BY ALL"""


def funnel_view(step1: str = "level_start", step2: str = "level_complete", hours: int = 24) -> str:
    return f"""SELECT project_id, event_date, '{step1}' AS step1, '{step2}' AS step2,
  count(DISTINCT CASE WHEN event_name = '{step1}' THEN uid END) AS started,
  count(DISTINCT CASE WHEN event_name = '{step2}' AND ts_server - last1 <= INTERVAL {hours} HOUR THEN uid END) AS completed
FROM (SELECT *, max(CASE WHEN event_name = '{step1}' THEN ts_server END) OVER (
        PARTITION BY project_id, uid ORDER BY ts_server
        RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last1
      FROM ev WHERE event_name IN ('{step1}', '{step2}'))
GROUP BY ALL HAVING started + completed > 0"""


VIEWS = {
    "v_events_trend": "SELECT project_id, event_date, event_name, count(*) AS events FROM ev GROUP BY ALL",
    "v_dau_trend": "SELECT project_id, event_date, count(DISTINCT uid) AS dau FROM ev GROUP BY ALL",
    "v_revenue_by_day": "SELECT project_id, event_date, revenue_currency, sum(revenue_amount) AS revenue "
    "FROM ev WHERE revenue_amount > 0 GROUP BY ALL",
    "v_ua_by_day": "SELECT project_id, event_date, ua_family, count(*) AS events FROM ev GROUP BY ALL",
    "v_os_by_day": "SELECT project_id, event_date, os_family, count(*) AS events FROM ev GROUP BY ALL",
    "retention_daily": RETENTION,
    "funnels_2step": funnel_view(),
    "v_exp_exposures_by_day": exposures_view(False),
    "v_exp_exposures_by_day_dim": exposures_view(True),
    "v_exp_conversion_same_day": SAME_DAY,
    "v_exp_conversion_24h": conversion_view(24, False),
    "v_exp_conversion_24h_dim": conversion_view(24, True),
    "v_exp_conversion_7d": conversion_view(168, False),
    "v_exp_conversion_7d_dim": conversion_view(168, True),
}
for _name in ["exposures_by_day", "exposures_by_day_dim", "conversion_24h", "conversion_24h_dim", "conversion_7d", "conversion_7d_dim"]:
    VIEWS[f"v_exp_{_name}_fast"] = VIEWS[f"v_exp_{_name}"]

_DATES = {"event_date", "exposure_date", "cohort_date"}
_COLUMNS = {
    "v_events_trend": "project_id event_date event_name events",
    "v_dau_trend": "project_id event_date dau",
    "v_revenue_by_day": "project_id event_date revenue_currency revenue",
    "v_ua_by_day": "project_id event_date ua_family events",
    "v_os_by_day": "project_id event_date os_family events",
    "retention_daily": "project_id cohort_date d users",
    "funnels_2step": "project_id event_date step1 step2 started completed",
    "v_exp_exposures_by_day": "project_id event_date exp variant exposures users",
    "v_exp_exposures_by_day_dim": "project_id event_date exp variant platform app_version country exposures users",
    "v_exp_conversion_same_day": "project_id event_date exp variant exposed_users converted_users cr",
    "v_exp_conversion_24h": "project_id exposure_date exp variant exposed_users converted_users cr_24h",
    "v_exp_conversion_24h_dim": "project_id exposure_date exp variant platform app_version country exposed_users converted_users cr_24h",
    "v_exp_conversion_7d": "project_id exposure_date exp variant exposed_users converted_users cr_7d",
    "v_exp_conversion_7d_dim": "project_id exposure_date exp variant platform app_version country exposed_users converted_users cr_7d",
}


def plain_column(name: str) -> str:
    """A result column in the plain types of the registry."""
    if name in _DATES:
        return f"CAST({name} AS VARCHAR) AS {name}"
    if name == "revenue":
        return "CAST(revenue AS DOUBLE) AS revenue"
    if name in {"d", "events", "users", "dau", "started", "completed", "exposures", "exposed_users", "converted_users"}:
        return f"CAST({name} AS BIGINT) AS {name}"
    return name


def view_sql(view: str) -> str:
    """The whole view in plain types."""
    cols = ", ".join(plain_column(c) for c in _COLUMNS[view].split())
    return with_(EV, EXPOSED, CONV, body=f"SELECT {cols} FROM ({VIEWS[view]})")


__all__ = ["AS_OF", "CONV", "DIMS", "EV", "EXPOSED", "VIEWS", "conversion_view", "funnel_view", "ratio", "view_sql", "with_"]
