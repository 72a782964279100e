"""Counts, active users, revenue, agents, retention, funnels and sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog.registry import query
from tallyloom.catalog.sql import AS_OF, EV, funnel_view, ratio, view_sql, with_
from tallyloom.catalog.stored import stored_path
from tallyloom.operators import funnel, metrics, retention, rollups, sessions
from tallyloom.operators.rollups import ACTOR_SKETCHES, read_state
from tallyloom.sources import testdata


@query("events_by_day", view_sql("v_events_trend"))
def events_by_day(spark, sf):
    return metrics.events_by_day(testdata.events(spark, sf))


@query("dau", view_sql("v_dau_trend"))
def dau(spark, sf):
    return metrics.dau(testdata.events(spark, sf))


@query(
    "dau_approx",
    with_(
        EV,
        body="SELECT project_id, CAST(event_date AS VARCHAR) AS event_date, count(DISTINCT uid) AS exact, "
        "true AS within_10_percent FROM ev GROUP BY ALL",
    ),
)
def dau_approx(spark, sf):
    """The estimate next to the exact count."""
    events = testdata.events(spark, sf)
    keys = ["project_id", "event_date"]
    estimate = metrics.dau(events, approximate=True).withColumnRenamed("dau", "estimate")
    both = metrics.dau(events).join(estimate, keys)
    close = F.abs(F.col("estimate") - F.col("dau")) <= F.col("dau") * 0.1
    return both.select(*keys, F.col("dau").alias("exact"), close.alias("within_10_percent"))


@query("revenue_by_day", view_sql("v_revenue_by_day"))
def revenue_by_day(spark, sf):
    return metrics.revenue_by_day(testdata.events(spark, sf))


@query("ua_by_day", view_sql("v_ua_by_day"))
def ua_by_day(spark, sf):
    return metrics.ua_by_day(metrics.agents_by_day(testdata.events(spark, sf)))


@query("os_by_day", view_sql("v_os_by_day"))
def os_by_day(spark, sf):
    return metrics.os_by_day(metrics.agents_by_day(testdata.events(spark, sf)))


def _top(family: str) -> str:
    body = (
        f"SELECT {family}, count(*) AS c FROM ev WHERE ts_server >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY "
        f"GROUP BY ALL ORDER BY c DESC, {family} LIMIT 20"
    )
    return with_(EV, body=body)


@query("ua_top20", _top("ua_family"))
def ua_top20(spark, sf):
    return metrics.top_families(testdata.events(spark, sf), "ua_family", AS_OF)


@query("os_top20", _top("os_family"))
def os_top20(spark, sf):
    return metrics.top_families(testdata.events(spark, sf), "os_family", AS_OF)


@query("device_class_share", with_(EV, body="SELECT device_class, count(*) AS c FROM ev GROUP BY ALL"))
def device_class_share(spark, sf):
    return metrics.device_classes(testdata.events(spark, sf))


@query(
    "ua_trend",
    with_(EV, body="SELECT CAST(event_date AS VARCHAR) AS event_date, ua_family, count(*) AS events FROM ev GROUP BY ALL"),
)
def ua_trend(spark, sf):
    return metrics.ua_trend(testdata.events(spark, sf))


@query(
    "dau_sketch",
    with_(
        EV,
        body="SELECT project_id, CAST(event_date AS VARCHAR) AS event_date, count(DISTINCT uid) AS exact, "
        "count(*) AS events, true AS within_5_percent FROM ev GROUP BY ALL",
    ),
)
def dau_sketch(spark, sf):
    """Stored sketches merged per day, next to the exact count."""
    events = testdata.events(spark, sf)
    keys = ["project_id", "event_date"]
    state = read_state(spark, stored_path(spark, sf), ACTOR_SKETCHES)
    merged = metrics.merge_state(state, *keys)
    both = metrics.dau(events).join(merged, keys)
    close = F.abs(F.col("actors") - F.col("dau")) <= F.col("dau") * 0.05
    return both.select(*keys, F.col("dau").alias("exact"), "events", close.alias("within_5_percent"))


@query(
    "monthly_actors_sketch",
    with_(
        EV,
        body="SELECT project_id, strftime(event_date, '%Y-%m') AS month, count(DISTINCT uid) AS exact, count(*) AS events, "
        "true AS within_5_percent FROM ev GROUP BY ALL",
    ),
)
def monthly_actors_sketch(spark, sf):
    """Stored day sketches merged to months: the coarser grain needs no second scan."""
    month = F.date_format("event_date", "yyyy-MM")
    events = testdata.events(spark, sf).withColumn("month", month)
    state = read_state(spark, stored_path(spark, sf), ACTOR_SKETCHES).withColumn("month", month)
    merged = metrics.merge_state(state, "project_id", "month")
    exact = events.groupBy("project_id", "month").agg(
        F.count_distinct(F.when(F.col("user_id") != "", F.col("user_id")).otherwise(F.col("device_id"))).alias("exact")
    )
    close = F.abs(F.col("actors") - F.col("exact")) <= F.col("exact") * 0.05
    return exact.join(merged, ["project_id", "month"]).select("project_id", "month", "exact", "events", close.alias("within_5_percent"))


@query(
    "retention_d1",
    with_(
        EV,
        body=f"""SELECT project_id, CAST(cohort AS VARCHAR) AS cohort_day, d0_users, d1_return,
          {ratio('d1_return', 'd0_users')} AS d1_retention FROM (
          SELECT f.project_id, f.d0 AS cohort, count(*) FILTER (WHERE a.d = f.d0) AS d0_users,
            count(*) FILTER (WHERE a.d = f.d0 + 1) AS d1_return
          FROM (SELECT project_id, uid, min(event_date) AS d0 FROM ev GROUP BY ALL) f
          LEFT JOIN (SELECT DISTINCT project_id, uid, event_date AS d FROM ev) a
            ON a.project_id = f.project_id AND a.uid = f.uid GROUP BY ALL)""",
    ),
)
def retention_d1(spark, sf):
    return retention.d1_retention(testdata.events(spark, sf))


@query("retention_daily", view_sql("retention_daily"))
def retention_daily(spark, sf):
    return retention.retention_daily(testdata.events(spark, sf))


@query(
    "retention_daily_ttl",
    with_(
        EV,
        body="""SELECT project_id, CAST(cohort_date AS VARCHAR) AS cohort_date, datediff('day', cohort_date, event_date) AS d,
          count(*) AS users FROM (
            WITH RECURSIVE days AS (
              SELECT DISTINCT project_id, uid, event_date, min(event_date) OVER (PARTITION BY project_id, uid) AS first FROM ev),
            starts AS (
              SELECT project_id, uid, first AS cohort_date FROM days GROUP BY ALL
              UNION ALL
              SELECT s.project_id, s.uid, (SELECT min(d.event_date) FROM days d WHERE d.project_id = s.project_id
                AND d.uid = s.uid AND d.event_date >= s.cohort_date + 4) AS cohort_date
              FROM starts s WHERE EXISTS (SELECT 1 FROM days d WHERE d.project_id = s.project_id
                AND d.uid = s.uid AND d.event_date >= s.cohort_date + 4))
            SELECT d.project_id, d.uid, d.event_date, d.first, max(s.cohort_date) AS cohort_date
            FROM days d JOIN starts s ON s.project_id = d.project_id AND s.uid = d.uid AND s.cohort_date <= d.event_date
            GROUP BY ALL)
          WHERE datediff('day', cohort_date, event_date) IN (0, 1, 2) GROUP BY ALL""",
    ),
)
def retention_daily_ttl(spark, sf):
    """Cohorts that end after four days, on day offsets 0, 1 and 2."""
    return retention.retention_daily(testdata.events(spark, sf), (0, 1, 2), ttl_days=4)


@query(
    "retention_pivot",
    with_(
        EV,
        body="""SELECT CAST(cohort_date AS VARCHAR) AS cohort_date,
          CAST(sum(users) FILTER (WHERE d = 0) AS BIGINT) AS d0, CAST(sum(users) FILTER (WHERE d = 1) AS BIGINT) AS d1,
          CAST(sum(users) FILTER (WHERE d = 7) AS BIGINT) AS d7, CAST(sum(users) FILTER (WHERE d = 30) AS BIGINT) AS d30
          FROM (SELECT project_id, cohort_date, datediff('day', cohort_date, event_date) AS d, count(*) AS users FROM (
            SELECT project_id, uid, event_date, min(event_date) OVER (PARTITION BY project_id, uid) AS cohort_date
            FROM (SELECT DISTINCT project_id, uid, event_date FROM ev)) GROUP BY ALL) GROUP BY cohort_date""",
    ),
)
def retention_pivot(spark, sf):
    return retention.retention_pivot(retention.retention_daily(testdata.events(spark, sf)))


@query(
    "funnel_all_time",
    with_(
        EV,
        body=f"""SELECT project_id, started, completed, {ratio('completed', 'started')} AS cr FROM (
          SELECT s.project_id, count(*) AS started, count(*) FILTER (WHERE c.t >= s.t) AS completed
          FROM (SELECT project_id, uid, min(ts_server) AS t FROM ev WHERE event_name = 'level_start' GROUP BY ALL) s
          LEFT JOIN (SELECT project_id, uid, min(ts_server) AS t FROM ev WHERE event_name = 'level_complete' GROUP BY ALL) c
            ON c.project_id = s.project_id AND c.uid = s.uid GROUP BY ALL)""",
    ),
)
def funnel_all_time(spark, sf):
    return funnel.all_time_funnel(testdata.events(spark, sf))


@query("funnel_daily", view_sql("funnels_2step"))
def funnel_daily(spark, sf):
    return funnel.daily_funnel(testdata.events(spark, sf))


@query(
    "funnel_daily_2h",
    with_(
        EV,
        body="SELECT project_id, CAST(event_date AS VARCHAR) AS event_date, step1, step2, started, completed "
        f"FROM ({funnel_view('level_start', 'revenue', 2)})",
    ),
)
def funnel_daily_2h(spark, sf):
    """Other steps and a timeout below a day."""
    return funnel.daily_funnel(testdata.events(spark, sf), "level_start", "revenue", timeout_hours=2)


def session_sql(minutes: int) -> str:
    return with_(
        EV,
        body=f"""SELECT project_id,
          upper(substr(sha1(project_id || ':' || uid || ':' || epoch_ms(min(ts_server))), 1, 24)) AS session_id,
          first(user_id ORDER BY ts_server, user_id, device_id) AS user_id,
          first(device_id ORDER BY ts_server, user_id, device_id) AS device_id,
          strftime(min(ts_server), '%Y-%m-%d %H:%M:%S.%g') AS session_start,
          strftime(max(ts_server), '%Y-%m-%d %H:%M:%S.%g') AS session_end,
          CAST(floor((epoch_ms(max(ts_server)) - epoch_ms(min(ts_server))) / 1000) AS BIGINT) AS duration,
          coalesce(first(country ORDER BY ts_server, country) FILTER (WHERE country <> ''), '') AS country,
          count(*) AS events
        FROM (SELECT *, sum(opens) OVER (PARTITION BY project_id, uid ORDER BY ts_server, event_id) AS no FROM (
          SELECT *, CASE WHEN ts_server - lag(ts_server) OVER (PARTITION BY project_id, uid ORDER BY ts_server, event_id)
            <= INTERVAL {minutes} MINUTE THEN 0 ELSE 1 END AS opens FROM ev))
        GROUP BY project_id, uid, no""",
    )


@query("sessions_30m", session_sql(30))
def sessions_30m(spark, sf):
    return sessions.sessions(testdata.events(spark, sf))


@query("sessions_6h", session_sql(360))
def sessions_6h(spark, sf):
    return sessions.sessions(testdata.events(spark, sf), gap_minutes=360)


@query(
    "client_session_roll",
    with_(
        EV,
        body="""SELECT project_id, uid, event_id, CAST(sum(opens) OVER (PARTITION BY project_id, uid ORDER BY ts_server, event_id) AS BIGINT) AS session_no
        FROM (SELECT *, CASE WHEN ts_server - lag(ts_server) OVER (PARTITION BY project_id, uid ORDER BY ts_server, event_id)
          <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens FROM ev)""",
    ),
)
def client_session_roll(spark, sf):
    return sessions.session_of_events(testdata.events(spark, sf))


@query(
    "collapse_sum",
    with_(
        EV,
        body="SELECT project_id, CAST(event_date AS VARCHAR) AS event_date, count(*) AS events FROM ev GROUP BY ALL",
    ),
)
def collapse_sum(spark, sf):
    """Event-name deltas collapsed to the day, as a summing table does on read."""
    deltas = metrics.events_by_day(testdata.events(spark, sf))
    return rollups.collapse_sum(deltas, ["project_id", "event_date"], ["events"])


@query(
    "collapse_replace",
    with_(
        EV,
        body="""SELECT project_id, uid, strftime(max(ts_server), '%Y-%m-%d %H:%M:%S.%g') AS ts_server,
          arg_max(event_id, ts_server) AS event_id, arg_max(event_name, ts_server) AS event_name FROM ev GROUP BY ALL""",
    ),
)
def collapse_replace(spark, sf):
    """The newest event per actor."""
    events = testdata.events(spark, sf)
    actor = F.when(F.col("user_id") != "", F.col("user_id")).otherwise(F.col("device_id"))
    rows = events.select("project_id", actor.alias("uid"), "ts_server", "event_id", "event_name")
    return rollups.collapse_replace(rows, ["project_id", "uid"], "ts_server")
