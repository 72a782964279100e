"""Organization, game, user and key reports; quotas and rate limits."""

from __future__ import annotations

from tallyloom.catalog.registry import query
from tallyloom.catalog.sql import AS_OF, EV, with_
from tallyloom.operators import tenants, usage
from tallyloom.sources import testdata

_TIME = "%Y-%m-%d %H:%M:%S.%g"


def organizations_sql(source: str = "nation", key: str = "n_nationkey", name: str = "n_name") -> str:
    return f"""orgs AS (SELECT 'org' || {key} AS id, {name} AS name,
  CASE {key} % 3 WHEN 0 THEN 'FREE' WHEN 1 THEN 'PRO' ELSE 'ENTERPRISE' END AS tier,
  CASE WHEN {key} % 4 = 3 THEN 'SUSPENDED' ELSE 'ACTIVE' END AS status,
  CASE {key} % 3 WHEN 0 THEN 4 WHEN 1 THEN 50 ELSE 1000 END AS max_games,
  CASE {key} % 3 WHEN 0 THEN 100 WHEN 1 THEN 100000000 ELSE -1 END AS max_events,
  CASE {key} % 3 WHEN 0 THEN 90 WHEN 1 THEN 365 ELSE 1095 END AS retention_days,
  {key} % 11 = 10 AS deleted FROM {source})"""


ORGS = organizations_sql()
# The statistics over all organizations take one per customer, so that they grow.
CUSTOMER_ORGS = ("customer", "c_custkey", "c_name")
GAMES = """games AS (SELECT 'p' || s_suppkey AS id, 'org' || s_nationkey AS org_id, s_name AS name, s_suppkey,
  CASE s_suppkey % 4 WHEN 0 THEN 'LIVE' WHEN 1 THEN 'DEVELOPMENT' WHEN 2 THEN 'TESTING' ELSE 'MAINTENANCE' END AS status,
  s_suppkey % 2 = 0 AS has_multiplayer, s_suppkey % 13 = 12 AS deleted FROM supplier)"""
USERS = """users AS (SELECT CAST(c_custkey AS VARCHAR) AS id, 'c' || c_custkey || '@ex.com' AS email, c_name AS name,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'ADMIN' ELSE 'USER' END AS global_role,
  'org' || c_nationkey AS org_id, c_custkey % 17 = 16 AS deleted FROM customer)"""
KEYS = """keys AS (SELECT 'key' || s_suppkey AS api_key, 'p' || s_suppkey AS project_id, s_suppkey AS s,
  CASE WHEN s_suppkey % 4 <> 0 THEN 'org' || s_nationkey END AS org_id,
  CASE WHEN s_suppkey % 4 <> 0 THEN 'p' || s_suppkey END AS game_id,
  CASE WHEN s_suppkey % 9 = 8 THEN 'REVOKED' ELSE 'ACTIVE' END AS status,
  s_suppkey * 37 % 1000 AS total_requests, s_suppkey * 911 % 10000 AS total_events,
  CASE WHEN s_suppkey % 5 <> 0 THEN DATE '2024-01-01' + CAST(s_suppkey % 60 AS INTEGER) END AS expires_at,
  CASE WHEN s_suppkey % 6 <> 0 THEN DATE '2023-12-01' + CAST(s_suppkey % 61 AS INTEGER) END AS last_used_at,
  DATE '2023-06-01' + CAST(s_suppkey % 200 AS INTEGER) AS created_at FROM supplier)"""
REQUESTS = """requests AS (SELECT 'key' || (user_id % 4) AS api_key,
  '10.' || (user_id % 256) || '.' || (event_id % 256) || '.7' AS client_ip, event_id AS request_id, ts,
  CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS events FROM events)"""


def _tables(spark, sf):
    return tuple(
        f(spark, sf)
        for f in (testdata.organizations, testdata.games, testdata.users, testdata.api_keys)
    )


def _org_stats(counts: str) -> str:
    return with_(
        ORGS, GAMES, USERS, KEYS,
        body=f"SELECT o.id AS org_id, o.name AS org_name, o.tier, {counts} FROM orgs o WHERE NOT o.deleted",
    )


_CORRECT = """
  (SELECT count(*) FROM games g WHERE g.org_id = o.id AND NOT g.deleted) AS total_games,
  (SELECT count(*) FROM games g WHERE g.org_id = o.id AND NOT g.deleted AND g.status = 'LIVE') AS live_games,
  (SELECT count(*) FROM users u WHERE u.org_id = o.id AND NOT u.deleted) AS total_users,
  (SELECT count(*) FROM keys k WHERE k.org_id = o.id) AS total_api_keys,
  CAST(coalesce((SELECT sum(total_events) FROM keys k WHERE k.org_id = o.id), 0) AS BIGINT) AS total_events_processed"""


@query("org_stats", _org_stats(_CORRECT))
def org_stats(spark, sf):
    return tenants.organization_stats(*_tables(spark, sf))


@query(
    "org_stats_as_written",
    with_(
        ORGS, GAMES, USERS, KEYS,
        body="""SELECT o.id AS org_id, o.name AS org_name, o.tier, count(g.id) AS total_games,
          count(CASE WHEN g.status = 'LIVE' THEN 1 END) AS live_games, count(u.id) AS total_users,
          count(k.api_key) AS total_api_keys, CAST(coalesce(sum(k.total_events), 0) AS BIGINT) AS total_events_processed
        FROM orgs o LEFT JOIN games g ON o.id = g.org_id AND NOT g.deleted
          LEFT JOIN users u ON o.id = u.org_id AND NOT u.deleted LEFT JOIN keys k ON o.id = k.org_id
        WHERE NOT o.deleted GROUP BY o.id, o.name, o.tier""",
    ),
)
def org_stats_as_written(spark, sf):
    return tenants.organization_stats(*_tables(spark, sf), as_written=True)


@query(
    "user_permissions",
    with_(
        ORGS, GAMES, USERS,
        """roles AS (SELECT CAST(o_custkey AS VARCHAR) AS user_id, 'org' || (o_orderkey % 30) AS org_id,
          CASE WHEN o_orderkey % 2 = 0 THEN 'p' || (o_orderkey % 150) END AS game_id,
          CASE WHEN o_orderpriority = '1-URGENT' THEN 'GAME_ADMIN' ELSE 'VIEWER' END AS role,
          CASE WHEN o_orderkey % 2 = 0 THEN 'GAME' ELSE 'ORGANIZATION' END AS scope
          FROM orders)""",
        body="""SELECT u.id AS user_id, u.email, u.name, u.global_role, r.org_id, r.game_id,
          CAST(NULL AS VARCHAR) AS environment_id, r.role, r.scope, o.name AS org_name, g.name AS game_name
        FROM users u LEFT JOIN roles r ON u.id = r.user_id LEFT JOIN orgs o ON r.org_id = o.id
          LEFT JOIN games g ON r.game_id = g.id WHERE NOT u.deleted""",
    ),
)
def user_permissions(spark, sf):
    orgs, games, users, _ = _tables(spark, sf)
    return tenants.user_permissions(users, testdata.roles(spark, sf), orgs, games)


@query(
    "upgrade_candidates",
    with_(
        ORGS, GAMES,
        body="""SELECT org_id, name, max_games, games FROM (
          SELECT o.id AS org_id, o.name, o.max_games,
            (SELECT count(*) FROM games g WHERE g.org_id = o.id AND NOT g.deleted) AS games
          FROM orgs o WHERE o.tier = 'FREE') WHERE games >= max_games""",
    ),
)
def upgrade_candidates(spark, sf):
    orgs, games, _, _ = _tables(spark, sf)
    return tenants.upgrade_candidates(orgs, games)


@query(
    "missing_games",
    with_(
        GAMES,
        "projects AS (SELECT 'p' || (p_partkey % 250) AS id, min(p_name) AS name FROM part GROUP BY 1)",
        body="""SELECT id, 'org_system' AS org_id, name, name AS display_name FROM projects p
          WHERE NOT EXISTS (SELECT 1 FROM games g WHERE g.id = p.id)""",
    ),
)
def missing_games(spark, sf):
    from pyspark.sql import functions as F

    part = testdata.table(spark, sf, "part")
    projects = part.groupBy(F.concat(F.lit("p"), (F.col("p_partkey") % 250).cast("string")).alias("id")).agg(
        F.min("p_name").alias("name")
    )
    return tenants.missing_games(projects, testdata.games(spark, sf))


@query(
    "missing_environments",
    with_(
        GAMES,
        body="""SELECT 'env_' || id || '_prod' AS id, id AS game_id, 'production' AS name,
          'Production Environment' AS display_name, 'PRODUCTION' AS type, 'ACTIVE' AS status
        FROM games WHERE s_suppkey % 3 = 0""",
    ),
)
def missing_environments(spark, sf):
    return tenants.missing_environments(testdata.games(spark, sf), testdata.environments(spark, sf))


@query(
    "key_backfill",
    with_(
        KEYS,
        body="""SELECT api_key, project_id, coalesce(org_id, 'org_system') AS org_id, coalesce(game_id, project_id) AS game_id,
          CASE WHEN org_id IS NULL AND s % 3 <> 0 THEN 'env_' || project_id || '_prod' END AS environment_id FROM keys""",
    ),
)
def key_backfill(spark, sf):
    keys = tenants.backfill_keys(testdata.api_keys(spark, sf), testdata.environments(spark, sf))
    return keys.select("api_key", "project_id", "org_id", "game_id", "environment_id")


@query(
    "organization_statistics",
    with_(
        organizations_sql(*CUSTOMER_ORGS),
        body="""SELECT count(*) AS total_orgs, count(*) FILTER (WHERE tier = 'FREE') AS free_orgs,
          count(*) FILTER (WHERE tier = 'PRO') AS pro_orgs, count(*) FILTER (WHERE tier = 'ENTERPRISE') AS enterprise_orgs,
          count(*) FILTER (WHERE status = 'ACTIVE') AS active_orgs FROM orgs WHERE NOT deleted""",
    ),
)
def organization_statistics(spark, sf):
    return tenants.organization_statistics(testdata.organizations(spark, sf, *CUSTOMER_ORGS))


@query(
    "active_organizations_by_tier",
    with_(organizations_sql(*CUSTOMER_ORGS), body="SELECT tier, count(*) AS orgs FROM orgs WHERE NOT deleted AND status = 'ACTIVE' GROUP BY tier"),
)
def active_organizations_by_tier(spark, sf):
    return tenants.active_organizations_by_tier(testdata.organizations(spark, sf, *CUSTOMER_ORGS))


_GAME_COUNTS = """count(*) AS total_games, count(*) FILTER (WHERE status = 'LIVE') AS live_games,
  count(*) FILTER (WHERE status = 'DEVELOPMENT') AS dev_games, count(*) FILTER (WHERE status = 'TESTING') AS test_games,
  count(*) FILTER (WHERE has_multiplayer) AS multiplayer_games FROM games WHERE NOT deleted"""


@query("game_statistics", with_(GAMES, body=f"SELECT {_GAME_COUNTS}"))
def game_statistics(spark, sf):
    return tenants.game_statistics(testdata.games(spark, sf))


@query("org_game_statistics", with_(GAMES, body=f"SELECT org_id, {_GAME_COUNTS} GROUP BY org_id"))
def org_game_statistics(spark, sf):
    return tenants.game_statistics(testdata.games(spark, sf), by_org=True)


@query(
    "key_usage",
    with_(
        REQUESTS,
        body=f"""SELECT api_key, count(*) AS total_requests, CAST(sum(events) AS BIGINT) AS total_events,
          strftime(max(ts), '{_TIME}') AS last_used_at, last(client_ip ORDER BY ts, request_id) AS last_used_ip
        FROM requests GROUP BY api_key""",
    ),
)
def key_usage(spark, sf):
    return usage.key_usage(testdata.requests(spark, sf))


@query(
    "key_health",
    with_(
        KEYS,
        body=f"""SELECT api_key, total_requests,
          status = 'ACTIVE' AND (expires_at IS NULL OR expires_at > DATE '{AS_OF}') AS is_active,
          status = 'ACTIVE' AND expires_at IS NOT NULL AND expires_at <= DATE '{AS_OF}' AS is_expired,
          status = 'ACTIVE' AND s % 2 = 0 AND s % 7 <> 0 AND created_at <= DATE '{AS_OF}' - 90 AS rotation_due,
          total_requests > 500 AS is_high_usage,
          status = 'ACTIVE' AND (last_used_at IS NULL OR last_used_at < DATE '{AS_OF}' - 30) AS is_unused FROM keys""",
    ),
)
def key_health(spark, sf):
    return usage.key_health(testdata.api_keys(spark, sf), AS_OF, 500, 30)


@query(
    "high_usage_keys",
    with_(KEYS, body="SELECT api_key, total_requests FROM keys WHERE total_requests > 500 ORDER BY 2 DESC, 1"),
)
def high_usage_keys(spark, sf):
    return usage.high_usage_keys(usage.key_health(testdata.api_keys(spark, sf), AS_OF, 500, 30))


@query(
    "quota_report",
    with_(
        EV, ORGS, GAMES,
        body="""SELECT org_id, tier, month, events, max_events, retention_days,
          max_events >= 0 AND events > max_events AS over_quota FROM (
          SELECT g.org_id, o.tier, strftime(e.event_date, '%Y%m') AS month, count(*) AS events,
            CAST(any_value(o.max_events) AS BIGINT) AS max_events, CAST(any_value(o.retention_days) AS BIGINT) AS retention_days
          FROM ev e JOIN games g ON g.id = e.project_id JOIN orgs o ON o.id = g.org_id GROUP BY ALL)""",
    ),
)
def quota_report(spark, sf):
    orgs, games, _, _ = _tables(spark, sf)
    return usage.quota_report(testdata.events(spark, sf), games, orgs)


@query(
    "game_quota_report",
    with_(
        ORGS, GAMES,
        body="""SELECT org_id, tier, CAST(max_games AS BIGINT) AS max_games, games, games >= max_games AS at_limit FROM (
          SELECT o.id AS org_id, o.tier, o.max_games, (SELECT count(*) FROM games g WHERE g.org_id = o.id AND NOT g.deleted) AS games
          FROM orgs o)""",
    ),
)
def game_quota_report(spark, sf):
    games = testdata.games(spark, sf).filter("deleted_at IS NULL")
    return usage.game_quota_report(testdata.organizations(spark, sf), games)


@query(
    "key_quota_report",
    with_(
        REQUESTS,
        body="""SELECT r.api_key, CAST(r.event_date AS VARCHAR) AS event_date, r.events, q.daily_quota FROM (
          SELECT api_key, CAST(ts AS DATE) AS event_date, CAST(sum(events) AS BIGINT) AS events FROM requests GROUP BY ALL) r
          JOIN (SELECT 'key' || s_suppkey AS api_key, s_suppkey % 20 AS daily_quota FROM supplier WHERE s_suppkey % 3 = 0) q
          ON q.api_key = r.api_key WHERE r.events > q.daily_quota""",
    ),
)
def key_quota_report(spark, sf):
    from pyspark.sql import functions as F

    by_day = testdata.requests(spark, sf).groupBy("api_key", F.to_date("ts").alias("event_date")).agg(
        F.sum("events").alias("events")
    )
    return usage.key_quota_report(by_day, testdata.api_keys(spark, sf))


_LIMITS = """limited AS (SELECT r.*, date_trunc('minute', r.ts) AS minute,
  coalesce(p.rpm, 2) AS rpm FROM requests r
  LEFT JOIN (SELECT 'key' || n_nationkey AS api_key, CASE WHEN n_nationkey % 3 = 1 THEN 1 END AS rpm FROM nation) p
    ON p.api_key = r.api_key)"""


@query(
    "rate_limit_audit",
    with_(
        REQUESTS, _LIMITS,
        body=f"""SELECT api_key, strftime(minute, '{_TIME}') AS minute, count(*) AS requests,
          least(count(*), any_value(rpm)) AS passed, count(*) - least(count(*), any_value(rpm)) AS refused
        FROM limited GROUP BY api_key, limited.minute""",
    ),
)
def rate_limit_audit(spark, sf):
    """Two requests per minute, one for keys whose policy says so."""
    return usage.rate_limit_report(
        testdata.requests(spark, sf), default=2, overrides=testdata.policies(spark, sf)
    )


@query(
    "refused_requests",
    with_(
        REQUESTS, _LIMITS,
        body=f"""SELECT api_key, request_id, strftime(ts, '{_TIME}') AS ts, ordinal FROM (
          SELECT *, row_number() OVER (PARTITION BY api_key, minute ORDER BY ts, request_id) AS ordinal FROM limited)
          WHERE ordinal > rpm""",
    ),
)
def refused_requests(spark, sf):
    return usage.refused_requests(
        testdata.requests(spark, sf), default=2, overrides=testdata.policies(spark, sf)
    )


@query(
    "refused_by_address",
    with_(
        REQUESTS,
        body=f"""SELECT client_ip, request_id, strftime(ts, '{_TIME}') AS ts, ordinal FROM (
          SELECT *, row_number() OVER (PARTITION BY client_ip, minute ORDER BY ts, request_id) AS ordinal FROM (
          SELECT regexp_replace(client_ip, '^(\\d+\\.\\d+)\\..*$', '\\1.0.0') AS client_ip, request_id, ts, date_trunc('minute', ts) AS minute FROM requests))
          WHERE ordinal > 1""",
    ),
)
def refused_by_address(spark, sf):
    """The per-address limit, on /16 networks and one request per minute."""
    from pyspark.sql import functions as F

    requests = testdata.requests(spark, sf).withColumn(
        "client_ip", F.regexp_replace("client_ip", r"^(\d+\.\d+)\..*$", "$1.0.0")
    )
    return usage.refused_requests(requests, "client_ip", 1)
