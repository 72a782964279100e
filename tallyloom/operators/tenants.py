"""Reports over organizations, games, users, roles and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Quotas per tier as (games, events per month, days of data); -1 = unlimited.
TIER_QUOTAS = {
    "FREE": (5, 1_000_000, 90),
    "PRO": (50, 100_000_000, 365),
    "ENTERPRISE": (1000, -1, 1095),
}
SYSTEM_ORG = "org_system"
PRODUCTION = "production"


def _alive(df: DataFrame) -> DataFrame:
    return df.filter(F.col("deleted_at").isNull()) if "deleted_at" in df.columns else df


def tier_quota(tier: str, part: int):
    """Column with one of the three quotas of a tier column."""
    result = None
    for name, quota in TIER_QUOTAS.items():
        value = F.lit(quota[part]).cast("long")
        test = F.col(tier) == name
        result = F.when(test, value) if result is None else result.when(test, value)
    return result


def organization_stats(
    orgs: DataFrame, games: DataFrame, users: DataFrame, keys: DataFrame, as_written: bool = False
) -> DataFrame:
    """Games, live games, users, keys and events per organization.

    Each child is counted on its own and joined once per organization. ``as_written``
    reproduces the numbers of joining all children at once, where every game is counted once
    per user and key and so on; they are products of the counts, so no pair is ever built.
    """
    per_game = _alive(games).groupBy(F.col("org_id").alias("id")).agg(
        F.count(F.lit(1)).alias("g"), F.count_if(F.col("status") == "LIVE").alias("live")
    )
    per_user = _alive(users).groupBy(F.col("org_id").alias("id")).agg(F.count(F.lit(1)).alias("u"))
    per_key = keys.groupBy(F.col("org_id").alias("id")).agg(
        F.count(F.lit(1)).alias("k"), F.sum("total_events").alias("e")
    )
    base = (
        _alive(orgs)
        .select("id", "name", "tier")
        .join(per_game, "id", "left")
        .join(per_user, "id", "left")
        .join(per_key, "id", "left")
    )
    g, live, u, k, e = (F.coalesce(F.col(c), F.lit(0)) for c in ("g", "live", "u", "k", "e"))
    one = F.lit(1)
    rows_g, rows_u, rows_k = F.greatest(g, one), F.greatest(u, one), F.greatest(k, one)
    if not as_written:
        rows_g = rows_u = rows_k = one
    return base.select(
        F.col("id").alias("org_id"),
        F.col("name").alias("org_name"),
        "tier",
        (g * rows_u * rows_k).alias("total_games"),
        (live * rows_u * rows_k).alias("live_games"),
        (u * rows_g * rows_k).alias("total_users"),
        (k * rows_g * rows_u).alias("total_api_keys"),
        (e * rows_g * rows_u).alias("total_events_processed"),
    )


def retention_limits(orgs: DataFrame, games: DataFrame) -> DataFrame:
    """Days that events of a project are kept: the limit of its organization, else that of the tier."""
    limit = F.coalesce(F.col("max_data_retention_days"), tier_quota("tier", 2))
    days = _alive(orgs).select(F.col("id").alias("org_id"), limit.alias("days"))
    return _alive(games).select(F.col("id").alias("project_id"), "org_id").join(days, "org_id").select("project_id", "days")


def user_permissions(
    users: DataFrame, roles: DataFrame, orgs: DataFrame, games: DataFrame
) -> DataFrame:
    """Users with each of their roles and the names of its organization and game."""
    r = roles.select("user_id", "org_id", "game_id", "environment_id", "role", "scope")
    o = orgs.select(F.col("id").alias("_org"), F.col("name").alias("org_name"))
    g = games.select(F.col("id").alias("_game"), F.col("name").alias("game_name"))
    u = _alive(users).select(F.col("id").alias("user_id"), "email", "name", "global_role")

    def key(name: str):
        """The id; a row without one matches nothing and carries a spread key."""
        spread = F.concat(F.lit("\0"), F.pmod(F.xxhash64("user_id"), F.lit(1_000_000)).cast("string"))
        return F.coalesce(F.col(name), spread)

    return (
        u.join(r, "user_id", "left")
        .withColumns({"_org": key("org_id"), "_game": key("game_id")})
        .join(o, "_org", "left")
        .join(g, "_game", "left")
        .select("user_id", "email", "name", "global_role", "org_id", "game_id", "environment_id", "role", "scope", "org_name", "game_name")
    )


def upgrade_candidates(orgs: DataFrame, games: DataFrame) -> DataFrame:
    """FREE organizations that have reached their number of games."""
    counts = _alive(games).groupBy(F.col("org_id").alias("id")).agg(F.count(F.lit(1)).alias("games"))
    return (
        orgs.filter(F.col("tier") == "FREE")
        .join(counts, "id", "left")
        .withColumn("games", F.coalesce("games", F.lit(0).cast("long")))
        .filter(F.col("games") >= F.col("max_games"))
        .select(F.col("id").alias("org_id"), "name", "max_games", "games")
    )


def missing_games(projects: DataFrame, games: DataFrame) -> DataFrame:
    """Game rows to add for projects that have none."""
    known = games.select("id")
    return projects.join(known, "id", "left_anti").select(
        "id", F.lit(SYSTEM_ORG).alias("org_id"), "name", F.col("name").alias("display_name")
    )


def missing_environments(games: DataFrame, environments: DataFrame) -> DataFrame:
    """Production environments to add for games that have none."""
    known = environments.filter(F.col("name") == PRODUCTION).select(F.col("game_id").alias("id"))
    return games.join(known, "id", "left_anti").select(
        F.concat(F.lit("env_"), "id", F.lit("_prod")).alias("id"),
        F.col("id").alias("game_id"),
        F.lit(PRODUCTION).alias("name"),
        F.lit("Production Environment").alias("display_name"),
        F.lit("PRODUCTION").alias("type"),
        F.lit("ACTIVE").alias("status"),
    )


def backfill_keys(keys: DataFrame, environments: DataFrame) -> DataFrame:
    """Keys without an organization get the system one, their project as game and its
    production environment; other keys are unchanged."""
    envs = (
        environments.filter(F.col("name") == PRODUCTION)
        .groupBy(F.col("game_id").alias("project_id"))
        .agg(F.min("id").alias("production_id"))
    )
    old = F.col("org_id").isNull() & F.col("project_id").isNotNull()
    return (
        keys.join(envs, "project_id", "left")
        .withColumns(
            {
                "org_id": F.when(old, F.lit(SYSTEM_ORG)).otherwise(F.col("org_id")),
                "game_id": F.when(old, F.col("project_id")).otherwise(F.col("game_id")),
                "environment_id": F.when(old, F.col("production_id")).otherwise(F.col("environment_id")),
            }
        )
        .drop("production_id")
    )


def organization_statistics(orgs: DataFrame) -> DataFrame:
    """Counts over all organizations by tier, and of the active ones."""
    tier = F.col("tier")
    return _alive(orgs).agg(
        F.count(F.lit(1)).alias("total_orgs"),
        *[F.count_if(tier == t).alias(f"{t.lower()}_orgs") for t in TIER_QUOTAS],
        F.count_if(F.col("status") == "ACTIVE").alias("active_orgs"),
    )


def active_organizations_by_tier(orgs: DataFrame) -> DataFrame:
    return (
        _alive(orgs).filter(F.col("status") == "ACTIVE").groupBy("tier").agg(F.count(F.lit(1)).alias("orgs"))
    )


def game_statistics(games: DataFrame, by_org: bool = False) -> DataFrame:
    """Counts of games by status and of multiplayer games, overall or per organization."""
    status = F.col("status")
    counts = [
        F.count(F.lit(1)).alias("total_games"),
        F.count_if(status == "LIVE").alias("live_games"),
        F.count_if(status == "DEVELOPMENT").alias("dev_games"),
        F.count_if(status == "TESTING").alias("test_games"),
        F.count_if(F.col("has_multiplayer")).alias("multiplayer_games"),
    ]
    alive = _alive(games)
    return alive.groupBy("org_id").agg(*counts) if by_org else alive.agg(*counts)
