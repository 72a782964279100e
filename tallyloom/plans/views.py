"""Named views over the events table, for SQL users and for the charts."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import conversion as conv
from tallyloom.operators import experiments as exp
from tallyloom.operators import funnel, metrics, retention, sessions
from tallyloom.operators.rollups import ROLLUPS, Rollup


def _conversion(events: DataFrame, build: Callable, dims: tuple[str, ...] = ()) -> DataFrame:
    return build(exp.exposures(events), conv.first_conversion(events), dims)


def _rollup(rollup: Rollup, events: DataFrame) -> DataFrame:
    return rollup.build(exp.exposures(events), conv.first_conversion(events))


# Names of the pre-aggregated views and the rollup table behind each.
FAST_VIEWS = {
    "v_exp_exposures_by_day_fast": "exp_daily_exposures",
    "v_exp_exposures_by_day_dim_fast": "exp_daily_exposures_dim",
    "v_exp_conversion_24h_fast": "exp_daily_conv_24h",
    "v_exp_conversion_24h_dim_fast": "exp_daily_conv_24h_dim",
    "v_exp_conversion_7d_fast": "exp_daily_conv_7d",
    "v_exp_conversion_7d_dim_fast": "exp_daily_conv_7d_dim",
}


VIEWS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "events": lambda e: e,
    "sessions": sessions.sessions,
    "v_events_trend": metrics.events_by_day,
    "v_dau_trend": metrics.dau,
    "v_revenue_by_day": metrics.revenue_by_day,
    "v_ua_by_day": lambda e: metrics.ua_by_day(metrics.agents_by_day(e)),
    "v_os_by_day": lambda e: metrics.os_by_day(metrics.agents_by_day(e)),
    "retention_daily": retention.retention_daily,
    "funnels_2step": funnel.daily_funnel,
    "exp_exposure_users": exp.exposures,
    "v_exp_exposure_users": exp.exposures,
    "exp_first_level_complete": conv.first_conversion,
    "v_exp_exposures_by_day": lambda e: exp.exposures_by_day(exp.exposures(e)),
    "v_exp_exposures_by_day_dim": lambda e: exp.exposures_by_day(exp.exposures(e), exp.DIMS),
    "v_exp_conversion_same_day": conv.same_day_conversion,
    "v_exp_conversion_24h": lambda e: _conversion(e, conv.conversion_24h),
    "v_exp_conversion_24h_dim": lambda e: _conversion(e, conv.conversion_24h, exp.DIMS),
    "v_exp_conversion_7d": lambda e: _conversion(e, conv.conversion_7d),
    "v_exp_conversion_7d_dim": lambda e: _conversion(e, conv.conversion_7d, exp.DIMS),
    **{r.name: partial(_rollup, r) for r in ROLLUPS},
}


def view_names() -> list[str]:
    return [*VIEWS, *FAST_VIEWS]


def view(events: DataFrame, name: str, rollups: dict[str, DataFrame] | None = None) -> DataFrame:
    """The view ``name`` over an events table.

    ``rollups`` are the stored tables by name (``operators.rollups.stored_views``): the fast views
    read them. Without them, the fast views are computed from the events, with the same result.
    """
    table = FAST_VIEWS.get(name, name)
    if name in FAST_VIEWS and rollups:
        return rollups[table]
    return VIEWS[table](events)


def register(events: DataFrame, rollups: dict[str, DataFrame] | None = None) -> list[str]:
    """Create a temporary view per name; returns the names."""
    names = view_names()
    for name in names:
        view(events, name, rollups).createOrReplaceTempView(name)
    return names


def apply_filters(
    df: DataFrame,
    project: str | None = None,
    exp: str | None = None,
    platform: list[str] | None = None,
    country: list[str] | None = None,
    app_version: list[str] | None = None,
) -> DataFrame:
    """Dashboard filters; a filter on a column the view lacks is ignored."""
    single = {"project_id": project, "exp": exp}
    multi = {"platform": platform, "country": country, "app_version": app_version}
    for name, value in single.items():
        if value is not None and name in df.columns:
            df = df.filter(F.col(name) == value)
    for name, values in multi.items():
        if values and name in df.columns:
            df = df.filter(F.col(name).isin(*values))
    return df


def last_days(df: DataFrame, day: str, as_of: str, days: int) -> DataFrame:
    """Days from ``days`` before ``as_of`` up to the day before it."""
    end = F.lit(as_of).cast("date")
    return df.filter((F.col(day) >= F.date_sub(end, days)) & (F.col(day) < end))
