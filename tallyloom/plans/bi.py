"""Dashboard queries: every chart is one grouped query, pivot or detail list over one view."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tallyloom.operators.retention import retention_pivot
from tallyloom.plans.views import apply_filters, last_days, view

RATE_DIGITS = 6


@dataclass(frozen=True)
class Chart:
    """``metrics`` maps a label to (function, column); ``days`` None means no time filter."""

    view: str
    day: str
    metrics: dict[str, tuple[str, str]] = field(default_factory=dict)
    by: tuple[str, ...] = ()
    days: int | None = 90
    row_limit: int | None = None
    series_limit: int | None = None
    series_metric: str | None = None
    columns: tuple[str, ...] = ()
    pivot: bool = False


def _sum(*columns: str) -> dict[str, tuple[str, str]]:
    return {f"sum_{c}": ("sum", c) for c in columns}


def _avg(column: str) -> dict[str, tuple[str, str]]:
    return {f"avg_{column}": ("avg", column)}


_DIMS = ("platform", "country", "app_version")

# The charts of the two dashboards.
CHARTS: dict[str, Chart] = {
    "events_trend": Chart("v_events_trend", "event_date", _sum("events"), ("event_name",)),
    "dau_trend": Chart("v_dau_trend", "event_date", _sum("dau")),
    "revenue_trend": Chart("v_revenue_by_day", "event_date", _sum("revenue"), ("revenue_currency",)),
    "retention_pivot": Chart("retention_daily", "cohort_date", pivot=True),
    "funnel_bar": Chart("funnels_2step", "event_date", _sum("started", "completed"), ("step1", "step2")),
    "ua_share": Chart("v_ua_by_day", "event_date", _sum("events"), ("ua_family",)),
    "os_share": Chart("v_os_by_day", "event_date", _sum("events"), ("os_family",)),
    "exp_exposures_trend": Chart("v_exp_exposures_by_day", "event_date", _sum("exposures"), ("variant",), None),
    "exp_exposures_trend_fast": Chart("v_exp_exposures_by_day_fast", "event_date", _sum("exposures"), ("variant",)),
    "exp_conversion_rate": Chart("v_exp_conversion_same_day", "event_date", _avg("cr"), ("variant",), None),
    "exp_conversion_24h": Chart("v_exp_conversion_24h", "exposure_date", _avg("cr_24h"), ("variant",), None),
    "exp_conversion_7d": Chart("v_exp_conversion_7d", "exposure_date", _avg("cr_7d"), ("variant",), None),
    "exp_cr_24h_fast": Chart("v_exp_conversion_24h_fast", "exposure_date", _avg("cr_24h"), ("variant",)),
    "exp_cr_7d_fast": Chart("v_exp_conversion_7d_fast", "exposure_date", _avg("cr_7d"), ("variant",)),
    **{
        f"exp_exposures_by_{d}": Chart(
            "v_exp_exposures_by_day_dim", "event_date", _sum("exposures"), (d,), None, row_limit=10
        )
        for d in _DIMS
    },
    **{
        f"exp_cr_24h_by_{d}": Chart(
            "v_exp_conversion_24h_dim", "exposure_date", _avg("cr_24h"), (d,), None, row_limit=10
        )
        for d in _DIMS
    },
    **{
        f"exp_exposures_dim_{d}_fast": Chart(
            "v_exp_exposures_by_day_dim_fast", "event_date", _sum("exposures"), (d,),
            series_limit=10, series_metric="exposures",
        )
        for d in _DIMS
    },
    **{
        f"exp_cr_24h_dim_{d}_fast": Chart(
            "v_exp_conversion_24h_dim_fast", "exposure_date", _avg("cr_24h"), (d,),
            series_limit=10, series_metric="exposed_users",
        )
        for d in _DIMS
    },
    "exp_exposures_dim_table_fast": Chart(
        "v_exp_exposures_by_day_dim_fast", "event_date", row_limit=500,
        columns=("event_date", "exp", "variant", "platform", "app_version", "country", "exposures", "users"),
    ),
    "exp_cr_24h_dim_table_fast": Chart(
        "v_exp_conversion_24h_dim_fast", "exposure_date", row_limit=500,
        columns=(
            "exposure_date", "exp", "variant", "platform", "app_version", "country",
            "exposed_users", "converted_users", "cr_24h",
        ),
    ),
}


def series_limit(df: DataFrame, by: str, metric: str, limit: int) -> DataFrame:
    """All rows of the ``limit`` values of ``by`` with the largest total, ties by value."""
    top = (
        df.groupBy(by)
        .agg(F.sum(metric).alias("total"))
        .orderBy(F.desc("total"), by)
        .limit(limit)
        .select(by)
    )
    return df.join(top, by, "left_semi")


def _detail_order(df: DataFrame, day: str, columns: tuple[str, ...]) -> list[str]:
    """The order of a detail table: its day, newest first, the other columns, and those not shown, so that
    no two rows of a view are equal."""
    return [day, *(c for c in columns if c != day), *(c for c in df.columns if c not in columns)]


def _sorted(df: DataFrame, names: list[str]) -> DataFrame:
    return df.orderBy(F.desc(names[0]), *names[1:])


def detail(df: DataFrame, day: str, columns: tuple[str, ...], limit: int, page: int = 0) -> DataFrame:
    """One page of rows, newest first, ties by the columns from left to right.

    A later page is found by the rows per day, one number per calendar day: the days before are skipped by the
    filter, and what is passed over is less than the rows of one day, however deep the page is.
    """
    skip = page * limit
    if skip:
        counts = df.groupBy(day).agg(F.count(F.lit(1)).alias("n")).collect()
        for r in sorted(counts, key=lambda r: (r[day] is None, -r[day].toordinal() if r[day] else 0)):
            if skip < r["n"]:
                left = F.col(day).isNull()
                df = df.filter(left if r[day] is None else (F.col(day) <= F.lit(r[day])) | left)
                break
            skip -= r["n"]
        else:
            return df.select(*columns).limit(0)
    return _sorted(df, _detail_order(df, day, columns)).select(*columns).offset(skip).limit(limit)


def detail_after(df: DataFrame, day: str, columns: tuple[str, ...], limit: int, last: Row | None = None) -> DataFrame:
    """The page behind the row ``last`` of the page before, or the first one; with all columns of the view, of which the
    next page needs the last row.

    The start is a comparison of the row's values, so every page is a top-``limit``, and no rows are passed over.
    """
    names = _detail_order(df, day, columns)
    if last is not None:
        behind = F.lit(False)
        for name in reversed(names):
            column, value = F.col(name), last[name]
            if name == day:  # newest first, no day last
                further = F.lit(False) if value is None else (column < F.lit(value)) | column.isNull()
            else:  # a null comes before all values
                further = column.isNotNull() if value is None else column > F.lit(value)
            behind = further | (column.eqNullSafe(F.lit(value)) & behind)
        # The day alone, for folders that need not be opened.
        near = F.lit(True) if last[day] is None else (F.col(day) <= F.lit(last[day])) | F.col(day).isNull()
        df = df.filter(near & F.coalesce(behind, F.lit(False)))
    return _sorted(df, names).select(*names).limit(limit)


def _metric(function: str, column: str):
    if function == "avg":
        return F.round(F.avg(column), RATE_DIGITS)
    return F.sum(column)


def run(
    chart: Chart,
    events: DataFrame,
    as_of: str,
    rollups: dict[str, DataFrame] | None = None,
    page: int = 0,
    row_limit: int | None = None,
    **filters,
) -> DataFrame:
    """The rows of a chart; ``filters`` are those of ``apply_filters``. ``page`` and ``row_limit`` choose the part of a
    detail table."""
    df = apply_filters(view(events, chart.view, rollups), **filters)
    if chart.days is not None:
        df = last_days(df, chart.day, as_of, chart.days)
    if chart.pivot:
        return retention_pivot(df)
    if chart.columns:
        return detail(df, chart.day, chart.columns, row_limit or chart.row_limit, page)
    if chart.series_limit is not None:
        df = series_limit(df, chart.by[0], chart.series_metric, chart.series_limit)
    values = [_metric(f, c).alias(label) for label, (f, c) in chart.metrics.items()]
    result = df.groupBy(chart.day, *chart.by).agg(*values)
    if chart.row_limit is not None:
        first = next(iter(chart.metrics))
        result = result.orderBy(F.desc(first), chart.day, *chart.by).limit(chart.row_limit)
    return result


def weighted_rate(df: DataFrame, day: str, by: tuple[str, ...] = ("variant",)) -> DataFrame:
    """Conversion rate per day weighted by exposures, where the charts average plain rates."""
    counts = df.groupBy(day, *by).agg(
        F.sum("exposed_users").alias("exposed_users"),
        F.sum("converted_users").alias("converted_users"),
    )
    ratio = F.col("converted_users").cast("double") / F.nullif(F.col("exposed_users"), F.lit(0))
    return counts.withColumn("weighted_cr", F.round(ratio, 4))


def experiment_days(daily: DataFrame, project: str, exp: str, as_of: str, days: int = 30) -> DataFrame:
    """One experiment over the last days: exposures, conversions and their ratio, 0 for none."""
    df = last_days(apply_filters(daily, project=project, exp=exp), "exposure_date", as_of, days)
    return df.groupBy("exposure_date").agg(
        F.sum("exposed_users").alias("exposures"), F.sum("converted_users").alias("conversions")
    ).withColumn("cr", _zero_guard())


def _zero_guard():
    ratio = F.col("conversions").cast("double") / F.nullif(F.col("exposures"), F.lit(0))
    return F.round(F.coalesce(ratio, F.lit(0.0)), 4)


def top_countries(
    daily_dim: DataFrame, project: str, exp: str, as_of: str, days: int = 14, limit: int = 10
) -> DataFrame:
    """Conversions by day for the countries with most exposures."""
    df = last_days(apply_filters(daily_dim, project=project, exp=exp), "exposure_date", as_of, days)
    top = series_limit(df, "country", "exposed_users", limit)
    return top.groupBy("exposure_date", "country").agg(
        F.sum("exposed_users").alias("exposures"), F.sum("converted_users").alias("conversions")
    ).withColumn("cr", _zero_guard())
