"""All dashboard charts."""

from __future__ import annotations

from tallyloom.catalog.registry import query
from tallyloom.catalog.sql import AS_OF, CONV, EV, EXPOSED, VIEWS, plain_column, ratio, with_
from tallyloom.catalog.stored import stored
from tallyloom.plans import bi
from tallyloom.plans.views import FAST_VIEWS, view
from tallyloom.sources import testdata


def chart_sql(chart: bi.Chart) -> str:
    """The SQL twin of a chart."""
    rows = f"SELECT * FROM ({VIEWS[chart.view]})"
    if chart.days is not None:
        rows += (
            f" WHERE {chart.day} >= DATE '{AS_OF}' - {chart.days} AND {chart.day} < DATE '{AS_OF}'"
        )
    parts = [EV, EXPOSED, CONV, f"rows_ AS ({rows})"]
    if chart.pivot:
        sums = ", ".join(f"CAST(sum(users) FILTER (WHERE d = {d}) AS BIGINT) AS d{d}" for d in (0, 1, 7, 30))
        return with_(*parts, body=f"SELECT CAST(cohort_date AS VARCHAR) AS cohort_date, {sums} FROM rows_ GROUP BY cohort_date")
    if chart.columns:
        rest = ", ".join(c for c in chart.columns if c != chart.day)
        cols = ", ".join(plain_column(c) for c in chart.columns)
        body = f"SELECT {cols} FROM (SELECT * FROM rows_ ORDER BY {chart.day} DESC, {rest} LIMIT {chart.row_limit})"
        return with_(*parts, body=body)
    source = "rows_"
    if chart.series_limit is not None:
        by = chart.by[0]
        source = (
            f"rows_ WHERE {by} IN (SELECT {by} FROM rows_ GROUP BY {by} "
            f"ORDER BY sum({chart.series_metric}) DESC, {by} LIMIT {chart.series_limit})"
        )
    values = []
    for label, (function, column) in chart.metrics.items():
        if function == "avg":
            values.append(f"round(avg({column}), {bi.RATE_DIGITS}) AS {label}")
        else:
            kind = "DOUBLE" if column == "revenue" else "BIGINT"
            values.append(f"CAST(sum({column}) AS {kind}) AS {label}")
    keys = ", ".join([chart.day, *chart.by])
    grouped = f"SELECT {keys}, {', '.join(values)} FROM {source} GROUP BY {keys}"
    if chart.row_limit is not None:
        first = next(iter(chart.metrics))
        grouped += f" ORDER BY {first} DESC, {keys} LIMIT {chart.row_limit}"
    return with_(*parts, body=f"SELECT * REPLACE (CAST({chart.day} AS VARCHAR) AS {chart.day}) FROM ({grouped})")


def _register(name: str, chart: bi.Chart) -> None:
    @query(f"bi_{name}", chart_sql(chart))
    def run(spark, sf):
        tables = stored(spark, sf) if chart.view in FAST_VIEWS else None
        return bi.run(chart, testdata.events(spark, sf), AS_OF, tables)


for _name, _chart in bi.CHARTS.items():
    _register(_name, _chart)


_FILTERED = with_(
    EV, EXPOSED, CONV,
    f"rows_ AS (SELECT * FROM ({VIEWS['v_exp_exposures_by_day_dim']}) WHERE project_id = 'p1' AND exp = 'exp1' "
    "AND platform IN ('ios', 'web') AND country IN ('US', 'JP'))",
    body="SELECT CAST(event_date AS VARCHAR) AS event_date, platform, CAST(sum(exposures) AS BIGINT) AS sum_exposures "
    "FROM rows_ GROUP BY ALL ORDER BY sum_exposures DESC, event_date, platform LIMIT 10",
)


@query("bi_filtered_exposures", _FILTERED)
def filtered_exposures(spark, sf):
    """A chart with the dashboard filters set."""
    return bi.run(
        bi.CHARTS["exp_exposures_by_platform"], testdata.events(spark, sf), AS_OF,
        project="p1", exp="exp1", platform=["ios", "web"], country=["US", "JP"],
    )


_PAGE = with_(
    EV, EXPOSED, CONV,
    body=f"""SELECT {", ".join(plain_column(c) for c in bi.CHARTS["exp_exposures_dim_table_fast"].columns)} FROM (
      SELECT * FROM ({VIEWS['v_exp_exposures_by_day_dim']}) ORDER BY event_date DESC, exp, variant, platform,
      app_version, country, exposures, users LIMIT 500 OFFSET 500)""",
)


def _page(offset: int, limit: int) -> str:
    return with_(
        EV, EXPOSED, CONV,
        body=f"""SELECT {", ".join(plain_column(c) for c in bi.CHARTS["exp_exposures_dim_table_fast"].columns)} FROM (
          SELECT * FROM ({VIEWS['v_exp_exposures_by_day_dim']}) ORDER BY event_date DESC, exp, variant, platform,
          app_version, country, exposures, users LIMIT {limit} OFFSET {offset})""",
    )


@query("bi_detail_deep_page", _page(99 * 10, 10))
def detail_deep_page(spark, sf):
    """The hundredth page of ten rows: days before it are skipped by their counts."""
    chart = bi.CHARTS["exp_exposures_dim_table_fast"]
    return bi.run(chart, testdata.events(spark, sf), AS_OF, stored(spark, sf), page=99, row_limit=10)


@query("bi_detail_next_pages", _page(2 * 500, 500))
def detail_next_pages(spark, sf):
    """The third page, reached from the last row of the page before each."""
    chart = bi.CHARTS["exp_exposures_dim_table_fast"]
    rows = view(testdata.events(spark, sf), chart.view, stored(spark, sf))
    last = None
    for _ in range(2):
        page = bi.detail_after(rows, chart.day, chart.columns, chart.row_limit, last).collect()  # one page: 500 rows
        if not page:
            return rows.select(*chart.columns).limit(0)
        last = page[-1]
    return bi.detail_after(rows, chart.day, chart.columns, chart.row_limit, last).select(*chart.columns)


@query("bi_detail_second_page", _PAGE)
def detail_second_page(spark, sf):
    chart = bi.CHARTS["exp_exposures_dim_table_fast"]
    return bi.run(chart, testdata.events(spark, sf), AS_OF, stored(spark, sf), page=1)


@query(
    "bi_weighted_cr_24h",
    with_(
        EV, EXPOSED, CONV,
        body=f"""SELECT CAST(exposure_date AS VARCHAR) AS exposure_date, variant, exposed_users, converted_users,
        {ratio('converted_users', 'exposed_users')} AS weighted_cr FROM (
        SELECT exposure_date, variant, CAST(sum(exposed_users) AS BIGINT) AS exposed_users,
          CAST(sum(converted_users) AS BIGINT) AS converted_users FROM ({VIEWS['v_exp_conversion_24h']}) GROUP BY ALL)""",
    ),
)
def weighted_cr_24h(spark, sf):
    return bi.weighted_rate(view(testdata.events(spark, sf), "v_exp_conversion_24h"), "exposure_date")


def _adhoc(view: str, days: int, by: str = "", where: str = "") -> str:
    rows = (
        f"rows_ AS (SELECT * FROM ({VIEWS[view]}) WHERE project_id = 'p1' AND exp = 'exp1' "
        f"AND exposure_date >= DATE '{AS_OF}' - {days} AND exposure_date < DATE '{AS_OF}')"
    )
    return with_(
        EV, EXPOSED, CONV, rows,
        body=f"""SELECT CAST(exposure_date AS VARCHAR) AS exposure_date, {by} exposures, conversions,
        coalesce({ratio('conversions', 'exposures')}, 0) AS cr FROM (
        SELECT exposure_date, {by} CAST(sum(exposed_users) AS BIGINT) AS exposures,
          CAST(sum(converted_users) AS BIGINT) AS conversions FROM rows_ {where} GROUP BY ALL)""",
    )


@query("bi_experiment_30d", _adhoc("v_exp_conversion_24h", 30))
def experiment_30d(spark, sf):
    daily = view(testdata.events(spark, sf), "v_exp_conversion_24h_fast", stored(spark, sf))
    return bi.experiment_days(daily, "p1", "exp1", AS_OF)


@query(
    "series_top10",
    _adhoc(
        "v_exp_conversion_24h_dim", 14, "country,",
        "WHERE country IN (SELECT country FROM rows_ GROUP BY country ORDER BY sum(exposed_users) DESC, country LIMIT 10)",
    ),
)
def series_top10(spark, sf):
    daily = view(testdata.events(spark, sf), "v_exp_conversion_24h_dim_fast", stored(spark, sf))
    return bi.top_countries(daily, "p1", "exp1", AS_OF)
