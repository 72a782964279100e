"""Hand-worked results."""

import random
from datetime import date

import pytest
from fixtures import activity, make_events, tuples, with_exposures
from pyspark.sql import functions as F

from tallyloom.operators import conversion as conv
from tallyloom.operators import dedup, experiments, funnel, metrics, retention, rollups, sessions
from tallyloom.plans import bi
from tallyloom.plans.views import view
from tallyloom.sinks import loads
from tallyloom.sources import testdata

D = lambda day: date(2024, 1, day)


def clean(spark):
    return dedup.deduplicate(activity(spark)).cache()


def test_dedup(spark):
    events = activity(spark)
    assert dedup.deduplicate(events).count() == 11
    assert tuples(dedup.duplicate_letters(events), "event_id", "reason") == [("e10", "duplicate")]


def test_duplicate_letters_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(dedup, "CHUNK", 3)
    many = make_events(spark, [("same", "u", "d", "n", "2024-01-01 00:00:00")] * 11 + [("one", "u", "d", "n", "2024-01-01 00:00:00")])
    letters = dedup.duplicate_letters(many)
    assert letters.count() == 10
    assert letters.columns == ["event_id", "reason"]


def test_dau(spark):
    assert tuples(metrics.dau(clean(spark)), "event_date", "dau") == [(D(1), 2), (D(2), 3), (D(3), 1), (D(8), 1)]


def test_sessions(spark):
    result = sessions.sessions(clean(spark))
    rows = {(r["user_id"] or r["device_id"], str(r["session_start"])): r for r in result.collect()}
    assert len(rows) == 9
    first = rows[("uA", "2024-01-01 00:00:00")]
    assert (first["events"], first["duration"]) == (2, 1800)
    assert first["session_id"] == "75B42ACE70270734176F096B"
    assert rows[("uA", "2024-01-01 01:00:00.001000")]["events"] == 1
    late = rows[("dB", "2024-01-02 11:00:00")]
    assert (late["events"], late["duration"], late["user_id"]) == (2, 0, "")
    assert sum(r["events"] for r in rows.values()) == 11


def test_retention(spark):
    expected = [(D(1), 0, 2), (D(1), 1, 2), (D(1), 7, 1), (D(2), 0, 1), (D(2), 1, 1)]
    assert tuples(retention.retention_daily(clean(spark)), "cohort_date", "d", "users") == expected
    assert tuples(retention.d1_retention(clean(spark)), "cohort_day", "d0_users", "d1_return", "d1_retention") == [
        (D(1), 2, 2, 1.0), (D(2), 1, 1, 1.0)
    ]
    pivot = retention.retention_pivot(retention.retention_daily(clean(spark)))
    assert sorted(tuple(r) for r in pivot.collect()) == [(D(1), 2, 2, 1, None), (D(2), 1, 1, None, None)]


def test_retention_restarts_after_ttl(spark):
    days = ["2024-01-01", "2024-01-08", "2024-02-09", "2024-02-10", "2024-02-16"]
    events = make_events(spark, [(f"r{i}", "u", "d", "n", f"{d} 10:00:00") for i, d in enumerate(days)])
    result = tuples(retention.retention_daily(events, ttl_days=40), "cohort_date", "d", "users")
    assert result == [(D(1), 0, 1), (D(1), 7, 1), (date(2024, 2, 10), 0, 1)]


def test_daily_funnel(spark):
    expected = [(D(1), 2, 1), (D(2), 1, 2)]
    assert tuples(funnel.daily_funnel(clean(spark)), "event_date", "started", "completed") == expected


def test_all_time_funnel(spark):
    assert tuples(funnel.all_time_funnel(clean(spark)), "started", "completed", "cr") == [(3, 2, 0.6667)]


def test_cell_millis_divides_the_day():
    for hours in (0.00001, 0.5, 1, 2, 5, 7, 23, 24, 100):
        ms = int(hours * 3_600_000)
        cell = funnel.cell_millis(ms)
        assert funnel.DAY_MS % cell == 0 and cell <= max(1, ms)


def test_experiment_readout(spark):
    events = with_exposures(spark)
    exposed, first = experiments.exposures(events), conv.first_conversion(events)
    assert tuples(experiments.exposures_by_day(exposed), "variant", "exposures", "users") == [("A", 2, 1), ("B", 2, 2)]
    same = conv.same_day_conversion(events)
    assert tuples(same, "variant", "exposed_users", "converted_users") == [("A", 1, 1), ("B", 2, 1)]
    columns = ("variant", "exposed_users", "converted_users")
    assert tuples(conv.conversion_24h(exposed, first), *columns, "cr_24h") == [("A", 2, 2, 1.0), ("B", 2, 1, 0.5)]
    assert tuples(conv.conversion_7d(exposed, first), *columns, "cr_7d") == [("A", 2, 2, 1.0), ("B", 2, 2, 1.0)]
    both = conv.conversion_24h(exposed, first, distinct=True)
    assert tuples(both, "variant", "exposed_users_distinct", "converted_users_distinct") == [("A", 1, 1), ("B", 2, 1)]


def test_uplift(spark):
    events = with_exposures(spark)
    by_day = conv.conversion_24h(experiments.exposures(events), conv.first_conversion(events))
    assert tuples(experiments.uplift(by_day, "cr_24h"), "uplift") == [(-0.5,)]


def test_late_conversion_moves_rollups(spark, tmp_path):
    """A conversion that arrives late, and before the known first one, changes old days too."""
    events = with_exposures(spark)
    late = make_events(
        spark,
        [
            ("late1", "uC", "dC", "level_complete", "2024-01-01 20:30:00"),
            ("late2", "uA", "dA", "level_complete", "2023-12-30 00:00:00"),
        ],
    )
    path = str(tmp_path / "rollups")
    rollups.rebuild(events, path)
    rollups.refresh(late, path, 1)
    rollups.refresh(late, path, 1)  # a repeated load changes nothing
    everything = events.unionByName(late)
    exposed, first = experiments.exposures(everything), conv.first_conversion(everything)
    for rollup in rollups.ROLLUPS:
        raw = rollup.build(exposed, first)
        stored = rollups.read_rollup(spark, path, rollup).select(*raw.columns)
        measures = 2 if rollup.hours == 0 else 3
        assert rollups.differences(raw, stored, raw.columns[:-measures]).count() == 0
    day = rollups.read_rollup(spark, path, rollups.ROLLUPS[2])
    assert tuples(day, "variant", "converted_users") == [("A", 0), ("B", 2)]


def test_stored_state_in_loads(spark, sf_dir, tmp_path):
    """Loads merged, deleted and expired give the same tables; what was interrupted is not read."""
    path = str(tmp_path / "stored")
    events = testdata.events(spark, sf_dir)
    part = F.pmod(F.xxhash64("event_id"), F.lit(5))
    for i in range(4):
        rollups.refresh(events.filter(part == i), path, i)
    before = {name: sorted(map(tuple, t.collect()), key=repr) for name, t in rollups.stored_views(spark, path).items()}

    def same():
        return {name: sorted(map(tuple, t.collect()), key=repr) for name, t in rollups.stored_views(spark, path).items()} == before

    state = f"{path}/{rollups.ACTORS}"
    # A merge and a load that broke off have no marker.
    events.limit(5).select("project_id", "event_date", "user_id").write.parquet(f"{state}.base/up_to=3")
    (tmp_path / "stored" / f"{rollups.ACTORS}.base" / "up_to=3" / loads.COMPLETE).unlink()
    events.limit(5).select("project_id", "event_date", "user_id").write.parquet(f"{state}/load_id=9")
    (tmp_path / "stored" / rollups.ACTORS / "load_id=9" / loads.COMPLETE).unlink()
    assert same()
    assert set(rollups.compact(spark, path).values()) == {2}
    assert same()
    assert rollups.clean(spark, path) >= 7 * 3
    assert same()
    days = events.select("event_date").distinct().count()
    assert loads.count_files(spark, f"{path}/{rollups.DETAIL}") <= 2 * days + 2
    assert set(rollups.compact(spark, path).values()) == {None}
    rollups.refresh(events.filter(part == 3), path, 3)  # the newest load may still be repeated
    assert same()
    rollups.refresh(events.filter(part == 4), path, 4)
    for name, table in rollups.stored_views(spark, path).items():
        assert rollups.stored_differences(view(events, name), table).count() == 0
    last = events.agg(F.max("event_date")).first()[0].isoformat()
    rollups.compact(spark, path, as_of=last, keep_days=7)
    old = F.col("event_date") < F.date_sub(F.lit(last).cast("date"), 7)
    left = rollups.read_state(spark, path, "events_by_day").filter(old).agg(F.sum("events")).first()[0]
    assert 0 < left < events.filter(old).count()  # of old days only the newest load is left


def test_a_load_opens_the_folders_of_its_actors(spark, sf_dir, tmp_path):
    path = str(tmp_path / "stored")
    rollups.rebuild(testdata.events(spark, sf_dir), path)
    actors = rollups.read_firsts(spark, path).limit(2)
    folders = rollups.buckets_of(actors)
    assert 0 < len(folders) <= 2
    part = rollups.read_state(spark, path, rollups.FIRSTS).filter(F.col("bucket").isin(folders))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan.replace("isnotnull(bucket", "bucket")
    assert len(part.inputFiles()) >= len(folders)
    assert part.join(actors, ["project_id", "uid"]).count() == 2


def test_versions_switch_in_one_step(spark, sf_dir, tmp_path, monkeypatch):
    root = str(tmp_path / "versions")
    events = testdata.events(spark, sf_dir)
    rollups.build_version(events.filter("event_id % 3 > 0"), root, "v1")
    rollups.switch_version(spark, root, "v1")
    rollups.build_version(events, root, "v2")
    wrong = rollups.verify_version(spark, root, "v2")
    assert len(wrong) == 13 and all(wrong.values())
    with pytest.raises(ValueError):
        rollups.switch_version(spark, root, "v3")
    # A switch that breaks off before the move leaves a file aside and the old version.
    (tmp_path / "versions" / rollups.CURRENT / ".000000000001.tmp").write_text("v")
    assert rollups.version_path(spark, root).endswith("/v1")
    rollups.switch_version(spark, root, "v2")
    assert rollups.version_path(spark, root).endswith("/v2")
    assert not any(rollups.verify_version(spark, root, "v2").values())


def test_pages(spark):
    """Pages by number and pages behind a row give the whole list in order, with equal, null and hidden values."""
    rng = random.Random(2)
    some = lambda *of: rng.choice([None, *of])
    rows = [(some(*(D(d) for d in range(1, 6))), some("a", "b"), rng.randrange(3), f"p{i}") for i in range(120)]
    df = spark.createDataFrame(rows, "day date, exp string, n long, project_id string").repartition(3)
    shown = ("day", "exp", "n")
    order = sorted(rows, key=lambda r: (r[0] is None, -r[0].toordinal() if r[0] else 0, r[1] is not None, r[1] or "", r[2], r[3]))
    for limit in (7, 50):
        last, got = None, []
        while page := bi.detail_after(df, "day", shown, limit, last).collect():
            got += [tuple(r) for r in page]
            last = page[-1]
        assert got == order
        for n in range(20):
            page = [tuple(r) for r in bi.detail(df, "day", shown, limit, n).collect()]
            assert page == [r[:3] for r in order[n * limit : n * limit + limit]]
    plan = bi.detail_after(df, "day", shown, 7, last)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=7" in plan and "offset" not in plan.lower()


def test_collapse(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 1, "q")], "k string, v long, s string")
    assert tuples(rollups.collapse_replace(rows, ["k"], "v"), "k", "v", "s") == [("a", 3, "y"), ("b", 1, "q")]
    assert tuples(rollups.collapse_sum(rows, ["k"], ["v"]), "k", "v") == [("a", 6), ("b", 1)]


def test_order_of_rows_does_not_matter(spark):
    events = clean(spark)
    turned = events.orderBy(F.desc("event_id")).repartition(3)
    for build in (sessions.sessions, retention.retention_daily, funnel.daily_funnel, funnel.all_time_funnel):
        assert sorted(map(tuple, build(events).collect())) == sorted(map(tuple, build(turned).collect()))


def test_repeated_events_do_not_matter_after_dedup(spark):
    events = activity(spark)
    twice = events.unionByName(events)
    for build in (sessions.sessions, retention.retention_daily, funnel.daily_funnel):
        once = build(dedup.deduplicate(events)).collect()
        assert sorted(map(tuple, once)) == sorted(map(tuple, build(dedup.deduplicate(twice)).collect()))
