from datetime import date, timedelta
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dockcast import session
from dockcast.operators import joins
from dockcast.operators import axis
from dockcast.operators.grid import backfill, densify
from dockcast.operators.cleaning import time_window
from dockcast.operators.summarize import GRANULARITIES, count_trips, visit_count
from dockcast.plans import demand
from dockcast.plans.trips import build_trips, join_stations
from dockcast.schemas import FLAGS, HOUR_PERIODS, MEASURES, ONE_HOT_PERIODS, TRIP, WEATHER_COLUMNS

DAY = date(2016, 7, 1)


def _station(spark, ids):
    from dockcast.schemas import STATION_ATTRIBUTES

    rows = [(i, *[float(i + n) for n in range(len(STATION_ATTRIBUTES))]) for i in ids]
    return spark.createDataFrame(rows, ["sta_id", *STATION_ATTRIBUTES])


def _trips(spark, rows):
    """rows: (from, to, day offset, hour)."""
    full = []
    for n, (a, b, d, h) in enumerate(rows):
        start = f"{(DAY + timedelta(days=d)).strftime('%m/%d/%Y')} {h:02d}:00:00"
        values = {f.name: None for f in TRIP}
        values.update(trip_id=n, starttime=start, from_station_id=a, to_station_id=b, birthyear=1980.0)
        full.append(tuple(values[f.name] for f in TRIP))
    return build_trips(spark.createDataFrame(full, TRIP))


def _random_trips(seed, n=60):
    rng = np.random.default_rng(seed)
    return [(int(a), int(b), int(d), int(h)) for a, b, d, h in
            zip(rng.integers(0, 6, n), rng.integers(0, 6, n), rng.integers(0, 5, n), rng.integers(0, 24, n))]


@pytest.mark.parametrize("seed, bound", [(0, None), (1, 30), (2, 10**9)])
def test_grid_is_complete_and_keeps_every_trip(spark, seed, bound):
    rows = _random_trips(seed)
    trips, station = _trips(spark, rows), _station(spark, range(1, 6))
    known = [r for r in rows if r[0] >= 1 and r[1] >= 1]
    grid = demand.demand_grid(trips, station, bound).toPandas()
    slots = {(d, 0 if h == 0 else (h - 1) // 4 + 1, h == 0) for _, _, d, h in known}
    buckets = {(d, HOUR_PERIODS[5 if zero else k - 1]) for d, k, zero in slots}
    assert len(grid) == len({r[0] for r in known}) * len(buckets)
    assert grid.trip_count.sum() == len(known)
    assert not grid.duplicated(["s_sta_id", "date", "hour_period"]).any()
    assert {((d - DAY).days, p) for d, p in zip(grid.date, grid.hour_period)} == buckets


def test_densify_leaves_counts_alone(spark):
    rows = [("a", 1, 5), ("a", 3, 7), ("b", 2, 1)]
    got = densify(spark.createDataFrame(rows, "e string, t int, n long"), ["e"], ["t"], "n")
    assert sorted(tuple(r) for r in got.collect()) == [
        ("a", 1, 5), ("a", 2, 0), ("a", 3, 7), ("b", 1, 0), ("b", 2, 1), ("b", 3, 0)]


@pytest.mark.parametrize("mode", list(GRANULARITIES))
def test_granularities_count_every_trip_once(spark, mode):
    rows = _random_trips(7)
    station = _station(spark, range(1, 6))
    joined = join_stations(_trips(spark, rows), station)
    known = sum(1 for r in rows if r[0] >= 1 and r[1] >= 1)
    counts = count_trips(joined, mode, dense=False, station=station)
    assert counts.agg(F.sum("trip_count")).first()[0] == known
    assert counts.select(*GRANULARITIES[mode].keys).distinct().count() == counts.count()
    assert ("s_num_biz" in counts.columns) == (mode >= 2)
    assert ("t_num_biz" in counts.columns) == (mode in (3, 5))


def test_large_station_table_gives_the_same_counts(spark, monkeypatch):
    rows = _random_trips(3) + [(1, 2, 0, 5)] * 200
    trips, station = _trips(spark, rows), _station(spark, range(1, 6))
    key = ["s_sta_id", "date", "hour_period"]
    small = demand.bucket_counts(trips, station).orderBy(*key).collect()
    joined = join_stations(trips, station).count()
    monkeypatch.setattr("dockcast.plans.demand.is_small", lambda df: False)
    monkeypatch.setattr("dockcast.plans.trips.is_small", lambda df: False)
    assert demand.bucket_counts(trips, station).orderBy(*key).collect() == small
    assert join_stations(trips, station).count() == joined


def test_shuffled_join_equals_broadcast_join(spark):
    facts = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("k"), "id")
    dim = spark.range(40).select(F.col("id").alias("d"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left_semi"):
        a = joins.lookup_join(facts, dim, "k", "d", how, small=True)
        b = joins.lookup_join(facts, dim, "k", "d", how, small=False)
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
        assert a.columns == b.columns
    assert not joins.is_small(dim, max_rows=39) and joins.is_small(dim, max_rows=40)


def _weather_period(spark, buckets):
    rows = [(DAY + timedelta(days=d), p, *[v] * (len(MEASURES) * 3), *[1] * len(FLAGS)) for d, p, v in buckets]
    types = ["date date", "hour_period string"] + [f"{c} double" for c in WEATHER_COLUMNS[: len(MEASURES) * 3]]
    return spark.createDataFrame(rows, ", ".join(types + [f"{f} int" for f in FLAGS]))


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_backfill_equals_a_fill_over_the_whole_table(spark, seed):
    """The filled grid equals pandas' backward fill over rows sorted by station, date, bucket."""
    rng = np.random.default_rng(seed)
    counts = demand.bucket_counts(_trips(spark, _random_trips(seed, 40)), _station(spark, range(0, 6)))
    present = [(d, p, float(rng.integers(0, 99))) for d in range(5) for p in HOUR_PERIODS if rng.random() < 0.3]
    weather = _weather_period(spark, present)
    raw = demand.grid_with_weather(counts, weather, fill=False).toPandas()
    order = ["s_sta_id", "date", "hour_period"]
    want = raw.sort_values(order).reset_index(drop=True)
    want[WEATHER_COLUMNS] = want[WEATHER_COLUMNS].bfill()
    got = demand.grid_with_weather(counts, weather, wrap=True).toPandas().sort_values(order).reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want, check_dtype=False)
    own = raw.sort_values(order).reset_index(drop=True)
    own[WEATHER_COLUMNS] = own.groupby("s_sta_id")[WEATHER_COLUMNS].bfill()
    plain = demand.grid_with_weather(counts, weather, wrap=False).toPandas().sort_values(order).reset_index(drop=True)
    pd.testing.assert_frame_equal(plain, own, check_dtype=False)


def test_model_data_columns(spark):
    trips, station = _trips(spark, _random_trips(5)), _station(spark, range(0, 6))
    model = demand.build_model_data(trips, station, _weather_period(spark, [(0, HOUR_PERIODS[0], 1.0)]))
    hot = list(ONE_HOT_PERIODS.values())
    assert model.columns == ["date", "s_sta_id", "week_of_year", "weekday", "business_day", "trip_count", *WEATHER_COLUMNS, *hot]
    assert model.select(sum(F.col(c) for c in hot).alias("n")).distinct().collect()[0].n == 1
    assert demand.axis_bound(trips) == 30


def test_trips_are_scanned_once_and_the_axis_is_broadcast(spark, tmp_path):
    path = str(tmp_path / "trips")
    _trips(spark, _random_trips(1)).write.parquet(path)
    station = _station(spark, range(0, 6))
    grid = demand.demand_grid(spark.read.parquet(path), station, axis_rows=30)
    grid.collect()
    plan = grid._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan parquet") == 1
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("closed, small", [("both", True), ("left", True), ("both", False)])
def test_activity_equals_counting_the_window(spark, monkeypatch, closed, small):
    rows = _random_trips(9, 150) + [(1, 2, 3, 0), (2, 0, 3, 0), (1, 2, 3, 1)]
    trips, station = _trips(spark, rows), _station(spark, range(1, 6))
    day = DAY + timedelta(days=2)
    if not small:
        monkeypatch.setattr("dockcast.plans.demand.is_small", lambda df: False)
    window = time_window(trips, day, 1, 1, closed)
    part = demand.activity_window(demand.station_activity(trips, station), day, 1, 1, closed)
    pairs = [
        (demand.bucket_counts(window, station), demand.activity_counts(part, station)),
        (visit_count(window), demand.activity_visits(part)),
    ]
    for want, got in pairs:
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_default_call_broadcasts_the_axis(spark):
    trips, station = _trips(spark, _random_trips(5)), _station(spark, range(1, 6))
    plan = demand.demand_grid(trips, station)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_scratch_tables_go(spark, monkeypatch):
    monkeypatch.setattr(session, "_WRITTEN", [])
    table = session.materialise(spark.range(3).toDF("x"), "gone")
    (file,) = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
    session.drop_scratch(spark)
    assert not Path(file.removeprefix("file://").removeprefix("file:")).exists()


@pytest.mark.parametrize("days", [1, 3, 1000])
def test_segments_of_an_axis_equal_the_whole(spark, days):
    """Numbers, shifts and next known values, with gaps longer than a segment."""
    draw = np.random.default_rng(days)
    rows = [(DAY + timedelta(days=d), p, None if d in (3, 4, 5, 6, 7) or draw.random() < 0.4 else float(d), None if d < 9 else 1.0)
            for d in range(14) for p in HOUR_PERIODS if draw.random() < 0.8 and d != 11]
    rows += [(DAY + timedelta(days=20), HOUR_PERIODS[0], None, None)]
    table = spark.createDataFrame(rows, "date date, hour_period string, x double, y double").repartition(3)
    order = ["date", "hour_period"]
    plain = sorted(rows, key=lambda r: r[:2])
    got = axis.numbered(table, order, days).orderBy(*order).collect()
    assert [r["_pos"] for r in got] == list(range(len(rows))) and {r["_size"] for r in got} == {len(rows)}
    for wrap in (False, True):
        one, other = (f(table, order, ["x", "y"], wrap=wrap, **more).orderBy(*order) for f, more in ((backfill, {}), (axis.next_known, {"segment_days": days})))
        assert [r.asDict() for r in other.collect()] == [r.asDict() for r in one.select(other.columns).collect()]
    lagged = axis.shifted(table, order, {"x_1": ("x", 1), "y_5": ("y", 5)}, days).orderBy(*order).collect()
    assert [(r.x_1, r.y_5) for r in lagged] == [(plain[k - 1][2] if k else None, plain[k - 5][3] if k > 4 else None) for k in range(len(plain))]


def test_no_window_has_the_whole_axis(spark):
    """Every unpartitioned window in these plans reads one row per segment."""
    table = spark.range(1000).selectExpr("date_add(date '2020-01-01', cast(id AS int)) AS date", "cast(id AS double) AS x")
    for made in (axis.numbered(table, ["date"], 30), axis.next_known(table, ["date"], ["x"], 30), axis.shifted(table, ["date"], {"y": ("x", 2)}, 30)):
        plan = made._jdf.queryExecution().optimizedPlan().toString().splitlines()
        for k, line in enumerate(plan):
            if "+- Window [" in line and "_segment" not in line.split("windowspecdefinition(")[1].split(" ASC")[0].split(" DESC")[0].split(",")[0]:
                assert any("Aggregate [_segment" in below for below in plan[k + 1 : k + 6]), line
