from datetime import date, datetime, timedelta
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockcast.catalog import queries
from dockcast.config import EngineConfig, ForecastParams
from dockcast.operators.cleaning import split_by_date
from dockcast.plans import demand, episodes, forecast, run, windows
from dockcast.schemas import FEATURES, HOUR_PERIODS
from dockcast.sources.files import Prepared, save_prepared
from tests.test_grid import DAY, _random_trips, _station, _trips, _weather_period

SF, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"
FAST = ForecastParams(max_iter=2, max_depth=2, step_size=0.5)


@pytest.fixture(scope="module")
def tables(spark):
    rows = _random_trips(11, 240)
    weather = _weather_period(spark, [(d, p, float(d)) for d in range(4) for p in HOUR_PERIODS])
    return _trips(spark, rows).cache(), _station(spark, range(0, 6)), weather


def test_one_date_keeps_keys_and_scores(spark, tables):
    found = forecast.forecast_one_date(
        *tables, DAY + timedelta(days=4), trace_back_days=4, n_clusters=2, params=FAST)
    rows = found.predictions.toPandas()
    assert len(rows) and rows.pred.notna().all() and set(rows.date) == {DAY + timedelta(days=4)}
    assert rows.cluster.nunique() == 2 and not rows.duplicated(["s_sta_id", "date", "hour_period"]).any()
    y, p = rows.trip_count, rows.pred
    want = 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert found.score.first().r2 == pytest.approx(want)


def test_cluster_without_train_rows_is_reported(spark):
    columns = ["s_sta_id", "date", "hour_period", "trip_count", "x"]
    rows = [(1, DAY, "1,1-4", 1, 0.5), (1, DAY, "2,5-8", 2, 1.5), (1, DAY + timedelta(days=1), "1,1-4", 3, None),
            (2, DAY + timedelta(days=1), "1,1-4", 4, 1.0)]
    data = spark.createDataFrame(rows, "s_sta_id long, date date, hour_period string, trip_count long, x double")
    assert data.columns == columns
    labels = spark.createDataFrame([(1, 0), (2, 1)], "sta_id long, cluster int")
    train, test = split_by_date(data, DAY + timedelta(days=1))
    got = {r.cluster: r for r in forecast.forecast_all(train, test, labels, FAST, features=["x"]).collect()}
    assert got[0].status == "ok" and got[0].pred is not None
    assert got[1].status == "no train rows" and got[1].pred is None and got[1].trip_count == 4


def test_rolling_run_from_prepared_tables(spark, tables, tmp_path):
    trips, station, weather = tables
    path = str(tmp_path / "prepared")
    save_prepared(Prepared(station, weather, trips), path)
    config = EngineConfig(prepared_path=path, forecast_end=DAY + timedelta(days=4), process_days=2,
                          trace_back_days=3, n_clusters=2, model=FAST)
    result = run.run(spark, config)
    scores = {r.forecast_date: r.r2 for r in result.scores.collect()}
    assert set(scores) == {DAY + timedelta(days=3), DAY + timedelta(days=4)}
    assert result.mean.first().mean_r2 == pytest.approx(np.mean(list(scores.values())))
    assert result.predictions.select("forecast_date").distinct().count() == 2


@pytest.mark.parametrize("closed", ["both", "left"])
def test_shared_windows_equal_windows_of_their_own(spark, tables, closed):
    """Model rows and visits of several dates from shared tables, and of each date from its own trips."""
    trips, station, weather = tables
    trips = trips.unionByName(_trips(spark, [(1, 2, d, 0) for d in (2, 3, 4)] + [(5, 2, 3, 0), (4, 1, 0, 9)]))
    days = [DAY + timedelta(days=d) for d in (2, 3, 4)]
    activity = demand.station_activity(trips, station)
    own = windows.spans(days, 2, 1, closed)
    rows = windows.model_rows(activity, station, weather, own).cache()
    seen = windows.visits(activity, own)
    for day in days:
        cut = demand.activity_window(activity, day, 2, 1, closed)
        want = demand.model_from_counts(demand.activity_counts(cut, station), weather, keep_period=True)
        got = rows.where(F.col("forecast_date") == F.lit(day))
        assert got.where("is_train != (date < forecast_date)").isEmpty() and want.count() > 20
        got = got.select(want.columns)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
        mine = seen.where(F.col("forecast_date") == F.lit(day)).drop("forecast_date")
        other = demand.activity_visits(cut)
        assert mine.select(other.columns).exceptAll(other).isEmpty() and other.exceptAll(mine.select(other.columns)).isEmpty()


def test_rows_of_a_rolling_run_hold_no_features(spark, tables, monkeypatch):
    """Features are made and binned once per date and bucket, not per station; those of all rows are the same."""
    days = [DAY + timedelta(days=d) for d in (3, 4)]
    activity, own = demand.station_activity(tables[0], tables[1]), windows.spans(days, 3, 1)
    found = {}
    fit = forecast.fit_predict
    monkeypatch.setattr(forecast, "fit_predict", lambda rows, *a, **k: found.update(rows=rows, **k) or fit(rows, *a, **k))
    options = dict(trace_back_days=3, n_clusters=2, params=FAST)
    thin = forecast.rolling_forecast(*tables, days[-1], 2, **options).predictions
    assert not set(FEATURES) & set(found["rows"].columns) and found["vectors"].count() <= 2 * windows.axis_rows(own) * len(own)
    wide = windows.model_rows(activity, *tables[1:], own).select("forecast_date", "s_sta_id", "date", "hour_period", "trip_count", "is_train", *FEATURES)
    got = found["rows"].join(found["vectors"], found["at"]).select(wide.columns)
    assert got.count() > 100 and got.exceptAll(wide).isEmpty() and wide.exceptAll(got).isEmpty()
    monkeypatch.setattr(windows, "MAX_BROADCAST_ROWS", 0)
    again = forecast.rolling_forecast(*tables, days[-1], 2, **options).predictions
    assert set(FEATURES) < set(found["rows"].columns) and sorted(map(tuple, again.collect())) == sorted(map(tuple, thin.collect()))


def test_rolling_dates_equal_single_dates(spark, tables, tmp_path):
    """Neither the other dates of a run nor a record of models change a prediction."""
    ledger = str(tmp_path / "ledger")
    both = forecast.rolling_forecast(*tables, DAY + timedelta(days=4), 2, trace_back_days=3, n_clusters=2, params=FAST, ledger=ledger)
    plain = lambda df: {(r.forecast_date, r.s_sta_id, r.date, r.hour_period): (r.cluster, r.pred) for r in df.collect()}
    one = {}
    for d in (3, 4):
        one |= plain(forecast.forecast_one_date(*tables, DAY + timedelta(days=d), trace_back_days=3, n_clusters=2, params=FAST).predictions)
    assert plain(both.predictions) == one
    assert both.cluster_scores.count() == 4 and spark.read.parquet(ledger).count() == 4


def test_shuffled_bytes_of_episodes_do_not_grow_with_their_length(spark):
    """No row is copied before the last exchange: explodes make ends and features only."""
    data = _dense(spark, 12, [3, 1, 2])
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "sta_id long, cluster int")
    for n in (2, 9):
        nested = episodes.episodes_nested(data, labels, DAY + timedelta(days=10), features=["trip_count"], episode_len=n, train_days=4, test_days=2)
        plan = nested._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" in plan and f"sequence(date, date_add(date, {n - 1})" not in plan
        assert plan.count("Generate explode") == 1


def _dense(spark, days, stations):
    rows = [(s, DAY + timedelta(days=d), p, s * 1000 + d * 10 + i) for s in stations for d in range(days)
            for i, p in enumerate(HOUR_PERIODS)]
    return spark.createDataFrame(rows, "s_sta_id long, date date, hour_period string, trip_count long")


def test_episodes_long_and_nested_agree(spark):
    data = _dense(spark, 12, [3, 1, 2])
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "sta_id long, cluster int")
    options = dict(features=["trip_count"], episode_len=3, train_days=4, test_days=2)
    fd = DAY + timedelta(days=10)
    long = episodes.episodes_long(data, labels, fd, **options)
    ends = {(r.split, (fd - r.episode_end).days) for r in long.select("split", "episode_end").distinct().collect()}
    assert ends == {("test", 1), ("test", 2), ("train", 3), ("train", 4), ("train", 5), ("train", 6)}
    spans = long.groupBy("episode_end", "feature").agg(
        F.min(F.datediff("date", "episode_end")).alias("lo"), F.max(F.datediff("date", "episode_end")).alias("hi"))
    assert {(r.feature, r.lo, r.hi) for r in spans.collect()} == {("trip_count", -2, 0), ("label", 1, 1)}

    nested = episodes.episodes_nested(data, labels, fd, **options).filter("cluster = 0")
    for r in nested.collect():
        assert r.station_block == 0 and list(r.stations) == [1, 2]
        assert len(r.matrix) == (18 if r.feature == "trip_count" else 6) == len(r.buckets)
        first = r.episode_end - timedelta(days=2) if r.feature == "trip_count" else r.episode_end + timedelta(days=1)
        assert r.buckets[0] == f"{first}_1,1-4"
        d = (first - DAY).days
        assert list(r.matrix[0]) == [1000.0 + d * 10, 2000.0 + d * 10]

    missing = data.filter(F.col("date") != F.lit(DAY + timedelta(days=7)))  # a day nobody has a row for
    cells = episodes.episodes_nested(missing, labels, fd, **options).select(
        "split", "episode_end", "feature", "stations", F.inline(F.arrays_zip("buckets", "matrix")))
    cells = cells.select("split", "episode_end", "feature", "buckets", F.inline(F.arrays_zip("stations", "matrix")))
    flat = episodes.episodes_long(missing, labels, fd, **options)
    assert sorted((r[0], r[1], r[2], r[3], r[4], r[5]) for r in cells.collect()) == sorted(
        (r.split, r.episode_end, r.feature, f"{r.date}_{r.hour_period}", r.s_sta_id, r.value) for r in flat.collect())

    blocks = episodes.episodes_nested(data, labels, fd, block_stations=1, **options).filter("cluster = 0")
    found = {(r.station_block, r.station_blocks, tuple(r.stations)) for r in blocks.collect()}
    assert sorted(s for _, _, stations in found for s in stations) == [1, 2]
    assert {n for _, n, _ in found} == {2}


def test_inclusive_end_adds_the_midnight_trip(spark):
    midnight = datetime(DAY.year, DAY.month, DAY.day) + timedelta(days=2)
    trips = _trips(spark, [(1, 2, 0, 9), (1, 2, 1, 9), (1, 2, 2, 0), (1, 2, 2, 1)])
    from dockcast.operators.cleaning import time_window

    kept = time_window(trips, DAY + timedelta(days=1), 5, 1)
    assert kept.filter(F.col("starttime_dt") == F.lit(midnight.isoformat()).cast("timestamp_ntz")).count() == 1
    assert kept.count() == 3
    assert {(r.date, r.hour_period) for r in kept.filter("hour = 0").collect()} == {(date(2016, 7, 3), "6,21-24")}


def test_all_dates_are_clustered_in_the_same_rounds(spark, tables, monkeypatch):
    asked = []
    ward = forecast.ward_labels
    monkeypatch.setattr(forecast, "ward_labels", lambda *a, **k: asked.append(k) or ward(*a, **k))
    ends = DAY + timedelta(days=4)
    both = forecast.rolling_forecast(*tables, ends, 2, trace_back_days=3, n_clusters=3, params=FAST)
    assert asked == [{"by": "_date"}]
    for day in (ends - timedelta(days=1), ends):
        alone = forecast.forecast_one_date(*tables, day, trace_back_days=3, n_clusters=3, params=FAST)
        key = ["s_sta_id", "date", "hour_period", "cluster", "pred"]
        got = both.predictions.filter(F.col("forecast_date") == F.lit(day)).select(*key)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, alone.predictions.select(*key).collect()))


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
def test_registered_forecasts_run_the_production_model(spark, monkeypatch):
    """Every label has a model of its own, no query passes a smaller one, and both come to their end."""
    asked = []
    fit = forecast.fit_predict
    monkeypatch.setattr(forecast, "fit_predict", lambda *a, **k: asked.append(a[5]) or fit(*a, **k))
    rows = queries.cluster_forecast(spark, SMALL).collect()
    assert {r.cluster for r in rows} == {r.cluster for r in queries.roles.labels(spark, SMALL).collect()} & {r.cluster for r in rows}
    assert rows and all(r.status == "ok" and r.pred is not None for r in rows)
    scores = queries.rolling_forecast(spark, SF).collect()
    assert {r.forecast_date for r in scores} == {date(2024, 1, 25) + timedelta(days=d) for d in range(5)}
    assert all(r.r2 is not None and r.unscored == 0 for r in scores)
    assert asked == [ForecastParams()] * 2 and ForecastParams().max_iter == 500


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
def test_one_split_of_every_label_is_its_train_mean(spark):
    got = queries.forecast_one_split_labels(spark, SF).toPandas()
    assert got.cluster.nunique() == 25 and (got.status == "ok").all()
    data = queries._model(spark, SF, keep_period=True).select("s_sta_id", "date", "trip_count", "business_day").toPandas()
    data["cluster"] = data.s_sta_id.map({r.sta_id: r.cluster for r in queries.roles.labels(spark, SF).collect()})
    want = data[data.date < date(2024, 1, 26)].groupby(["cluster", "business_day"]).trip_count.mean()
    kind = data.drop_duplicates("date").set_index("date").business_day
    assert got.pred.tolist() == pytest.approx([want[c, kind[d]] for c, d in zip(got.cluster, got.date, strict=True)], abs=1e-5)
