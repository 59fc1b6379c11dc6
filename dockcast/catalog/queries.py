"""Registered queries: each operator on the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockcast.catalog import roles
from dockcast.config import EngineConfig, ForecastParams
from dockcast.functions import timecols as tc
from dockcast.operators import cleaning, joins, metrics, reshape, scaling, summarize, windows
from dockcast.operators.grid import densify
from dockcast.operators.ward import ward_labels
from dockcast.plans import clusters, demand, episodes, forecast
from dockcast.plans.trips import build_trips, join_stations
from dockcast.plans.weather import build_weather, clean_weather, weather_by_period
from dockcast.schemas import FLAGS, MEASURES, ONE_HOT_PERIODS, PROFILE_KEYS, STATION_NAMES, TRIP, WEATHER, WEATHER_COLUMNS
from dockcast.session import scratch_path
from dockcast.sources.files import (
    Prepared,
    Tables,
    list_csv,
    load_prepared,
    prepare,
    prepare_tables,
    read_csv_folder,
    read_station_csv,
    save_prepared,
)

Query = Callable[[SparkSession, str], DataFrame]
ROUND = 6
_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


def rounded(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.selectExpr(*[f"round(`{c}`, {ROUND}) AS `{c}`" if c in columns else f"`{c}`" for c in df.columns])


def _means(df: DataFrame) -> DataFrame:
    return rounded(df, [c for c in WEATHER_COLUMNS if c.endswith("_mean")])


def _trips(spark: SparkSession, sf: str) -> DataFrame:
    return build_trips(roles.trip(spark, sf))


def _joined(spark: SparkSession, sf: str) -> DataFrame:
    return join_stations(_trips(spark, sf), roles.station(spark, sf))


def _bound(spark: SparkSession, sf: str) -> int:
    return demand.axis_bound(roles.table(spark, sf, "events"), "ts")


def _counts(spark: SparkSession, sf: str) -> DataFrame:
    return demand.bucket_counts(_trips(spark, sf), roles.station(spark, sf))


def _grid(spark: SparkSession, sf: str) -> DataFrame:
    return densify(_counts(spark, sf), ["s_sta_id"], demand.BUCKET, "trip_count", axis_rows=_bound(spark, sf))


def _period(spark: SparkSession, sf: str) -> DataFrame:
    return weather_by_period(clean_weather(roles.weather(spark, sf)))


def _visits(spark: SparkSession, sf: str) -> DataFrame:
    return summarize.visit_count(_trips(spark, sf))


def _model(spark: SparkSession, sf: str, **options) -> DataFrame:
    return demand.build_model_data(
        _trips(spark, sf), roles.station(spark, sf), _period(spark, sf), axis_rows=_bound(spark, sf), **options
    )


def _events(spark: SparkSession, sf: str) -> DataFrame:
    hour = F.hour("ts")
    return roles.table(spark, sf, "events").select(
        "event_id", F.to_date("ts").alias("date"), hour.alias("hour"), tc.hour_period("hour(ts)").alias("hour_period")
    )


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return roles.table(spark, sf, "orders").withColumn("date", F.to_date("o_orderdate"))


# --- trip counts ---------------------------------------------------------------------


@query
def demand_grid(spark, sf):
    return demand.demand_grid(_trips(spark, sf), roles.station(spark, sf), _bound(spark, sf))


@query
def trip_count_city_day(spark, sf):
    return summarize.count_trips(_joined(spark, sf), 1)


@query
def trip_count_station_day(spark, sf):
    return summarize.count_trips(_joined(spark, sf), 2, station=roles.station(spark, sf))


@query
def trip_count_od_day(spark, sf):
    return summarize.count_trips(_joined(spark, sf), 3, station=roles.station(spark, sf))


@query
def trip_count_station_hour(spark, sf):
    return summarize.count_trips(_joined(spark, sf), 4, station=roles.station(spark, sf))


@query
def trip_count_od_period(spark, sf):
    return summarize.count_trips(_joined(spark, sf), 5, station=roles.station(spark, sf))


@query
def trip_count_station_period(spark, sf):
    return summarize.count_trips(
        _joined(spark, sf), 6, station=roles.station(spark, sf), axis_rows=_bound(spark, sf)
    )


@query
def trip_lattice(spark, sf):
    """All six granularities from one stored count; ``mode`` says which one a row is of."""
    found = summarize.trip_lattice(_joined(spark, sf))
    keys = ["date", "s_sta_id", "t_sta_id", "hour_period", "hour"]
    rows = [df.select(F.lit(m).alias("mode"), *[c if c in df.columns else F.lit(None).alias(c) for c in keys], "trip_count") for m, df in found.items()]
    return reduce(DataFrame.unionByName, rows)


@query
def trip_count_station_day_dense(spark, sf):
    return summarize.count_trips(_joined(spark, sf), 2, dense=True)


# --- columns -------------------------------------------------------------------------


@query
def hour_period(spark, sf):
    return _events(spark, sf).select("event_id", "hour", "hour_period")


@query
def parse_trip_time(spark, sf):
    return roles.trip(spark, sf).select(
        "trip_id", "starttime", tc.parse_time("starttime").alias("starttime_dt")
    )


@query
def parse_weather_time(spark, sf):
    return roles.weather(spark, sf).select("datetime", tc.parse_time("datetime").alias("parsed"), "tempi")


@query
def calendar_parts(spark, sf):
    return _orders(spark, sf).select(
        "o_orderkey",
        "date",
        F.hour("o_orderdate").alias("hour"),
        F.weekofyear("date").alias("week_of_year"),
        F.weekday("date").alias("weekday"),
    )


@query
def profile_key(spark, sf):
    key = tc.profile_key("date", "hour_period")
    return _events(spark, sf).select("event_id", key.alias("weekday_hour_period"))


@query
def grid_key(spark, sf):
    key = tc.grid_key("date", "hour_period")
    keyed = _events(spark, sf).select("event_id", key.alias("date_hour_period"))
    day, period = tc.split_grid_key("date_hour_period")
    return keyed.withColumns({"date": day, "hour_period": period})


@query
def business_day(spark, sf):
    return _orders(spark, sf).select("o_orderkey", "date", tc.is_business_day("date").alias("business_day"))


@query
def business_calendar(spark, sf):
    return tc.business_calendar(_orders(spark, sf))


@query
def date_window(spark, sf):
    return _orders(spark, sf).select(
        "o_orderkey", "date", F.date_sub("date", 365).alias("window_start"), F.date_add("date", 1).alias("window_end")
    )


@query
def date_range(spark, sf):
    return _orders(spark, sf).select("o_orderkey", F.explode(tc.dates_ending("date", 5)).alias("date"))


@query
def cluster_color(spark, sf):
    return clusters.station_colors(roles.station(spark, sf), roles.labels(spark, sf))


@query
def row_share(spark, sf):
    return rounded(reshape.row_share(_visits(spark, sf)), ["share"])


# --- cleaning and filters ------------------------------------------------------------


@query
def weather_valid(spark, sf):
    return clean_weather(roles.weather(spark, sf))


@query
def trip_fill(spark, sf):
    filled = cleaning.fill_constants(cleaning.drop_trip_columns(roles.trip(spark, sf)))
    return rounded(cleaning.fill_mean(filled, "birthyear"), ["birthyear"])


@query
def drop_null_rows(spark, sf):
    return cleaning.drop_null_rows(roles.trip(spark, sf))


@query
def null_report(spark, sf):
    return cleaning.null_report(roles.trip(spark, sf))


@query
def range_filter(spark, sf):
    return rounded(cleaning.time_window(_trips(spark, sf), date(2024, 1, 20), 10, 1), ["birthyear"])


@query
def train_test_split(spark, sf):
    before, after = cleaning.split_by_date(_grid(spark, sf), date(2024, 1, 20))
    return before.withColumn("split", F.lit("train")).unionByName(after.withColumn("split", F.lit("test")))


@query
def site_filter(spark, sf):
    return cleaning.site_rows(_grid(spark, sf), 7)


# --- joins ---------------------------------------------------------------------------


@query
def trip_station(spark, sf):
    return rounded(_joined(spark, sf), ["birthyear"])


@query
def cluster_members(spark, sf):
    return joins.cluster_members(_grid(spark, sf), roles.labels(spark, sf), 3, keep_station=True)[0]


@query
def cluster_rows(spark, sf):
    return joins.with_cluster(_grid(spark, sf), roles.labels(spark, sf))


@query
def episode_dates(spark, sf):
    cells = _grid(spark, sf).withColumn("feature", F.lit("trip_count"))
    rows = episodes.to_episodes(cells, date(2024, 1, 28), 7, 1, 8, 5)
    return rows.groupBy("episode_end", "date").agg(
        F.count(F.lit(1)).alias("cells"), F.sum("trip_count").alias("trip_count")
    )


# --- summaries -----------------------------------------------------------------------


@query
def station_activity(spark, sf):
    return demand.station_activity(_trips(spark, sf), roles.station(spark, sf))


@query
def activity_counts(spark, sf):
    activity = demand.station_activity(_trips(spark, sf), roles.station(spark, sf))
    window = demand.activity_window(activity, date(2024, 1, 20), 10, 1)
    return demand.activity_counts(window, roles.station(spark, sf))


@query
def visit_count(spark, sf):
    return _visits(spark, sf)


@query
def group_summary(spark, sf):
    out = summarize.group_summary(
        roles.table(spark, sf, "orders"),
        ["o_orderpriority", "o_orderstatus"],
        ["o_totalprice"],
        ["o_custkey"],
        ["o_orderdate"],
    )
    return rounded(out, ["o_totalprice_mean"])


@query
def weather_period(spark, sf):
    return _means(_period(spark, sf))


@query
def weather_daily_lags_segments(spark, sf):
    """The lags of ``weather_daily_lags`` with the calendar in segments of five days."""
    daily = summarize.group_summary(clean_weather(roles.weather(spark, sf)), ["date"], MEASURES, FLAGS)
    return _means(windows.lag_flags(daily, segment_days=5).na.drop("any"))


@query
def weather_daily_lags(spark, sf):
    return _means(build_weather(roles.weather(spark, sf)).daily)


@query
def weather_calendar_lags(spark, sf):
    daily = summarize.group_summary(clean_weather(roles.weather(spark, sf)), ["date"], None, FLAGS)
    return windows.lag_flags(daily, by="calendar")


@query
def distinct_stations(spark, sf):
    return summarize.distinct_sorted(_joined(spark, sf), "s_sta_id")


@query
def distinct_count(spark, sf):
    return summarize.distinct_count(_joined(spark, sf), "s_sta_id")


def _predicted(spark, sf):
    mean = F.avg("trip_count").over(W.partitionBy("s_sta_id", "hour_period"))
    return _grid(spark, sf).withColumn("pred", mean)


@query
def r2(spark, sf):
    return rounded(metrics.r2_score(_predicted(spark, sf)), ["r2"])


@query
def mean_r2(spark, sf):
    scores = metrics.r2_score(_predicted(spark, sf), by=["date"])
    return rounded(metrics.mean_r2(scores), ["mean_r2"])


# --- reshape and scale ---------------------------------------------------------------


@query
def profile_pivot(spark, sf):
    return reshape.profile_pivot(_visits(spark, sf))


@query
def one_hot(spark, sf):
    return reshape.one_hot(_events(spark, sf).select("event_id", "hour_period"), "hour_period", ONE_HOT_PERIODS)


@query
def one_hot_observed(spark, sf):
    return reshape.one_hot(roles.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus")


@query
def minmax(spark, sf):
    wide = reshape.profile_pivot(_visits(spark, sf))
    return rounded(scaling.similarity_table(wide, PROFILE_KEYS, "absolute")[0], PROFILE_KEYS)


@query
def minmax_relative(spark, sf):
    wide = reshape.profile_pivot(_visits(spark, sf))
    return rounded(scaling.similarity_table(wide, PROFILE_KEYS, "relative")[0], PROFILE_KEYS)


@query
def minmax_train_test(spark, sf):
    columns = ["o_totalprice", "o_custkey"]
    rows = _orders(spark, sf).select("o_orderkey", "date", *columns)
    train, test = cleaning.split_by_date(rows, date(1998, 1, 1))
    train, test = scaling.standardize_train_test(train, test, columns)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return rounded(both.drop("date"), columns)


# --- series --------------------------------------------------------------------------

_EPISODES = {
    "forecast_date": date(2024, 1, 26),
    "features": ["trip_count", "tempi_mean", "rain"],
    "episode_len": 7,
    "label_day_len": 2,
    "train_days": 6,
    "test_days": 3,
}


@query
def episodes_long(spark, sf):
    data = _model(spark, sf, keep_period=True)
    return rounded(episodes.episodes_long(data, roles.labels(spark, sf), **_EPISODES), ["value"])


@query
def episodes_nested(spark, sf):
    data = _model(spark, sf, keep_period=True)
    return episodes.episodes_nested(data, roles.labels(spark, sf), **_EPISODES)


@query
def episodes_nested_cells(spark, sf):
    """The matrices taken apart again: one row per time, station and feature."""
    nested = episodes_nested(spark, sf)
    keys = ["cluster", "split", "episode_end", "feature"]
    times = nested.select(*keys, "stations", F.inline(F.arrays_zip("buckets", "matrix")))
    cells = times.select(*keys, F.col("buckets").alias("bucket"), F.inline(F.arrays_zip("stations", "matrix")))
    return rounded(cells.toDF(*keys, "bucket", "s_sta_id", "value"), ["value"])


@query
def target_shift(spark, sf):
    return windows.target_shift(_grid(spark, sf), 6)


@query
def site_series(spark, sf):
    """Features and next-day target of one station, side by side again."""
    grid = demand.demand_grid(_trips(spark, sf), roles.station(spark, sf), _bound(spark, sf))
    features, target = windows.site_timeseries(grid, 7, 6)
    return features.join(target, ["s_sta_id", "date", "hour_period"])


@query
def backfill_weather(spark, sf):
    filled = demand.grid_with_weather(
        _counts(spark, sf), _period(spark, sf), wrap=False, axis_rows=_bound(spark, sf)
    )
    return _means(filled)


@query
def backfill_weather_segments(spark, sf):
    """The same with the axis numbered and filled in segments of four days."""
    filled = demand.grid_with_weather(
        _counts(spark, sf), _period(spark, sf), wrap=False, axis_rows=_bound(spark, sf), segment_days=4
    )
    return _means(filled)


@query
def grid_weather_join(spark, sf):
    joined = demand.grid_with_weather(
        _counts(spark, sf), _period(spark, sf), fill=False, axis_rows=_bound(spark, sf)
    )
    return _means(joined)


@query
def model_data(spark, sf):
    return _means(_model(spark, sf))


@query
def trip_prepared(spark, sf):
    return rounded(_trips(spark, sf), ["birthyear"])


# --- files ---------------------------------------------------------------------------


@query
def union_files(spark, sf):
    """Two CSV exports with different column order, one of them without a column."""
    folder = scratch_path(spark, "csv")
    orders = roles.table(spark, sf, "orders")
    opened = orders.filter("o_orderstatus = 'O'").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    other = orders.filter("o_orderstatus <> 'O'").select("o_totalprice", "o_orderkey", "o_custkey")
    for part in (opened, other):
        part.write.mode("append").option("header", True).csv(folder)
    return read_csv_folder(spark, folder, T.StructType.fromDDL("o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string"))


@query
def load_and_prepare(spark, sf):
    """The roles as CSV folders, loaded and prepared; a second call takes what the first saved."""
    base = scratch_path(spark, "bundle")
    back = {v: k for k, v in STATION_NAMES.items()}
    roles.station(spark, sf).withColumnsRenamed(back).coalesce(1).write.option("header", True).csv(f"{base}/station")
    (part,) = list_csv(spark, f"{base}/station")
    for name, table in (("weather", roles.weather(spark, sf)), ("trip", roles.trip(spark, sf))):
        table.write.option("header", True).csv(f"{base}/{name}")
    tables = Tables(
        read_station_csv(spark, part), read_csv_folder(spark, f"{base}/weather", WEATHER), read_csv_folder(spark, f"{base}/trip", TRIP)
    )
    saved = scratch_path(spark, "saved")
    save_prepared(prepare_tables(tables), saved)
    again = prepare(spark, EngineConfig(data_path=f"{base}/gone", prepared_path=saved))
    total = lambda df, name, c: df.agg(
        F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows"), F.round(F.sum(c), 4).cast("double").alias("total")
    )
    return (
        total(again.station, "station", "sta_id")
        .unionByName(total(again.weather_period, "weather_period", "tempi_max"))
        .unionByName(total(again.trip, "trip", "to_station_id"))
    )


@query
def one_hot_several(spark, sf):
    kept = roles.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    names = {"o_orderstatus": {"O": "is_open", "F": "is_final"}, "o_orderpriority": {"1-URGENT": "is_urgent"}}
    return reshape.one_hot(kept, ["o_orderstatus", "o_orderpriority"], names)


@query
def save_reload(spark, sf):
    path = scratch_path(spark, "prepared")
    save_prepared(Prepared(roles.station(spark, sf), _period(spark, sf), _trips(spark, sf)), path)
    return rounded(load_prepared(spark, path).trip, ["birthyear"])


# --- clustering and forecasting ------------------------------------------------------


@query
def station_clusters(spark, sf):
    found = clusters.process_clustering(_trips(spark, sf), 8, roles.station(spark, sf))
    return found.station.select("sta_id", "cluster")


@query
def station_clusters_in_blocks(spark, sf):
    """The same labels, merged in rounds over blocks of 16 profiles."""
    points = clusters.profile_points(reshape.profile_pivot(summarize.visit_count(_trips(spark, sf))))
    labels = ward_labels(points, 8, block_rows=16)
    return clusters.label_stations(roles.station(spark, sf), labels).select("sta_id", "cluster")


@query
def station_clusters_leaves(spark, sf):
    """The labels by way of leaves; with more leaves than profiles they are those of the exact method."""
    found = clusters.process_clustering(_trips(spark, sf), 8, roles.station(spark, sf), method="leaves")
    return found.station.select("sta_id", "cluster")


@query
def station_clusters_bisecting(spark, sf):
    found = clusters.process_clustering(_trips(spark, sf), 8, roles.station(spark, sf), method="bisecting")
    return found.station.select("sta_id", "cluster")


@query
def cluster_forecast(spark, sf):
    """A production model for every label."""
    data = _model(spark, sf, keep_period=True)
    train, test = cleaning.split_by_date(data, date(2024, 1, 28))
    return forecast.forecast_all(train, test, roles.labels(spark, sf))


def _one_split(spark, sf, labels):
    """A single tree with one split on the business day: each cluster's train mean of either kind of day."""
    data = _model(spark, sf, keep_period=True)
    train, test = cleaning.split_by_date(data, date(2024, 1, 26))
    single = ForecastParams(max_iter=1, max_depth=1, subsampling_rate=1.0, feature_subset="all", engine="spark")
    return rounded(forecast.forecast_all(train, test, labels, single, ["business_day"]), ["pred"])


@query
def forecast_one_split(spark, sf):
    """Nine labels make one cluster, as in its SQL; ``forecast_one_split_labels`` has them all."""
    labels = roles.labels(spark, sf).withColumn("cluster", F.floor(F.col("cluster") / 9).cast("int"))
    return _one_split(spark, sf, labels)


@query
def forecast_one_split_labels(spark, sf):
    return _one_split(spark, sf, roles.labels(spark, sf))


@query
def rolling_forecast(spark, sf):
    run = forecast.rolling_forecast(
        _trips(spark, sf), roles.station(spark, sf), _period(spark, sf), date(2024, 1, 29), n_clusters=16
    )
    return run.scores
