"""Demand table: dense trip counts with calendar, weather and bucket indicators."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.functions.timecols import profile_key, with_calendar
from dockcast.operators.cleaning import known
from dockcast.operators.axis import next_known
from dockcast.operators.grid import backfill, close_trailing_gap, condensed, densify, time_axis
from dockcast.operators.joins import is_small, lookup_join
from dockcast.operators.reshape import one_hot
from dockcast.schemas import HOUR_PERIODS, ONE_HOT_PERIODS, WEATHER_COLUMNS

BUCKET = ["date", "hour_period"]


def axis_bound(df: DataFrame, day: str = "date") -> int:
    """Most buckets the time axis of a table can have; one aggregate over its date column.

    A caller that has cut the trips to a window knows this without looking.
    """
    days = df.agg((F.datediff(F.max(day), F.min(day)) + 1).alias("days")).first()["days"]
    return (days or 0) * len(HOUR_PERIODS)


def bucket_counts(trips: DataFrame, station: DataFrame) -> DataFrame:
    """Trips per (start station, date, bucket), both stations known.

    With a small station table the trips are counted where they are read. With a large one
    they are first counted per pair of stations and bucket, so that only counts are
    shuffled to the stations and a busy station is already condensed.
    """
    needed = known(trips, ["from_station_id", "to_station_id", *BUCKET])
    ids = station.select("sta_id")
    start, end = ids.withColumnRenamed("sta_id", "s_sta_id"), ids.withColumnRenamed("sta_id", "t_sta_id")
    small = is_small(ids)
    if small:
        rows = needed.select("from_station_id", "to_station_id", *BUCKET, "starttime")
        counted = F.count("starttime")
    else:
        rows = needed.groupBy("from_station_id", "to_station_id", *BUCKET).agg(F.count("starttime").alias("trips"))
        counted = F.sum("trips")
    joined = lookup_join(rows, start, "from_station_id", "s_sta_id", small=small)
    joined = lookup_join(joined, end, "to_station_id", "t_sta_id", small=small)
    return joined.groupBy("s_sta_id", *BUCKET).agg(counted.alias("trip_count"))


def station_activity(trips: DataFrame, station: DataFrame) -> DataFrame:
    """Trips condensed to (start station, date, bucket), enough for every forecast date.

    ``visits`` counts all trips, ``known_trips`` those that end at a known station.
    ``at_midnight`` keeps the trips at 00:00:00 apart, so a window whose last instant is a
    midnight can be cut from this table exactly. However many dates are forecast, the trips
    are read once.
    """
    needed = known(trips, ["from_station_id", *BUCKET]).withColumn(
        "at_midnight", F.expr("starttime_dt = cast(date AS timestamp_ntz)")
    )
    keys = ["from_station_id", *BUCKET, "at_midnight"]
    ends = station.select(F.col("sta_id").alias("t_sta_id"))
    small = is_small(ends)
    if small:
        rows = needed.select(*keys, "to_station_id", F.col("starttime").isNotNull().cast("long").alias("_n"))
    else:
        rows = needed.groupBy(*keys, "to_station_id").agg(F.count("starttime").alias("_n"))
    flagged = lookup_join(rows, ends, "to_station_id", "t_sta_id", "left", small=small)
    return flagged.groupBy(*keys).agg(
        F.sum("_n").alias("visits"), F.expr("coalesce(sum(_n) FILTER (WHERE t_sta_id IS NOT NULL), 0)").alias("known_trips")
    )


def activity_window(
    activity: DataFrame, forecast_date: date, trace_back_days: int, test_days: int, closed: str = "both"
) -> DataFrame:
    """The part of an activity table that lies in the time window of a forecast date."""
    low, high = forecast_date - timedelta(days=trace_back_days), forecast_date + timedelta(days=test_days)
    inside = F.col("date") < F.lit(high)
    if closed == "both":
        inside = inside | ((F.col("date") == F.lit(high)) & F.col("at_midnight"))
    elif closed != "left":
        raise ValueError(f"closed must be 'both' or 'left', not {closed!r}")
    return activity.filter((F.col("date") >= F.lit(low)) & inside)


def activity_counts(activity: DataFrame, station: DataFrame) -> DataFrame:
    """The same as :func:`bucket_counts`, from an activity table."""
    start = station.select(F.col("sta_id").alias("s_sta_id"))
    started = lookup_join(activity.filter("known_trips > 0"), start, "from_station_id", "s_sta_id")
    return started.groupBy("s_sta_id", *BUCKET).agg(F.sum("known_trips").alias("trip_count"))


def activity_visits(activity: DataFrame) -> DataFrame:
    """Visits per (station, weekday and bucket), from an activity table."""
    keyed = activity.withColumn("weekday_hour_period", profile_key("date", "hour_period"))
    return keyed.groupBy("from_station_id", "weekday_hour_period").agg(F.sum("visits").alias("visit_count"))


def demand_grid(trips: DataFrame, station: DataFrame, axis_rows: int | None = None) -> DataFrame:
    """Dense grid: every observed start station at every observed bucket, zero-filled."""
    counts = bucket_counts(trips, station)
    return with_calendar(densify(counts, ["s_sta_id"], BUCKET, "trip_count", axis_rows=axis_rows))


def grid_with_weather(
    counts: DataFrame,
    weather_period: DataFrame,
    wrap: bool = True,
    fill: bool = True,
    axis_rows: int | None = None,
    segment_days: int | None = None,
) -> DataFrame:
    """Dense grid of bucket counts with the weather of its bucket, gaps filled from the next bucket.

    The grid is dense and weather depends on the bucket alone, so weather is joined and
    filled on the short time axis and reaches the stations together with the bucket.
    """
    counts, axis_rows = condensed(counts, BUCKET, axis_rows)
    last = {"_last_station": "s_sta_id"} if wrap and fill else {}
    axis = time_axis(counts, BUCKET, "trip_count", segment_days, **last)
    axis = axis.join(weather_period.select(*BUCKET, *WEATHER_COLUMNS), BUCKET, "left")
    if fill:
        fill_gaps = next_known if segment_days else backfill
        axis = fill_gaps(axis, BUCKET, WEATHER_COLUMNS, wrap=wrap, **({"segment_days": segment_days} if segment_days else {}))
    axis = with_calendar(axis)
    grid = densify(counts, ["s_sta_id"], BUCKET, "trip_count", axis, axis_rows)
    if wrap and fill:
        grid = close_trailing_gap(grid, WEATHER_COLUMNS)
    return grid.select(
        *BUCKET, "s_sta_id", "week_of_year", "weekday", "business_day", "trip_count", *WEATHER_COLUMNS
    )


def build_model_data(
    trips: DataFrame,
    station: DataFrame,
    weather_period: DataFrame,
    wrap: bool = True,
    keep_period: bool = False,
    axis_rows: int | None = None,
) -> DataFrame:
    """Model table: one row per (station, date, bucket).

    ``wrap=True`` fills a weather gap at the end of the history from the first weather of
    the history, for all stations but the last, as a backward fill over a table sorted by
    station does; ``wrap=False`` leaves it null.
    """
    return model_from_counts(bucket_counts(trips, station), weather_period, wrap, keep_period, axis_rows)


def model_from_counts(
    counts: DataFrame,
    weather_period: DataFrame,
    wrap: bool = True,
    keep_period: bool = False,
    axis_rows: int | None = None,
) -> DataFrame:
    """:func:`build_model_data` for trips already counted per bucket."""
    grid = grid_with_weather(counts, weather_period, wrap, axis_rows=axis_rows)
    return one_hot(grid, "hour_period", ONE_HOT_PERIODS, remove_original=not keep_period)
