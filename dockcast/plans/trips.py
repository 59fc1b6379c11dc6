"""Trips: fills, parsed start time and calendar columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.functions.timecols import hour_period, parse_time, profile_key, with_calendar
from dockcast.operators.cleaning import drop_trip_columns, fill_constants, fill_mean
from dockcast.operators.joins import is_small, lookup_join, with_prefix

STATION_TABLE_EXTRAS = ("lat", "lon")


def build_trips(trips: DataFrame, juneteenth: bool = False) -> DataFrame:
    """Prepared trips: one row per trip, no shuffle."""
    filled = fill_mean(fill_constants(drop_trip_columns(trips)), "birthyear")
    timed = filled.withColumn("starttime_dt", parse_time("starttime"))
    parts = timed.withColumns(
        {
            "date": F.to_date("starttime_dt"),
            "hour": F.hour("starttime_dt"),
            "hour_period": hour_period("hour(starttime_dt)"),
        }
    )
    keyed = parts.withColumn("weekday_hour_period", profile_key("date", "hour_period"))
    return with_calendar(keyed, juneteenth=juneteenth)


def join_stations(trips: DataFrame, station: DataFrame) -> DataFrame:
    """Trips whose two stations are known, with the attributes of both (``s_*``, ``t_*``).

    Columns that a later step does not read are pruned from the station side, so a count
    on top of this carries only keys.
    """
    station = station.drop(*STATION_TABLE_EXTRAS)
    small = is_small(station)
    started = lookup_join(
        trips.drop("starttime_dt"), with_prefix(station, "s_"), "from_station_id", "s_sta_id", small=small
    )
    return lookup_join(started, with_prefix(station, "t_"), "to_station_id", "t_sta_id", small=small)
