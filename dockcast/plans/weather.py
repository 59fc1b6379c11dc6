"""Weather: readings to bucket and daily summaries."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.functions.timecols import hour_period, parse_time
from dockcast.operators.cleaning import clip_lower, drop_weather_columns, valid_readings
from dockcast.operators.summarize import group_summary
from dockcast.operators.windows import lag_flags
from dockcast.schemas import FLAGS, MEASURES


class WeatherTables(NamedTuple):
    period: DataFrame
    daily: DataFrame


def clean_weather(weather: DataFrame) -> DataFrame:
    """Valid readings with date, hour and bucket."""
    valid = valid_readings(drop_weather_columns(weather))
    timed = valid.withColumns({"precipi": clip_lower(F.col("precipi"), 0.0), "datetime": parse_time("datetime")})
    return timed.withColumns(
        {"date": F.to_date("datetime"), "hour": F.hour("datetime"), "hour_period": hour_period("hour(datetime)")}
    )


def weather_by_period(clean: DataFrame) -> DataFrame:
    return group_summary(clean, ["date", "hour_period"], MEASURES, FLAGS)


def weather_by_day(clean: DataFrame, lag_by: str = "rows") -> DataFrame:
    """Daily summary with the lag flags; days with any null are dropped."""
    return lag_flags(group_summary(clean, ["date"], MEASURES, FLAGS), lag_by).na.drop("any")


def build_weather(weather: DataFrame, lag_by: str = "rows") -> WeatherTables:
    clean = clean_weather(weather)
    return WeatherTables(weather_by_period(clean), weather_by_day(clean, lag_by))
