"""Row and value cleaning: column drops, validity filters, clips, fills and null reports."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockcast.schemas import MISSING_TEXT, TRIP_UNUSED, WEATHER_METRIC_UNITS, WEATHER_MOSTLY_INVALID


def nan_to_null(df: DataFrame) -> DataFrame:
    """Floating NaN becomes NULL, so that comparisons and aggregates skip it."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.selectExpr(*[f"nanvl(`{c}`, NULL) AS `{c}`" if c in floats else f"`{c}`" for c in df.columns])


def missing_text_to_null(df: DataFrame) -> DataFrame:
    """The spellings of a missing cell in text columns become NULL."""
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    spelled = ", ".join(f"'{t}'" for t in MISSING_TEXT)
    return df.selectExpr(
        *[f"CASE WHEN `{c}` NOT IN ({spelled}) THEN `{c}` END AS `{c}`" if c in texts else f"`{c}`" for c in df.columns]
    )


def drop_weather_columns(weather: DataFrame) -> DataFrame:
    return weather.drop(*WEATHER_METRIC_UNITS, *WEATHER_MOSTLY_INVALID)


def valid_readings(weather: DataFrame) -> DataFrame:
    """Drop sentinel readings; calm hours (wind 0) and nulls go too."""
    return weather.filter("tempi > -80 AND wspdi > 0 AND pressurei > -9999")


def clip_lower(col: Column, low: float) -> Column:
    """``greatest`` would turn null into ``low``; a missing value has to stay missing."""
    return F.when(col < low, F.lit(low)).otherwise(col)


def drop_trip_columns(trips: DataFrame) -> DataFrame:
    return trips.drop(*TRIP_UNUSED)


def fill_constants(trips: DataFrame) -> DataFrame:
    return trips.na.fill({"usertype": "Customer", "gender": "U"})


def fill_mean(df: DataFrame, column: str) -> DataFrame:
    """Fill nulls with the mean of the whole input.

    The mean is a scalar subquery: one partial aggregate over a single column, no shuffle
    of the rows and no join.
    """
    mean = df.agg(F.avg(column)).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), mean))


def known(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows without a null in the given columns, as plain conditions.

    Unlike ``na.drop`` this tells Catalyst that the columns hold no null from here on, so
    it adds no further null checks above, and equal plans stay equal and are reused.
    """
    return df.filter(" AND ".join(f"{c} IS NOT NULL" for c in columns))


def drop_null_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=subset)


def null_report(df: DataFrame, raise_on_null: bool = False) -> DataFrame:
    """One row per column with its null count; one aggregate over the table.

    With ``raise_on_null`` the returned plan fails when run on a table with nulls.
    """
    counts = df.agg(*[F.expr(f"count_if(`{c}` IS NULL) AS `{c}`") for c in df.columns])
    pairs = ", ".join(f"struct('{c}' AS column_name, `{c}` AS null_count)" for c in df.columns)
    report = counts.selectExpr(f"inline(array({pairs}))")
    if raise_on_null:
        message = F.concat(F.lit("find na in dataframe: "), F.col("column_name"))
        checked = F.when(F.col("null_count") == 0, F.col("null_count")).otherwise(F.raise_error(message).cast("long"))
        report = report.withColumn("null_count", checked)
    return report


def time_window(
    trips: DataFrame,
    forecast_date: date,
    trace_back_days: int = 365,
    test_days: int = 1,
    closed: str = "both",
    column: str = "starttime_dt",
) -> DataFrame:
    """Trips from ``trace_back_days`` before to ``test_days`` after the forecast date.

    Both ends belong to the window unless ``closed="left"``. If the table has a ``date``
    column the bound is repeated on it, so a table partitioned by date reads only the
    partitions of the window.
    """
    if closed not in ("both", "left"):
        raise ValueError(f"closed must be 'both' or 'left', not {closed!r}")
    low = forecast_date - timedelta(days=trace_back_days)
    high = forecast_date + timedelta(days=test_days)
    start = F.lit(datetime(low.year, low.month, low.day).isoformat()).cast("timestamp_ntz")
    end = F.lit(datetime(high.year, high.month, high.day).isoformat()).cast("timestamp_ntz")
    upper = F.col(column) <= end if closed == "both" else F.col(column) < end
    kept = trips.filter((F.col(column) >= start) & upper)
    if "date" in trips.columns:
        kept = kept.filter(F.col("date").between(F.lit(low), F.lit(high)))
    return kept


def split_by_date(df: DataFrame, forecast_date: date, day: str = "date") -> tuple[DataFrame, DataFrame]:
    """(before the forecast date, from the forecast date on)."""
    cut = F.lit(forecast_date)
    return df.filter(F.col(day) < cut), df.filter(F.col(day) >= cut)


def site_rows(df: DataFrame, station: int) -> DataFrame:
    return df.filter(F.col("s_sta_id") == station)
