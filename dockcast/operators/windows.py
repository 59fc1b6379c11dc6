"""Row shifts: weather lag flags and the shifted target of every station."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockcast.operators.axis import shifted
from dockcast.schemas import LAG_HOURS, LAGGED_FLAGS


def lag_flags(daily: DataFrame, by: str = "rows", segment_days: int | None = None) -> DataFrame:
    """Each weather flag one, two and three days before, as ``<flag>_24h``, ``_48h``, ``_72h``.

    ``rows`` shifts by rows of the daily table: one row per date, so a single ordered
    window over the calendar. ``calendar`` looks up the exact earlier date, which differs
    where dates are missing. With ``segment_days`` the calendar is cut into segments and no task has
    all of it (:mod:`dockcast.operators.axis`).
    """
    if by == "rows" and segment_days:
        return shifted(daily, ["date"], {f"{f}_{hours}": (f, n) for n, hours in LAG_HOURS.items() for f in LAGGED_FLAGS}, segment_days)
    if by == "rows":
        return daily.selectExpr(
            "*",
            *[
                f"lag({flag}, {n}) OVER (ORDER BY date) AS {flag}_{hours}"
                for n, hours in LAG_HOURS.items()
                for flag in LAGGED_FLAGS
            ],
        )
    if by != "calendar":
        raise ValueError(f"by must be 'rows' or 'calendar', not {by!r}")
    out = daily
    for n, hours in LAG_HOURS.items():
        earlier = daily.select(
            F.date_add("date", n).alias("date"), *[F.col(f).alias(f"{f}_{hours}") for f in LAGGED_FLAGS]
        )
        out = out.join(earlier, "date", "left")
    return out


def target_shift(
    data: DataFrame,
    periods: int,
    direction: str = "lag",
    label: str = "trip_count",
    station: str = "s_sta_id",
    order: tuple[str, ...] = ("date", "hour_period"),
) -> DataFrame:
    """The label ``periods`` rows away within each station as ``next_day_trip_count``.

    Done for all stations at once; rows with any null are dropped. A station has one row
    per calendar bucket, so no window partition outgrows the calendar.
    """
    shift = {"lag": F.lag, "lead": F.lead}[direction]
    run = W.partitionBy(station).orderBy(*order)
    return data.withColumn("next_day_trip_count", shift(label, periods).over(run)).na.drop("any")


def site_timeseries(data: DataFrame, station: int, periods: int, direction: str = "lag") -> tuple[DataFrame, DataFrame]:
    """Features and shifted target of one station, both with their keys."""
    keys = ["s_sta_id", "date", "hour_period"]
    rows = target_shift(data.filter(F.col("s_sta_id") == station), periods, direction)
    return rows.drop("trip_count", "next_day_trip_count"), rows.select(*keys, "next_day_trip_count")
