"""Grouped summaries and the six trip-count granularities."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.functions.timecols import with_calendar
from dockcast.operators.cleaning import known
from dockcast.operators.grid import densify
from dockcast.session import materialise
from dockcast.operators.joins import lookup_join, with_prefix


def group_summary(
    df: DataFrame,
    keys: list[str],
    min_max_mean: list[str] | None = None,
    max_only: list[str] | None = None,
    min_only: list[str] | None = None,
) -> DataFrame:
    """min, max and mean of the first list, max of the second, min of the third.

    One aggregate; rows with a null key take no part.
    """
    exprs = []
    for c in min_max_mean or []:
        exprs += [f"min({c}) AS {c}_min", f"max({c}) AS {c}_max", f"avg({c}) AS {c}_mean"]
    exprs += [f"max({c}) AS {c}" for c in max_only or []]
    exprs += [f"min({c}) AS {c}" for c in min_only or []]
    if not exprs:
        raise ValueError("no column to summarise")
    return known(df, keys).groupBy(*keys).agg(*map(F.expr, exprs))


def visit_count(trips: DataFrame) -> DataFrame:
    """Visits per (station, weekday and bucket) with a known start time."""
    return (
        known(trips, ["from_station_id", "weekday_hour_period"])
        .groupBy("from_station_id", "weekday_hour_period")
        .agg(F.count("starttime").alias("visit_count"))
    )


@dataclass(frozen=True)
class Granularity:
    """Grouping keys of a trip count: stations first, then time."""

    stations: tuple[str, ...]
    time: tuple[str, ...]

    @property
    def keys(self) -> list[str]:
        return [*self.stations, *self.time]


GRANULARITIES = {
    1: Granularity((), ("date",)),
    2: Granularity(("s_sta_id",), ("date",)),
    3: Granularity(("s_sta_id", "t_sta_id"), ("date",)),
    4: Granularity(("s_sta_id",), ("date", "hour")),
    5: Granularity(("s_sta_id", "t_sta_id"), ("date", "hour_period")),
    6: Granularity(("s_sta_id",), ("date", "hour_period")),
}


def count_trips(
    trip_station: DataFrame,
    mode: int = 6,
    dense: bool | None = None,
    station: DataFrame | None = None,
    axis_rows: int | None = None,
) -> DataFrame:
    """Trip count at one of six granularities, with the calendar columns of the date.

    1 day · 2 day and start station · 3 day, start and end station · 4 hour and start
    station · 5 bucket, start and end station · 6 bucket and start station.

    ``dense`` adds the zero cells (default for mode 6 only). Giving ``station`` attaches
    the attributes of the start station (modes 2 to 6) and the end station (3 and 5).
    """
    grain = GRANULARITIES[mode]
    counts = (
        known(trip_station, grain.keys)
        .groupBy(*grain.keys)
        .agg(F.count("starttime").alias("trip_count"))
    )
    if dense if dense is not None else mode == 6:
        counts = densify(counts, list(grain.stations), list(grain.time), "trip_count", axis_rows=axis_rows)
    out = with_calendar(counts)
    if station is not None:
        for role in grain.stations:
            prefix = role.removesuffix("sta_id")
            attributes = with_prefix(station.drop("lat", "lon"), prefix).withColumnRenamed(role, "_role_id")
            out = lookup_join(out, attributes, role, "_role_id").drop("_role_id")
    return out


def trip_lattice(trip_station: DataFrame) -> dict[int, DataFrame]:
    """Sparse counts at all six granularities from one scan of the trips.

    The finest count (both stations, date, bucket and hour) is written once; each coarser one is
    added up from the closest finer one. Rows with an unknown key stay in until they are left out of
    the granularities that need it, so every count is that of :func:`count_trips`.
    """
    finest = trip_station.groupBy("s_sta_id", "t_sta_id", "date", "hour_period", "hour").agg(F.count("starttime").alias("trip_count"))
    finest = materialise(finest, "lattice-finest")

    def coarser(counts: DataFrame, keys: list[str]) -> DataFrame:
        return counts.groupBy(*keys).agg(F.sum("trip_count").alias("trip_count"))

    from_finer = {5: None, 4: None, 3: 5, 6: 5, 2: 6, 1: 2}
    raw: dict[int, DataFrame] = {}
    for mode, finer in from_finer.items():
        raw[mode] = coarser(finest if finer is None else raw[finer], GRANULARITIES[mode].keys)
        if mode in (5, 6):  # these are read by others again
            raw[mode] = materialise(raw[mode], f"lattice-{mode}")
    return {mode: with_calendar(known(raw[mode], GRANULARITIES[mode].keys)) for mode in sorted(raw)}


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.countDistinct(column).alias("distinct_count"))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)
