"""Pivot to the activity profile, row shares and one-hot columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockcast.schemas import PROFILE_KEYS


MAX_VALUES = 1000  # columns one_hot makes of one column


def profile_pivot(visits: DataFrame, keys: list[str] = PROFILE_KEYS) -> DataFrame:
    """Station × (weekday, bucket) visit counts, zero where there was no visit.

    The column list is fixed, which saves the job that would look for it and keeps the
    schema the same on every input.
    """
    wide = visits.groupBy("from_station_id").pivot("weekday_hour_period", keys).agg(F.sum("visit_count"))
    return wide.na.fill(0)


def row_share(visits: DataFrame) -> DataFrame:
    """Long form: share of each count in the total of its station."""
    total = F.sum("visit_count").over(W.partitionBy("from_station_id"))
    return visits.withColumn("share", F.try_divide(F.col("visit_count"), total))


def wide_row_share(wide: DataFrame, columns: list[str]) -> DataFrame:
    """Wide form of :func:`row_share`; the sum stays within the row."""
    total = " + ".join(f"`{c}`" for c in columns)
    kept = [f"`{c}`" for c in wide.columns if c not in columns]
    summed = wide.selectExpr("*", f"{total} AS _sum")
    return summed.selectExpr(*kept, *[f"try_divide(`{c}`, _sum) AS `{c}`" for c in columns])


def one_hot(
    df: DataFrame, columns: str | list[str], names: dict | None = None, remove_original: bool = True
) -> DataFrame:
    """0/1 column per value of a column, or of each of several; a null value gives zeros everywhere.

    ``names`` maps values to column names, for several columns per column. Without it the
    values are looked up and name their columns, after the column's name if there are several.
    The values become columns of the plan, so more than ``MAX_VALUES`` raise an error that names the
    column; with declared values nothing is looked up.
    """
    several = not isinstance(columns, str)
    wanted = list(columns) if several else [columns]
    named = (names or {}) if several else {columns: names}
    out = {}
    for column in wanted:
        values = named.get(column)
        if values is None:
            found = df.select(column).na.drop().distinct().limit(MAX_VALUES + 1).collect()
            if len(found) > MAX_VALUES:
                raise ValueError(f"column {column} has more than {MAX_VALUES} values; declare those that are wanted")
            found.sort(key=lambda row: row[0])
            values = {row[0]: f"{column}_{row[0]}" if several else str(row[0]) for row in found}
        out |= {name: F.col(column).eqNullSafe(F.lit(value)).cast("int") for value, name in values.items()}
    made = df.withColumns(out) if out else df
    return made.drop(*wanted) if remove_original else made
