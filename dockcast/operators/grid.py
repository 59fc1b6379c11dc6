"""The dense grid (every entity at every observed time) and weather on its time axis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockcast.operators.axis import numbered
from dockcast.operators.joins import MAX_BROADCAST_ROWS
from dockcast.session import materialise

AXIS_COLUMNS = ["_pos", "_size"]


def time_axis(counts: DataFrame, time: list[str], value: str, segment_days: int | None = None, **whole_axis_max: str) -> DataFrame:
    """The observed times, numbered from 0 in ``_pos``, and their number in ``_size``.

    The windows have no partition key: their input is already one row per calendar bucket
    (at most 24 per day of history, whatever the number of trips), so one task orders a few
    thousand rows. With ``segment_days`` the axis is numbered in segments of so many days instead, and no
    task has all of it. Each ``name=column`` adds the maximum of a column over the whole table.

    Ordering by the summed ``value`` last changes nothing, the times being distinct, but it
    keeps all columns of ``counts`` in use: the plan below is then the same as in the other
    branch of :func:`densify`, and Spark reuses its shuffle instead of scanning trips twice.
    """
    everything = W.partitionBy()
    tops = [F.max(c).alias(name) for name, c in whole_axis_max.items()]
    seen = counts.groupBy(*time).agg(F.sum(value).alias("_total"), *tops)
    if segment_days:
        placed = numbered(seen.select(*time), time, segment_days, time[0])
        return placed.withColumns({name: seen.agg(F.max(name)).scalar() for name in whole_axis_max}) if whole_axis_max else placed
    return seen.select(
        *time,
        (F.row_number().over(W.orderBy(*time, "_total")) - 1).cast("int").alias("_pos"),
        F.count(F.lit(1)).over(everything).cast("int").alias("_size"),
        *[F.max(name).over(everything).alias(name) for name in whole_axis_max],
    )


def condensed(counts: DataFrame, time: list[str], axis_rows: int | None) -> tuple[DataFrame, int]:
    """Counts whose time axis has a known bound.

    Without a bound the counts, a table far smaller than what was counted, are written once
    and their times are counted.
    """
    if axis_rows is not None:
        return counts, axis_rows
    counts = materialise(counts, "condensed")
    return counts, counts.select(*time).distinct().count()


def densify(
    counts: DataFrame,
    entity: list[str],
    time: list[str],
    value: str,
    axis: DataFrame | None = None,
    axis_rows: int | None = None,
) -> DataFrame:
    """Add a zero cell for every (observed entity, observed time) that has no row.

    Gap filling instead of a product of entities and times: the sparse rows of an entity
    are ordered along the numbered axis, and each row emits itself and the zero cells up
    to the next row. Only sparse counts are shuffled; the dense rows are made in place,
    and no entity has more rows than the axis, so none is hot.

    ``axis`` may carry further columns of the time axis (for example weather), which are
    then returned too. ``axis_rows`` is a known bound of its length (days times buckets of
    a time window); without it the times are counted. Up to the broadcast limit the axis is
    broadcast and the dense rows never move. Beyond it both joins are merge joins: the size
    seen before the gaps are filled says nothing about the dense rows, so Spark must not
    broadcast that side on its own.
    """
    counts, axis_rows = condensed(counts, time, axis_rows)
    if axis is None:
        axis = time_axis(counts, time, value)
    small = axis_rows <= MAX_BROADCAST_ROWS
    join_hint = "broadcast" if small else "merge"

    placed = counts.join(axis.select(*time, *AXIS_COLUMNS).hint(join_hint), time)
    run = W.partitionBy(*entity).orderBy("_pos")
    spans = placed.select(
        *entity,
        F.col(value).alias("_value"),
        F.col("_pos").alias("_at"),
        F.when(F.row_number().over(run) == 1, F.lit(0)).otherwise(F.col("_pos")).alias("_from"),
        F.lead("_pos").over(run).alias("_next"),
        "_size",
    )
    cells = spans.select(
        *entity, "_value", "_at", F.explode(F.expr("sequence(_from, coalesce(_next, _size) - 1)")).alias("_pos")
    ).select(
        *entity,
        "_pos",
        F.when(F.col("_pos") == F.col("_at"), F.col("_value")).otherwise(F.lit(0)).alias(value),
    )
    extra = [c for c in axis.columns if c not in (*time, *AXIS_COLUMNS)]
    return cells.join(axis.drop("_size").hint(join_hint), "_pos").select(*entity, *time, value, *extra)


def backfill(axis: DataFrame, order: list[str], columns: list[str], wrap: bool = False, by: list[str] | None = None) -> DataFrame:
    """Fill nulls with the next known value along the ordered time axis.

    One row per calendar bucket comes in, so the unpartitioned window is bounded by the
    calendar. It runs backwards in time with a growing frame, which costs one pass.

    With ``wrap`` each column ``c`` gets a companion ``_head_c``: the first known value of
    the whole axis, which is what follows the last bucket when the filled table lists one
    station after the other. ``by`` tells several axes in one table apart.
    """
    backwards = ", ".join(f"{c} DESC" for c in order)
    parts = f"PARTITION BY {', '.join(by)}" if by else ""
    frame = f"({parts} ORDER BY {backwards} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    kept = [c for c in axis.columns if c not in columns]
    filled = axis.selectExpr(*kept, *[f"last({c}, true) OVER {frame} AS {c}" for c in columns])
    if not wrap:
        return filled
    # After the fill the first row holds the first known value of every column.
    first = f"struct({', '.join(order)})"
    return filled.selectExpr("*", *[f"min_by({c}, {first}) OVER ({parts}) AS _head_{c}" for c in columns])


def close_trailing_gap(grid: DataFrame, columns: list[str], more: str = "s_sta_id < _last_station") -> DataFrame:
    """Use the ``_head_`` companions of :func:`backfill` for all but the last station, the rows with ``more`` stations to follow."""
    helpers = {"_last_station", *[f"_head_{c}" for c in columns]}
    kept = [c for c in grid.columns if c not in helpers and c not in columns]
    return grid.selectExpr(*kept, *[f"coalesce({c}, CASE WHEN {more} THEN _head_{c} END) AS {c}" for c in columns])
