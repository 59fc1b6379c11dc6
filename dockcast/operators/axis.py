"""Ordered axes too long for one task, in two passes over segments of the calendar.

A segment is a run of ``segment_days`` days, so no sample or sort is needed to cut the axis. The first pass works
inside each segment; what a segment has to know of the others (rows before it, the next known value
after it) comes from a table with one row per segment. Rows of a segment meet in one task, those of the axis never.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _cut(axis: DataFrame, day: str, segment_days: int) -> DataFrame:
    return axis.withColumn("_segment", F.floor(F.datediff(F.col(day), F.lit("1970-01-01").cast("date")) / segment_days))


def numbered(axis: DataFrame, order: list[str], segment_days: int, day: str = "date") -> DataFrame:
    """The axis with ``_pos``, counted from 0 along it, and ``_size``, its number of rows."""
    cut = _cut(axis, day, segment_days)
    sizes = cut.groupBy("_segment").agg(F.count(F.lit(1)).alias("_rows"))
    run, whole = W.orderBy("_segment"), W.partitionBy()  # a row per segment
    ahead = sizes.select("_segment", (F.sum("_rows").over(run) - F.col("_rows")).alias("_ahead"), F.sum("_rows").over(whole).alias("_size"))
    inside = F.row_number().over(W.partitionBy("_segment").orderBy(*order)) - 1
    placed = cut.withColumn("_inside", inside).join(ahead, "_segment")
    pos = (F.col("_ahead") + F.col("_inside")).cast("int")
    return placed.withColumn("_pos", pos).withColumn("_size", F.col("_size").cast("int")).drop("_segment", "_ahead", "_inside")


def shifted(axis: DataFrame, order: list[str], columns: dict[str, tuple[str, int]], segment_days: int, day: str = "date") -> DataFrame:
    """The axis with ``name``: the value of a column ``n`` rows before, for each ``name: (column, n)``."""
    placed = numbered(axis, order, segment_days, day).drop("_size")
    out = placed
    for n in sorted({n for _, n in columns.values()}):
        earlier = placed.select((F.col("_pos") + n).alias("_pos"), *[F.col(c).alias(name) for name, (c, k) in columns.items() if k == n])
        out = out.join(earlier, "_pos", "left")
    return out.select(*axis.columns, *columns)


def next_known(axis: DataFrame, order: list[str], columns: list[str], segment_days: int, day: str = "date", wrap: bool = False) -> DataFrame:
    """Nulls filled with the next known value along the axis, as by :func:`dockcast.operators.grid.backfill`."""
    cut = _cut(axis, day, segment_days)
    back = W.partitionBy("_segment").orderBy(*[F.desc(c) for c in order]).rowsBetween(W.unboundedPreceding, 0)
    place = F.struct(*order)
    firsts = cut.groupBy("_segment").agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in columns])
    later = W.orderBy(F.desc("_segment")).rowsBetween(W.unboundedPreceding, -1)  # a row per segment
    heads = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_segment"))).over(W.partitionBy()).alias(f"_head_{c}") for c in columns] if wrap else []
    carried = firsts.select("_segment", *[F.last(c, True).over(later).alias(f"_next_{c}") for c in columns], *heads)
    kept = [c for c in axis.columns if c not in columns]
    filled = cut.select("_segment", *kept, *[F.last(c, True).over(back).alias(c) for c in columns]).join(carried, "_segment")
    return filled.select(*kept, *[F.coalesce(c, f"_next_{c}").alias(c) for c in columns], *([f"_head_{c}" for c in columns] if wrap else []))
