"""Time-series episodes: the recent days of each feature and the next days of the label."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockcast.functions.timecols import grid_key
from dockcast.operators.joins import with_cluster
from dockcast.session import materialise

CELL = ["cluster", "s_sta_id", "date", "hour_period"]
BLOCK_STATIONS = 1024


def _ends(first: Column, last: Column, low: date, high: date) -> Column:
    """Episode ends from ``first`` to ``last`` that lie within the calendar of the run."""
    begin, end = F.greatest(first, F.lit(low)), F.least(last, F.lit(high))
    return F.when(begin <= end, F.sequence(begin, end, F.expr("interval 1 day"))).otherwise(
        F.array().cast("array<date>")
    )


def to_episodes(
    cells: DataFrame,
    forecast_date: date,
    episode_len: int,
    label_day_len: int,
    train_days: int,
    test_days: int,
) -> DataFrame:
    """Send each dated row to the episodes it belongs to.

    Membership in a date range is computed from the row's own date, so this is an explode
    and no join: a feature row serves the ends from its date to ``episode_len - 1`` days
    later, a label row the ends of the ``label_day_len`` days before it.
    """
    low, high = forecast_date - timedelta(days=train_days + test_days), forecast_date - timedelta(days=1)
    day = F.col("date")
    feature = _ends(day, F.date_add(day, episode_len - 1), low, high)
    label = _ends(F.date_sub(day, label_day_len), F.date_sub(day, 1), low, high)
    span = cells.filter(day.between(F.lit(low - timedelta(days=episode_len - 1)), F.lit(high + timedelta(days=label_day_len))))
    ends = F.when(F.col("feature") == "label", label).otherwise(feature)
    split = F.when(F.col("episode_end") < F.lit(forecast_date - timedelta(days=test_days)), "train").otherwise("test")
    return span.withColumn("episode_end", F.explode(ends)).withColumn("split", split)


def _cells(data: DataFrame, labels: DataFrame, features: list[str], label_field: str) -> DataFrame:
    """Long form (cell, feature, value): one row per cell and feature, missing values 0."""
    member = with_cluster(data, labels)
    wanted = dict.fromkeys([*features, label_field])
    sums = member.groupBy(*CELL).agg(*[F.expr(f"sum(cast({c} AS double)) AS {c}") for c in wanted])
    named = [f"struct('{f}' AS feature, {f} AS value)" for f in features]
    named.append(f"struct('label' AS feature, {label_field} AS value)")
    return sums.selectExpr(*CELL, f"inline(array({', '.join(named)}))").na.fill({"value": 0.0})


def episodes_long(
    data: DataFrame,
    labels: DataFrame,
    forecast_date: date,
    features: list[str],
    label_field: str = "trip_count",
    episode_len: int = 26,
    label_day_len: int = 1,
    train_days: int = 25,
    test_days: int = 5,
) -> DataFrame:
    """One row per (cluster, split, episode, feature, station, bucket), all clusters at once.

    Test episodes end on the ``test_days`` days before the forecast date, train episodes on
    the ``train_days`` days before those. The label starts on the day after the end.
    """
    cells = _cells(data, labels, features, label_field)
    rows = to_episodes(cells, forecast_date, episode_len, label_day_len, train_days, test_days)
    return rows.select("cluster", "split", "episode_end", "feature", "s_sta_id", "date", "hour_period", "value")


def episodes_nested(
    data: DataFrame,
    labels: DataFrame,
    forecast_date: date,
    features: list[str],
    label_field: str = "trip_count",
    episode_len: int = 26,
    label_day_len: int = 1,
    train_days: int = 25,
    test_days: int = 5,
    block_stations: int = BLOCK_STATIONS,
) -> DataFrame:
    """The same as matrices ``[time][station]``, with the stations and buckets they run over.

    A cluster of more than ``block_stations`` stations is dealt out by a hash of the station
    into ``station_blocks`` blocks of about that size, and ``station_block`` says which of them
    a matrix is; a smaller cluster has one block, number 0. So a matrix has a bounded size
    however many stations a cluster has. ``data`` has to be dense, as the demand grid is; it is
    written once.

    Each day's matrix is built and shuffled once. An episode is a window over the days of its group:
    the days are ordered, and each end collects those in its frame where they lie, so what is
    shuffled doesn't grow with ``episode_len``.
    """
    data = materialise(data.select(*CELL[1:], *dict.fromkeys([*features, label_field])), "episode-rows")
    placed = labels.select("sta_id", "cluster").join(
        data.select(F.col("s_sta_id").alias("sta_id")).distinct(), "sta_id", "left_semi"
    )
    blocks = F.ceil(F.count(F.lit(1)) / block_stations).cast("int")
    placed = placed.join(placed.groupBy("cluster").agg(blocks.alias("station_blocks")), "cluster")
    block = F.pmod(F.xxhash64("sta_id"), F.col("station_blocks")).cast("int")
    placed = placed.select(F.col("sta_id").alias("_block_sta"), block.alias("station_block"), "station_blocks")
    cells = _cells(data, labels, features, label_field)
    cells = cells.join(placed, cells["s_sta_id"] == placed["_block_sta"]).drop("_block_sta")
    group = ["cluster", "station_block", "station_blocks", "feature"]
    by_station = F.array_sort(F.collect_list(F.struct("s_sta_id", "value")))
    vectors = cells.groupBy(*group, "date", "hour_period").agg(by_station.alias("_cells"))
    vectors = vectors.select(
        *group, "date", "hour_period", F.col("_cells.s_sta_id").alias("stations"), F.col("_cells.value").alias("row")
    )
    low, high = forecast_date - timedelta(days=train_days + test_days), forecast_date - timedelta(days=1)
    span = vectors.filter(F.col("date").between(F.lit(low - timedelta(days=episode_len - 1)), F.lit(high + timedelta(days=label_day_len))))
    by_time = F.array_sort(F.collect_list(F.struct(grid_key("date", "hour_period").alias("bucket"), "row")))
    days = span.groupBy(*group, "date").agg(F.struct(by_time.alias("rows"), F.first("stations").alias("stations")).alias("day"))
    ends = F.explode(F.sequence(F.lit(low), F.lit(high), F.expr("interval 1 day"))).alias("date")
    marks = vectors.select(*group).distinct().select(*group, ends, F.lit(None).cast(days.schema["day"].dataType).alias("day"), F.lit(True).alias("is_end"))
    both = days.withColumn("is_end", F.lit(False)).unionByName(marks)
    order = W.partitionBy(*group).orderBy(F.datediff("date", F.lit(low)))
    is_label = F.col("feature") == "label"
    before = F.collect_list(F.when(~is_label, F.col("day"))).over(order.rangeBetween(1 - episode_len, 0))
    after = F.collect_list(F.when(is_label, F.col("day"))).over(order.rangeBetween(1, label_day_len))
    episodes = both.withColumn("days", F.concat(before, after)).filter("is_end AND size(days) > 0")
    split = F.when(F.col("date") < F.lit(forecast_date - timedelta(days=test_days)), "train").otherwise("test").alias("split")
    rows = F.flatten("days.rows")
    return episodes.select(
        "cluster", split, F.col("date").alias("episode_end"), "feature", "station_block", "station_blocks",
        F.col("days")[0]["stations"].alias("stations"), rows["bucket"].alias("buckets"), rows["row"].alias("matrix"),
    )
