"""The given tables in the roles of station, weather and trip, as Spark and as SQL.

Every row of the source tables takes part. ``events`` serves twice: each event is a trip,
and each event is a weather reading whose pressure is a sentinel in every fifth bucket, so
that the engine's own validity filter leaves some buckets without weather and keeps the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockcast.schemas import WEATHER_METRIC_UNITS, WEATHER_MOSTLY_INVALID


# Declared, so that no job has to look at the files while a plan is built.
SCHEMAS = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def counted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the counter inside ``props`` as column ``k``."""
    return table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))


def station(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS sta_id",
        "s_suppkey * 3 AS trip_ct",
        "s_suppkey + 100 AS ct_popn",
        "s_acctbal AS avg_median_income",
        "cast(s_nationkey AS long) AS num_biz",
        "cast(s_nationkey AS long) + 1 AS num_bss",
        "s_suppkey + 7 AS total_cap",
        "s_suppkey % 5 AS num_school",
        "s_suppkey % 3 AS num_park",
        "s_acctbal / 2 AS total_park_area",
    )


# A flag is set where the value exceeds its bound.
FLAG_BOUNDS = {"fog": 10, "rain": 20, "snow": 50, "hail": 80, "thunder": 100, "tornado": 150}


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted_events(spark, sf_dir).selectExpr(
        "date_format(ts, 'yyyy-MM-dd HH:mm:ss') AS datetime",
        "value AS tempi",
        "value * 0.5D AS dewpti",
        "cast(k AS double) AS hum",
        "value - 1D AS wspdi",
        "k * 3D AS wdird",
        "k * 0.25D AS visi",
        "CASE WHEN (day(ts) * 6 + (hour(ts) + 23) % 24 div 4) % 5 = 0 THEN -9999D ELSE value + 900D END AS pressurei",
        "CASE WHEN k % 5 = 0 THEN NULL WHEN k % 5 = 1 THEN -9999D ELSE value * 0.125D END AS precipi",
        *[f"cast(value > {bound} AS int) AS {name}" for name, bound in FLAG_BOUNDS.items()],
        *[f"value AS {c}" for c in WEATHER_METRIC_UNITS + WEATHER_MOSTLY_INVALID],
        "event_type AS conds",
        "'N' AS wdire",
    )


def trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted_events(spark, sf_dir).selectExpr(
        "event_id AS trip_id",
        "date_format(ts, 'MM/dd/yyyy HH:mm:ss') AS starttime",
        "date_format(ts + interval 10 minutes, 'MM/dd/yyyy HH:mm:ss') AS stoptime",
        "k + 1000 AS bikeid",
        "value AS tripduration",
        "user_id AS from_station_id",
        "concat('station ', user_id) AS from_station_name",
        "k AS to_station_id",
        "concat('station ', k) AS to_station_name",
        "nullif(event_type, 'view') AS usertype",
        "CASE WHEN k % 3 = 1 THEN 'M' WHEN k % 3 = 2 THEN 'F' END AS gender",
        "CASE WHEN k % 7 <> 0 THEN k + 1900D END AS birthyear",
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed label per station; more labels than palette colours."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("sta_id"), F.col("s_nationkey").alias("cluster")
    )


# --- the same in SQL ---------------------------------------------------------------

_FLAG_SQL = ",\n    ".join(f"CAST(value > {bound} AS INTEGER) AS {name}" for name, bound in FLAG_BOUNDS.items())
_UNUSED_SQL = ", ".join(f"value AS {c}" for c in WEATHER_METRIC_UNITS + WEATHER_MOSTLY_INVALID)

EVENTS_SQL = """
ev AS (
  SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k FROM events)"""

STATION_SQL = """
station AS (
  SELECT s_suppkey AS sta_id, s_suppkey * 3 AS trip_ct, s_suppkey + 100 AS ct_popn,
    s_acctbal AS avg_median_income, CAST(s_nationkey AS BIGINT) AS num_biz,
    CAST(s_nationkey AS BIGINT) + 1 AS num_bss, s_suppkey + 7 AS total_cap,
    s_suppkey % 5 AS num_school, s_suppkey % 3 AS num_park, s_acctbal / 2 AS total_park_area
  FROM supplier)"""

WEATHER_SQL = f"""
weather AS (
  SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS datetime, value AS tempi, value * 0.5 AS dewpti,
    CAST(k AS DOUBLE) AS hum, value - 1.0 AS wspdi, k * CAST(3.0 AS DOUBLE) AS wdird,
    k * CAST(0.25 AS DOUBLE) AS visi,
    CASE WHEN (day(ts) * 6 + (hour(ts) + 23) % 24 // 4) % 5 = 0 THEN -9999.0 ELSE value + 900.0 END AS pressurei,
    CASE WHEN k % 5 = 0 THEN NULL WHEN k % 5 = 1 THEN -9999.0 ELSE value * 0.125 END AS precipi,
    {_FLAG_SQL},
    {_UNUSED_SQL}, event_type AS conds, 'N' AS wdire
  FROM ev)"""

TRIP_SQL = """
trip AS (
  SELECT event_id AS trip_id, strftime(ts, '%m/%d/%Y %H:%M:%S') AS starttime,
    strftime(ts + INTERVAL 10 MINUTE, '%m/%d/%Y %H:%M:%S') AS stoptime, k + 1000 AS bikeid,
    value AS tripduration, user_id AS from_station_id,
    'station ' || CAST(user_id AS VARCHAR) AS from_station_name, k AS to_station_id,
    'station ' || CAST(k AS VARCHAR) AS to_station_name,
    nullif(event_type, 'view') AS usertype,
    CASE WHEN k % 3 = 1 THEN 'M' WHEN k % 3 = 2 THEN 'F' END AS gender,
    CASE WHEN k % 7 <> 0 THEN CAST(k + 1900 AS DOUBLE) END AS birthyear
  FROM ev)"""

LABELS_SQL = """
station_labels AS (SELECT s_suppkey AS sta_id, s_nationkey AS cluster FROM supplier)"""
