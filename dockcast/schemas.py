"""Schemas of the three base tables and the column lists shared by all plans."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: raw input header names and the names used here ---------------

STATION_NAMES = {
    "staID": "sta_id",
    "tripCt": "trip_ct",
    "ctPopn": "ct_popn",
    "avgMedianIncome": "avg_median_income",
    "numBiz": "num_biz",
    "numBSS": "num_bss",
    "totalCap": "total_cap",
    "numSchool": "num_school",
    "numPark": "num_park",
    "totalParkArea": "total_park_area",
    "start_station_lat": "lat",
    "start_station_lon": "lon",
}

MEASURES = ["tempi", "dewpti", "hum", "wspdi", "wdird", "visi", "pressurei", "precipi"]
FLAGS = ["fog", "rain", "snow", "hail", "thunder", "tornado"]
LAGGED_FLAGS = ["rain", "snow", "hail", "thunder", "tornado"]
LAG_HOURS = {1: "24h", 2: "48h", 3: "72h"}

WEATHER_METRIC_UNITS = [
    "tempm", "dewptm", "wspdm", "wgustm", "vism", "pressurem", "windchillm", "heatindexm", "precipm",
]
WEATHER_MOSTLY_INVALID = ["heatindexi", "wgusti", "windchilli"]

TRIP_UNUSED = ["bikeid", "trip_id", "from_station_name", "to_station_name"]

HOUR_PERIODS = ["1,1-4", "2,5-8", "3,9-12", "4,13-16", "5,17-20", "6,21-24"]

# Text that a missing cell may hold in a CSV export.
MISSING_TEXT = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- Derived column lists --------------------------------------------------------

STATION_ATTRIBUTES = [n for n in STATION_NAMES.values() if n not in ("sta_id", "lat", "lon")]
ONE_HOT_PERIODS = {label: f"hp_{label[0]}" for label in HOUR_PERIODS}
PROFILE_KEYS = [f"{day}_{label}" for day in range(7) for label in HOUR_PERIODS]
WEATHER_COLUMNS = [f"{m}_{s}" for m in MEASURES for s in ("min", "max", "mean")] + FLAGS
CALENDAR_COLUMNS = ["week_of_year", "weekday", "business_day"]
FEATURES = CALENDAR_COLUMNS + WEATHER_COLUMNS + list(ONE_HOT_PERIODS.values())

_LONG, _DOUBLE, _INT, _TEXT = T.LongType(), T.DoubleType(), T.IntegerType(), T.StringType()


def _struct(*groups) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for names, t in groups for n in names])


STATION = T.StructType(
    [
        T.StructField(raw, _DOUBLE if name in ("avg_median_income", "total_park_area", "lat", "lon") else _LONG)
        for raw, name in STATION_NAMES.items()
    ]
)

WEATHER = _struct(
    (["datetime"], _TEXT),
    (MEASURES, _DOUBLE),
    (FLAGS, _INT),
    (WEATHER_METRIC_UNITS + WEATHER_MOSTLY_INVALID, _DOUBLE),
    (["conds", "wdire"], _TEXT),
)

TRIP = _struct(
    (["trip_id"], _LONG),
    (["starttime", "stoptime"], _TEXT),
    (["bikeid"], _LONG),
    (["tripduration"], _DOUBLE),
    (["from_station_id"], _LONG),
    (["from_station_name"], _TEXT),
    (["to_station_id"], _LONG),
    (["to_station_name", "usertype", "gender"], _TEXT),
    (["birthyear"], _DOUBLE),
)
