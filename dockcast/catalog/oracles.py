"""DuckDB SQL with the meaning of each registered query."""

from __future__ import annotations

from dockcast.catalog.roles import EVENTS_SQL, LABELS_SQL, STATION_SQL, TRIP_SQL, WEATHER_SQL
from dockcast.functions.colors import PALETTE
from dockcast.schemas import (
    FLAGS,
    HOUR_PERIODS,
    LAG_HOURS,
    LAGGED_FLAGS,
    MEASURES,
    ONE_HOT_PERIODS,
    PROFILE_KEYS,
    STATION_ATTRIBUTES,
    WEATHER_COLUMNS,
)

ROUND = 6


def _with(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def _period(hour: str) -> str:
    slot = f"((({hour}) + 23) % 24) // 4"
    cases = " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(HOUR_PERIODS))
    return f"CASE {slot} {cases} END"


def _business(d: str) -> str:
    """Holidays listed from the rule of each, the observed day included."""
    fixed = "(strftime({x}, '%m-%d') IN ('01-01', '07-04', '11-11', '12-25'))"
    is_on = fixed.format(x=d)
    before = fixed.format(x=f"({d} + INTERVAL 1 DAY)")
    after = fixed.format(x=f"({d} - INTERVAL 1 DAY)")
    nth = f"((day({d}) - 1) // 7 + 1)"
    floating = f"""(isodow({d}) = 1 AND (
        (month({d}) = 1 AND {nth} = 3 AND year({d}) >= 1986) OR (month({d}) = 2 AND {nth} = 3)
        OR (month({d}) = 5 AND month({d} + INTERVAL 7 DAY) = 6)
        OR (month({d}) = 9 AND {nth} = 1) OR (month({d}) = 10 AND {nth} = 2))
      OR isodow({d}) = 4 AND month({d}) = 11 AND {nth} = 4)"""
    return f"""(isodow({d}) <= 5 AND NOT ({is_on} OR (isodow({d}) = 5 AND {before})
      OR (isodow({d}) = 1 AND {after}) OR {floating}))"""


def _calendar(d: str) -> str:
    return f"""CAST(week({d}) AS INTEGER) AS week_of_year, CAST(isodow({d}) - 1 AS INTEGER) AS weekday,
      {_business(d)} AS business_day"""


def _rounded(columns, source: str = "") -> str:
    p = f"{source}." if source else ""
    return ", ".join(f"round({p}{c}, {ROUND}) AS {c}" for c in columns)


MEAN_COLUMNS = [c for c in WEATHER_COLUMNS if c.endswith("_mean")]
EXACT_COLUMNS = [c for c in WEATHER_COLUMNS if not c.endswith("_mean")]
WEATHER_OUT = ", ".join(EXACT_COLUMNS) + ", " + _rounded(MEAN_COLUMNS)

CLEAN_WEATHER = """
clean AS (
  SELECT CAST(datetime AS TIMESTAMP) AS datetime, CAST(CAST(datetime AS TIMESTAMP) AS DATE) AS date,
    CAST(hour(CAST(datetime AS TIMESTAMP)) AS INTEGER) AS hour,
    {period} AS hour_period, {measures}, CASE WHEN precipi < 0 THEN 0.0 ELSE precipi END AS precipi, {flags}, conds, wdire
  FROM weather WHERE tempi > -80 AND wspdi > 0 AND pressurei > -9999)""".format(
    period=_period("hour(CAST(datetime AS TIMESTAMP))"),
    measures=", ".join(m for m in MEASURES if m != "precipi"),
    flags=", ".join(FLAGS),
)
_SUMMARY = ", ".join(
    [f"min({m}) AS {m}_min, max({m}) AS {m}_max, avg({m}) AS {m}_mean" for m in MEASURES]
    + [f"max({f}) AS {f}" for f in FLAGS]
)
WEATHER_PERIOD = f"""
weather_period AS (SELECT date, hour_period, {_SUMMARY} FROM clean GROUP BY date, hour_period)"""
WEATHER_DAILY = f"""
weather_day AS (SELECT date, {_SUMMARY} FROM clean GROUP BY date)"""

_START = "strptime(starttime, '%m/%d/%Y %H:%M:%S')"
PREPARED = f"""
prepared AS (
  SELECT *, CAST(isodow(date) - 1 AS VARCHAR) || '_' || hour_period AS weekday_hour_period, {_calendar("date")}
  FROM (SELECT starttime, stoptime, tripduration, from_station_id, to_station_id,
      coalesce(usertype, 'Customer') AS usertype, coalesce(gender, 'U') AS gender,
      coalesce(birthyear, (SELECT avg(birthyear) FROM trip)) AS birthyear,
      {_START} AS starttime_dt, CAST({_START} AS DATE) AS date,
      CAST(hour({_START}) AS INTEGER) AS hour, {_period(f"hour({_START})")} AS hour_period
    FROM trip))"""
_ROLES = ", ".join(f"{r}.{c} AS {r}_{c}" for r in "st" for c in ["sta_id", *STATION_ATTRIBUTES])
TRIP_STATION = f"""
trip_station AS (
  SELECT p.* EXCLUDE (starttime_dt), {_ROLES}
  FROM prepared p JOIN station s ON p.from_station_id = s.sta_id JOIN station t ON p.to_station_id = t.sta_id)"""
COUNTS = """
counts AS (SELECT s_sta_id, date, hour_period, count(starttime) AS trip_count
  FROM trip_station GROUP BY ALL)"""
AXIS = """
axis AS (SELECT DISTINCT date, hour_period FROM counts),
stations AS (SELECT DISTINCT s_sta_id FROM counts)"""
GRID = """
grid AS (SELECT s.s_sta_id, a.date, a.hour_period, coalesce(c.trip_count, 0) AS trip_count
  FROM stations s CROSS JOIN axis a LEFT JOIN counts c
    ON c.s_sta_id = s.s_sta_id AND c.date = a.date AND c.hour_period = a.hour_period)"""

BASE = [EVENTS_SQL, STATION_SQL, TRIP_SQL]
TRIPS = [*BASE, PREPARED]
JOINED = [*TRIPS, TRIP_STATION]
GRIDDED = [*JOINED, COUNTS, AXIS, GRID]
READINGS = [EVENTS_SQL, WEATHER_SQL, CLEAN_WEATHER]
PERIODS = [WEATHER_SQL, CLEAN_WEATHER, WEATHER_PERIOD]

# Next known value: whole-table order (station, date, bucket) for the model table, the time
# axis alone for the plain fill.
_RAW = f"""
raw AS (SELECT g.*, {", ".join("w." + c for c in WEATHER_COLUMNS)}
  FROM grid g LEFT JOIN weather_period w ON g.date = w.date AND g.hour_period = w.hour_period)"""


def _bfill(frame: str) -> str:
    return ", ".join(f"first_value({c} IGNORE NULLS) OVER ({frame}) AS {c}" for c in WEATHER_COLUMNS)


_TABLE_ORDER = "ORDER BY s_sta_id, date, hour_period ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
_SITE_ORDER = "PARTITION BY s_sta_id ORDER BY date, hour_period ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
_WEATHER_JOINED = [*GRIDDED, *PERIODS, _RAW]
_HOT = ", ".join(f"CAST(hour_period = '{p}' AS INTEGER) AS {n}" for p, n in ONE_HOT_PERIODS.items())

MODEL = f"""
model AS (SELECT date, hour_period, s_sta_id, {_calendar("date")}, trip_count, {_HOT}, {_bfill(_TABLE_ORDER)} FROM raw)"""
VISITS = """
visits AS (SELECT from_station_id, weekday_hour_period, count(starttime) AS visit_count
  FROM prepared GROUP BY ALL)"""
CELLS = """
cells AS (SELECT s.from_station_id, k.weekday_hour_period, coalesce(v.visit_count, 0) AS visit_count
  FROM (SELECT DISTINCT from_station_id FROM visits) s CROSS JOIN (SELECT unnest([{keys}]) AS weekday_hour_period) k
  LEFT JOIN visits v ON v.from_station_id = s.from_station_id AND v.weekday_hour_period = k.weekday_hour_period)""".format(
    keys=", ".join(f"'{k}'" for k in PROFILE_KEYS)
)


def _mode(keys: list[str]) -> str:
    k = ", ".join(keys)
    extra = _calendar("date")
    return _with(*JOINED, body=f"SELECT {k}, count(starttime) AS trip_count, {extra} FROM trip_station GROUP BY {k}")


def _mode_attributes(keys: list[str], roles: list[str]) -> str:
    k = ", ".join(keys)
    attrs = ", ".join(f"any_value({r}_{c}) AS {r}_{c}" for r in roles for c in STATION_ATTRIBUTES)
    return _with(
        *JOINED, body=f"SELECT {k}, count(starttime) AS trip_count, {_calendar('date')}, {attrs} FROM trip_station GROUP BY {k}"
    )


def _profile_wide(expr: str) -> str:
    return ", ".join(f"{expr.format(k=k)} AS \"{k}\"" for k in PROFILE_KEYS)


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["demand_grid"] = _with(*GRIDDED, body=f"SELECT *, {_calendar('date')} FROM grid")
    q["trip_count_city_day"] = _mode(["date"])
    q["trip_count_station_day"] = _mode_attributes(["date", "s_sta_id"], ["s"])
    q["trip_count_od_day"] = _mode_attributes(["date", "s_sta_id", "t_sta_id"], ["s", "t"])
    q["trip_count_station_hour"] = _mode_attributes(["date", "hour", "s_sta_id"], ["s"])
    q["trip_count_od_period"] = _mode_attributes(["date", "hour_period", "s_sta_id", "t_sta_id"], ["s", "t"])
    grains = {1: ["date"], 2: ["date", "s_sta_id"], 3: ["date", "s_sta_id", "t_sta_id"], 4: ["date", "s_sta_id", "hour"],
              5: ["date", "s_sta_id", "t_sta_id", "hour_period"], 6: ["date", "s_sta_id", "hour_period"]}
    every = ["date", "s_sta_id", "t_sta_id", "hour_period", "hour"]
    q["trip_lattice"] = _with(*JOINED, body=" UNION ALL ".join(
        f"SELECT {m} AS mode, {', '.join(c if c in keys else f'NULL AS {c}' for c in every)}, count(starttime) AS trip_count"
        f" FROM trip_station WHERE {' AND '.join(f'{c} IS NOT NULL' for c in keys)} GROUP BY {', '.join(keys)}"
        for m, keys in grains.items()))
    q["trip_count_station_period"] = _with(
        *GRIDDED,
        body=f"SELECT g.*, {_calendar('date')}, "
        + ", ".join(f"s.{c} AS s_{c}" for c in STATION_ATTRIBUTES)
        + " FROM grid g JOIN station s ON g.s_sta_id = s.sta_id",
    )
    q["trip_count_station_day_dense"] = _with(
        *JOINED,
        """
c AS (SELECT s_sta_id, date, count(starttime) AS trip_count FROM trip_station GROUP BY ALL)""",
        body=f"""SELECT s.s_sta_id, d.date, coalesce(c.trip_count, 0) AS trip_count, {_calendar("d.date")}
FROM (SELECT DISTINCT s_sta_id FROM c) s CROSS JOIN (SELECT DISTINCT date FROM c) d
LEFT JOIN c ON c.s_sta_id = s.s_sta_id AND c.date = d.date""",
    )
    q["hour_period"] = f"SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, {_period('hour(ts)')} AS hour_period FROM events"
    q["parse_trip_time"] = _with(*BASE, body=f"SELECT trip_id, starttime, {_START} AS starttime_dt FROM trip")
    q["parse_weather_time"] = _with(
        EVENTS_SQL, WEATHER_SQL, body="SELECT datetime, CAST(datetime AS TIMESTAMP) AS parsed, tempi FROM weather"
    )
    q["calendar_parts"] = """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date,
  CAST(hour(o_orderdate) AS INTEGER) AS hour, CAST(week(o_orderdate) AS INTEGER) AS week_of_year,
  CAST(isodow(o_orderdate) - 1 AS INTEGER) AS weekday FROM orders"""
    q["profile_key"] = f"""SELECT event_id, CAST(isodow(ts) - 1 AS VARCHAR) || '_' || {_period('hour(ts)')}
  AS weekday_hour_period FROM events"""
    q["grid_key"] = f"""SELECT event_id, strftime(ts, '%Y-%m-%d') || '_' || {_period('hour(ts)')} AS date_hour_period,
  CAST(ts AS DATE) AS date, {_period('hour(ts)')} AS hour_period FROM events"""
    day = "CAST(o_orderdate AS DATE)"
    q["business_day"] = f"SELECT o_orderkey, {day} AS date, {_business(day)} AS business_day FROM orders"
    q["business_calendar"] = f"""WITH days AS (
  SELECT CAST(unnest(generate_series(min({day}), max({day}), INTERVAL 1 DAY)) AS DATE) AS date FROM orders)
SELECT date FROM days WHERE {_business('date')}"""
    q["date_window"] = f"""SELECT o_orderkey, {day} AS date, {day} - 365 AS window_start, {day} + 1 AS window_end FROM orders"""
    q["date_range"] = f"""SELECT o_orderkey, CAST(unnest(generate_series({day} - 4, {day}, INTERVAL 1 DAY)) AS DATE) AS date
FROM orders"""
    colors = "[" + ", ".join(f"'{c}'" for c in PALETTE) + "]"
    q["cluster_color"] = _with(
        STATION_SQL,
        LABELS_SQL,
        body=f"""SELECT s.*, l.cluster, l.cluster AS label, ({colors})[l.cluster % 19 + 1] AS label_color
FROM station s JOIN station_labels l ON s.sta_id = l.sta_id""",
    )
    q["row_share"] = _with(
        *TRIPS,
        VISITS,
        body=f"""SELECT from_station_id, weekday_hour_period, visit_count,
  round(visit_count / sum(visit_count) OVER (PARTITION BY from_station_id), {ROUND}) AS share FROM visits""",
    )
    q["weather_valid"] = _with(*READINGS, body="SELECT * FROM clean")
    q["trip_fill"] = _with(
        *BASE,
        body=f"""SELECT starttime, stoptime, tripduration, from_station_id, to_station_id,
  coalesce(usertype, 'Customer') AS usertype, coalesce(gender, 'U') AS gender,
  round(coalesce(birthyear, (SELECT avg(birthyear) FROM trip)), {ROUND}) AS birthyear FROM trip""",
    )
    q["drop_null_rows"] = _with(
        *BASE, body="SELECT * FROM trip WHERE usertype IS NOT NULL AND gender IS NOT NULL AND birthyear IS NOT NULL"
    )
    columns = [
        "trip_id", "starttime", "stoptime", "bikeid", "tripduration", "from_station_id", "from_station_name",
        "to_station_id", "to_station_name", "usertype", "gender", "birthyear",
    ]
    q["null_report"] = _with(
        *BASE,
        body="\nUNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM trip" for c in columns
        ),
    )
    window = "starttime_dt >= TIMESTAMP '2024-01-10' AND starttime_dt <= TIMESTAMP '2024-01-21'"
    q["range_filter"] = _with(
        *TRIPS,
        body=f"SELECT * REPLACE (round(birthyear, {ROUND}) AS birthyear) FROM prepared WHERE {window}",
    )
    q["train_test_split"] = _with(
        *GRIDDED,
        body="""SELECT *, CASE WHEN date < DATE '2024-01-20' THEN 'train' ELSE 'test' END AS split FROM grid""",
    )
    q["site_filter"] = _with(*GRIDDED, body="SELECT * FROM grid WHERE s_sta_id = 7")
    q["trip_station"] = _with(
        *JOINED, body=f"SELECT * REPLACE (round(birthyear, {ROUND}) AS birthyear) FROM trip_station"
    )
    q["cluster_members"] = _with(
        *GRIDDED,
        LABELS_SQL,
        body="SELECT * FROM grid WHERE s_sta_id IN (SELECT sta_id FROM station_labels WHERE cluster = 3)",
    )
    q["cluster_rows"] = _with(
        *GRIDDED, LABELS_SQL, body="SELECT g.*, l.cluster FROM grid g JOIN station_labels l ON g.s_sta_id = l.sta_id"
    )
    q["episode_dates"] = _with(
        *GRIDDED,
        body="""SELECT e.episode_end, g.date, count(*) AS cells, CAST(sum(trip_count) AS BIGINT) AS trip_count
FROM grid g JOIN (SELECT CAST(unnest(generate_series(DATE '2024-01-15', DATE '2024-01-27', INTERVAL 1 DAY)) AS DATE)
  AS episode_end) e ON g.date BETWEEN e.episode_end - 6 AND e.episode_end
GROUP BY ALL""",
    )
    q["visit_count"] = _with(*TRIPS, VISITS, body="SELECT * FROM visits")
    q["station_activity"] = _with(
        *TRIPS,
        body="""SELECT from_station_id, date, hour_period, starttime_dt = CAST(date AS TIMESTAMP) AS at_midnight,
  count(starttime) AS visits, count(s.sta_id) AS known_trips
FROM prepared p LEFT JOIN station s ON p.to_station_id = s.sta_id GROUP BY ALL""",
    )
    q["activity_counts"] = _with(
        *TRIPS,
        body=f"""SELECT s.sta_id AS s_sta_id, date, hour_period, count(starttime) AS trip_count
FROM prepared p JOIN station s ON p.from_station_id = s.sta_id JOIN station t ON p.to_station_id = t.sta_id
WHERE {window} GROUP BY ALL""",
    )
    q["group_summary"] = f"""SELECT o_orderpriority, o_orderstatus, min(o_totalprice) AS o_totalprice_min,
  max(o_totalprice) AS o_totalprice_max, round(avg(o_totalprice), {ROUND}) AS o_totalprice_mean,
  max(o_custkey) AS o_custkey, min(o_orderdate) AS o_orderdate
FROM orders GROUP BY o_orderpriority, o_orderstatus"""
    q["weather_period"] = _with(
        *READINGS, WEATHER_PERIOD, body=f"SELECT date, hour_period, {WEATHER_OUT} FROM weather_period"
    )
    lags = ", ".join(
        f"lag({f}, {n}) OVER (ORDER BY date) AS {f}_{h}" for n, h in LAG_HOURS.items() for f in LAGGED_FLAGS
    )
    lag_names = [f"{f}_{h}" for h in LAG_HOURS.values() for f in LAGGED_FLAGS]
    complete = " AND ".join(f"{c} IS NOT NULL" for c in [*WEATHER_COLUMNS, *lag_names])
    q["weather_daily_lags"] = _with(
        *READINGS,
        WEATHER_DAILY,
        f" lagged AS (SELECT *, {lags} FROM weather_day)",
        body=f"SELECT date, {WEATHER_OUT}, {', '.join(lag_names)} FROM lagged WHERE {complete}",
    )
    looked_up = ", ".join(
        f"d{n}.{f} AS {f}_{h}" for n, h in LAG_HOURS.items() for f in LAGGED_FLAGS
    )
    joins = " ".join(f"LEFT JOIN weather_day d{n} ON d{n}.date = w.date - {n}" for n in LAG_HOURS)
    q["weather_calendar_lags"] = _with(
        *READINGS,
        WEATHER_DAILY,
        body=f"SELECT w.date, {', '.join('w.' + f for f in FLAGS)}, {looked_up} FROM weather_day w {joins}",
    )
    q["distinct_stations"] = _with(*JOINED, body="SELECT DISTINCT s_sta_id FROM trip_station")
    q["distinct_count"] = _with(*JOINED, body="SELECT count(DISTINCT s_sta_id) AS distinct_count FROM trip_station")
    predicted = """
predicted AS (SELECT date, s_sta_id, trip_count, avg(trip_count) OVER (PARTITION BY s_sta_id, hour_period) AS pred FROM grid)"""
    r2 = f"1 - sum((trip_count - pred) * (trip_count - pred)) / (var_pop(trip_count) * count(*))"
    q["r2"] = _with(*GRIDDED, predicted, body=f"SELECT count(*) AS n, round({r2}, {ROUND}) AS r2 FROM predicted")
    q["mean_r2"] = _with(
        *GRIDDED,
        predicted,
        body=f"SELECT round(avg(r2), {ROUND}) AS mean_r2 FROM (SELECT date, {r2} AS r2 FROM predicted GROUP BY date)",
    )
    q["profile_pivot"] = _with(
        *TRIPS,
        VISITS,
        body="SELECT from_station_id, "
        + _profile_wide("CAST(coalesce(sum(visit_count) FILTER (WHERE weekday_hour_period = '{k}'), 0) AS BIGINT)")
        + " FROM visits GROUP BY from_station_id",
    )
    q["one_hot"] = f"""SELECT event_id, {', '.join(f"CAST({_period('hour(ts)')} = '{p}' AS INTEGER) AS {n}"
        for p, n in ONE_HOT_PERIODS.items())} FROM events"""
    q["one_hot_observed"] = f"""SELECT o_orderkey, {', '.join(
        f"CAST(o_orderstatus = '{s}' AS INTEGER) AS {s}" for s in "FOP")} FROM orders"""
    stats = """
stats AS (SELECT weekday_hour_period, min({v}) AS lo, max({v}) AS hi FROM {t} GROUP BY weekday_hour_period)"""
    scaled = "CASE WHEN s.hi = s.lo THEN 0.0 ELSE (c.{v} - s.lo) / CAST(s.hi - s.lo AS DOUBLE) END"
    pivoted = _profile_wide("round(max(x) FILTER (WHERE weekday_hour_period = '{k}'), " + str(ROUND) + ")")
    q["minmax"] = _with(
        *TRIPS, VISITS, CELLS, stats.format(v="visit_count", t="cells"),
        body=f"""SELECT from_station_id, {pivoted} FROM (SELECT c.from_station_id, c.weekday_hour_period,
  {scaled.format(v="visit_count")} AS x FROM cells c JOIN stats s USING (weekday_hour_period)) GROUP BY from_station_id""",
    )
    q["minmax_relative"] = _with(
        *TRIPS, VISITS, CELLS,
        """
shares AS (SELECT from_station_id, weekday_hour_period,
  visit_count / CAST(sum(visit_count) OVER (PARTITION BY from_station_id) AS DOUBLE) AS share FROM cells)""",
        stats.format(v="share", t="shares"),
        body=f"""SELECT from_station_id, {pivoted} FROM (SELECT c.from_station_id, c.weekday_hour_period,
  {scaled.format(v="share")} AS x FROM shares c JOIN stats s USING (weekday_hour_period)) GROUP BY from_station_id""",
    )
    both = ", ".join(
        f"round((o.{c} - s.{c}_lo) / CAST(s.{c}_hi - s.{c}_lo AS DOUBLE), {ROUND}) AS {c}"
        for c in ("o_totalprice", "o_custkey")
    )
    q["minmax_train_test"] = f"""WITH s AS (
  SELECT min(o_totalprice) AS o_totalprice_lo, max(o_totalprice) AS o_totalprice_hi,
    min(o_custkey) AS o_custkey_lo, max(o_custkey) AS o_custkey_hi FROM orders WHERE o_orderdate < DATE '1998-01-01')
SELECT o.o_orderkey, {both},
  CASE WHEN o.o_orderdate < DATE '1998-01-01' THEN 'train' ELSE 'test' END AS split FROM orders o, s"""
    features = ["trip_count", "tempi_mean", "rain"]
    rows = "\nUNION ALL ".join(
        f"""SELECT l.cluster, e.episode_end, '{f}' AS feature, m.s_sta_id, m.date, m.hour_period,
  CAST(coalesce(m.{f}, 0) AS DOUBLE) AS value
FROM model m JOIN station_labels l ON m.s_sta_id = l.sta_id JOIN ends e ON m.date BETWEEN e.episode_end - 6 AND e.episode_end"""
        for f in features
    )
    episodes = f"""
ends AS (SELECT CAST(unnest(generate_series(DATE '2024-01-17', DATE '2024-01-25', INTERVAL 1 DAY)) AS DATE) AS episode_end),
episodes AS ({rows}
UNION ALL SELECT l.cluster, e.episode_end, 'label' AS feature, m.s_sta_id, m.date, m.hour_period,
  CAST(coalesce(m.trip_count, 0) AS DOUBLE) AS value
FROM model m JOIN station_labels l ON m.s_sta_id = l.sta_id JOIN ends e ON m.date BETWEEN e.episode_end + 1 AND e.episode_end + 2)"""
    split = "CASE WHEN episode_end < DATE '2024-01-23' THEN 'train' ELSE 'test' END AS split"
    q["episodes_long"] = _with(
        *_WEATHER_JOINED, MODEL, LABELS_SQL, episodes,
        body=f"SELECT * REPLACE (round(value, {ROUND}) AS value), {split} FROM episodes",
    )
    q["episodes_nested_cells"] = _with(
        *_WEATHER_JOINED, MODEL, LABELS_SQL, episodes,
        body=f"""SELECT cluster, episode_end, feature, s_sta_id, strftime(date, '%Y-%m-%d') || '_' || hour_period AS bucket,
  round(value, {ROUND}) AS value, {split} FROM episodes""",
    )
    q["target_shift"] = _with(
        *GRIDDED,
        body="""SELECT * FROM (SELECT *, lag(trip_count, 6) OVER (PARTITION BY s_sta_id ORDER BY date, hour_period)
  AS next_day_trip_count FROM grid) WHERE next_day_trip_count IS NOT NULL""",
    )
    q["site_series"] = _with(
        *GRIDDED,
        body=f"""SELECT s_sta_id, date, hour_period, {_calendar('date')}, next_day_trip_count FROM (
  SELECT *, lag(trip_count, 6) OVER (ORDER BY date, hour_period) AS next_day_trip_count FROM grid WHERE s_sta_id = 7)
WHERE next_day_trip_count IS NOT NULL""",
    )
    q["backfill_weather"] = _with(
        *_WEATHER_JOINED,
        f" filled AS (SELECT date, hour_period, s_sta_id, trip_count, {_bfill(_SITE_ORDER)} FROM raw)",
        body=f"SELECT date, hour_period, s_sta_id, {_calendar('date')}, trip_count, {WEATHER_OUT} FROM filled",
    )
    q["grid_weather_join"] = _with(
        *_WEATHER_JOINED,
        body=f"SELECT date, hour_period, s_sta_id, {_calendar('date')}, trip_count, {WEATHER_OUT} FROM raw",
    )
    q["model_data"] = _with(
        *_WEATHER_JOINED, MODEL,
        body=f"""SELECT date, s_sta_id, week_of_year, weekday, business_day, trip_count, {WEATHER_OUT},
  {', '.join(ONE_HOT_PERIODS.values())} FROM model""",
    )
    q["trip_prepared"] = _with(
        *TRIPS, body=f"SELECT * REPLACE (round(birthyear, {ROUND}) AS birthyear) FROM prepared"
    )
    q["union_files"] = """SELECT o_orderkey, o_custkey, o_totalprice,
  CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS o_orderpriority FROM orders"""
    q["save_reload"] = _with(
        *TRIPS, body=f"SELECT * REPLACE (round(birthyear, {ROUND}) AS birthyear) FROM prepared"
    )
    q["station_clusters"] = _with(
        *TRIPS, VISITS, CELLS, """
scaled AS (
  SELECT from_station_id AS id, weekday_hour_period AS cell, (visit_count - min(visit_count) OVER c)
    / CAST(CASE WHEN max(visit_count) OVER c = min(visit_count) OVER c THEN 1
      ELSE max(visit_count) OVER c - min(visit_count) OVER c END AS DOUBLE) AS x
  FROM cells WINDOW c AS (PARTITION BY weekday_hour_period)),
points AS (SELECT id, list(x ORDER BY cell) AS vec FROM scaled GROUP BY id),
weighted AS (SELECT min(id) AS cid, CAST(count(*) AS DOUBLE) AS n, vec, list(id) AS members FROM points GROUP BY vec),
merged AS (
  SELECT 0 AS step, cid, n, vec, members FROM weighted
  UNION ALL
  SELECT s.step + 1, s.cid, s.n + coalesce(o.n, 0),
    CASE WHEN o.cid IS NULL THEN s.vec
      ELSE list_transform(list_zip(s.vec, o.vec), lambda p: (s.n * p[1] + o.n * p[2]) / (s.n + o.n)) END,
    CASE WHEN o.cid IS NULL THEN s.members ELSE list_concat(s.members, o.members) END
  FROM merged s
  CROSS JOIN (
    SELECT a.cid AS x, b.cid AS y FROM merged a JOIN merged b ON a.cid < b.cid
    ORDER BY a.n * b.n / (a.n + b.n) * pow(list_distance(a.vec, b.vec), 2), a.cid, b.cid LIMIT 1) best
  LEFT JOIN merged o ON s.cid = best.x AND o.cid = best.y
  WHERE s.cid <> best.y AND (SELECT count(*) FROM merged) > 8),
labels AS (
  SELECT unnest(members) AS sta_id, CAST(row_number() OVER (ORDER BY cid) - 1 AS INTEGER) AS cluster
  FROM merged WHERE step = (SELECT max(step) FROM merged))""",
        body="SELECT sta_id, cluster FROM station JOIN labels USING (sta_id)",
    ).replace("WITH", "WITH RECURSIVE", 1)
    q["load_and_prepare"] = _with(
        *TRIPS, *PERIODS,
        body="""SELECT 'station' AS name, count(*) AS rows, round(CAST(sum(sta_id) AS DOUBLE), 4) AS total FROM station
UNION ALL SELECT 'weather_period', count(*), round(CAST(sum(tempi_max) AS DOUBLE), 4) FROM weather_period
UNION ALL SELECT 'trip', count(*), round(CAST(sum(to_station_id) AS DOUBLE), 4) FROM prepared""",
    )
    q["one_hot_several"] = """SELECT o_orderkey, CAST(coalesce(o_orderstatus = 'O', false) AS INTEGER) AS is_open,
  CAST(coalesce(o_orderstatus = 'F', false) AS INTEGER) AS is_final,
  CAST(coalesce(o_orderpriority = '1-URGENT', false) AS INTEGER) AS is_urgent FROM orders"""
    q["backfill_weather_segments"] = q["backfill_weather"]
    q["weather_daily_lags_segments"] = q["weather_daily_lags"]
    q["station_clusters_in_blocks"] = q["station_clusters_leaves"] = q["station_clusters"]
    for name, label in (("forecast_one_split", "l.cluster // 9"), ("forecast_one_split_labels", "l.cluster")):
        q[name] = _with(
            *GRIDDED, LABELS_SQL,
            f"""
rows AS (SELECT g.*, CAST({label} AS INTEGER) AS cluster, {_business('g.date')} AS business_day
  FROM grid g JOIN station_labels l ON g.s_sta_id = l.sta_id),
fitted AS (SELECT cluster, business_day, avg(trip_count) AS pred FROM rows WHERE date < DATE '2024-01-26' GROUP BY ALL)""",
            body=f"""SELECT s_sta_id, date, hour_period, cluster, trip_count, round(pred, {ROUND}) AS pred,
  CASE WHEN pred IS NULL THEN 'no train rows' ELSE 'ok' END AS status
FROM rows LEFT JOIN fitted USING (cluster, business_day) WHERE date >= DATE '2024-01-26'""",
        )
    return q
