from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from dockcast.operators import cleaning, metrics, reshape, scaling, summarize, windows
from dockcast.plans.weather import build_weather

NAN = float("nan")


def _weather(spark, rows):
    """rows: (datetime, tempi, wspdi, pressurei, precipi, rain)."""
    from dockcast.schemas import FLAGS, MEASURES, WEATHER

    full = []
    for when, temp, wind, pressure, precip, rain in rows:
        values = {f.name: None for f in WEATHER}
        values.update({m: 1.0 for m in MEASURES}, **{f: 0 for f in FLAGS})
        values.update(datetime=when, tempi=temp, wspdi=wind, pressurei=pressure, precipi=precip, rain=rain)
        full.append(tuple(values[f.name] for f in WEATHER))
    return spark.createDataFrame(full, WEATHER)


def test_valid_readings_drop_sentinels_nulls_and_nan(spark):
    rows = [
        ("2016-01-01 01:00:00", 20.0, 5.0, 30.0, 0.1, 0),
        ("2016-01-01 02:00:00", -80.0, 5.0, 30.0, 0.1, 0),
        ("2016-01-01 03:00:00", 20.0, 0.0, 30.0, 0.1, 0),
        ("2016-01-01 04:00:00", 20.0, 5.0, -9999.0, 0.1, 0),
        ("2016-01-01 05:00:00", None, 5.0, 30.0, 0.1, 0),
        ("2016-01-01 06:00:00", NAN, 5.0, 30.0, 0.1, 0),
    ]
    clean = cleaning.valid_readings(cleaning.nan_to_null(_weather(spark, rows)))
    assert clean.count() == 1


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-9999.0,), (0.5,), (None,)], "x double")
    assert [r.y for r in df.select(cleaning.clip_lower(F.col("x"), 0.0).alias("y")).collect()] == [0.0, 0.5, None]


def test_weather_tables(spark):
    rows = [
        ("2016-01-01 00:30:00", 10.0, 5.0, 30.0, -9999.0, 1),
        ("2016-01-01 22:00:00", 20.0, 5.0, 30.0, 0.5, 0),
        ("2016-01-02 01:00:00", 30.0, 5.0, 30.0, 0.0, 0),
        ("2016-01-03 01:00:00", 40.0, 5.0, 30.0, 0.0, 1),
        ("2016-01-05 01:00:00", 50.0, 5.0, 30.0, 0.0, 0),
    ]
    period, daily = build_weather(_weather(spark, rows))
    first = period.filter("date = '2016-01-01'").collect()
    assert len(first) == 1 and first[0].hour_period == "6,21-24"
    assert (first[0].tempi_min, first[0].tempi_max, first[0].tempi_mean) == (10.0, 20.0, 15.0)
    assert (first[0].precipi_min, first[0].rain) == (0.0, 1)
    # Row shifts: three earlier rows are needed, and the day gap is not seen.
    (row,) = daily.collect()
    assert (row.date, row.rain_24h, row.rain_48h, row.rain_72h) == (date(2016, 1, 5), 1, 0, 1)
    by_date = build_weather(_weather(spark, rows), lag_by="calendar").daily
    assert by_date.count() == 0


def test_constant_and_mean_fill(spark):
    df = spark.createDataFrame([(None, None, 1980.0), ("Subscriber", "M", None), (None, "F", 1990.0)],
                               "usertype string, gender string, birthyear double")
    got = cleaning.fill_mean(cleaning.fill_constants(df), "birthyear").collect()
    assert [tuple(r) for r in got] == [("Customer", "U", 1980.0), ("Subscriber", "M", 1985.0), ("Customer", "F", 1990.0)]


def test_null_report(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    assert {r.column_name: r.null_count for r in cleaning.null_report(df).collect()} == {"a": 1, "b": 2}
    with pytest.raises(Exception, match="find na in dataframe"):
        cleaning.null_report(df, raise_on_null=True).collect()
    clean = spark.createDataFrame([(1,)], "a int")
    assert cleaning.null_report(clean, raise_on_null=True).first().null_count == 0


def test_time_window_ends(spark):
    times = [datetime(2016, 7, 1), datetime(2016, 6, 30, 23, 59, 59), datetime(2016, 7, 12), datetime(2016, 7, 12, 0, 0, 1)]
    df = spark.createDataFrame([(t, t.date()) for t in times], "starttime_dt timestamp_ntz, date date")
    both = cleaning.time_window(df, date(2016, 7, 11), 10, 1)
    assert {r.starttime_dt for r in both.collect()} == {times[0], times[2]}
    left = cleaning.time_window(df, date(2016, 7, 11), 10, 1, closed="left")
    assert {r.starttime_dt for r in left.collect()} == {times[0]}


def test_group_summary_skips_null_keys(spark):
    df = spark.createDataFrame([("a", 1.0, 5), ("a", 3.0, 2), (None, 9.0, 9)], "k string, x double, y int")
    got = summarize.group_summary(df, ["k"], ["x"], ["y"]).collect()
    assert [r.asDict() for r in got] == [{"k": "a", "x_min": 1.0, "x_max": 3.0, "x_mean": 2.0, "y": 5}]


def test_one_hot_domain_and_null(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, c string")
    got = reshape.one_hot(df, "c", {"a": "is_a", "b": "is_b", "z": "is_z"}).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, 1, 0, 0), (2, 0, 1, 0), (3, 0, 0, 0)]
    kept = reshape.one_hot(df, "c", remove_original=False)
    assert kept.columns == ["id", "c", "a", "b"]


def test_minmax_constant_column_and_unclipped_test(spark):
    train = spark.createDataFrame([(0.0, 7), (10.0, 7)], "x double, c int")
    test = spark.createDataFrame([(20.0, 8)], "x double, c int")
    a, b = scaling.standardize_train_test(train, test, ["x", "c"])
    assert [tuple(r) for r in a.collect()] == [(0.0, 0.0), (1.0, 0.0)]
    assert tuple(b.first()) == (2.0, 1.0)


def test_relative_mode_uses_row_shares(spark):
    wide = spark.createDataFrame([(1, 1, 3), (2, 10, 10)], "k int, a int, b int")
    scaled, stats = scaling.similarity_table(wide, ["a", "b"])
    assert stats.first().asDict() == {"a_min": 0.25, "a_max": 0.5, "b_min": 0.5, "b_max": 0.75}
    assert {r.k: (r.a, r.b) for r in scaled.collect()} == {1: (0.0, 1.0), 2: (1.0, 0.0)}


@pytest.mark.parametrize(
    "rows, want",
    [
        ([(1, 1.0), (3, 3.0)], 1.0),
        ([(1, 2.0), (3, 2.0)], 0.0),
        ([(2, 2.0), (2, 2.0)], 1.0),
        ([(2, 2.0), (2, 3.0)], 0.0),
        ([(2, 2.0)], None),
    ],
)
def test_r2_edges(spark, rows, want):
    df = spark.createDataFrame(rows, "trip_count long, pred double")
    assert metrics.r2_score(df).first().r2 == want


def test_r2_is_not_squared_correlation(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0)], "trip_count long, pred double")
    assert metrics.r2_score(df).first().r2 == pytest.approx(1 - (81 + 324 + 729) / 2)


def test_target_shift_both_directions(spark):
    rows = [(1, date(2016, 1, d), "1,1-4", d * 10) for d in (1, 2, 3)] + [(2, date(2016, 1, 1), "1,1-4", 5)]
    df = spark.createDataFrame(rows, "s_sta_id long, date date, hour_period string, trip_count long")
    lag = {r.date.day: r.next_day_trip_count for r in windows.target_shift(df, 1).collect()}
    lead = {r.date.day: r.next_day_trip_count for r in windows.target_shift(df, 1, "lead").collect()}
    assert lag == {2: 10, 3: 20} and lead == {1: 20, 2: 30}
    features, label = windows.site_timeseries(df, 1, 1)
    assert "trip_count" not in features.columns and label.count() == features.count() == 2
