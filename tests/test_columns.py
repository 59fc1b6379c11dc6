from datetime import date, datetime, timedelta

import pytest
from pandas.tseries.holiday import USFederalHolidayCalendar
from pyspark.sql import functions as F

from dockcast.functions import timecols as tc
from dockcast.functions.colors import PALETTE, cluster_color

EXPECTED = {0: "6,21-24", **{h: p for h, p in zip(range(1, 24), sum([[p] * 4 for p in (
    "1,1-4", "2,5-8", "3,9-12", "4,13-16", "5,17-20", "6,21-24")], []))}}


def test_hour_period_of_every_hour_and_null(spark):
    df = spark.createDataFrame([(h,) for h in [*range(24), None]], "h int")
    got = {r.h: r.p for r in df.select("h", tc.hour_period("h").alias("p")).collect()}
    assert got == {**EXPECTED, None: None}


def test_parse_time_forms(spark):
    rows = [
        ("07/04/2016 00:00:00", datetime(2016, 7, 4)),
        ("7/4/2016 9:05:07", datetime(2016, 7, 4, 9, 5, 7)),
        ("7/4/2016 23:59", datetime(2016, 7, 4, 23, 59)),
        ("2016-07-04 08:00:01", datetime(2016, 7, 4, 8, 0, 1)),
        ("2016-07-04", datetime(2016, 7, 4)),
        ("03/13/2016 02:30:00", datetime(2016, 3, 13, 2, 30)),
        (None, None),
    ]
    df = spark.createDataFrame(rows, "t string, want timestamp_ntz")
    for r in df.withColumn("got", tc.parse_time("t")).collect():
        assert r.got == r.want, r.t


@pytest.mark.parametrize("text", ["yesterday", "13/45/2016 01:00:00"])
def test_parse_time_raises_on_other_text(spark, text):
    with pytest.raises(Exception, match="cannot parse time"):
        spark.createDataFrame([(text,)], "t string").select(tc.parse_time("t")).collect()


def test_business_day_equals_the_federal_calendar(spark):
    first, last = date(1975, 1, 1), date(2030, 12, 31)
    days = spark.range((last - first).days + 1).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("d"))
    got = {
        r.d: (r.plain, r.june)
        for r in days.select(
            "d", tc.is_business_day("d").alias("plain"), tc.is_business_day("d", juneteenth=True).alias("june")
        ).collect()
    }
    # A holiday just past the range may be observed inside it.
    holidays = {d.date() for d in USFederalHolidayCalendar().holidays(first, last + timedelta(days=5))}
    for d, (plain, june) in got.items():
        want = d.weekday() < 5 and d not in holidays
        assert june == want, d
        near_june = d.year >= 2021 and d.month == 6 and 18 <= d.day <= 21
        assert plain == want or near_june, d


def test_iso_week_and_weekday(spark):
    df = spark.createDataFrame([(date(2016, 1, 1),), (date(2016, 1, 4),), (date(2018, 12, 31),)], "date date")
    got = [(r.week_of_year, r.weekday) for r in tc.with_calendar(df).collect()]
    assert got == [(53, 4), (1, 0), (1, 0)]


def test_keys_round_trip(spark):
    df = spark.createDataFrame([(date(2016, 8, 1), "2,5-8"), (None, "2,5-8")], "d date, p string")
    day, period = tc.split_grid_key("k")
    got = df.select(tc.grid_key("d", "p").alias("k"), tc.profile_key("d", "p").alias("w")).select("k", "w", day, period)
    first, second = got.collect()
    assert tuple(first) == ("2016-08-01_2,5-8", "0_2,5-8", date(2016, 8, 1), "2,5-8")
    assert second[0] is None and second[1] is None


def test_business_calendar_spans_the_table(spark):
    df = spark.createDataFrame([(date(2016, 7, 1),), (date(2016, 7, 6),)], "date date")
    got = [r.date for r in tc.business_calendar(df).orderBy("date").collect()]
    assert got == [date(2016, 7, 1), date(2016, 7, 5), date(2016, 7, 6)]


def test_forecast_dates_include_the_end():
    assert tc.forecast_dates(date(2016, 8, 1), 5) == [date(2016, 7, d) for d in (28, 29, 30, 31)] + [date(2016, 8, 1)]


def test_cluster_color_starts_over(spark):
    df = spark.createDataFrame([(0,), (18,), (19,), (37,), (None,)], "label int")
    got = [r.c for r in df.select(cluster_color("label").alias("c")).collect()]
    assert got == [PALETTE[0], PALETTE[18], PALETTE[0], PALETTE[18], None]


def test_fixed_values_are_spelled_out():
    from dockcast.functions.colors import PALETTE
    from dockcast.schemas import HOUR_PERIODS, PROFILE_KEYS

    assert HOUR_PERIODS == ["1,1-4", "2,5-8", "3,9-12", "4,13-16", "5,17-20", "6,21-24"]
    assert " ".join(PALETTE) == (
        "red blue green purple orange darkred lightred beige darkblue darkgreen cadetblue darkpurple white pink "
        "lightblue lightgreen gray black lightgray"
    )
    assert len(PROFILE_KEYS) == 42 and PROFILE_KEYS[0] == "0_1,1-4" and PROFILE_KEYS[-1] == "6_6,21-24"
