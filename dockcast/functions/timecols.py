"""Date, time and key columns; all of them built-in expressions.

Arguments are column names or SQL expressions.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast.config import DATE_FORMAT
from dockcast.schemas import HOUR_PERIODS

# US federal holidays. Month*100+day for the fixed dates; for the floating
# ones month, weekday (Monday = 0), first and last possible day of the month, first year.
FIXED_HOLIDAYS = [101, 704, 1111, 1225]
JUNETEENTH = 619
JUNETEENTH_FROM = 2021
FLOATING_HOLIDAYS = [
    (1, 0, 15, 21, 1986),
    (2, 0, 15, 21, 1),
    (5, 0, 25, 31, 1),
    (9, 0, 1, 7, 1),
    (10, 0, 8, 14, 1),
    (11, 3, 22, 28, 1),
]


def hour_period(hour: str) -> Column:
    """Four-hour bucket label of an hour; hour 0 closes the last bucket of its own date.

    The null check is needed: with a constant array ``element_at`` does not see a null index.
    """
    labels = ", ".join(f"'{p}'" for p in HOUR_PERIODS)
    slot = f"cast(({hour} + 23) % 24 div 4 + 1 AS int)"
    return F.expr(f"CASE WHEN {hour} IS NOT NULL THEN element_at(array({labels}), {slot}) END")


def parse_time(text: str) -> Column:
    """Text to ``timestamp_ntz``: ``M/d/yyyy H:mm[:ss]`` or any ISO form; other text raises.

    The month-first form is turned into ISO order so that one cast serves both.
    """
    iso = rf"regexp_replace(trim({text}), r'^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}})', '$3-$1-$2')"
    bad = f"CASE WHEN {text} IS NOT NULL THEN cast(raise_error(concat('cannot parse time: ', {text})) AS timestamp_ntz) END"
    return F.expr(f"coalesce(try_cast({iso} AS timestamp_ntz), {bad})")


def profile_key(day: str, period: str) -> Column:
    """``<weekday>_<bucket>``, Monday being 0; null if a part is null."""
    return F.expr(f"concat(cast(weekday({day}) AS string), '_', {period})")


def grid_key(day: str, period: str) -> Column:
    """``yyyy-MM-dd_<bucket>``; null if a part is null."""
    return F.expr(f"concat(date_format({day}, '{DATE_FORMAT}'), '_', {period})")


def split_grid_key(key: str) -> tuple[Column, Column]:
    """Inverse of :func:`grid_key`: (date, bucket)."""
    return F.expr(f"to_date(split({key}, '_')[0], '{DATE_FORMAT}')"), F.expr(f"split({key}, '_')[1]")


def business_day_sql(day: str, juneteenth: bool = False) -> str:
    """Condition: Monday to Friday and not a US federal holiday.

    A fixed holiday on Saturday is kept on the Friday before, one on Sunday on the
    Monday after. For a working day this means: it is a fixed holiday, or a Friday
    before one, or a Monday after one.
    """
    codes = ", ".join(map(str, FIXED_HOLIDAYS))

    def fixed(d: str) -> str:
        code = f"month({d}) * 100 + day({d})"
        hit = f"{code} IN ({codes})"
        return f"({hit} OR ({code} = {JUNETEENTH} AND year({d}) >= {JUNETEENTH_FROM}))" if juneteenth else f"({hit})"

    floating = " OR ".join(
        f"(month({day}) = {month} AND weekday({day}) = {on} AND day({day}) BETWEEN {first} AND {last}"
        + (f" AND year({day}) >= {since})" if since > 1 else ")")
        for month, on, first, last, since in FLOATING_HOLIDAYS
    )
    return (
        f"(weekday({day}) < 5 AND NOT ({fixed(day)} OR {floating}"
        f" OR (weekday({day}) = 4 AND {fixed(f'date_add({day}, 1)')})"
        f" OR (weekday({day}) = 0 AND {fixed(f'date_sub({day}, 1)')})))"
    )


def is_business_day(day: str, juneteenth: bool = False) -> Column:
    """:func:`business_day_sql` as a column."""
    return F.expr(business_day_sql(day, juneteenth))


def with_calendar(df: DataFrame, day: str = "date", juneteenth: bool = False) -> DataFrame:
    """Add week_of_year, weekday (Monday = 0) and business_day of a date column."""
    return df.selectExpr(
        "*",
        f"weekofyear({day}) AS week_of_year",
        f"weekday({day}) AS weekday",
        f"{business_day_sql(day, juneteenth)} AS business_day",
    )


def business_calendar(df: DataFrame, day: str = "date", juneteenth: bool = False) -> DataFrame:
    """All business days between the first and the last date of a table."""
    span = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date"))
    return days.filter(is_business_day("date", juneteenth))


def dates_ending(end: str, periods: int) -> Column:
    """Array of ``periods`` consecutive dates, the last one being ``end``."""
    return F.expr(f"sequence(date_sub({end}, {periods - 1}), {end}, interval 1 day)")


def forecast_dates(end: date, days: int) -> list[date]:
    """The ``days`` forecast dates up to and including ``end``."""
    return [end - timedelta(days=n) for n in range(days - 1, -1, -1)]
