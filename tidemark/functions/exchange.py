"""Sessions of the New York exchange from its holiday rules."""

from __future__ import annotations

from datetime import date, timedelta
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Full days closed for other reasons (fixed values).
CLOSED = tuple(date.fromisoformat(x) for x in (
    "1994-04-27", "2001-09-11", "2001-09-12", "2001-09-13", "2001-09-14", "2004-06-11", "2007-01-02", "2012-10-29", "2012-10-30", "2018-12-05", "2025-01-09"))


def easter(year: int) -> date:
    """Gregorian computus (anonymous algorithm)."""
    a, (b, c) = year % 19, divmod(year, 100)
    g = (8 * b + 13) // 25
    h = (19 * a + b - b // 4 - g + 15) % 30
    m = (a + 11 * h) // 319
    week = (2 * (b % 4) + 2 * (c // 4) - c % 4 - h + m + 32) % 7
    month = (h - m + week + 90) // 25
    return date(year, month, (h - m + week + month + 19) % 32)


def nth_weekday(year: int, month: int, weekday: int, n: int) -> date:
    """The n-th such weekday of a month; -1 is the last."""
    if n > 0:
        first = date(year, month, 1)
        return first + timedelta((weekday - first.weekday()) % 7 + 7 * (n - 1))
    last = date(year + month // 12, month % 12 + 1, 1) - timedelta(1)
    return last - timedelta((last.weekday() - weekday) % 7)


def observed(d: date) -> date:
    """Saturday's holiday is on Friday, Sunday's on Monday."""
    return d - timedelta(1) if d.weekday() == 5 else d + timedelta(1) if d.weekday() == 6 else d


@lru_cache
def holidays(year: int) -> frozenset[date]:
    new_year = date(year, 1, 1)
    out = {nth_weekday(year, 2, 0, 3), easter(year) - timedelta(2), nth_weekday(year, 5, 0, -1), observed(date(year, 7, 4)), nth_weekday(year, 9, 0, 1), nth_weekday(year, 11, 3, 4), observed(date(year, 12, 25))}
    if new_year.weekday() != 5:  # on a Saturday it isn't made up for
        out.add(observed(new_year))
    if year >= 1998:
        out.add(nth_weekday(year, 1, 0, 3))
    if year >= 2022:
        out.add(observed(date(year, 6, 19)))
    return frozenset(out | {d for d in CLOSED if d.year == year})


def sessions(start: date, end: date) -> list[date]:
    days = (start + timedelta(i) for i in range((end - start).days + 1))
    return [d for d in days if d.weekday() < 5 and d not in holidays(d.year)]


def sessions_frame(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row a session: about 252 a year, so it may be broadcast."""
    return spark.createDataFrame([(d,) for d in sessions(start, end)], "trade_date date")


def next_session(spark: SparkSession, start: date, end: date) -> DataFrame:
    """calendar_date, trade_date: each date with the first session on or after it (none: no row)."""
    last = end + timedelta(14)
    spine = spark.range((last - start).days + 1).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("calendar_date"))
    held = spine.join(F.broadcast(sessions_frame(spark, start, last)), F.col("calendar_date") == F.col("trade_date"), "left")
    ahead = Window.orderBy("calendar_date").rowsBetween(0, Window.unboundedFollowing)
    return held.select("calendar_date", F.min("trade_date").over(ahead).alias("trade_date")).where(F.col("calendar_date") <= F.lit(end))
