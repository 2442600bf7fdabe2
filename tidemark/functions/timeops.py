"""Instants and exchange sessions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

EXCHANGE_ZONE = "America/New_York"


def pin_utc(spark: SparkSession) -> None:
    """Instants are compared and cast under UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def session_date(c: Column, zone: str = EXCHANGE_ZONE) -> Column:
    """Date on the exchange's clock of an instant (session time zone UTC)."""
    return F.from_utc_timestamp(c.cast("timestamp"), zone).cast("date")


def instant_of_millis(c: Column) -> Column:
    return F.timestamp_millis(c)


def parsed_instant(text: Column, fallback: Column | None = None) -> Column:
    """ISO-8601 text; what can't be parsed is the fallback, else null."""
    t = F.try_to_timestamp(text)
    return t if fallback is None else F.coalesce(t, fallback)


def age_phrase(moment: Column, now: Column) -> Column:
    """"3 days ago", by the largest whole unit."""
    s = F.unix_timestamp(now) - F.unix_timestamp(moment)

    def said(n: Column, unit: str) -> Column:
        return F.concat(n.cast("string"), F.when(n == 1, F.lit(f" {unit} ago")).otherwise(F.lit(f" {unit}s ago")))

    whole = lambda k: F.floor(s / k)
    return F.when(s < 60, F.lit("just now")).when(s < 3600, said(whole(60), "minute")).when(s < 86400, said(whole(3600), "hour")).otherwise(said(whole(86400), "day"))


def staleness(moment: Column, now: Column, days: int) -> Column:
    """A line that says how old the newest row is, and whether that is too old."""
    old = F.unix_timestamp(now) - F.unix_timestamp(moment) > days * 86400
    line = F.concat(F.lit("Updated "), age_phrase(moment, now))
    return F.when(moment.isNull(), F.lit("No data yet")).when(old, F.concat(line, F.lit(f", more than {days} days: stale"))).otherwise(line)


def retention_floor(today: Column, days: int) -> Column:
    return F.date_sub(today, days)


def window_start(today: Column, days: int, oldest: Column) -> Column:
    """The floor, but not before what is held."""
    return F.greatest(F.date_sub(today, days), F.coalesce(oldest, F.date_sub(today, days)))


def backfill_slice(oldest: Column, floor: Column, days: int) -> tuple[Column, Column]:
    """Next slice before what is held: [start, end)."""
    return F.greatest(F.date_sub(oldest, days), floor), oldest


def price_fetch_start(held: Column, backfill: Column, today: Column) -> Column:
    """Last session held (inclusive), or the backfill start; never after today."""
    return F.least(F.coalesce(held, backfill), today)


def news_fetch_start(held: Column, backfill: Column) -> Column:
    """The newest instant held (inclusive: its article comes again and the upsert makes that harmless), or
    the start of the backfill date."""
    return F.coalesce(held, backfill.cast("timestamp"))
