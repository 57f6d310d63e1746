"""Time columns: parsing (F6), UTC labelling (F7), truncation (F10) and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexwatch.functions.numbers import to_number
from hexwatch.settings import COMPACT_DATE, HALF_DAY_FORMAT, MONTH_FIRST, NAMED_MONTH, NAMED_MONTH_FORMATS, YEAR_FIRST


def parse_date(c: Column, formats: list[str] | None = None) -> Column:
    """Date text to TIMESTAMP_NTZ; a text with a zone offset is converted to UTC.

    `2014-01-31`, `2014/1/31` and `1/31/2014`, each with an optional 24-hour time, are brought into ISO order and cast:
    no formatter runs and nothing is thrown for a text that does not fit; `20140131` is cut up likewise. Only 12-hour
    times, month names (`31-Jan-2014`, `January 31, 2014`), and whatever extra `formats` are given, go through a formatter.
    """
    text = F.btrim(c)
    iso = (
        F.when((text.substr(2, 1) == "/") | (text.substr(3, 1) == "/"), F.regexp_replace(text, MONTH_FIRST, "$3-$1-$2"))
        .when(text.substr(5, 1) == "/", F.translate(text, "/", "-"))
        .when(text.rlike(COMPACT_DATE), F.concat_ws("-", text.substr(1, 4), text.substr(5, 2), text.substr(7, 2)))
        .otherwise(text)
    )
    half_day = F.upper(F.right(text, F.lit(1))) == "M"
    tries = [
        F.when(half_day, F.try_to_timestamp(text, F.lit(HALF_DAY_FORMAT)))
        .when(iso.rlike(YEAR_FIRST), iso.try_cast("timestamp"))
    ]
    named = text.rlike(NAMED_MONTH)
    tries += [F.when(named, F.try_to_timestamp(F.initcap(text) if "," in f else text, F.lit(f))) for f in NAMED_MONTH_FORMATS]
    tries += [F.try_to_timestamp(text, F.lit(f)) for f in formats or []]
    return F.coalesce(*tries).cast("timestamp_ntz")


def clip_hour(c: Column) -> Column:
    """Hour text to 0..23; what is not a number counts as 0."""
    hour = F.coalesce(to_number(c), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(23.0), hour)).cast("int")


def parse_occurred_at(date: Column, hour: Column | None = None, formats: list[str] | None = None) -> Column:
    """the hour is added to the date, so a time part in the date stays."""
    day = parse_date(date, formats)
    return day if hour is None else F.timestamp_add("HOUR", clip_hour(hour), day)


def to_utc(c: Column, source_tz: str | None = None) -> Column:
    """label a wall-clock time as UTC without shifting it, or shift it out of `source_tz` when one is given.

    Works under a UTC session time zone, which `hexwatch.session.require_utc` checks.
    """
    instant = c.cast("timestamp")
    return F.to_utc_timestamp(instant, source_tz) if source_tz else instant


def hour_start(c: Column) -> Column:
    return F.date_trunc("hour", c)


def day_start(c: Column) -> Column:
    return F.date_trunc("day", c)


def hour_number(c: Column) -> Column:
    """Hours since the epoch as BIGINT: range frames order by it."""
    return F.floor(F.unix_seconds(c.cast("timestamp")) / F.lit(3600)).cast("bigint")


def hour_of_day(c: Column) -> Column:
    return F.hour(c)


def day_of_week(c: Column) -> Column:
    """Monday = 0."""
    return F.weekday(c)


def is_weekend(c: Column) -> Column:
    return F.weekday(c) >= 5


def is_night(c: Column, start: int = 22, end: int = 6) -> Column:
    """F14, our choice of hours: from `start` up to but not including `end`."""
    return (F.hour(c) >= start) | (F.hour(c) < end)


def month(c: Column) -> Column:
    return F.month(c)


def season(c: Column) -> Column:
    """F17, our choice of boundaries: Mar-May = 1, Jun-Aug = 2, Sep-Nov = 3, Dec-Feb = 4."""
    return F.when(F.month(c) < 3, 4).otherwise(F.floor(F.month(c) / F.lit(3)).cast("int"))


#: A calendar has one row per day: up to so many days (over 270 years) are broadcast.
MAX_BROADCAST_DAYS = 100_000


def with_holiday_flag(df: DataFrame, holidays: DataFrame | None, ts: str = "time_window") -> DataFrame:
    """true when the day is in `holidays(holiday_date)`. The calendar's size is checked, then it is broadcast."""
    if holidays is None:
        return df.withColumn("is_holiday", F.lit(False))
    days = holidays.select(F.col("holiday_date").cast("date").alias("_holiday")).where("_holiday is not null").distinct()
    if days.limit(MAX_BROADCAST_DAYS + 1).count() <= MAX_BROADCAST_DAYS:
        days = F.broadcast(days)
    joined = df.join(days, F.to_date(F.col(ts)) == F.col("_holiday"), "left")
    return joined.withColumn("is_holiday", F.col("_holiday").isNotNull()).drop("_holiday")
