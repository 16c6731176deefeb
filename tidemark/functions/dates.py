"""Calendar functions of the posting engine. The local calendar is that of Nairobi, UTC+3."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "Africa/Nairobi"


def local_date(ts: Column) -> Column:
    """Local calendar day of an instant."""
    return F.to_date(F.from_utc_timestamp(ts, ZONE))


def local_noon(day: Column) -> Column:
    """The instant of noon of a local day."""
    return F.to_utc_timestamp(day.cast("timestamp") + F.expr("INTERVAL 12 HOURS"), ZONE)


def date_key(day: Column) -> Column:
    """yyyymmdd of a day from 2000 to 2040, -1 for other days and null."""
    inside = day.between(F.lit("2000-01-01").cast("date"), F.lit("2040-12-31").cast("date"))
    return F.when(inside, F.date_format(day, "yyyyMMdd").cast("int")).otherwise(F.lit(-1))


def week_start(day: Column) -> Column:
    """Monday of the day's week."""
    return F.date_trunc("week", day).cast("date")


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def parts(day: Column) -> dict[str, Column]:
    return {
        "cal_year": F.year(day),
        "cal_quarter": F.quarter(day),
        "cal_month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "iso_week": F.weekofyear(day),
        "day_of_month": F.dayofmonth(day),
        "iso_dow": F.weekday(day) + 1,
        "day_name": F.date_format(day, "EEEE"),
        "is_weekend": F.weekday(day) >= 5,
    }
