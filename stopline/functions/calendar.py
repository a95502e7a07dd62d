"""Calendar and clock columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_timestamp(text: Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text to a zone-less timestamp; NULL where the text does not fit."""
    return F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")


def parse_date(text: Column, fmt: str = "MM/dd/yyyy") -> Column:
    return F.try_to_timestamp(text, F.lit(fmt)).cast("date")


def round_hour(ts: Column) -> Column:
    """Nearest hour; minute 30 and later rounds up."""
    return F.date_trunc("hour", ts + F.expr("INTERVAL '30' MINUTE")).cast("timestamp_ntz")


def day_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def day_label(ts: Column) -> Column:
    """Short weekday name; order it by `dayofweek` (1 = Sunday)."""
    return F.date_format(ts, "EEE")


def day_of_month(ts: Column) -> Column:
    """Two digits and the letter d: 01d … 31d."""
    return F.concat(F.date_format(ts, "dd"), F.lit("d"))


def hour_text(ts: Column) -> Column:
    return F.date_format(ts, "HH")


def hour_band(hour: Column) -> Column:
    """05-10 Morning, 11-16 Midday, 17-22 Evening, 23-04 Night."""
    h = hour.cast("int")
    return (
        F.when(h.between(5, 10), "Morning")
        .when(h.between(11, 16), "Midday")
        .when(h.between(17, 22), "Evening")
        .when((h == 23) | h.between(0, 4), "Night")
    )


def weekpart(day: Column) -> Column:
    """Weekday for Monday-Thursday names, Weekend for Friday-Sunday."""
    return F.when(day.isin("Monday", "Tuesday", "Wednesday", "Thursday"), "Weekday").when(
        day.isin("Friday", "Saturday", "Sunday"), "Weekend"
    )


def decade_label(year: Column) -> Column:
    """1980s … 2000s, 2010s from 2010 on; earlier years keep their number."""
    y = year.cast("int")
    return (
        F.when(y >= 2010, "2010s")
        .when(y >= 2000, "2000s")
        .when(y >= 1990, "1990s")
        .when(y >= 1980, "1980s")
        .otherwise(y.cast("string"))
    )


def calendar_parts(df: DataFrame, ts: str) -> DataFrame:
    """Add weekday name and hour text, as `dow` and `hour`."""
    return df.withColumns({"dow": day_name(F.col(ts)), "hour": hour_text(F.col(ts))})
