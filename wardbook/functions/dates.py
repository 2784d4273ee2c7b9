"""Date and time expressions on TIMESTAMP_NTZ.

None of them looks at the session time zone. In particular ``timestampdiff`` and
``date_trunc`` are avoided: both go through the session zone for NTZ input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_timestamp(text: Column) -> Column:
    """ISO text to a UTC wall-clock timestamp; text that is no time fails the job.

    Text without a zone is taken as UTC.
    """
    zoned = F.substring(text, 12, 40).rlike("[A-Z+-]")
    # unix_micros counts from the epoch in UTC whatever the session zone is.
    micros = F.unix_micros(text.try_cast("timestamp")).cast("decimal(20,0)")
    seconds = (micros / F.lit(1_000_000)).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    in_utc = epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    parsed = F.when(zoned, in_utc).otherwise(text.try_cast("timestamp_ntz"))
    no_time = F.raise_error(F.concat(F.lit("No timestamp: "), text)).cast("timestamp_ntz")
    return F.coalesce(parsed, F.when(text.isNotNull(), no_time))


def day(ts: Column) -> Column:
    return ts.cast("date")


def month_start(ts: Column) -> Column:
    return F.trunc(day(ts), "month")


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds from start to end, truncated toward zero; negative if end is earlier."""
    return (end - start).cast("interval second").cast("bigint")


def date_id(date: Column) -> Column:
    """yyyymmdd as a number, without going through text."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.day(date)).cast("bigint")


def iso_weekday(date: Column) -> Column:
    """Monday 1 to Sunday 7."""
    return (F.weekday(date) + 1).cast("bigint")


def calendar_columns(date: Column) -> dict[str, Column]:
    """The attributes of a calendar date, in column order."""
    return {
        "date_id": date_id(date),
        "full_date": date,
        "day_of_month": F.day(date).cast("bigint"),
        "month": F.month(date).cast("bigint"),
        "month_name": F.date_format(date, "MMMM"),
        "quarter": F.quarter(date).cast("bigint"),
        "year": F.year(date).cast("bigint"),
        "day_of_week": iso_weekday(date),
        "day_name": F.date_format(date, "EEEE"),
        "is_weekend": iso_weekday(date).isin(6, 7),
    }
