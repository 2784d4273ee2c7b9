"""Report queries over the raw table and the marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.functions.dates import day
from wardbook.schema import PARTITION_COLUMN


def rows_per_day(raw: DataFrame, start_date: str, end_date: str) -> DataFrame:
    """(day, row_count) of raw rows created from start_date to end_date, in order."""
    created = (
        F.col(PARTITION_COLUMN) if PARTITION_COLUMN in raw.columns else day(F.col("created_date"))
    )
    first, last = (dt.date.fromisoformat(d) for d in (start_date, end_date))
    return (
        raw.where(created.between(F.lit(first), F.lit(last)))
        .groupBy(created.alias("day"))
        .agg(F.count("*").alias("row_count"))
        .orderBy("day")
    )


def created_vs_closed(daily: DataFrame) -> DataFrame:
    """Daily series of created and closed requests."""
    return daily.select("metric_date", "created_count", "closed_count")


def top_complaint_types(mix: DataFrame, limit: int = 10) -> DataFrame:
    """The complaint types with most requests; equal counts in name order."""
    return (
        mix.groupBy("complaint_type")
        .agg(F.sum("total_requests").alias("total_requests"))
        .orderBy(F.desc("total_requests"), "complaint_type")
        .limit(limit)
    )
