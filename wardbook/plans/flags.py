"""Request facts with validity, completeness and consistency flags."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardbook.functions.dates import day, elapsed_seconds, month_start
from wardbook.operators.measures import SECONDS_PER_HOUR

CRITICAL_IDS = ["location_id", "complaint_type_id", "agency_id", "status_id"]
CLOSED = "CLOSED"


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def complaints_flagged(fct: DataFrame, dim_status: DataFrame) -> DataFrame:
    """int_complaints_flagged.

    The status lookup is left to Spark: the written dimension's file size decides
    between a broadcast and a sort-merge join, whose hot status values adaptive
    execution splits.
    """
    created, closed = F.col("created_at"), F.col("closed_at")
    both_known = closed.isNotNull() & created.isNotNull()
    missing = {c: F.col(c).isNull() for c in CRITICAL_IDS}

    return fct.join(dim_status, "status_id", "left").select(
        "complaint_key",
        "unique_key",
        "created_at",
        "closed_at",
        day(created).alias("metric_date"),
        month_start(created).alias("metric_month"),
        "location_id",
        "complaint_type_id",
        "agency_id",
        "status_id",
        (elapsed_seconds(created, closed) / F.lit(SECONDS_PER_HOUR)).alias("resolution_hours"),
        _flag(both_known & (closed < created)).alias("is_invalid_time_order"),
        *[_flag(is_null).alias(f"is_missing_{c}") for c, is_null in missing.items()],
        _flag(reduce(or_, missing.values())).alias("is_missing_critical_fields"),
        # An unknown status leaves the comparison NULL and the flag 0.
        _flag(both_known & (closed >= created) & (F.col("status") != CLOSED)).alias(
            "is_closed_at_status_mismatch"
        ),
    )
