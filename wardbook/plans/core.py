"""Dimensions and facts."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.functions.dates import calendar_columns, date_id, day
from wardbook.functions.keys import (
    AGENCY_KEY,
    CHANNEL_KEY,
    COMPLAINT_TYPE_KEY,
    LOCATION_KEY,
    STATUS_KEY,
)
from wardbook.schema import TIMESTAMP_COLUMNS

def dim_date(stg: DataFrame) -> DataFrame:
    """Every calendar date a request was created, closed or updated on; one scan."""
    dates = stg.select(F.explode(F.array(*[day(F.col(c)) for c in TIMESTAMP_COLUMNS])).alias("d"))
    distinct = dates.where(F.col("d").isNotNull()).distinct()
    return distinct.select(*[e.alias(name) for name, e in calendar_columns(F.col("d")).items()])


def dim_location(stg: DataFrame) -> DataFrame:
    """Distinct locations. The key is carried once through the shuffle."""
    distinct = (
        stg.where(F.col("location_key").isNotNull())
        .select("location_key", *LOCATION_KEY)
        .distinct()
    )
    return distinct.select(F.col("location_key").alias("location_id"), *distinct.columns)


def _attribute_dimension(stg: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """Distinct combinations of the columns behind a key, if any of them is known."""
    any_known = reduce(or_, [F.col(c).isNotNull() for c in columns])
    key = F.col(f"{name}_key").alias(f"{name}_id")
    return stg.where(any_known).select(key, *columns).distinct()


def dim_agency(stg: DataFrame) -> DataFrame:
    return _attribute_dimension(stg, "agency", AGENCY_KEY)


def dim_complaint_type(stg: DataFrame) -> DataFrame:
    return _attribute_dimension(stg, "complaint_type", COMPLAINT_TYPE_KEY)


def dim_status(stg: DataFrame) -> DataFrame:
    return _attribute_dimension(stg, "status", STATUS_KEY)


def dim_channel(stg: DataFrame) -> DataFrame:
    return _attribute_dimension(stg, "channel", CHANNEL_KEY)


def fct_complaint(stg: DataFrame) -> DataFrame:
    """One row per request: times, date ids and foreign keys."""
    key = F.col("unique_key")
    return stg.where(key.isNotNull()).select(
        key.alias("complaint_key"),
        key,
        F.col("created_date").alias("created_at"),
        F.col("closed_date").alias("closed_at"),
        F.col("resolution_action_updated_date").alias("resolution_action_updated_at"),
        date_id(day(F.col("created_date"))).alias("created_date_id"),
        date_id(day(F.col("closed_date"))).alias("closed_date_id"),
        date_id(day(F.col("resolution_action_updated_date"))).alias("resolution_action_date_id"),
        F.col("location_key").alias("location_id"),
        F.col("agency_key").alias("agency_id"),
        F.col("complaint_type_key").alias("complaint_type_id"),
        F.col("status_key").alias("status_id"),
        F.col("channel_key").alias("channel_id"),
        "police_precinct",
    )


def fct_complaint_text(stg: DataFrame) -> DataFrame:
    """The long text of each request, apart from the facts that are scanned often."""
    return stg.where(F.col("unique_key").isNotNull()).select("unique_key", "resolution_description")
