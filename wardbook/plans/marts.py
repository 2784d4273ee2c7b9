"""Published metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardbook.functions.dates import day, elapsed_seconds
from wardbook.functions.numbers import share_percent
from wardbook.functions.text import clean_with_default
from wardbook.operators.measures import QUANTILES, mean_hours, quantile_columns, quantiles
from wardbook.schema import UNSPECIFIED

# Hours of the day, both ends included.
DAY_PARTS = {
    "morning": (6, 11),
    "afternoon": (12, 17),
    "evening": (18, 23),
    "overnight": (0, 5),
}
# The flags whose counts are published, in column order.
FLAGS = [
    "invalid_time_order",
    "missing_critical_fields",
    "missing_location_id",
    "missing_complaint_type_id",
    "missing_agency_id",
    "missing_status_id",
    "closed_at_status_mismatch",
]


def validly_closed() -> Column:
    return (
        F.col("closed_at").isNotNull()
        & F.col("created_at").isNotNull()
        & (F.col("is_invalid_time_order") == 0)
    )


def created_by_day(flagged: DataFrame) -> DataFrame:
    """Requests, day parts and flags per created day."""
    hour = F.hour("created_at")
    return (
        flagged.where(F.col("created_at").isNotNull())
        .groupBy(day(F.col("created_at")).alias("metric_date"))
        .agg(
            F.count("*").alias("created_count"),
            *[
                F.count_if(hour.between(*hours)).alias(f"created_{part}_count")
                for part, hours in DAY_PARTS.items()
            ],
            *[F.count_if(F.col(f"is_{flag}") == 1).alias(f"{flag}_count") for flag in FLAGS],
        )
    )


def resolution_by(flagged: DataFrame, key: Column) -> DataFrame:
    """Closed count, mean and quantiles of resolution hours of validly closed requests."""
    seconds = elapsed_seconds(F.col("created_at"), F.col("closed_at"))
    grouped = (
        flagged.where(validly_closed())
        .groupBy(key)
        .agg(
            F.count("*").alias("closed_count"),
            mean_hours(seconds).alias("avg_resolution_hours"),
            quantiles(F.col("resolution_hours")).alias("_quantiles"),
        )
    )
    return grouped.withColumns(quantile_columns(F.col("_quantiles"), "resolution_hours")).drop(
        "_quantiles"
    )


def daily_metrics(flagged: DataFrame) -> DataFrame:
    """fct_daily_metrics: created-day counts beside the closures of the same day.

    A day with closures but no creations has no row.
    """
    created = created_by_day(flagged)
    closed = resolution_by(flagged, day(F.col("closed_at")).alias("metric_date"))
    return daily_of(created, closed)


def daily_of(created: DataFrame, closed: DataFrame) -> DataFrame:
    """fct_daily_metrics of created-day counts and closing-day measures."""
    closed_count = F.coalesce("closed_count", F.lit(0)).cast("bigint")
    return created.join(closed, "metric_date", "left").select(
        "metric_date",
        "created_count",
        closed_count.alias("closed_count"),
        (F.col("created_count") - closed_count).alias("daily_net_case_flow"),
        "avg_resolution_hours",
        *[f"{name}_resolution_hours" for name in QUANTILES],
        *[f"created_{part}_count" for part in DAY_PARTS],
        *[f"{flag}_count" for flag in FLAGS],
    )


def monthly_metrics(flagged: DataFrame) -> DataFrame:
    """fct_monthly_metrics: everything by created month, in one grouping."""
    closed = validly_closed()
    seconds = F.when(closed, elapsed_seconds(F.col("created_at"), F.col("closed_at")))
    hours = F.when(closed, F.col("resolution_hours"))
    grouped = (
        flagged.where(F.col("metric_month").isNotNull())
        .groupBy(F.col("metric_month").alias("month_start"))
        .agg(
            F.count("*").alias("created_count"),
            F.count_if(closed).alias("closed_count"),
            mean_hours(seconds).alias("avg_resolution_hours"),
            quantiles(hours).alias("_quantiles"),
            *[F.sum(f"is_{flag}").alias(f"{flag}_count") for flag in FLAGS],
        )
    )
    return monthly_of(grouped.withColumns(quantile_columns(F.col("_quantiles"), "resolution_hours")))


def monthly_of(grouped: DataFrame) -> DataFrame:
    """fct_monthly_metrics of counts and unrounded measures by month."""
    return grouped.select(
        "month_start",
        "created_count",
        "closed_count",
        (F.col("created_count") - F.col("closed_count")).alias("net_case_flow"),
        F.round("avg_resolution_hours", 2).alias("avg_resolution_hours"),
        *[F.round(f"{name}_resolution_hours", 2).alias(f"{name}_resolution_hours") for name in QUANTILES],
        *[f"{flag}_count" for flag in FLAGS],
    ).orderBy("month_start")


def borough_mix(flagged: DataFrame, dim_location: DataFrame, dim_type: DataFrame) -> DataFrame:
    """fct_borough_complaint_mix: requests and shares by borough and complaint type.

    Requests are counted per (location, type) before any lookup. The location
    dimension can be as large as the facts, and this way a location with a third of
    all requests meets it as one row per complaint type.
    """
    counted = (
        flagged.where(F.col("created_at").isNotNull())
        .groupBy("location_id", "complaint_type_id")
        .agg(
            F.count("*").alias("n"),
            F.min("created_at").alias("first_at"),
            F.max("created_at").alias("last_at"),
        )
    )
    named = (
        counted.join(
            dim_type.select("complaint_type_id", "complaint_type"), "complaint_type_id", "left"
        )
        .join(dim_location.select("location_id", "borough"), "location_id", "left")
        .select(
            clean_with_default(F.col("borough"), UNSPECIFIED).alias("borough"),
            F.coalesce("complaint_type", F.lit(UNSPECIFIED)).alias("complaint_type"),
            "n",
            "first_at",
            "last_at",
        )
    )
    groups = named.groupBy("borough", "complaint_type").agg(
        day(F.min("first_at")).alias("min_created_date"),
        day(F.max("last_at")).alias("max_created_date"),
        F.sum("n").alias("total_requests"),
    )
    return mix_of(groups)


def mix_of(groups: DataFrame) -> DataFrame:
    """fct_borough_complaint_mix of the counts and days of its groups."""
    total = F.col("total_requests")
    in_borough = F.sum("total_requests").over(Window.partitionBy("borough"))
    # A scalar subquery over the same groups, so that no window pulls every group into
    # one task. It takes all their columns: pruned to the count it would be another
    # plan, and Spark could not reuse the groups it has already shuffled.
    in_all = groups.agg(
        F.struct(
            F.sum("total_requests").alias("total"),
            F.min("min_created_date"),
            F.max("max_created_date"),
        )
    ).scalar()
    return groups.select(
        "min_created_date",
        "max_created_date",
        "borough",
        "complaint_type",
        "total_requests",
        share_percent(total, in_borough).alias("pct_of_borough_requests"),
        share_percent(total, in_all.getField("total")).alias("pct_of_all_requests"),
    )
