"""Aggregate measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The published quantiles.
QUANTILES = {"median": 0.5, "p90": 0.9, "p95": 0.95}
# Rank error of the sketch is 1/accuracy of the group size.
QUANTILE_ACCURACY = 10_000
SECONDS_PER_HOUR = 3600.0


def quantiles(value: Column) -> Column:
    """All published quantiles of a group from one mergeable sketch; each is a data value."""
    return F.percentile_approx(value, list(QUANTILES.values()), QUANTILE_ACCURACY)


def quantile_columns(sketch: Column, suffix: str) -> dict[str, Column]:
    return {f"{name}_{suffix}": sketch.getItem(i) for i, name in enumerate(QUANTILES)}


def mean_hours(seconds: Column) -> Column:
    """Mean of whole seconds, in hours.

    Summing exact integers makes the mean independent of the order rows arrive in;
    the decimal keeps the sum of very many rows from overflowing.
    """
    total = F.sum(seconds.cast("decimal(20,0)")).cast("double")
    return F.try_divide(total, F.count(seconds)) / F.lit(SECONDS_PER_HOUR)
