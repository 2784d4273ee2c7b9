"""Cleaned requests, one row per raw row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardbook.functions.dates import day
from wardbook.functions.keys import surrogate_keys
from wardbook.functions.numbers import safe_decimal
from wardbook.functions.text import clean_text, clean_upper, clean_with_default
from wardbook.schema import (
    CASE_KEPT_COLUMNS,
    COORDINATE_COLUMNS,
    RAW_COLUMNS,
    UNSPECIFIED,
    UPPER_COLUMNS,
)


def cleaned(column: str) -> Column:
    """A raw column under its cleaning rule; dates, the key and JSON pass through."""
    raw = F.col(column)
    if column == "borough":
        return clean_with_default(F.upper(raw), UNSPECIFIED)
    if column in UPPER_COLUMNS:
        return clean_upper(raw)
    if column in CASE_KEPT_COLUMNS:
        return clean_text(raw)
    if column in COORDINATE_COLUMNS:
        return safe_decimal(raw)
    return raw


def validity() -> dict[str, Column]:
    """Whether a request was closed before it was created, and has usable coordinates."""
    reversed_times = F.col("closed_date") < F.col("created_date")
    in_range = F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180)
    return {
        "invalid_close_before_create": F.coalesce(reversed_times, F.lit(False)),
        "valid_lat_long": F.coalesce(in_range, F.lit(False)),
    }


def stage_requests(raw: DataFrame) -> DataFrame:
    """stg_311_requests: a narrow projection, no shuffle.

    Raw columns the caller has dropped (the JSON payload, say) are left out.
    """
    present = [c for c in RAW_COLUMNS if c in raw.columns]
    clean = raw.select(*[cleaned(c).alias(c) for c in present])
    return clean.withColumns(
        {
            **surrogate_keys(),
            "created_day": day(F.col("created_date")),
            "closed_day": day(F.col("closed_date")),
            **validity(),
        }
    )
