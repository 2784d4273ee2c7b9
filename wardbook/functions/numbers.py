"""Exact decimals and shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC = "decimal(38,9)"


def safe_decimal(text: Column) -> Column:
    """Text to a 9-place decimal; text that is no number becomes NULL."""
    return text.try_cast(NUMERIC)


def decimal_text(value: Column) -> Column:
    """Shortest plain text of a 9-place decimal: 40.7128, 100, 0.

    Casting prints values under 1e-6 in scientific form when ANSI mode is off, so
    those few are written from their count of billionths.
    """
    plain = F.regexp_replace(value.cast("string"), "[.]?0+$", "")
    billionths = (F.abs(value) * F.lit(1_000_000_000)).cast("bigint").cast("string")
    tiny = F.concat(
        F.when(value < 0, "-").otherwise(""),
        F.lit("0."),
        F.regexp_replace(F.lpad(billionths, 9, "0"), "0+$", ""),
    )
    return (
        F.when(value == 0, "0")
        .when(F.abs(value) < F.lit(0.000001).cast(NUMERIC), tiny)
        .otherwise(plain)
    )


def share_percent(part: Column, whole: Column) -> Column:
    """part / whole in percent with two decimals; NULL when whole is zero.

    The quotient keeps 9 places, which leaves the product with 100 exact.
    """
    quotient = F.try_divide(part.cast("decimal(19,0)"), whole.cast("decimal(19,0)"))
    return F.round(quotient.cast("decimal(20,9)") * F.lit(100), 2)
