"""Data checks. Each returns the offending rows; a check passes when there are none."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: how far the shares may be from 100 in total.
SHARE_TOLERANCE = Decimal("1.00")


def counted(rows: DataFrame, tests: dict[str, Column], name: str = "test") -> DataFrame:
    """(test, failures): the rows that meet each condition, in one pass over them."""
    counts = rows.agg(*[F.count_if(c).alias(f"c{i}") for i, c in enumerate(tests.values())])
    entries = [F.struct(F.lit(t).alias(name), F.col(f"c{i}").alias("failures")) for i, t in enumerate(tests)]
    return counts.select(F.inline(F.array(*entries)))


def null_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, failures) for every column, in one pass over the rows."""
    return counted(rows, {c: F.col(c).isNull() for c in columns}, "column_name")


def duplicates(rows: DataFrame, column: str) -> DataFrame:
    """(unique_field, n_records) of non-NULL values that occur more than once."""
    return (
        rows.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count("*").alias("n_records"))
        .where("n_records > 1")
    )


def composite_duplicates(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(columns, row_count) of column combinations that occur more than once.

    NULLs count as equal, unlike in duplicates().
    """
    return rows.groupBy(*columns).agg(F.count("*").alias("row_count")).where("row_count > 1")


def unaccepted_values(rows: DataFrame, column: str, accepted: list[str]) -> DataFrame:
    """(value_field, n_records) of values outside the accepted list; NULL is accepted."""
    return (
        rows.groupBy(F.col(column).alias("value_field"))
        .agg(F.count("*").alias("n_records"))
        .where(~F.col("value_field").isin(accepted))
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """(from_field, row_count): child values without a parent and the rows they stand on.

    The child is reduced to its distinct values first, so a value carried by a third
    of all rows reaches the join as one row.
    """
    references = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("from_field"))
        .agg(F.count("*").alias("row_count"))
    )
    parents = parent.select(F.col(field).alias("from_field"))
    return references.join(parents, "from_field", "left_anti")


def shares_off_total(mix: DataFrame, tolerance: Decimal = SHARE_TOLERANCE) -> DataFrame:
    """(pct_sum) if the shares of all requests miss 100 by more than the tolerance."""
    total = mix.agg(F.sum("pct_of_all_requests").alias("pct_sum"))
    return total.where(F.abs(F.col("pct_sum") - 100) > F.lit(tolerance))


def wrong_time_order_flag() -> Column:
    """Whether the stored time-order flag differs from the one the row's times give."""
    invalid = (
        F.col("closed_at").isNotNull()
        & F.col("created_at").isNotNull()
        & (F.col("closed_at") < F.col("created_at"))
    )
    return F.col("is_invalid_time_order") != F.when(invalid, 1).otherwise(0)


def wrong_time_order_flags(flagged: DataFrame) -> DataFrame:
    """Rows whose stored time-order flag differs from the one their times give."""
    return flagged.where(wrong_time_order_flag()).select(
        "unique_key", "created_at", "closed_at", "is_invalid_time_order"
    )
