"""Row selection: date predicates and the page cap."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardbook.schema import PARTITION_COLUMN

# Fixed value: days that a target date covers.
DEFAULT_OFFSET_DAYS = 1


def _date(text: str | dt.date) -> dt.date:
    if isinstance(text, dt.datetime):
        return text.date()
    return text if isinstance(text, dt.date) else dt.datetime.fromisoformat(text).date()


def _timestamp(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def target_days(target_date: str | dt.date, offset_days: int = DEFAULT_OFFSET_DAYS) -> tuple[Column, dt.date, dt.date]:
    """Whether a row is created in [target_date, target_date + offset_days); the first and last day."""
    start = _date(target_date)
    end = start + dt.timedelta(days=offset_days)
    created = F.col("created_date")
    keep = (created >= _timestamp(f"{start} 00:00:00")) & (created < _timestamp(f"{end} 00:00:00"))
    return keep, start, end - dt.timedelta(days=1)


def range_days(start_date: str | dt.date, end_date: str | dt.date) -> tuple[Column, dt.date, dt.date]:
    """Whether a row is created from start_date 00:00:00 to end_date 23:59:59; the first and last day."""
    start, end = _date(start_date), _date(end_date)
    keep = F.col("created_date").between(_timestamp(f"{start} 00:00:00"), _timestamp(f"{end} 23:59:59"))
    return keep, start, end


def on_target_date(
    rows: DataFrame, target_date: str | dt.date, offset_days: int = DEFAULT_OFFSET_DAYS
) -> DataFrame:
    """Rows created in [target_date, target_date + offset_days)."""
    return _pruned(rows, *target_days(target_date, offset_days))


def in_date_range(rows: DataFrame, start_date: str | dt.date, end_date: str | dt.date) -> DataFrame:
    """Rows created from start_date 00:00:00 to end_date 23:59:59, both included."""
    return _pruned(rows, *range_days(start_date, end_date))


def _pruned(rows: DataFrame, keep: Column, first: dt.date, last: dt.date) -> DataFrame:
    # The day column is derived from the timestamp, which Spark cannot know: name
    # the day bounds too where the table has them, so that whole days are skipped.
    kept = rows.where(keep)
    if PARTITION_COLUMN not in rows.columns:
        return kept
    return kept.where(F.col(PARTITION_COLUMN).between(F.lit(first), F.lit(last)))


def window_of(
    *,
    target_date: str | None = None,
    offset_days: int = DEFAULT_OFFSET_DAYS,
    start_date: str | None = None,
    end_date: str | None = None,
) -> tuple[Column, dt.date, dt.date] | None:
    """Whichever date filter is asked for, a target date before a range, with its first and last
    day; None without one."""
    if target_date:
        return target_days(target_date, offset_days)
    if bool(start_date) != bool(end_date):
        raise ValueError("start_date and end_date go together")
    return range_days(start_date, end_date) if start_date else None


def by_dates(rows: DataFrame, **dates) -> DataFrame:
    """Apply whichever date filter is asked for; see window_of()."""
    window = window_of(**dates)
    return _pruned(rows, *window) if window else rows


def first_pages(rows: DataFrame, max_pages: int | None) -> DataFrame:
    """Rows of the first max_pages pages (page_no counts from 0); None keeps all."""
    return rows if max_pages is None else rows.where(F.col("page_no") < max_pages)
