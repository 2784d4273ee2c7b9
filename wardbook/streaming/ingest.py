"""Pages landed as they arrive, and windows of days taken from what has landed.

A feed has one position for all windows: each page is read once, parsed and upserted into
a landing table beside the feed's progress, which holds the latest version of every key on
any page so far. A run then takes its days from the landing table. What a narrow run leaves
out is there for a wider one, and neither reads an old page again.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wardbook.operators.selection import DEFAULT_OFFSET_DAYS, by_dates, window_of
from wardbook.sources.folders import names, put_text, remove, text_of
from wardbook.sources.pages import normalized, page_files, page_lines, page_rows
from wardbook.sources.raw_table import NULL_PARTITION, PRODUCTION_TABLE, raw_table_path, read_days, upsert
from wardbook.sources.versions import current


def stream_pages(
    spark: SparkSession,
    pages_folder: str,
    root: str,
    progress_folder: str,
    *,
    target_table: str = PRODUCTION_TABLE,
    pages_per_batch: int = 1000,
    many_pages_a_file: bool = False,
    target_date: str | None = None,
    offset_days: int = DEFAULT_OFFSET_DAYS,
    start_date: str | None = None,
    end_date: str | None = None,
    run_no: int | None = None,
) -> StreamingQuery:
    """Land the pages not seen before, then upsert the rows of the dates asked for, or all.

    Returns the query that landed the pages, when all is done. progress_folder remembers
    the pages, holds the landing table, and knows which version of each of its days every
    target has taken: a run reads those of its days that changed since. pages_per_batch
    counts files.

    Dates select among current rows, the latest of each key on all pages seen. A row that a
    target took and that has left the dates since stays there until a run that covers it.

    The keyed upsert takes late and replayed pages as they are, so no watermark or
    state is kept. Micro-batches may come in any page order: rows carry their page.
    Page numbers are compared within a run, so a feed that is resumed should keep its
    run_no; the default is the time of the start.
    """
    path = raw_table_path(root, target_table)
    run = time.time_ns() // 1000 if run_no is None else run_no
    dates = {"target_date": target_date, "offset_days": offset_days, "start_date": start_date, "end_date": end_date}
    window_of(**dates)  # bad dates fail before the start
    progress = progress_folder.rstrip("/")

    def land(pages: DataFrame, _batch: int) -> None:
        upsert(pages.sparkSession, _landing(progress), normalized(page_rows(pages)), run)

    source = spark.readStream.option("maxFilesPerTrigger", pages_per_batch).option("recursiveFileLookup", True)
    if many_pages_a_file:
        pages = page_lines(source.text(pages_folder))
    else:
        pages = page_files(source.text(pages_folder, wholetext=True))
    query = (
        pages.writeStream.foreachBatch(land)
        .option("checkpointLocation", f"{progress}/pages")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    _take(spark, progress, path, dates)
    return query


def _landing(progress: str) -> str:
    return f"{progress}/landed"


def _take(spark: SparkSession, progress: str, path: str, dates: dict) -> None:
    """Upsert the landed rows of these dates into a target, from the days that have changed."""
    landed = current(spark, _landing(progress)) or {}
    taken = _Taken(spark, progress, path)
    before = taken.days()
    window = window_of(**dates)
    inside = _within(window)
    changed = {d for d in landed if inside(d) and before.get(d) != landed[d]}
    if not changed:
        return
    rows = by_dates(read_days(spark, _landing(progress), changed), **dates)
    upsert(spark, path, rows.selectExpr("*", "0L AS pos"), None)
    # A range ends with a whole second, so a part of its last day may be left out.
    partly = {str(window[2])} if window and not dates["target_date"] else set()
    taken.put(before | {d: landed[d] for d in changed - partly})


def _within(window: tuple | None) -> Callable[[str], bool]:
    """Whether a day, named as in the manifest, is one of the window's."""
    if window is None:
        return lambda _: True
    _, first, last = window
    return lambda name: name != NULL_PARTITION and str(first) <= name <= str(last)


class _Taken:
    """Which version of each landed day a target has taken: a small file, renamed into place."""

    def __init__(self, spark: SparkSession, progress: str, path: str):
        self.spark = spark
        # In the target's folder, by feed: what drops the target drops this with it.
        self.folder = f"{path}/_taken/{hashlib.sha256(progress.encode()).hexdigest()[:16]}"

    def days(self) -> dict[str, str]:
        found = self._names()
        return json.loads(text_of(self.spark, f"{self.folder}/{found[-1]}")) if found else {}

    def put(self, days: dict[str, str]) -> None:
        found = self._names()
        number = int(found[-1].split(".")[0]) + 1 if found else 0
        put_text(self.spark, f"{self.folder}/{number:012d}.json", json.dumps(days))
        for old in found:
            remove(self.spark, f"{self.folder}/{old}")

    def _names(self) -> list[str]:
        return [n for n in names(self.spark, self.folder) if n.endswith(".json")]
