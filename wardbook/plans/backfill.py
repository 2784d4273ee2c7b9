"""Ingest, and the backfill run from pages to tested marts."""

from __future__ import annotations

import logging
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardbook.operators.selection import DEFAULT_OFFSET_DAYS, first_pages, window_of
from wardbook.plans.model_tests import offending, report
from wardbook.plans.warehouse import Warehouse
from wardbook.sources.folders import written
from wardbook.sources.pages import normalized, page_rows, read_page_lines, read_pages
from wardbook.sources.raw_table import (
    PROBE_TABLE,
    PRODUCTION_TABLE,
    check_raw,
    raw_table_path,
    read_raw,
    reset_probe,
    upsert,
)


log = logging.getLogger(__name__)


class FailedTests(RuntimeError):
    """Some model tests found offending rows."""


def ingest(
    spark: SparkSession,
    pages_folder: str,
    root: str,
    *,
    target_table: str = PRODUCTION_TABLE,
    target_date: str | None = None,
    offset_days: int = DEFAULT_OFFSET_DAYS,
    start_date: str | None = None,
    end_date: str | None = None,
    max_pages: int | None = None,
    many_pages_a_file: bool = False,
    run_no: int | None = None,
) -> int:
    """Upsert a folder of pages into a raw table, all pages in one batch.

    All pages are read unless ``max_pages`` is given, which keeps the pages numbered
    below it, logs how many were left out, and applies only without a date filter. Dates
    select among current rows: of a key on several pages, the last one decides.
    ``run_no`` orders runs; the default is the time the run starts.
    """
    path = raw_table_path(root, target_table)
    pages = (read_page_lines if many_pages_a_file else read_pages)(spark, pages_folder)
    dates = {
        "target_date": target_date,
        "offset_days": offset_days,
        "start_date": start_date,
        "end_date": end_date,
    }
    if max_pages is not None and not (target_date or start_date or end_date):
        left_out = pages.where(F.col("page_no") >= max_pages).count()
        if left_out:
            log.warning("%d pages from number %d on are left out", left_out, max_pages)
        pages = first_pages(pages, max_pages)
    window = window_of(**dates)
    rows = normalized(page_rows(pages))
    run = time.time_ns() // 1000 if run_no is None else run_no
    return upsert(spark, path, rows, run, window[0] if window else None)


def build_and_test(raw: DataFrame, root: str) -> tuple[Warehouse, DataFrame]:
    """Build all model tables under root and write the test report beside them; publish nothing."""
    warehouse = Warehouse(root, raw)
    return warehouse, written(report(warehouse.build_all()), warehouse.path("test_report"))


def backfill(
    spark: SparkSession,
    pages_folder: str,
    root: str,
    *,
    start_date: str,
    end_date: str,
    test: bool = False,
    reset: bool = False,
    many_pages_a_file: bool = False,
    run_no: int | None = None,
) -> DataFrame:
    """Reset the probe table if asked, ingest, check the raw table, build, test, publish.

    Each step must succeed before the next starts. Returns the test report, or fails
    with FailedTests, which names the written report, and leaves the published tables
    as they are. What failed, by test, is then in the folder test_failures beside the report.
    """
    if not (start_date and end_date):
        raise ValueError("A backfill needs both start_date and end_date.")
    table = PROBE_TABLE if test else PRODUCTION_TABLE
    reset_probe(spark, root, test=test, reset=reset)
    ingest(
        spark,
        pages_folder,
        root,
        target_table=table,
        start_date=start_date,
        end_date=end_date,
        many_pages_a_file=many_pages_a_file,
        run_no=run_no,
    )
    path = raw_table_path(root, table)
    check_raw(spark, path)
    warehouse, results = build_and_test(read_raw(spark, path), root)
    failed = results.where(~F.col("passed")).count()
    if failed:
        written(offending(warehouse.build_all()), warehouse.path("test_failures"))
        raise FailedTests(f"{failed} model tests failed, see {warehouse.path('test_report')}")
    warehouse.publish()
    return results
