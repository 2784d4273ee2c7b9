"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardbook.functions.dates import calendar_columns, day
from wardbook.functions.keys import surrogate_keys
from wardbook.functions.numbers import decimal_text
from wardbook.operators import quality
from wardbook.operators.latest import latest_per_key, merged
from wardbook.operators.selection import first_pages, in_date_range, on_target_date
from wardbook.plans import day_states, model_tests
from wardbook.plans.backfill import backfill, ingest
from wardbook.plans.marts import resolution_by
from wardbook.plans.reports import created_vs_closed, rows_per_day, top_complaint_types
from wardbook.plans.staging import stage_requests
from wardbook.plans.warehouse import MODELS, Warehouse
from wardbook.schema import CASE_KEPT_COLUMNS, RAW_COLUMNS, RAW_SCHEMA, UPPER_COLUMNS
from wardbook.sources import fixture
from wardbook.sources.folders import scratch_folder, state
from wardbook.sources.pages import (
    PAGE_SIZE,
    normalized,
    page_rows,
    write_page_lines,
    write_pages,
)
from wardbook.sources.raw_table import (
    PROBE_TABLE,
    PRODUCTION_TABLE,
    RAW_TABLES,
    raw_gate,
    raw_table_path,
    read_raw,
    reset_probe,
    upsert,
)
from wardbook.streaming.ingest import stream_pages

Query = Callable[["Inputs"], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the registered queries, shared with their SQL.
DAY_RANGE = ("1996-01-01", "1996-12-31")
TARGET_DATE = ("1997-05-28", 30)
EVENT_RANGE = ("2024-01-01", "2024-01-31")
UNIQUE_COLUMNS = ["unique_key", "location_key", "complaint_type_key", "status_key"]
ACCEPTED_STATUS = ["OPEN", "CLOSED"]
TOLERANCES = ["1.00", "0.00"]
PAGE_CAP = 3
STREAM_BATCHES = 3
WINDOW_DAYS = ["2024-01-29", "2024-01-30"]
TOP_TYPES = 5  # the test tables have seven


class Inputs:
    """The test tables of one folder and the model tables built from them.

    The models are materialised as the published ones are: staging, core and marts
    are written once, into the shared folder, when the first query needs them.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def raw(self) -> DataFrame:
        return fixture.raw_requests(self.spark, self.sf_dir)

    @cached_property
    def staged(self) -> DataFrame:
        return stage_requests(self.raw)

    @cached_property
    def warehouse(self) -> Warehouse:
        return Warehouse(scratch_folder(self.spark, "models"), self.raw)

    @cached_property
    def day_states(self) -> str:
        """Day states of all events, taken in two upserts and refreshed after each."""
        root = scratch_folder(self.spark, "states")
        pages, raw = f"{root}/pages", raw_table_path(root, PRODUCTION_TABLE)
        write_page_lines(fixture.event_records(self.spark, self.sf_dir, F.col("event_id")), pages)
        first, last = EVENT_RANGE
        ingest(self.spark, pages, root, many_pages_a_file=True, max_pages=PAGE_CAP, run_no=1)
        day_states.refresh(self.spark, f"{root}/states", raw)
        ingest(self.spark, pages, root, many_pages_a_file=True, start_date=first, end_date=last, run_no=2)
        day_states.refresh(self.spark, f"{root}/states", raw)
        return f"{root}/states"

    def table(self, name: str) -> DataFrame:
        return self.warehouse.table(name)

    def read(self, name: str) -> DataFrame:
        return fixture.read_table(self.spark, self.sf_dir, name)


TABLES = ["orders", "customer", "nation", "region", "supplier", "part", "events"]

# One set of model tables per application, input folder, state of its files and session
# zone: a plan keeps the zone it was analysed under.
_INPUTS: dict[tuple, Inputs] = {}


def bind() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries as (spark, sf_dir) callables that share their model tables."""

    def bound(query: Query) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            zone = spark.conf.get("spark.sql.session.timeZone")
            key = (spark.sparkContext.applicationId, sf_dir, zone, state(spark, sf_dir, TABLES))
            if key not in _INPUTS:
                _INPUTS[key] = Inputs(spark, sf_dir)
            return _plain_numbers(query(_INPUTS[key]))

        return run

    return {name: bound(query) for name, query in QUERIES.items()}


def _plain_numbers(frame: DataFrame) -> DataFrame:
    # Decimals print differently per engine; doubles compare.
    decimals = [f.name for f in frame.schema if isinstance(f.dataType, T.DecimalType)]
    return frame.withColumns({c: F.col(c).cast("double") for c in decimals})


def query(name: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        return f

    return register


def _labelled(label: str, parts: dict[str, DataFrame]) -> DataFrame:
    return reduce(
        DataFrame.unionByName, [p.withColumn(label, F.lit(name)) for name, p in parts.items()]
    )


# Raw layer


@query("raw_pages")
def _raw_pages(i: Inputs) -> DataFrame:
    rows = page_rows(fixture.order_pages(i.raw))
    return rows.select(
        "page_no",
        "pos",
        F.get_json_object("record", "$.unique_key").alias("unique_key"),
        F.get_json_object("record", "$.status").alias("status"),
    )


@query("raw_normalized")
def _raw_normalized(i: Inputs) -> DataFrame:
    rows = normalized(page_rows(fixture.order_pages(i.raw)))
    return rows.select(
        *[c for c in RAW_COLUMNS if c != "raw_json"],
        F.get_json_object("raw_json", "$.complaint_type").alias("json_complaint_type"),
        "page_no",
        "pos",
    )


@query("raw_page_cap")
def _raw_page_cap(i: Inputs) -> DataFrame:
    rows = first_pages(fixture.event_records(i.spark, i.sf_dir, F.col("event_id")), PAGE_CAP)
    return rows.select(
        "page_no",
        "pos",
        F.get_json_object("record", "$.unique_key").cast("bigint").alias("unique_key"),
    )


def _order_versions(i: Inputs) -> DataFrame:
    k = F.col("o_orderkey")
    return i.read("orders").select(
        F.col("o_custkey").cast("string").alias("unique_key"),
        F.when(k % 13 != 0, F.col("o_orderdate")).alias("created_date"),
        F.col("o_orderpriority").alias("agency"),
        F.col("o_orderstatus").alias("status"),
        (k % 8).alias("page_no"),
        k.alias("pos"),
    )


@query("raw_dedup_latest")
def _raw_dedup_latest(i: Inputs) -> DataFrame:
    order = [F.col("created_date").desc_nulls_last(), F.col("pos").desc()]
    return latest_per_key(_order_versions(i), "unique_key", order)


@query("raw_upsert")
def _raw_upsert(i: Inputs) -> DataFrame:
    target = i.read("customer").select(
        F.col("c_custkey").cast("string").alias("unique_key"),
        F.lit(None).cast("timestamp_ntz").alias("created_date"),
        F.col("c_mktsegment").alias("agency"),
        F.lit("stored").alias("status"),
    )
    return merged(target, _order_versions(i))


@query("raw_gate")
def _raw_gate_report(i: Inputs) -> DataFrame:
    return raw_gate(i.raw)


@query("raw_target_date")
def _raw_target_date(i: Inputs) -> DataFrame:
    return on_target_date(i.raw, *TARGET_DATE).select("unique_key", "created_date")


@query("raw_date_range")
def _raw_date_range(i: Inputs) -> DataFrame:
    return in_date_range(i.raw, *DAY_RANGE).select("unique_key", "created_date")


@query("rows_per_day")
def _raw_rows_per_day(i: Inputs) -> DataFrame:
    return rows_per_day(i.raw, *DAY_RANGE)


STORED_ORDER = ["unique_key", "created_date", "status", "created_day"]


def _order_rows(i: Inputs, page: int) -> DataFrame:
    """Orders as raw rows of one page, created on their day, in all columns."""
    known = {
        "unique_key": F.col("o_orderkey").cast("string"),
        "created_date": F.col("o_orderdate").cast("timestamp_ntz"),
        "agency": F.col("o_orderpriority"),
        "status": F.col("o_orderstatus"),
    }
    missing = {f.name: F.lit(None).cast(f.dataType) for f in RAW_SCHEMA if f.name not in known}
    return (
        i.read("orders")
        .withColumns(known | missing)
        .select(*RAW_COLUMNS, F.lit(page).cast("bigint").alias("page_no"), F.col("o_orderkey").alias("pos"))
    )


@query("raw_upsert_table")
def _raw_upsert_table(i: Inputs) -> DataFrame:
    """A stored table of all orders, upserted twice and read back.

    The second run closes every third order, moves every fifth by 40 days, takes its
    creation time from every 101st, and moves all orders of January 1996 to February, so
    days gain rows, lose some, and are emptied. A later call of the first run's page 1
    changes nothing but orders the second run left alone.
    """
    path = raw_table_path(scratch_folder(i.spark, "upsert"), PRODUCTION_TABLE)
    upsert(i.spark, path, _order_rows(i, 0), run_no=1)
    k = F.col("unique_key").cast("bigint")
    january = F.date_trunc("month", "created_date") == F.lit("1996-01-01").cast("timestamp")
    moved = (
        F.when(k % 101 == 0, F.lit(None).cast("timestamp_ntz"))
        .when(january, F.add_months("created_date", 1).cast("timestamp_ntz"))
        .when(k % 5 == 0, F.timestamp_add("DAY", F.lit(40), F.col("created_date")))
        .otherwise(F.col("created_date"))
    )
    changed = _order_rows(i, 0).where((k % 3 == 0) | (k % 5 == 0) | (k % 101 == 0) | january)
    changed = changed.withColumns({"created_date": moved, "status": F.lit("run 2")})
    upsert(i.spark, path, changed, run_no=2)
    later = _order_rows(i, 1).where("pos % 7 = 0").withColumn("status", F.lit("page 1"))
    upsert(i.spark, path, later, run_no=1)
    return read_raw(i.spark, path).select(*STORED_ORDER)


@query("raw_probe_reset")
def _raw_probe_reset(i: Inputs) -> DataFrame:
    """(table_name, status, row_count) after both tables took all orders, the probe was reset,
    and both took all of them again, as an earlier run: only the reset table shows it."""
    root = scratch_folder(i.spark, "probe")
    paths = {t: raw_table_path(root, t) for t in RAW_TABLES}
    for path in paths.values():
        upsert(i.spark, path, _order_rows(i, 0).withColumn("status", F.lit("before")), run_no=2)
    reset_probe(i.spark, root, test=False, reset=True)
    reset_probe(i.spark, root, test=True, reset=True)
    for path in paths.values():
        upsert(i.spark, path, _order_rows(i, 0).withColumn("status", F.lit("after")), run_no=1)
    stored = {t: read_raw(i.spark, p).groupBy("status").agg(F.count("*").alias("row_count")) for t, p in paths.items()}
    return _labelled("table_name", stored)


@query("stream_ingest")
def _stream_ingest(i: Inputs) -> DataFrame:
    """Pages of events in three batches or more; users come back in later ones."""
    root = scratch_folder(i.spark, "stream")
    records = fixture.event_records(i.spark, i.sf_dir, F.col("user_id"))
    write_pages(records, f"{root}/pages")
    last = i.read("events").agg(F.max("event_id")).first()[0]
    files = max(1, (last // PAGE_SIZE + 1) // STREAM_BATCHES)
    stream_pages(
        i.spark, f"{root}/pages", root, f"{root}/progress", pages_per_batch=files, run_no=1
    ).awaitTermination()
    stored = read_raw(i.spark, raw_table_path(root, PRODUCTION_TABLE))
    return stored.select(
        "unique_key",
        "created_date",
        "closed_date",
        "agency",
        "descriptor",
        "location",
        "created_day",
    )


@query("raw_window")
def _raw_window(i: Inputs) -> DataFrame:
    """Windows of days over the current rows of users, who come back on later pages.

    The production table takes all pages, then a window of them in a later run, which may
    not bring back older versions. The probe table takes the window's days one run each,
    from a feed that reads each page once.
    """
    root = scratch_folder(i.spark, "window")
    pages = f"{root}/pages"
    write_page_lines(fixture.event_records(i.spark, i.sf_dir, F.col("user_id")), pages)
    first, last = WINDOW_DAYS
    ingest(i.spark, pages, root, many_pages_a_file=True, run_no=1)
    ingest(i.spark, pages, root, many_pages_a_file=True, run_no=2, start_date=first, end_date=last)
    for target in WINDOW_DAYS:
        stream_pages(
            i.spark, pages, root, f"{root}/progress", target_table=PROBE_TABLE, many_pages_a_file=True,
            target_date=target, run_no=1,
        ).awaitTermination()
    stored = {t: read_raw(i.spark, raw_table_path(root, t)) for t in RAW_TABLES}
    return _labelled("table_name", {t: r.select("unique_key", "created_date", "agency", "created_day") for t, r in stored.items()})


@query("backfill_daily")
def _backfill_daily(i: Inputs) -> DataFrame:
    """Files of many pages, ingested, built, tested, published and opened again."""
    root = scratch_folder(i.spark, "backfill")
    records = fixture.event_records(i.spark, i.sf_dir, F.col("event_id"))
    write_page_lines(records, f"{root}/pages")
    first, last = EVENT_RANGE
    backfill(
        i.spark, f"{root}/pages", root, start_date=first, end_date=last, many_pages_a_file=True, run_no=1
    )
    return Warehouse.opened(i.spark, root).table("fct_daily_metrics")


@query("refreshed_daily")
def _refreshed_daily(i: Inputs) -> DataFrame:
    return day_states.daily_metrics(i.spark, i.day_states)


@query("refreshed_mix")
def _refreshed_mix(i: Inputs) -> DataFrame:
    return day_states.borough_mix(i.spark, i.day_states)


# Staging and its expressions


@query("stg_requests")
def _stg_requests(i: Inputs) -> DataFrame:
    return i.staged


@query("stg_clean_text")
def _stg_clean_text(i: Inputs) -> DataFrame:
    text = [c for c in RAW_COLUMNS if c in {*UPPER_COLUMNS, *CASE_KEPT_COLUMNS, "borough"}]
    return i.staged.select("unique_key", *text)


@query("stg_numeric")
def _stg_numeric(i: Inputs) -> DataFrame:
    return i.staged.select(
        "unique_key",
        "latitude",
        "longitude",
        decimal_text(F.col("latitude")).alias("latitude_text"),
        decimal_text(F.col("longitude")).alias("longitude_text"),
    )


@query("stg_validity")
def _stg_validity(i: Inputs) -> DataFrame:
    return i.staged.select(
        "unique_key", "invalid_close_before_create", "valid_lat_long"
    )


@query("surrogate_keys")
def _surrogate_key_columns(i: Inputs) -> DataFrame:
    return i.staged.select("unique_key", *surrogate_keys())


@query("date_parts")
def _date_parts(i: Inputs) -> DataFrame:
    return i.raw.select(
        "unique_key",
        *[e.alias(name) for name, e in calendar_columns(day(F.col("created_date"))).items()],
    )


# Models


def _model(name: str) -> Query:
    return lambda i: i.warehouse.plan(name)


MODEL_QUERIES = {
    "dim_date": "dim_date",
    "dim_location": "dim_location",
    "dim_agency": "dim_agency",
    "dim_complaint_type": "dim_complaint_type",
    "dim_status": "dim_status",
    "dim_channel": "dim_channel",
    "fct_complaint": "fct_311_complaint",
    "fct_complaint_text": "fct_311_complaint_text",
    "complaints_flagged": "int_complaints_flagged",
    "daily_metrics": "fct_daily_metrics",
    "monthly_metrics": "fct_monthly_metrics",
    "borough_mix": "fct_borough_complaint_mix",
}
QUERIES.update({key: _model(name) for key, name in MODEL_QUERIES.items()})


@query("resolution_percentiles")
def _resolution_percentiles(i: Inputs) -> DataFrame:
    return resolution_by(i.table("int_complaints_flagged"), F.col("metric_month"))


@query("created_vs_closed")
def _created_and_closed(i: Inputs) -> DataFrame:
    return created_vs_closed(i.table("fct_daily_metrics"))


@query("top_complaint_types")
def _top_types(i: Inputs) -> DataFrame:
    return top_complaint_types(i.table("fct_borough_complaint_mix"), TOP_TYPES)


# Data checks, on inputs that do hold violations


@query("dq_not_null")
def _dq_not_null(i: Inputs) -> DataFrame:
    stg = i.table("stg_311_requests")
    return quality.null_counts(stg, stg.columns)


@query("dq_unique")
def _dq_unique(i: Inputs) -> DataFrame:
    stg = i.table("stg_311_requests")
    return _labelled("column_name", {c: quality.duplicates(stg, c) for c in UNIQUE_COLUMNS})


@query("dq_accepted_values")
def _dq_accepted_values(i: Inputs) -> DataFrame:
    stg = i.table("stg_311_requests")
    accepted = {"borough": model_tests.ACCEPTED_BOROUGHS, "status": ACCEPTED_STATUS}
    return _labelled(
        "column_name",
        {c: quality.unaccepted_values(stg, c, values) for c, values in accepted.items()},
    )


@query("dq_relationships")
def _dq_relationships(i: Inputs) -> DataFrame:
    found = model_tests.orphans({name: i.table(name) for name in MODELS})
    # The child's column, from "relationships child.column parent.column".
    return found.select("from_field", "row_count", F.split("test", " ")[1].alias("reference"))


@query("dq_composite_key")
def _dq_composite_key(i: Inputs) -> DataFrame:
    return quality.composite_duplicates(i.table("stg_311_requests"), ["agency", "agency_name"])


@query("dq_pct_sum")
def _dq_pct_sum(i: Inputs) -> DataFrame:
    mix = i.table("fct_borough_complaint_mix")
    return _labelled(
        "tolerance", {t: quality.shares_off_total(mix, Decimal(t)) for t in TOLERANCES}
    )


@query("dq_time_order_flag")
def _dq_time_order_flag(i: Inputs) -> DataFrame:
    flagged = i.table("int_complaints_flagged")
    cleared = flagged.withColumn("is_invalid_time_order", F.lit(0))
    return _labelled(
        "flag",
        {
            "stored": quality.wrong_time_order_flags(flagged),
            "cleared": quality.wrong_time_order_flags(cleared),
        },
    )


@query("dq_report")
def _dq_report(i: Inputs) -> DataFrame:
    return model_tests.report({name: i.table(name) for name in MODELS})
