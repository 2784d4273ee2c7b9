"""The raw request table: Parquet, one folder per created day, one row per unique_key.

A change writes the days it touches to a version folder of its own, and a manifest that is
published afterwards says which version of each day holds.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardbook.functions.dates import day
from wardbook.operators.latest import arrival_order, latest_per_key
from wardbook.operators.perhaps import perhaps
from wardbook.schema import ARRIVAL_COLUMNS, PARTITION_COLUMN, RAW_COLUMNS, STORED_SCHEMA
from wardbook.sources import key_index
from wardbook.sources.folders import many_tasks, names, remove, written
from wardbook.sources.versions import current, current_number, publish

# The tables an ingest may write to.
PRODUCTION_TABLE = "raw_311_requests"
PROBE_TABLE = "raw_311_requests_probe"
RAW_TABLES = [PRODUCTION_TABLE, PROBE_TABLE]

KEY = "unique_key"
#: Keys that a task may hold, and the driver while they are sent to all tasks. Files of more keys
#: than this may be small, so their bytes do not tell.
MOST_HELD = 250_000
#: Rows of a batch for each that is kept, from which on the others are left out before a sort.
MOST_OLD = 2
#: Which row of a batch one is.
PLACE = [KEY, *ARRIVAL_COLUMNS, "page_file", "pos"]
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def raw_table_path(root: str, table: str) -> str:
    if table not in RAW_TABLES:
        raise ValueError(f"{table!r} is no raw table; there are {RAW_TABLES}")
    return f"{root.rstrip('/')}/{table}"


def create_if_missing(spark: SparkSession, path: str) -> None:
    if current(spark, path) is None:
        publish(spark, path, {})


def reset_probe(spark: SparkSession, root: str, *, test: bool, reset: bool) -> bool:
    """Drop the probe table if this is a test run that asks for it; the production table never."""
    if not (test and reset):
        return False
    remove(spark, raw_table_path(root, PROBE_TABLE))
    return True


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """The raw columns, and the day column that prunes folders."""
    return _stored(spark, path).select(*RAW_COLUMNS, PARTITION_COLUMN)


def read_days(spark: SparkSession, path: str, days: set[str]) -> DataFrame:
    """The stored rows of these days, named as in the manifest, with run and page; no other day is read."""
    return _stored(spark, path, days)


def raw_gate(raw: DataFrame) -> DataFrame:
    """(field_count, row_count) of the raw columns."""
    fields = len([c for c in raw.columns if c in RAW_COLUMNS])
    return raw.agg(F.count("*").alias("row_count")).select(
        F.lit(fields).cast("bigint").alias("field_count"), "row_count"
    )


def check_raw(spark: SparkSession, path: str) -> int:
    """Row count of the raw table; fails if the table is missing or empty."""
    if current(spark, path) is None:
        raise RuntimeError(f"There is no raw table at {path}")
    rows = raw_gate(read_raw(spark, path)).first()["row_count"]
    if rows == 0:
        raise RuntimeError(f"The raw table at {path} is empty")
    return rows


def upsert(spark: SparkSession, path: str, rows: DataFrame, run_no: int | None, wanted: Column | None = None) -> int:
    """Upsert normalized page rows by unique_key; returns how many rows were loaded.

    A page row replaces the stored row of its key unless that one came from a later
    page of the same run or from a later run, so neither the order micro-batches
    arrive in nor a replay changes the result. run_no None: rows have their own run_no.

    wanted, a condition on rows, selects among current rows: a key is left out if the latest
    of its rows, wanted or not, does not meet it, so an older version that does cannot
    come back.

    Plain files have no MERGE. Days that gain or lose a row are written anew, each row
    once, and published together; until then, and if anything fails, the table is as it
    was. Rows are written in full twice: the parsed batch and the new days. Which days
    those are tells an index of keys and days, read for the batch's keys only.
    """
    create_if_missing(spark, path)
    scratch = f"{path}/_scratch-{uuid.uuid4().hex}"
    arrived = rows if "page_file" in rows.columns else rows.withColumn("page_file", F.lit(""))
    if run_no is not None:
        arrived = arrived.withColumn("run_no", F.lit(run_no).cast("bigint"))
    arrived = arrived.withColumns(
        {PARTITION_COLUMN: day(F.col("created_date")), "wanted": F.lit(True) if wanted is None else F.coalesce(wanted, F.lit(False))}
    )
    if wanted is not None:
        # Of a row that is not wanted, only its place among the versions of its key counts.
        wide = [c for c in RAW_COLUMNS if c not in (KEY, "created_date")]
        arrived = arrived.withColumns({c: F.when(F.col("wanted"), F.col(c)) for c in wide})
    try:
        # The batch, parsed once. It may hold a key on several pages.
        batch = written(arrived, f"{scratch}/batch")
        narrow = batch.select(*PLACE, "created_date", PARTITION_COLUMN, "wanted")
        newest = latest_per_key(narrow, KEY, arrival_order()).drop("created_date")
        if wanted is None:
            keys, loaded = batch.select(KEY), batch.count()
        else:
            current_ = F.col("wanted") & F.col(KEY).isNotNull()
            newest = written(newest.where(current_), f"{scratch}/newest")
            batch, keys = batch.where("wanted"), newest.select(KEY)
            loaded = batch.select(KEY).join(_matched(keys), KEY, "left_semi").count()
        if loaded:
            _merge(spark, path, batch, newest.drop("wanted"), keys, scratch)
    finally:
        remove(spark, scratch)
    return loaded


def _matched(keys: DataFrame) -> DataFrame:
    """A written table of keys as the side of a join that is looked up: sorted, if it is long."""
    return keys.hint("merge") if keys.count() > MOST_HELD else keys


def _of_places(batch: DataFrame, places: DataFrame) -> DataFrame:
    """The rows of a batch at these places. If their join sorts and most of the batch are older
    versions, wide rows at other places are left out before it."""
    matched = _matched(places)
    if matched is places or batch.count() < MOST_OLD * places.count():
        return batch.join(matched, PLACE, "left_semi")
    few = perhaps(batch, places, F.xxhash64(*PLACE))
    # An inner join: Spark would put a semi join below the one with the bitmaps.
    return few.join(places.distinct().hint("merge"), PLACE)


def stored_places(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """key, arrival and day of the stored rows of these keys.

    Reads the index for the buckets of these keys, whatever days they are on. Keys are made
    distinct first, so that many copies of one do not meet in a task. Both sides are dealt
    by the key then, so a sorted join of them moves nothing more.
    """
    number = current_number(spark, path)
    if not key_index.is_current(spark, path, number):
        places = _stored(spark, path).select(KEY, *ARRIVAL_COLUMNS, PARTITION_COLUMN)
        key_index.rebuild(spark, path, places, number)
    found = key_index.entries(spark, path, key_index.buckets_of(keys))
    return found.join(keys.select(KEY).distinct().hint("merge"), KEY, "left_semi")


def _merge(spark: SparkSession, path: str, batch: DataFrame, newest: DataFrame, keys: DataFrame, scratch: str) -> None:
    """Publish the table with the newest row of each of these keys of a batch in it."""
    days = current(spark, path)
    touched = written(stored_places(spark, path, keys), f"{scratch}/touched")
    winners = written(_replacing(newest, touched), f"{scratch}/winners")
    if winners.isEmpty():  # later arrivals are stored already
        return
    keys = _matched(winners.select(KEY))
    changed = _days(winners) | _days(touched.join(keys, KEY, "left_semi"))
    rewritten = {d for d in changed if _name(d) in days}

    replacing = _of_places(batch, winners.select(*PLACE)).select(*STORED_SCHEMA.names)
    kept = _stored(spark, path, {_name(d) for d in rewritten}).join(keys, KEY, "left_anti")
    version = f"version={uuid.uuid4().hex}"
    _write(kept.unionByName(replacing) if rewritten else replacing, f"{path}/{version}")

    fresh = {n.split("=", 1)[1] for n in names(spark, f"{path}/{version}") if n.startswith(PARTITION_COLUMN)}
    after = {d: folder for d, folder in days.items() if d not in {_name(c) for c in changed}}
    number = publish(spark, path, after | {d: f"{version}/{PARTITION_COLUMN}={d}" for d in fresh})
    key_index.add(spark, path, winners, number)


def _name(day_: dt.date | None) -> str:
    return str(day_) if day_ else NULL_PARTITION


def _stored(spark: SparkSession, path: str, days: set[str] | None = None) -> DataFrame:
    """The stored rows, of all days or of these."""
    published = current(spark, path) or {}
    folders = sorted(f for d, f in published.items() if days is None or d in days)
    if not folders:
        return spark.createDataFrame([], STORED_SCHEMA)
    paths = [f"{path}/{folder}" for folder in folders]
    return spark.read.schema(STORED_SCHEMA).option("basePath", path).parquet(*paths).select(*STORED_SCHEMA.names)


def _replacing(newest: DataFrame, touched: DataFrame) -> DataFrame:
    """Those of the newest rows' places whose stored row is no later arrival."""
    latest_stored = latest_per_key(touched, KEY, [F.desc(c) for c in ARRIVAL_COLUMNS])
    stored_arrival = latest_stored.select(KEY, F.struct(*ARRIVAL_COLUMNS).alias("stored_arrival"))
    is_later = F.struct(*ARRIVAL_COLUMNS) >= F.col("stored_arrival")
    return (
        newest.join(stored_arrival.hint("merge"), KEY, "left")
        .where(F.col("stored_arrival").isNull() | is_later)
        .drop("stored_arrival")
    )


def _days(rows: DataFrame) -> set[dt.date | None]:
    """Distinct created days: as many as the calendar has, however many rows there are."""
    return {r[0] for r in rows.select(PARTITION_COLUMN).distinct().collect()}


def _write(rows: DataFrame, path: str) -> None:
    # Rebalancing by day gives each day few files; adaptive execution splits a day
    # that is too large for one task. Writing by day sorts by day anyway; with the key
    # after it, row groups have narrow key ranges.
    by_day = rows.hint("rebalance", PARTITION_COLUMN).sortWithinPartitions(PARTITION_COLUMN, KEY)
    with many_tasks(rows.sparkSession):
        by_day.write.partitionBy(PARTITION_COLUMN).parquet(path)
