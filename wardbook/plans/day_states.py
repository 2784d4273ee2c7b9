"""Metrics refreshed from the days that changed.

For each created day of the raw table a few small states are kept: counts and flags of the
day; counts, seconds and a quantile sketch for each day on which its requests were closed;
counts by borough and complaint type. All of them can be merged, so the published metrics
are made from the states alone, by day, by month, or over all, and no fact is read again.

A refresh compares the raw table's manifest with the one it last saw. Days whose folder
differs are read and their states made anew; the others are left alone. States are stored by
month, and a month with a changed day is rewritten, which is cheap as states are few. All
is published at once, with the manifest that the states belong to.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardbook.functions.dates import day, elapsed_seconds
from wardbook.functions.keys import COMPLAINT_TYPE_KEY, LOCATION_KEY, STATUS_KEY
from wardbook.functions.text import clean_with_default
from wardbook.operators.measures import QUANTILES, SECONDS_PER_HOUR
from wardbook.plans import core, marts
from wardbook.plans.flags import complaints_flagged
from wardbook.plans.staging import stage_requests
from wardbook.schema import TIMESTAMP_COLUMNS, UNSPECIFIED
from wardbook.sources.folders import names, put_text, remove, text_of, written
from wardbook.sources.raw_table import NULL_PARTITION, read_days
from wardbook.sources.versions import current, publish

#: Size of a quantile sketch. Groups of up to so many closures are exact; the rank error of
#: larger ones is below 1/1000, also after any number of merges.
SKETCH_SIZE = 4096
#: The manifest's entry for the raw days that the states belong to.
RAW_DAYS = "raw"
DAY = "created_day"
#: What facts and lookups take of a cleaned request.
STAGED = [
    "unique_key",
    *TIMESTAMP_COLUMNS,
    *[f"{name}_key" for name in ("location", "agency", "complaint_type", "status", "channel")],
    *LOCATION_KEY,
    *COMPLAINT_TYPE_KEY,
    *STATUS_KEY,
    "police_precinct",
]


def _created_states(flagged: DataFrame) -> DataFrame:
    return marts.created_by_day(flagged).withColumnRenamed("metric_date", DAY)


def _closed_states(flagged: DataFrame) -> DataFrame:
    seconds = elapsed_seconds(F.col("created_at"), F.col("closed_at"))
    return (
        flagged.where(marts.validly_closed())
        .groupBy(day(F.col("created_at")).alias(DAY), day(F.col("closed_at")).alias("closed_day"))
        .agg(
            F.count("*").alias("closed_count"),
            F.sum(seconds.cast("decimal(20,0)")).alias("seconds"),
            F.kll_sketch_agg_double("resolution_hours", F.lit(SKETCH_SIZE)).alias("sketch"),
        )
    )


def _mix_states(flagged: DataFrame, dim_location: DataFrame, dim_type: DataFrame) -> DataFrame:
    """Requests by day, borough and complaint type, counted before any lookup.

    A day's requests of one location and type meet the lookups as one row.
    """
    counted = (
        flagged.where(F.col("created_at").isNotNull())
        .groupBy(day(F.col("created_at")).alias(DAY), "location_id", "complaint_type_id")
        .agg(F.count("*").alias("n"))
    )
    types = dim_type.select("complaint_type_id", "complaint_type")
    locations = dim_location.select("location_id", "borough")
    # The lookups of the metric: a request's own borough and type, or the default.
    return (
        counted.join(types, "complaint_type_id", "left")
        .join(locations, "location_id", "left")
        .groupBy(
            DAY,
            clean_with_default(F.col("borough"), UNSPECIFIED).alias("borough"),
            F.coalesce("complaint_type", F.lit(UNSPECIFIED)).alias("complaint_type"),
        )
        .agg(F.sum("n").alias("n"))
    )


def _states(raw: DataFrame, staged: str) -> dict[str, DataFrame]:
    """The states of raw rows by kind. The rows are cleaned once, and written.

    The lookups come from the same rows: a key is a hash of its attributes, so they hold the
    attributes that the dimensions of all rows hold.
    """
    stg = written(stage_requests(raw.drop("raw_json")).select(*STAGED), staged)
    flagged = complaints_flagged(core.fct_complaint(stg), core.dim_status(stg))
    return {
        "created": _created_states(flagged),
        "closed": _closed_states(flagged),
        "mix": _mix_states(flagged, core.dim_location(stg), core.dim_complaint_type(stg)),
    }


def refresh(spark: SparkSession, root: str, raw_path: str) -> set[str]:
    """Bring the states under root up to the raw table; returns the days that had changed."""
    now = current(spark, raw_path) or {}
    published = current(spark, root) or {}
    before = json.loads(text_of(spark, f"{root}/{published[RAW_DAYS]}")) if published else {}
    changed = {d for d in now.keys() | before.keys() if now.get(d) != before.get(d)}
    if not changed:
        return changed
    # Requests of an unknown day are in no metric.
    dated = {d for d in changed if d != NULL_PARTITION}
    months = {d[:7] for d in dated}
    version = f"version-{uuid.uuid4().hex}"
    staged = f"{root}/{version}/staged"
    made = _states(read_days(spark, raw_path, dated), staged)
    after = {name: folder for name, folder in published.items() if name.split("/")[-1] not in months}
    for name, rows in made.items():
        older = [published[f"{name}/{m}"] for m in sorted(months) if f"{name}/{m}" in published]
        if older:
            stored = spark.read.schema(rows.schema).parquet(*[f"{root}/{f}" for f in older])
            kept = [dt.date.fromisoformat(d) for d in sorted(dated)]
            rows = rows.unionByName(stored.where(~F.col(DAY).isin(kept)))
        folder = f"{root}/{version}/{name}"
        month = F.substring(F.col(DAY).cast("string"), 1, 7)
        rows.withColumn("month", month).hint("rebalance", "month").write.partitionBy("month").parquet(folder)
        written = [n.split("=", 1)[1] for n in names(spark, folder) if n.startswith("month=")]
        after |= {f"{name}/{m}": f"{version}/{name}/month={m}" for m in written}
    remove(spark, staged)
    put_text(spark, f"{root}/{version}/raw.json", json.dumps(now))
    publish(spark, root, after | {RAW_DAYS: f"{version}/raw.json"})
    return changed


def states(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The published states of one kind."""
    published = current(spark, root) or {}
    folders = sorted(f for n, f in published.items() if n.split("/")[0] == name)
    if not folders:
        raise RuntimeError(f"There are no {name} states at {root}")
    return spark.read.parquet(*[f"{root}/{f}" for f in folders])


def _merged(closed: DataFrame, key: Column) -> DataFrame:
    """Closures of states by a key: counts, mean and quantiles of resolution hours."""
    sketch = F.col("sketch")
    merged = closed.groupBy(key).agg(
        F.sum("closed_count").alias("closed_count"),
        F.sum("seconds").cast("double").alias("seconds"),
        F.kll_merge_agg_double("sketch", F.lit(SKETCH_SIZE)).alias("sketch"),
    )
    mean = F.try_divide(F.col("seconds"), F.col("closed_count")) / F.lit(SECONDS_PER_HOUR)
    values = {f"{n}_resolution_hours": F.kll_sketch_get_quantile_double(sketch, F.lit(q)) for n, q in QUANTILES.items()}
    return merged.withColumns({"avg_resolution_hours": mean, **values}).drop("seconds", "sketch")


def daily_metrics(spark: SparkSession, root: str) -> DataFrame:
    """fct_daily_metrics from the states."""
    created = states(spark, root, "created").withColumnRenamed(DAY, "metric_date")
    return marts.daily_of(created, _merged(_closed(spark, root), F.col("closed_day").alias("metric_date")))


def monthly_metrics(spark: SparkSession, root: str) -> DataFrame:
    """fct_monthly_metrics from the states, closures by created month as in the full build."""
    month = F.trunc(F.col(DAY), "month").alias("month_start")
    created = states(spark, root, "created")
    counts = ["created_count", *[f"{flag}_count" for flag in marts.FLAGS]]
    summed = created.groupBy(month).agg(*[F.sum(c).alias(c) for c in counts])
    joined = summed.join(_merged(_closed(spark, root), month), "month_start", "left")
    return marts.monthly_of(joined.withColumn("closed_count", F.coalesce("closed_count", F.lit(0)).cast("bigint")))


def borough_mix(spark: SparkSession, root: str) -> DataFrame:
    """fct_borough_complaint_mix from the states."""
    groups = states(spark, root, "mix").groupBy("borough", "complaint_type").agg(
        F.min(DAY).alias("min_created_date"), F.max(DAY).alias("max_created_date"), F.sum("n").alias("total_requests")
    )
    return marts.mix_of(groups)


def _closed(spark: SparkSession, root: str) -> DataFrame:
    published = current(spark, root) or {}
    if any(n.startswith("closed/") for n in published):
        return states(spark, root, "closed")
    kinds = f"{DAY} date, closed_day date, closed_count bigint, seconds decimal(30,0), sketch binary"
    return spark.createDataFrame([], kinds)
