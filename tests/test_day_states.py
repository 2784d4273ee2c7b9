"""Metrics refreshed from changed days, against full builds."""

import random

import pytest
from pyspark.sql import functions as F
from rows import at, batch_frame

from wardbook.plans import day_states
from wardbook.plans.warehouse import Warehouse
from wardbook.sources import raw_table
from wardbook.sources.raw_table import read_raw, upsert

METRICS = {
    "fct_daily_metrics": day_states.daily_metrics,
    "fct_monthly_metrics": day_states.monthly_metrics,
    "fct_borough_complaint_mix": day_states.borough_mix,
}


def request(pick, key, days=None):
    created = pick.choice(days or [None, *[at(d, pick.randint(0, 23)) for d in range(1, 8)], at(1).replace(month=8)])
    closed = pick.choice([None, at(pick.randint(1, 20), pick.randint(0, 23), 30), created])
    return {
        "unique_key": str(key),
        "created_date": created,
        "closed_date": closed,
        "agency": pick.choice(["NYPD", None]),
        "agency_name": pick.choice(["Police", " "]),
        "complaint_type": pick.choice(["Noise", " noise", "Heat", None]),
        "status": pick.choice(["Closed", "Open", None]),
        "borough": pick.choice(["QUEENS", "Bronx ", "", None]),
        "incident_zip": pick.choice(["1", "2"]),
    }


def same(spark, raw, root, folder):
    full = Warehouse(folder, read_raw(spark, raw))
    for name, refreshed in METRICS.items():
        wanted = full.plan(name)
        found = refreshed(spark, root)
        assert found.columns == wanted.columns
        assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect())), name


def test_as_a_full_build_after_every_upsert(spark, root):
    pick = random.Random(2)
    raw, states = f"{root}/raw", f"{root}/states"
    batches = [
        [request(pick, k) for k in range(80)],
        [request(pick, k, [at(2, 5), at(3, 7)]) for k in range(0, 40, 3)],
        [request(pick, k) for k in (3, 90, 91)],
    ]
    for run, batch in enumerate(batches):
        upsert(spark, raw, batch_frame(spark, *batch), run)
        assert day_states.refresh(spark, states, raw)
        same(spark, raw, states, f"{root}/full-{run}")
    assert day_states.refresh(spark, states, raw) == set()


def test_only_changed_days_are_read_and_only_their_months_written(spark, root, monkeypatch):
    pick = random.Random(3)
    raw, states = f"{root}/raw", f"{root}/states"
    july, august = [at(d) for d in (1, 2, 3)], [at(4).replace(month=8)]
    upsert(spark, raw, batch_frame(spark, *[request(pick, k, july + august) for k in range(40)]), 1)
    day_states.refresh(spark, states, raw)
    before = day_states.current(spark, states)
    upsert(spark, raw, batch_frame(spark, request(pick, 100, [at(2)])), 2)
    read = []
    real = raw_table._stored
    monkeypatch.setattr(raw_table, "_stored", lambda *a: read.append(real(*a)) or read[-1])
    assert day_states.refresh(spark, states, raw) == {"2026-07-02"}
    assert {f.split("created_day=")[1][:10] for frame in read for f in frame.inputFiles()} == {"2026-07-02"}
    after = day_states.current(spark, states)
    assert {n for n in after if after[n] != before.get(n)} == {"raw", "created/2026-07", "closed/2026-07", "mix/2026-07"}
    plan = day_states.monthly_metrics(spark, states)
    assert all("/states/" in f for f in plan.inputFiles())


def test_rows_are_cleaned_once_and_counted_before_lookups(spark, root):
    pick = random.Random(5)
    raw = f"{root}/raw"
    upsert(spark, raw, batch_frame(spark, *[request(pick, k, [at(1), at(2)]) for k in range(30)]), 1)
    made = day_states._states(raw_table.read_days(spark, raw, {"2026-07-01", "2026-07-02"}), f"{root}/staged")
    for name, rows in made.items():
        assert all("/staged/" in f for f in rows.inputFiles()), name
    # Only the mix looks anything but the status up.
    plans = {name: rows._jdf.queryExecution().optimizedPlan().toString().count("Join ") for name, rows in made.items()}
    assert plans["created"] <= 1 and plans["closed"] <= 1


def test_emptied_days_go(spark, root):
    raw, states = f"{root}/raw", f"{root}/states"
    pick = random.Random(4)
    upsert(spark, raw, batch_frame(spark, request(pick, 1, [at(1)]), request(pick, 2, [at(1).replace(month=9)])), 1)
    day_states.refresh(spark, states, raw)
    upsert(spark, raw, batch_frame(spark, request(pick, 2, [at(1)])), 2)
    assert day_states.refresh(spark, states, raw) == {"2026-07-01", "2026-09-01"}
    same(spark, raw, states, f"{root}/full")
    with pytest.raises(RuntimeError, match="no created states"):
        day_states.daily_metrics(spark, f"{root}/nothing")


def test_quantiles_of_many_merged_sketches_have_the_stated_rank(spark):
    rows = spark.range(400_000).select((F.col("id") % 300).alias("d"), (F.col("id") * 7919 % 400_000).cast("double").alias("v"))
    parts = rows.groupBy("d").agg(F.kll_sketch_agg_double("v", F.lit(day_states.SKETCH_SIZE)).alias("s"))
    merged = parts.agg(F.kll_merge_agg_double("s", F.lit(day_states.SKETCH_SIZE)).alias("s"))
    for q in (0.5, 0.9, 0.95):
        value = merged.select(F.kll_sketch_get_quantile_double("s", F.lit(q))).first()[0]
        assert abs(value / 400_000 - q) <= 1 / 1000
