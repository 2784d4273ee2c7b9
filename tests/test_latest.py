import random

import pytest
from pyspark.sql import functions as F
from rows import at

from wardbook.operators.latest import latest_per_key, merged

TARGET = "unique_key string, created_date timestamp_ntz, status string"
PAGES = TARGET + ", page_no long, pos long"


def replayed(target, pages):
    """Page by page: dedupe the page, then overwrite by key."""
    table = {row[0]: row for row in target}
    for page in sorted({p[3] for p in pages}):
        best = {}
        for key, created, status, _, pos in (p for p in pages if p[3] == page):
            rank = (created is not None, created or at(1), pos)
            if key not in best or rank > best[key][0]:
                best[key] = (rank, (key, created, status))
        table.update({key: row for key, (_, row) in best.items()})
    return set(table.values())


@pytest.mark.parametrize("seed", range(4))
def test_closed_form_equals_page_by_page_replay(spark, seed):
    pick = random.Random(seed)
    keys = [str(i) for i in range(12)]
    target = [(k, at(pick.randint(1, 9)), "stored") for k in pick.sample(keys, 6)]
    pages = [
        (
            # One key holds about a third of all rows.
            pick.choice([*keys, *["0"] * 6]),
            pick.choice([None, at(pick.randint(1, 4))]),
            f"v{i}",
            pick.randint(0, 5),
            i,
        )
        for i in range(150)
    ]
    result = merged(
        spark.createDataFrame(target, TARGET), spark.createDataFrame(pages, PAGES)
    ).collect()
    assert len(result) == len({r[0] for r in result})
    assert {tuple(r) for r in result} == replayed(target, pages)


def test_a_later_page_overwrites_a_newer_row(spark):
    pages = spark.createDataFrame(
        [("a", at(9), "newer", 0, 0), ("a", at(1), "older", 1, 0)], PAGES
    )
    target = spark.createDataFrame([], TARGET)
    assert [r["status"] for r in merged(target, pages).collect()] == ["older"]


def test_latest_per_key_limits_groups_before_the_shuffle(spark):
    rows = spark.range(100).selectExpr("cast(id % 3 as string) k", "id v")
    plan = latest_per_key(rows, "k", [F.desc("v")])._jdf.queryExecution().toString()
    partial = plan.index("Partial", plan.index("Physical Plan"))
    assert plan.index("Exchange hashpartitioning", plan.index("Physical Plan")) < partial
