"""The file-based upsert against a model of it, and the guards around the raw table."""

import random

import pytest
from pyspark.sql import functions as F
from rows import at, batch_frame

from wardbook.schema import RAW_COLUMNS
from wardbook.sources import raw_table
from wardbook.sources.folders import exists, names
from wardbook.sources.raw_table import (
    check_raw,
    create_if_missing,
    raw_gate,
    raw_table_path,
    read_raw,
    reset_probe,
    upsert,
)
from wardbook.sources.versions import current, publish


def contents(spark, path):
    rows = read_raw(spark, path).select("unique_key", "created_date", "status").collect()
    assert len(rows) == len({r[0] for r in rows}), "one row per key"
    return {r["unique_key"]: (r["created_date"], r["status"]) for r in rows}


def folders(spark, path):
    days = read_raw(spark, path).select("created_day").distinct().collect()
    return {r[0] for r in days}


def put(spark, path, *rows, run=1):
    named = [dict(zip(("unique_key", "created_date", "status", "page_no"), r)) for r in rows]
    return upsert(spark, path, batch_frame(spark, *named), run)


def test_insert_update_and_move(spark, root):
    path = f"{root}/raw"
    assert put(spark, path, ("a", at(1), "x", 0), ("b", at(1), "x", 0), ("c", None, "x", 1)) == 3
    assert contents(spark, path) == {"a": (at(1), "x"), "b": (at(1), "x"), "c": (None, "x")}
    # a and b move out of day 1 and empty it, c moves out of the NULL day, d is new.
    put(
        spark,
        path,
        ("a", at(2), "y", 0),
        ("b", at(3), "y", 0),
        ("c", at(3), "y", 0),
        ("d", None, "y", 0),
        run=2,
    )
    assert contents(spark, path) == {
        "a": (at(2), "y"), "b": (at(3), "y"), "c": (at(3), "y"), "d": (None, "y"),
    }
    assert folders(spark, path) == {at(2).date(), at(3).date(), None}
    assert "2026-07-01" not in current(spark, path)


def test_rows_of_untouched_keys_stay(spark, root):
    path = f"{root}/raw"
    put(spark, path, ("a", at(1), "x", 0), ("b", at(1), "x", 0), ("c", at(2), "x", 0))
    put(spark, path, ("b", at(1, 5), "y", 0), run=2)
    assert contents(spark, path) == {"a": (at(1), "x"), "b": (at(1, 5), "y"), "c": (at(2), "x")}


def test_replay_and_page_order(spark, root):
    path = f"{root}/raw"
    late = [("a", at(2), "page 5", 5)]
    early = [("a", at(1), "page 3", 3), ("b", at(1), "page 3", 3)]
    put(spark, path, *late)
    put(spark, path, *early)
    expected = {"a": (at(2), "page 5"), "b": (at(1), "page 3")}
    assert contents(spark, path) == expected
    put(spark, path, *late)
    put(spark, path, *early)
    assert contents(spark, path) == expected
    # A later run starts over at page 0 and wins.
    put(spark, path, ("a", at(1), "run 2", 0), run=2)
    assert contents(spark, path)["a"] == (at(1), "run 2")


def test_same_key_twice_on_a_page(spark, root):
    path = f"{root}/raw"
    loaded = put(
        spark,
        path,
        ("a", at(1), "older", 0),
        ("a", at(3), "newest", 0),
        ("a", None, "unknown", 0),
    )
    assert loaded == 3
    assert contents(spark, path) == {"a": (at(3), "newest")}


def test_empty_batch_changes_nothing(spark, root):
    path = f"{root}/raw"
    put(spark, path, ("a", at(1), "x", 0))
    assert put(spark, path, run=2) == 0
    assert contents(spark, path) == {"a": (at(1), "x")}


def test_readers_see_the_table_before_or_after_a_change_never_between(spark, root, monkeypatch):
    """Read between every step of an upsert that moves days, and after a failure at each."""
    path = f"{root}/raw"
    put(spark, path, ("a", at(1), "x", 0), ("b", at(2), "x", 0), ("c", at(2), "x", 0))
    before = contents(spark, path)
    batch = [("a", at(2), "y", 0), ("b", at(5), "y", 0)]
    after = {"a": (at(2), "y"), "b": (at(5), "y"), "c": (at(2), "x")}
    steps = ["written", "latest_per_key", "_days", "_write", "names", "publish"]
    for failing in [*steps, None]:
        seen = []

        def watch(name, patched, failing=failing, seen=seen):
            real = getattr(raw_table, name)

            def step(*args, **kwargs):
                seen.append(contents(spark, path))
                if name == failing:
                    raise OSError("lost")
                return real(*args, **kwargs)

            patched.setattr(raw_table, name, step)

        with monkeypatch.context() as patched:
            for name in steps:
                watch(name, patched)
            if failing:
                with pytest.raises(OSError):
                    put(spark, path, *batch, run=2)
            else:
                put(spark, path, *batch, run=2)
        assert seen and all(s == before for s in seen)
        assert contents(spark, path) == (before if failing else after)
        assert not [n for n in names(spark, path) if n.startswith("_scratch")]


def test_a_publish_that_fails_leaves_the_last_one(spark, root):
    publish(spark, root, {"x": "v1/x"})
    with pytest.raises(Exception, match="rename|exist|Rename"):
        from wardbook.sources import versions

        original = versions._manifest
        try:
            versions._manifest = lambda r, n: f"{r}/missing-folder-{n}/deep/m.json" if n else original(r, n)
            versions.put_text(spark, f"{root}/_manifests/000000000000.json/no", "{}")
        finally:
            versions._manifest = original
    assert current(spark, root) == {"x": "v1/x"}


def test_old_versions_go_when_no_manifest_names_them(spark, root):
    path = f"{root}/raw"
    for run in range(1, 6):
        put(spark, path, ("a", at(1), str(run), 0), ("b", at(run + 1), "x", 0), run=run)
    live = set(current(spark, path).values())
    assert len(live) == 2 and contents(spark, path)["a"] == (at(1), "5")
    assert len(names(spark, f"{path}/_manifests")) == 2
    days = [f"{v}/{d}" for v in names(spark, path) if v.startswith("version") for d in names(spark, f"{path}/{v}")]
    kept = {d for d in days if "created_day" in d}
    assert live <= kept and len(kept) <= 4


def test_rows_are_written_in_full_twice(spark, root, monkeypatch):
    path = f"{root}/raw"
    put(spark, path, ("a", at(1), "x", 0), ("b", at(2), "x", 0))
    wide = []
    real_written, real_write = raw_table.written, raw_table._write
    monkeypatch.setattr(raw_table, "written", lambda rows, to: wide.append(len(rows.columns)) or real_written(rows, to))
    monkeypatch.setattr(raw_table, "_write", lambda rows, to: wide.append(len(rows.columns)) or real_write(rows, to))
    put(spark, path, ("a", at(2), "y", 0), run=2)
    assert sum(n >= len(RAW_COLUMNS) for n in wide) == 2 and len(wide) == 4


def test_random_batches_against_a_dictionary(spark, root):
    pick = random.Random(11)
    path = f"{root}/raw"
    model = {}
    for run in range(1, 5):
        batch = [
            (str(pick.randint(0, 15)), pick.choice([None, at(pick.randint(1, 6))]), f"{run}.{i}", 0)
            for i in range(pick.randint(1, 25))
        ]
        put(spark, path, *batch, run=run)
        best = {}
        for i, (key, created, status, _) in enumerate(batch):
            rank = (created is not None, created or at(1), i)
            if key not in best or rank > best[key][0]:
                best[key] = (rank, (created, status))
        model.update({key: value for key, (_, value) in best.items()})
        assert contents(spark, path) == model


def test_day_filter_prunes_folders(spark, root):
    from wardbook.operators.selection import in_date_range

    path = f"{root}/raw"
    put(spark, path, ("a", at(1), "x", 0), ("b", at(2), "x", 0), ("c", at(3), "x", 0))
    picked = in_date_range(read_raw(spark, path), "2026-07-02", "2026-07-02").select("unique_key")
    plan = picked._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(created_day" in plan
    assert "GreaterThanOrEqual(created_date" in plan
    assert [r[0] for r in picked.collect()] == ["b"]


def test_table_names_are_checked(root):
    assert raw_table_path(root, "raw_311_requests").startswith(root)
    with pytest.raises(ValueError, match="is no raw table"):
        raw_table_path(root, "other")


def test_probe_is_reset_only_in_test_mode_on_request(spark, root):
    production = raw_table_path(root, "raw_311_requests")
    probe = raw_table_path(root, "raw_311_requests_probe")
    for path in (production, probe):
        put(spark, path, ("a", at(1), "x", 0))
    for test, reset in ((False, False), (False, True), (True, False)):
        assert not reset_probe(spark, root, test=test, reset=reset)
        assert exists(spark, production) and exists(spark, probe)
    assert reset_probe(spark, root, test=True, reset=True)
    assert exists(spark, production) and not exists(spark, probe)
    assert reset_probe(spark, root, test=True, reset=True)


def test_gate(spark, root):
    path = f"{root}/raw"
    with pytest.raises(RuntimeError, match="no raw table"):
        check_raw(spark, path)
    create_if_missing(spark, path)
    create_if_missing(spark, path)
    with pytest.raises(RuntimeError, match="is empty"):
        check_raw(spark, path)
    put(spark, path, ("a", at(1), "x", 0))
    assert check_raw(spark, path) == 1
    assert raw_gate(read_raw(spark, path)).first().asDict() == {
        "field_count": len(RAW_COLUMNS),
        "row_count": 1,
    }


def test_all_raw_columns_survive(spark, root):
    path = f"{root}/raw"
    full = {c: f"{c} text" for c in RAW_COLUMNS}
    full.update(created_date=at(1), closed_date=at(2), resolution_action_updated_date=at(3))
    upsert(spark, path, batch_frame(spark, full), 1)
    row = read_raw(spark, path).drop("created_day").first()
    assert row.asDict() == full


def test_a_hot_day_is_split(spark, root):
    """A day with most of the rows is written by several tasks."""
    path = f"{root}/raw"
    rows = spark.range(20000).select(
        F.col("id").cast("string").alias("unique_key"),
        F.lit("2026-07-01 10:00:00").cast("timestamp_ntz").alias("created_date"),
        F.sha2(F.col("id").cast("string"), 512).alias("raw_json"),
    )
    known = rows.columns
    batch = rows.select(
        *known,
        *[
            F.lit(None).cast("timestamp_ntz" if c.endswith("_date") else "string").alias(c)
            for c in RAW_COLUMNS
            if c not in known
        ],
        F.lit(0).cast("bigint").alias("page_no"),
        F.col("unique_key").cast("bigint").alias("pos"),
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        upsert(spark, path, batch, 1)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    stored = read_raw(spark, path)
    assert stored.count() == 20000
    assert stored.select(F.input_file_name()).distinct().count() > 1


def test_files_are_sorted_by_key(spark, root):
    path = f"{root}/raw"
    keys = [str(k) for k in range(100)]
    random.Random(3).shuffle(keys)
    put(spark, path, *[(k, at(1), "x", 0) for k in keys])
    put(spark, path, *[(k, at(1), "y", 0) for k in keys[:10]], run=2)
    rows = read_raw(spark, path).select("unique_key", F.input_file_name().alias("file")).collect()
    by_file = {}
    for row in rows:
        by_file.setdefault(row["file"], []).append(row["unique_key"])
    assert sum(map(len, by_file.values())) == 100
    assert all(found == sorted(found) for found in by_file.values())


def test_older_versions_of_a_long_batch_are_left_out_before_its_join_sorts(spark, monkeypatch):
    monkeypatch.setattr(raw_table, "MOST_HELD", 10)
    rows = [{"unique_key": str(i % 40), "created_date": at(1), "status": str(i), "page_no": i // 40} for i in range(2000)]
    batch = batch_frame(spark, *rows).withColumns({"run_no": F.lit(1).cast("bigint"), "page_file": F.lit("")})
    last = batch.where("page_no = 49").select(*raw_table.PLACE)
    found = raw_table._of_places(batch, last)
    assert {r["status"] for r in found.collect()} == {str(i) for i in range(1960, 2000)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    # Printed from the root down: the rows are filtered below the sorted join.
    assert plan.index("SortMergeJoin") < plan.index("getbit")


def test_upserts_of_long_batches(spark, root, monkeypatch):
    monkeypatch.setattr(raw_table, "MOST_HELD", 10)
    path = f"{root}/raw"
    put(spark, path, *[(str(i % 40), at(1 + i % 3), f"v{i}", i // 40) for i in range(400)])
    put(spark, path, *[(str(i % 60), at(2), f"w{i}", i // 60) for i in range(180)], run=2)
    assert contents(spark, path) == {str(i % 60): (at(2), f"w{i}") for i in range(120, 180)}
