"""The index of keys and days beside the raw table."""

import random

import pytest
from rows import at, batch_frame

from wardbook.schema import ARRIVAL_COLUMNS, PARTITION_COLUMN
from wardbook.sources import key_index, raw_table
from wardbook.sources.folders import names, remove
from wardbook.sources.raw_table import read_raw, stored_places, upsert
from wardbook.sources.versions import current, current_number


def put(spark, path, *rows, run=1):
    named = [dict(zip(("unique_key", "created_date", "status", "page_no"), r, strict=False)) for r in rows]
    return upsert(spark, path, batch_frame(spark, *named), run)


def keys(spark, *found):
    return spark.createDataFrame([(k,) for k in found], "unique_key string")


def places(frame):
    return sorted(map(tuple, frame.select(key_index.KEY, *ARRIVAL_COLUMNS, PARTITION_COLUMN).collect()), key=str)


def by_scan(spark, path):
    return places(raw_table._stored(spark, path))


def by_index(spark, path):
    return places(key_index.entries(spark, path, list(range(key_index.BUCKETS))))


def test_the_index_holds_the_day_and_arrival_of_every_key(spark, root):
    pick = random.Random(5)
    path = f"{root}/raw"
    for run in range(1, 14):
        rows = [
            (str(pick.randint(0, 30)), pick.choice([None, at(pick.randint(1, 6))]), f"{run}.{i}", i)
            for i in range(pick.randint(1, 12))
        ]
        put(spark, path, *rows, run=pick.choice([run, 3]))
        assert by_index(spark, path) == by_scan(spark, path)
    folders = key_index._folders(spark, path)
    assert max(map(len, folders.values())) <= key_index.MOST_FOLDERS
    live = {f.split("/")[0] for each in folders.values() for f in each}
    changes = {n for n in names(spark, f"{path}/_index") if n.startswith("change")}
    assert live <= changes and len(changes - live) <= 1


def test_a_batch_of_one_old_key_reads_its_bucket_and_its_day(spark, root, monkeypatch):
    path = f"{root}/raw"
    put(spark, path, *[(str(k), at(1 + k % 28), "x", 0) for k in range(400)])
    found = stored_places(spark, path, keys(spark, "37"))
    assert places(found) == [("37", 1, 0, at(1 + 37 % 28).date())]
    read = key_index.entries(spark, path, key_index.buckets_of(keys(spark, "37"))).inputFiles()
    bucket = key_index.buckets_of(keys(spark, "37"))[0]
    assert len(read) == 1 and f"/bucket={bucket}/" in read[0]
    seen = []
    real = raw_table._stored
    monkeypatch.setattr(raw_table, "_stored", lambda *a: seen.append(real(*a)) or seen[-1])
    before = current(spark, path)
    put(spark, path, ("37", at(1 + 37 % 28, 5), "y", 0), run=2)
    files = [f for frame in seen for f in frame.inputFiles()]
    assert files and {f.split("created_day=")[1][:10] for f in files} == {str(at(1 + 37 % 28).date())}
    after = current(spark, path)
    assert {d for d in after if after[d] != before[d]} == {str(at(1 + 37 % 28).date())}


@pytest.mark.parametrize("lost", ["all", "last", "none"])
def test_a_lost_or_late_index_is_made_anew(spark, root, monkeypatch, lost):
    path = f"{root}/raw"
    put(spark, path, ("a", at(1), "x", 0), ("b", at(2), "x", 0))
    if lost == "last":  # the run ends after the table is published and before the index is
        with monkeypatch.context() as patched:
            patched.setattr(key_index, "add", lambda *a: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                put(spark, path, ("a", at(3), "y", 0), ("c", at(4), "y", 0), run=2)
    else:
        put(spark, path, ("a", at(3), "y", 0), ("c", at(4), "y", 0), run=2)
    if lost == "all":
        remove(spark, f"{path}/_index")
    assert key_index.is_current(spark, path, current_number(spark, path)) == (lost == "none")
    put(spark, path, ("a", at(5), "z", 0), run=3)
    rows = {r["unique_key"]: (r["created_date"], r["status"]) for r in read_raw(spark, path).collect()}
    assert rows == {"a": (at(5), "z"), "b": (at(2), "x"), "c": (at(4), "y")}
    assert read_raw(spark, path).count() == 3
    assert by_index(spark, path) == by_scan(spark, path)


def test_an_older_arrival_leaves_the_index(spark, root):
    path = f"{root}/raw"
    put(spark, path, ("a", at(2), "new", 5), run=2)
    before = by_index(spark, path)
    put(spark, path, ("a", at(9), "old", 9), run=1)
    assert by_index(spark, path) == before == by_scan(spark, path)


def test_no_task_and_no_driver_holds_a_long_table_of_keys(spark, root, monkeypatch):
    path = f"{root}/raw"
    rows = [(str(k), at(1 + k % 3), "x", 0) for k in range(40)]
    put(spark, path, *rows)
    plans = []

    def kept(frame, folder, written=raw_table.written):
        plans.append(frame)
        return written(frame, folder)

    monkeypatch.setattr(raw_table, "MOST_HELD", 10, raising=False)
    monkeypatch.setattr(raw_table, "written", kept)
    monkeypatch.setattr(raw_table, "_write", lambda frame, to, write=raw_table._write: plans.append(frame) or write(frame, to))
    put(spark, path, *[(k, day, "y", page) for k, day, _, page in rows], run=2)
    texts = [p._jdf.queryExecution().executedPlan().toString() for p in plans]
    assert sum("SortMergeJoin" in t for t in texts) >= 3
    assert not any("Broadcast" in t for t in texts)
    assert {r["status"] for r in read_raw(spark, path).collect()} == {"y"}
