"""Windows of days over current rows: an older version never comes back, and no page is read twice."""

import pytest
from pyspark.sql import functions as F
from rows import write_page

from wardbook.operators.selection import window_of
from wardbook.plans.backfill import ingest
from wardbook.sources import raw_table
from wardbook.sources.folders import names
from wardbook.sources.raw_table import read_raw, reset_probe
from wardbook.streaming.ingest import stream_pages


def record(key, day, status, time="10:00:00.000"):
    return {"unique_key": key, "created_date": f"2026-07-{day:02d}T{time}", "status": status}


def stored(spark, root, table="raw_311_requests"):
    return {r["unique_key"]: r["status"] for r in read_raw(spark, f"{root}/{table}").collect()}


WINDOW = {"start_date": "2026-07-04", "end_date": "2026-07-06"}


@pytest.fixture
def pages(tmp_path):
    folder = tmp_path / "pages"
    write_page(folder, 0, [record(1, 5, "old"), record(2, 5, "kept"), record(3, 2, "old")])
    write_page(folder, 1, [record(1, 2, "new"), record(3, 6, "new")])
    return folder


def test_an_older_version_inside_the_window_does_not_come_back(spark, root, pages):
    assert ingest(spark, str(pages), root, run_no=1) == 5
    assert stored(spark, root) == {"1": "new", "2": "kept", "3": "new"}
    assert ingest(spark, str(pages), root, run_no=2, **WINDOW) == 2
    assert stored(spark, root) == {"1": "new", "2": "kept", "3": "new"}


def test_a_window_into_an_empty_table_takes_current_rows_only(spark, root, pages):
    ingest(spark, str(pages), root, **WINDOW)
    assert stored(spark, root) == {"2": "kept", "3": "new"}
    days = {str(r[0]) for r in read_raw(spark, f"{root}/raw_311_requests").select("created_day").collect()}
    assert days == {"2026-07-05", "2026-07-06"}


@pytest.mark.parametrize("pages_per_batch", [1, 5])
def test_a_stream_of_a_window_is_as_the_batch(spark, root, pages, pages_per_batch):
    stream_pages(spark, str(pages), root, f"{root}/p", pages_per_batch=pages_per_batch, run_no=1, **WINDOW).awaitTermination()
    assert stored(spark, root) == {"2": "kept", "3": "new"}
    stream_pages(spark, str(pages), root, f"{root}/p", run_no=1)
    assert stored(spark, root) == {"1": "new", "2": "kept", "3": "new"}


def test_the_second_day_reads_no_old_page_and_its_days_only(spark, root, pages, monkeypatch):
    def run(**dates):
        return stream_pages(spark, str(pages), root, f"{root}/p", run_no=1, **dates)

    read = []
    real = raw_table._stored
    monkeypatch.setattr(raw_table, "_stored", lambda *a: read.append(real(*a)) or read[-1])
    assert run(target_date="2026-07-05").lastProgress["numInputRows"] == 2
    read.clear()
    second = run(target_date="2026-07-06")
    assert second.lastProgress is None or second.lastProgress["numInputRows"] == 0
    landed = {f.split("created_day=")[1][:10] for frame in read for f in frame.inputFiles() if "/landed/" in f}
    assert landed == {"2026-07-06"}
    assert stored(spark, root) == {"2": "kept", "3": "new"}
    read.clear()
    run(target_date="2026-07-06")
    assert not [f for frame in read for f in frame.inputFiles()]  # nothing has changed
    # A new page is read alone, and a wider run still finds what the others left out.
    write_page(pages, 2, [record(2, 6, "moved")])
    assert run().lastProgress["numInputRows"] == 1
    assert stored(spark, root) == {"1": "new", "2": "moved", "3": "new"}


def test_a_row_of_the_last_split_second_is_left_out_and_arrives_later(spark, root, tmp_path):
    folder = tmp_path / "late"
    write_page(folder, 0, [record(1, 6, "a", "23:59:59.000"), record(2, 6, "b", "23:59:59.500"), record(3, 6, "c")])
    write_page(folder, 1, [record(3, 6, "late", "23:59:59.700")])
    for step in (lambda **d: ingest(spark, str(folder), f"{root}/batch", **d), lambda **d: stream_pages(spark, str(folder), f"{root}/s", f"{root}/p", run_no=1, **d)):
        step(**WINDOW)
    assert stored(spark, f"{root}/batch") == stored(spark, f"{root}/s") == {"1": "a"}
    stream_pages(spark, str(folder), f"{root}/s", f"{root}/p", run_no=1, target_date="2026-07-06")
    assert stored(spark, f"{root}/s") == {"1": "a", "2": "b", "3": "late"}


def test_unknown_creation_times_are_in_no_window(spark, root, tmp_path):
    folder = tmp_path / "unknown"
    write_page(folder, 0, [record(1, 5, "dated"), {"unique_key": 2, "status": "undated"}])
    write_page(folder, 1, [{"unique_key": 1, "status": "undated"}])
    assert ingest(spark, str(folder), root, **WINDOW) == 0
    stream_pages(spark, str(folder), root, f"{root}/p", run_no=1, **WINDOW)
    assert stored(spark, root) == {}
    stream_pages(spark, str(folder), root, f"{root}/p", run_no=1)
    assert stored(spark, root) == {"1": "undated", "2": "undated"}


def test_one_feed_serves_several_tables(spark, root, pages):
    for table in raw_table.RAW_TABLES:
        stream_pages(spark, str(pages), root, f"{root}/p", target_table=table, run_no=1)
    assert stored(spark, root) == stored(spark, root, raw_table.PROBE_TABLE) == {"1": "new", "2": "kept", "3": "new"}
    reset_probe(spark, root, test=True, reset=True)
    probe = {"target_table": raw_table.PROBE_TABLE, "run_no": 1}
    stream_pages(spark, str(pages), root, f"{root}/p", target_date="2026-07-05", **probe)
    assert stored(spark, root, raw_table.PROBE_TABLE) == {"2": "kept"}
    assert "_taken" in names(spark, f"{root}/{raw_table.PROBE_TABLE}")


def test_windows():
    assert window_of() is None
    keep, first, last = window_of(target_date="2026-07-04", offset_days=3)
    assert (str(first), str(last)) == ("2026-07-04", "2026-07-06") and isinstance(keep, type(F.col("x")))
    assert [str(d) for d in window_of(**WINDOW)[1:]] == ["2026-07-04", "2026-07-06"]
