"""Batch ingest, micro-batch ingest and the backfill run."""

import pytest
from rows import write_page

from wardbook.plans.backfill import FailedTests, backfill, ingest
from wardbook.plans.warehouse import MODELS, Warehouse
from wardbook.sources.raw_table import read_raw
from wardbook.streaming.ingest import stream_pages


def record(key, day, status="Closed", **fields):
    return {
        "unique_key": key,
        "created_date": f"2026-07-{day:02d}T10:00:00.000",
        "closed_date": f"2026-07-{day:02d}T12:00:00.000",
        "agency": "NYPD",
        "agency_name": "Police",
        "complaint_type": "Noise",
        "status": status,
        "open_data_channel_type": "PHONE",
        "borough": "QUEENS",
        **fields,
    }


def stored(spark, root, table="raw_311_requests"):
    return {r["unique_key"]: r["status"] for r in read_raw(spark, f"{root}/{table}").collect()}


@pytest.fixture
def pages(tmp_path):
    folder = tmp_path / "pages"
    write_page(folder, 0, [record(1, 1), record(2, 1)])
    write_page(folder, 1, [record(2, 2, "page 1"), record(3, 2)])
    write_page(folder, 2, [record(4, 3)])
    write_page(folder, 3, [record(1, 4, "page 3"), record(5, 4)])
    write_page(folder, 4, [])
    return folder


def test_all_pages_are_read_by_default(spark, root, pages):
    assert ingest(spark, str(pages), root) == 7
    assert set(stored(spark, root)) == set("12345")


def test_a_page_cap_is_explicit_and_says_what_it_leaves_out(spark, root, pages, caplog):
    assert ingest(spark, str(pages), root, max_pages=3) == 5
    assert "2 pages from number 3 on are left out" in caplog.text
    assert stored(spark, root) == {"1": "Closed", "2": "page 1", "3": "Closed", "4": "Closed"}


def test_a_date_filter_lifts_the_cap(spark, root, pages):
    loaded = ingest(spark, str(pages), root, start_date="2026-07-01", end_date="2026-07-31", max_pages=3)
    assert loaded == 7
    assert stored(spark, root) == {
        "1": "page 3", "2": "page 1", "3": "Closed", "4": "Closed", "5": "Closed",
    }


def test_target_date_and_no_cap(spark, root, pages):
    assert ingest(spark, str(pages), root, target_date="2026-07-02", offset_days=2) == 3
    assert set(stored(spark, root)) == {"2", "3", "4"}
    assert ingest(spark, str(pages), root, max_pages=None) == 7


def test_unknown_table(spark, root, pages):
    with pytest.raises(ValueError, match="is no raw table"):
        ingest(spark, str(pages), root, target_table="elsewhere")


@pytest.mark.parametrize("pages_per_batch", [1, 2, 1000])
def test_stream_equals_batch(spark, root, pages, pages_per_batch):
    query = stream_pages(
        spark, str(pages), root, f"{root}/progress", pages_per_batch=pages_per_batch, run_no=1
    )
    query.awaitTermination()
    expected = {"1": "page 3", "2": "page 1", "3": "Closed", "4": "Closed", "5": "Closed"}
    assert stored(spark, root) == expected
    # Only new pages are read on the next start.
    write_page(pages, 5, [record(6, 5), record(2, 5, "page 5")])
    stream_pages(spark, str(pages), root, f"{root}/progress", run_no=1).awaitTermination()
    assert stored(spark, root) == {**expected, "6": "Closed", "2": "page 5"}


def test_pages_that_arrive_late_do_not_win(spark, root, tmp_path):
    folder = tmp_path / "feed"
    write_page(folder, 9, [record(1, 2, "page 9")])
    stream_pages(spark, str(folder), root, f"{root}/progress", run_no=1).awaitTermination()
    write_page(folder, 8, [record(1, 1, "page 8"), record(2, 1)])
    stream_pages(spark, str(folder), root, f"{root}/progress", run_no=1).awaitTermination()
    assert stored(spark, root) == {"1": "page 9", "2": "Closed"}


def test_backfill_passes_on_good_data(spark, root, pages):
    report = backfill(
        spark, str(pages), root, start_date="2026-07-01", end_date="2026-07-31", test=True
    )
    assert report.count() == 65
    assert report.where("not passed").count() == 0
    assert set(stored(spark, root, "raw_311_requests_probe")) == set("12345")
    assert Warehouse.opened(spark, root).table("fct_monthly_metrics").first()["created_count"] == 5
    # A reset empties the probe table first.
    backfill(
        spark,
        str(pages),
        root,
        start_date="2026-07-04",
        end_date="2026-07-04",
        test=True,
        reset=True,
    )
    assert set(stored(spark, root, "raw_311_requests_probe")) == {"1", "5"}
    assert Warehouse.opened(spark, root).table("fct_monthly_metrics").first()["created_count"] == 2


def test_backfill_stops_on_violations_after_writing_the_report(spark, root, tmp_path):
    folder = tmp_path / "bad"
    write_page(folder, 0, [record(1, 1, agency=None, agency_name=" "), record(2, 1, borough="X")])
    with pytest.raises(FailedTests, match="2 model tests failed") as raised:
        backfill(spark, str(folder), root, start_date="2026-07-01", end_date="2026-07-02")
    with pytest.raises(RuntimeError, match="no published warehouse"):
        Warehouse.opened(spark, root)
    failed = spark.read.parquet(str(raised.value).split("see ")[1]).where("not passed").collect()
    assert {r["test"]: r["failures"] for r in failed} == {
        "accepted_values stg_311_requests.borough": 1,
        "relationships fct_311_complaint.agency_id dim_agency.agency_id": 1,
    }


def test_what_failed_is_kept_beside_the_report(spark, root, tmp_path):
    folder = tmp_path / "bad"
    write_page(folder, 0, [record(1, 1, agency=None, agency_name=" "), record(2, 1, borough="X"), record(3, 2, borough="X")])
    with pytest.raises(FailedTests) as raised:
        backfill(spark, str(folder), root, start_date="2026-07-01", end_date="2026-07-02")
    report = str(raised.value).split("see ")[1]
    found = spark.read.parquet(report.replace("test_report", "test_failures")).collect()
    by_test = {r["test"]: (r["value"], r["row_count"]) for r in found}
    assert by_test["accepted_values stg_311_requests.borough"] == ("X", 2)
    assert by_test["relationships fct_311_complaint.agency_id dim_agency.agency_id"][1] == 1
    assert len(by_test) == len(found) == 2


def test_backfill_of_nothing_stops_at_the_gate(spark, root, pages):
    with pytest.raises(RuntimeError, match="is empty"):
        backfill(spark, str(pages), root, start_date="2020-01-01", end_date="2020-01-02")
    with pytest.raises(ValueError, match="start_date and end_date"):
        backfill(spark, str(pages), root, start_date="2020-01-01", end_date="")


def test_a_failed_build_leaves_the_published_one(spark, root, pages, tmp_path):
    dates = {"start_date": "2026-07-01", "end_date": "2026-07-31"}
    backfill(spark, str(pages), root, **dates)
    write_page(tmp_path / "bad", 9, [record(9, 9, borough="X")])
    with pytest.raises(FailedTests):
        backfill(spark, str(tmp_path / "bad"), root, **dates)
    found = Warehouse.opened(spark, root)
    assert {found.table(name).count() for name in ("stg_311_requests", "int_complaints_flagged")} == {5}


def test_a_built_warehouse_is_opened_without_writing(spark, root, pages):
    from wardbook.sources.folders import names

    backfill(spark, str(pages), root, start_date="2026-07-01", end_date="2026-07-31")
    before = [(f, names(spark, f"{root}/models/{f}")) for f in names(spark, f"{root}/models")]
    session = spark.newSession()
    found = Warehouse.opened(session, root)
    found.create_views()
    assert {t.name for t in session.catalog.listTables()} == set(MODELS)
    assert session.sql("SELECT sum(created_count) FROM fct_daily_metrics").first()[0] == 5
    assert [(f, names(spark, f"{root}/models/{f}")) for f in names(spark, f"{root}/models")] == before


def test_rows_outside_of_a_window_arrive_later(spark, root, pages):
    def run(**dates):
        stream_pages(spark, str(pages), root, f"{root}/progress", run_no=1, **dates).awaitTermination()
        return stored(spark, root)

    assert set(run(start_date="2026-07-02", end_date="2026-07-02")) == {"2", "3"}
    assert set(run(target_date="2026-07-03", offset_days=2)) == {"1", "2", "3", "4", "5"}
    whole = run()
    stream_pages(spark, str(pages), f"{root}/once", f"{root}/once/progress", run_no=1).awaitTermination()
    assert whole == stored(spark, f"{root}/once")
    with pytest.raises(ValueError, match="go together"):
        run(start_date="2026-07-02")


def test_many_pages_a_file_by_batch_and_by_stream(spark, root, tmp_path):
    from json import dumps

    for i, day in enumerate((1, 2)):
        lines = [dumps({"page_no": 2 * i + j, "rows": [record(j, day, f"page {2 * i + j}")]}) for j in (0, 1)]
        (tmp_path / f"feed-{i}.jsonl").write_text("\n".join(lines))
    expected = {"0": "page 2", "1": "page 3"}
    ingest(spark, str(tmp_path), root, many_pages_a_file=True)
    assert stored(spark, root) == expected
    stream_pages(
        spark, str(tmp_path), f"{root}/s", f"{root}/s/progress", pages_per_batch=1, many_pages_a_file=True, run_no=1
    ).awaitTermination()
    assert stored(spark, f"{root}/s") == expected
