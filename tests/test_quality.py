from collections import Counter
from decimal import Decimal

import pytest
from rows import at, raw_frame

from wardbook.operators import quality
from wardbook.plans import model_tests
from wardbook.plans.warehouse import MODELS, Warehouse


def test_nulls(spark):
    rows = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    counts = {r[0]: r[1] for r in quality.null_counts(rows, ["a", "b"]).collect()}
    assert counts == {"a": 1, "b": 2}


def test_null_counts_of_no_rows(spark):
    rows = spark.createDataFrame([], "a int")
    assert [tuple(r) for r in quality.null_counts(rows, ["a"]).collect()] == [("a", 0)]


def test_duplicate_nulls_fail_the_composite_check_only(spark):
    rows = spark.createDataFrame([(None, None), (None, None), ("x", "y")], "a string, b string")
    assert quality.duplicates(rows, "a").count() == 0
    assert [tuple(r) for r in quality.composite_duplicates(rows, ["a", "b"]).collect()] == [
        (None, None, 2)
    ]


def test_duplicates(spark):
    rows = spark.createDataFrame([("x",), ("x",), ("y",)], "a string")
    assert [tuple(r) for r in quality.duplicates(rows, "a").collect()] == [("x", 2)]


def test_accepted_values(spark):
    rows = spark.createDataFrame([("A",), ("B",), ("B",), (None,)], "a string")
    assert [tuple(r) for r in quality.unaccepted_values(rows, "a", ["A"]).collect()] == [("B", 2)]
    assert quality.unaccepted_values(rows, "a", ["A", "B"]).count() == 0


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    assert [tuple(r) for r in quality.orphans(child, "fk", parent, "id").collect()] == [(2, 2)]


@pytest.mark.parametrize(
    "shares, fails", [(["99.00"], False), (["98.99"], True), (["60", "41.01"], True), ([], False)]
)
def test_shares(spark, shares, fails):
    mix = spark.createDataFrame(
        [(Decimal(s),) for s in shares], "pct_of_all_requests decimal(10,2)"
    )
    assert (quality.shares_off_total(mix).count() == 1) is fails


def test_time_order_flag(spark):
    rows = spark.createDataFrame(
        [
            ("right 1", at(2), at(1), 1),
            ("wrong 0", at(2), at(1), 0),
            ("right 0", at(1), at(2), 0),
            ("wrong 1", at(1), at(2), 1),
            ("open", at(1), None, 0),
            ("open wrong", None, at(1), 1),
        ],
        "unique_key string, created_at timestamp_ntz, closed_at timestamp_ntz,"
        " is_invalid_time_order int",
    )
    found = {r["unique_key"] for r in quality.wrong_time_order_flags(rows).collect()}
    assert found == {"wrong 0", "wrong 1", "open wrong"}


def test_the_declared_suite_is_complete():
    count = sum(map(len, model_tests.NOT_NULL.values()))
    count += sum(map(len, model_tests.UNIQUE.values()))
    count += len(model_tests.COMPOSITE_UNIQUE) + len(model_tests.RELATIONSHIPS)
    # Accepted boroughs, share total, time-order flag.
    assert count + 3 == 65


def test_values_of_a_column_are_shuffled_once_for_all_its_tests(spark, root):
    columns = [c for group in model_tests._groups(model_tests.TESTS) for c in group]
    assert len(columns) == len(set(columns)) == 29
    day = {"created_date": at(1), "closed_date": at(2), "status": "Open", "agency": "A", "borough": "Nowhere"}
    keys = ["1", "1", "2", None, "3"]
    warehouse = Warehouse(root, raw_frame(spark, *[{**day, "unique_key": k, "city": f"c{i % 2}"} for i, k in enumerate(keys)]))
    tables = {name: warehouse.table(name) for name in MODELS}
    # A child without a parent, and parents without children.
    tables["dim_status"] = tables["dim_status"].where("false")
    tables["fct_311_complaint_text"] = tables["fct_311_complaint_text"].where("unique_key = '1'")
    found = {(r["test"], r["value"]): (r["rows"], r["parents"]) for r in model_tests.values(tables).collect()}

    def counts(model, column):
        return Counter(str(r[0]) for r in tables[model].select(column).collect() if r[0] is not None)

    for model, unique in model_tests.UNIQUE.items():
        for c in unique:
            test = f"unique {model}.{c}"
            assert {v: n for (t, v), (n, _) in found.items() if t == test} == counts(model, c), test
    for child, column, parent, field in model_tests.RELATIONSHIPS:
        test, rows, parents = model_tests.relationship(child, column, parent, field), counts(child, column), counts(parent, field)
        wanted = {v: (rows[v], parents[v]) for v in rows.keys() | parents.keys()}
        assert {v: n for (t, v), n in found.items() if t == test} == wanted, test
    assert found["accepted_values stg_311_requests.borough", "NOWHERE"] == (5, 0)
