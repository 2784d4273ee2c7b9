"""Column expressions on hand-made edge rows."""

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wardbook.functions.dates import (
    calendar_columns,
    date_id,
    day,
    elapsed_seconds,
    month_start,
    utc_timestamp,
)
from wardbook.functions.keys import ATTRIBUTE_NULL, hashed, surrogate_keys
from wardbook.functions.numbers import decimal_text, safe_decimal, share_percent
from wardbook.functions.text import clean_text, clean_upper, clean_with_default


def evaluate(spark, values, schema, *expressions):
    frame = spark.createDataFrame(values, schema)
    return [tuple(r) for r in frame.select(*expressions).collect()]


def column(spark, values, schema, expression):
    return [r[0] for r in evaluate(spark, [(v,) for v in values], schema, expression)]


def test_clean_text_strips_every_unicode_blank(spark):
    texts = ["\t a b \n", " x　", "  ", "", "  ", None, "Main st"]
    assert column(spark, texts, "v string", clean_text(F.col("v"))) == [
        "a b", "x", None, None, None, None, "Main st",
    ]
    assert column(spark, texts, "v string", clean_upper(F.col("v"))) == [
        "A B", "X", None, None, None, None, "MAIN ST",
    ]


def test_clean_with_default(spark):
    texts = [" bronx ", "\t", None]
    cleaned = column(spark, texts, "v string", clean_with_default(F.col("v"), "UNSPECIFIED"))
    assert cleaned == ["bronx", "UNSPECIFIED", "UNSPECIFIED"]


def test_safe_decimal(spark):
    texts = ["abc", "", "NaN", "1e400", "4.07e1", "+5", "0.0000000015", None, " 40.5 "]
    assert column(spark, texts, "v string", safe_decimal(F.col("v"))) == [
        None, None, None, None, Decimal("40.7"), Decimal(5), Decimal("0.000000002"), None,
        Decimal("40.5"),
    ]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_decimal_text_is_plain_and_shortest(spark, ansi):
    texts = [
        "40.7128", "100", "0", "-0.0", "0.000000001", "-0.00000012", "-73.9", "0.5", "1000000",
    ]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        values = column(spark, texts, "v string", decimal_text(safe_decimal(F.col("v"))))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert values == [
        "40.7128", "100", "0", "0", "0.000000001", "-0.00000012", "-73.9", "0.5", "1000000",
    ]


def test_share_percent(spark):
    pairs = [(1, 3), (2, 3), (0, 5), (1, 0), (1, 1), (5, 8), (1, 16000)]
    shares = evaluate(spark, pairs, "n long, t long", share_percent(F.col("n"), F.col("t")))
    assert [s[0] for s in shares] == [
        Decimal(x) if x else None
        for x in ("33.33", "66.67", "0.00", None, "100.00", "62.50", "0.01")
    ]


def test_utc_timestamp(spark, zone):
    texts = [
        "2026-07-01T00:12:34.000",
        "2026-03-08T02:30:00",
        "2026-07-01T00:00:00Z",
        "2026-07-01T00:00:00.25+05:30",
        "2026-11-01T05:30:00-00:00",
        "2026-11-01T06:30:00Z",
        "2026-07-01",
        None,
    ]
    assert column(spark, texts, "v string", utc_timestamp(F.col("v"))) == [
        dt.datetime(2026, 7, 1, 0, 12, 34),
        dt.datetime(2026, 3, 8, 2, 30),
        dt.datetime(2026, 7, 1),
        dt.datetime(2026, 6, 30, 18, 30, 0, 250000),
        dt.datetime(2026, 11, 1, 5, 30),
        dt.datetime(2026, 11, 1, 6, 30),
        dt.datetime(2026, 7, 1),
        None,
    ]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("text", ["not a time", "", "2026-13-01T00:00:00", "2026-07-01T25:00:00Z"])
def test_bad_timestamp_text_fails(spark, ansi, text):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match=f"No timestamp: {text}"):
            column(spark, [text], "v string", utc_timestamp(F.col("v")))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_elapsed_seconds_ignores_the_session_zone(spark, zone):
    pairs = [
        (dt.datetime(1995, 3, 13, 3, 17, 46), dt.datetime(1995, 4, 2, 2, 4, 32)),
        (dt.datetime(2024, 1, 1, 0, 0, 0, 900000), dt.datetime(2024, 1, 1, 0, 0, 2, 100000)),
        (dt.datetime(2024, 1, 1, 0, 0, 2, 100000), dt.datetime(2024, 1, 1, 0, 0, 0, 900000)),
        (dt.datetime(2024, 1, 1), None),
    ]
    seconds = evaluate(
        spark, pairs, "a timestamp_ntz, b timestamp_ntz", elapsed_seconds(F.col("a"), F.col("b"))
    )
    assert [s[0] for s in seconds] == [1723606, 1, -1, None]


def test_days_and_months_ignore_the_session_zone(spark, zone):
    times = [dt.datetime(1995, 4, 2, 2, 30), dt.datetime(2024, 12, 31, 23, 59, 59)]
    assert column(spark, times, "v timestamp_ntz", day(F.col("v"))) == [
        dt.date(1995, 4, 2), dt.date(2024, 12, 31),
    ]
    assert column(spark, times, "v timestamp_ntz", month_start(F.col("v"))) == [
        dt.date(1995, 4, 1), dt.date(2024, 12, 1),
    ]
    assert column(spark, times, "v timestamp_ntz", date_id(day(F.col("v")))) == [19950402, 20241231]


def test_calendar_columns(spark, zone):
    columns = calendar_columns(F.col("d"))
    rows = evaluate(
        spark, [(dt.date(2024, 2, 4),), (dt.date(2024, 2, 5),)], "d date", *columns.values()
    )
    assert rows == [
        (20240204, dt.date(2024, 2, 4), 4, 2, "February", 1, 2024, 7, "Sunday", True),
        (20240205, dt.date(2024, 2, 5), 5, 2, "February", 1, 2024, 1, "Monday", False),
    ]


def test_keys_collide_where_joined_text_is_equal(spark):
    pairs = [("A|", "B"), ("A", "|B"), (None, "B"), ("<NULL>", "B"), (None, None)]
    keys = evaluate(
        spark,
        pairs,
        "a string, b string",
        hashed([F.col("a"), F.col("b")], ATTRIBUTE_NULL),
    )
    first, second, third, fourth, fifth = (k[0] for k in keys)
    assert first == second
    assert third == fourth
    assert fifth == hashlib.md5(b"<NULL>|<NULL>").hexdigest()


def test_location_key_text(spark):
    row = {
        "city": "QUEENS",
        "borough": "QUEENS",
        "latitude": Decimal("40.7128"),
        "longitude": Decimal("-73.900000000"),
    }
    text_columns = [
        "city", "borough", "landmark", "street_name", "incident_zip", "park_borough",
        "cross_street_1", "cross_street_2", "intersection_street_1", "intersection_street_2",
        "incident_address", "park_facility_name", "x_coordinate_state_plane",
        "y_coordinate_state_plane", "community_board", "council_district", "agency",
        "agency_name", "complaint_type", "descriptor", "descriptor_2", "status",
        "open_data_channel_type",
    ]
    schema = ", ".join(f"{c} string" for c in text_columns)
    schema += ", latitude decimal(38,9), longitude decimal(38,9)"
    values = tuple(row.get(c) for c in text_columns) + (row["latitude"], row["longitude"])
    keys = surrogate_keys()
    ((location, status),) = evaluate(
        spark, [values], schema, keys["location_key"], keys["status_key"]
    )
    joined = "QUEENS|QUEENS|||||||||||40.7128|-73.9||||"
    assert location == hashlib.md5(joined.encode()).hexdigest()
    assert status == hashlib.md5(b"<NULL>").hexdigest()
