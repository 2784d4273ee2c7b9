"""Service requests derived from the test tables, one per order or per event.

The rules are those of FIXTURES.md: they put blanks, mixed case, bad numbers, missing
values and reversed times into the raw columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardbook.schema import RAW_COLUMNS, TIMESTAMP_COLUMNS
from wardbook.sources.pages import PAGE_SIZE

DAY_SECONDS = 86_400
MONTH_SECONDS = 30 * DAY_SECONDS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _after(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds.cast("int"), ts)


def _row_of(table: DataFrame, k: Column) -> Column:
    """The key, from 0 up, of the row of a lookup table that belongs to k."""
    return k % table.agg(F.count("*")).scalar()


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def raw_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw request per order, over all orders."""
    orders, customer, nation, region = (
        read_table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region")
    )
    supplier, part = (read_table(spark, sf_dir, t) for t in ("supplier", "part"))
    # The narrow orders are spread over the tasks that then make wide rows and JSON of them, all
    # that the session has: adaptive execution would join them by the bytes of narrow rows. Each
    # lookup joins by itself, because what a join of lookups returns counts as far larger than it
    # is, and the orders would be sent to the few tasks that read it.
    base = (
        orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
        .repartition(_tasks(spark), "o_orderkey")
        .withColumn("k", F.col("o_orderkey"))
        .withColumns({"its_supplier": _row_of(supplier, F.col("k")), "its_part": _row_of(part, F.col("k"))})
        .join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(supplier, F.col("its_supplier") == F.col("s_suppkey"))
        .join(part, F.col("its_part") == F.col("p_partkey"))
    )

    k = F.col("k")
    text = k.cast("string")
    nothing = F.lit(None).cast("string")
    nation_key = F.col("n_nationkey")

    def every(n: int) -> Column:
        return k % n == 0

    def blank_or(n: int, blank: str, otherwise: Column) -> Column:
        return F.when(every(n), F.lit(blank)).otherwise(otherwise)

    created = _after(F.col("o_orderdate"), (k * 7919) % DAY_SECONDS)
    status = F.col("o_orderstatus")
    closed = F.when(
        (status == "F") | every(20), _after(created, (k * 104729) % MONTH_SECONDS)
    ).when((status == "P") & (k % 10 == 1), _after(created, -3600 * (1 + k % 24)))

    dated = base.withColumns({"created_date": created, "closed_date": closed})
    columns = {
        "unique_key": text,
        "created_date": F.col("created_date"),
        "closed_date": F.col("closed_date"),
        "resolution_action_updated_date": F.when(
            ~every(7), F.coalesce("closed_date", _after(F.col("created_date"), F.lit(DAY_SECONDS)))
        ),
        "agency": F.when(
            ~every(89), F.concat(F.upper(F.substring("s_name", 1, 3)), (k % 10).cast("string"))
        ),
        "agency_name": blank_or(89, "  ", F.concat(F.lit("  "), "s_name", F.lit(" "))),
        "complaint_type": F.when(every(101), nothing)
        .when(every(2), F.lower("p_type"))
        .otherwise(F.concat(F.lit(" "), "p_type")),
        "descriptor": F.col("p_brand"),
        "descriptor_2": blank_or(3, "", F.col("p_name")),
        "status": F.when(every(97), "")
        .when(status == "F", " Closed ")
        .when(status == "O", "open")
        .otherwise("In Progress"),
        "resolution_description": blank_or(5, "  ", F.concat(F.lit("text "), text, F.lit(" "))),
        "open_data_channel_type": F.when(every(4), "phone")
        .when(k % 4 == 1, "ONLINE ")
        .when(k % 4 == 2, " mobile"),
        "incident_address": F.concat((k % 300).cast("string"), F.lit(" main st")),
        "street_name": F.lit(" Main St"),
        "cross_street_1": F.when(every(2), "First Ave"),
        "cross_street_2": blank_or(3, " ", F.lit("second ave")),
        "intersection_street_1": nothing,
        "intersection_street_2": nothing,
        "landmark": F.when(every(11), " Old Mill "),
        "city": F.col("n_name"),
        "borough": F.when(every(50), " ")
        .when(every(53), nothing)
        .when(F.col("r_name") == "AFRICA", "Bronx")
        .when(F.col("r_name") == "AMERICA", "Brooklyn ")
        .when(F.col("r_name") == "ASIA", "MANHATTAN")
        .when(F.col("r_name") == "EUROPE", "queens")
        .otherwise(" Staten Island"),
        "incident_zip": (10000 + nation_key).cast("string"),
        "community_board": F.concat((k % 18).cast("string"), F.lit(" "), F.lower("r_name")),
        "council_district": (k % 51).cast("string"),
        "police_precinct": F.concat(F.lit("Precinct "), (k % 77).cast("string")),
        "park_borough": F.upper("r_name"),
        "park_facility_name": F.lit("Unspecified"),
        "taxi_pick_up_location": nothing,
        "bbl": (1_000_000_000 + k).cast("string"),
        "x_coordinate_state_plane": (900_000 + nation_key).cast("string"),
        "y_coordinate_state_plane": F.concat(F.lit(" "), (100_000 + nation_key).cast("string")),
        "latitude": blank_or(
            33, "bad", F.concat(F.lit("40."), (700 + nation_key).cast("string"))
        ),
        "longitude": F.when(
            ~every(37), F.concat(F.lit("-73."), (900 + nation_key).cast("string"))
        ),
    }
    rows = dated.select(*[e.alias(name) for name, e in columns.items()])
    located = rows.withColumn("location", _json(["latitude", "longitude"]))
    return located.withColumn("raw_json", record_json()).select(*RAW_COLUMNS)


def _iso(ts: Column) -> Column:
    # date_format would take NTZ times through the session zone.
    return F.replace(ts.cast("string"), F.lit(" "), F.lit("T"))


def _json(columns: list[str | Column]) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def record_json() -> Column:
    """A raw request as the JSON record a page would carry."""
    return _json(
        [
            _iso(F.col(c)).alias(c) if c in TIMESTAMP_COLUMNS else F.col(c)
            for c in RAW_COLUMNS
            if c != "raw_json"
        ]
    )


def order_pages(raw: DataFrame) -> DataFrame:
    """(page_no, value): one page per request, holding a first and a final version of it.

    The first version has no closing time and status New. Pages are built row by row,
    so nothing is collected whatever the number of orders.
    """
    final = raw.select("*", F.col("raw_json").alias("final"))
    first = final.withColumns(
        {"closed_date": F.lit(None).cast("timestamp_ntz"), "status": F.lit("New")}
    )
    return first.select(
        F.col("unique_key").cast("bigint").alias("page_no"),
        F.concat(F.lit("["), record_json(), F.lit(","), "final", F.lit("]")).alias("value"),
    )


def event_records(spark: SparkSession, sf_dir: str, key: Column) -> DataFrame:
    """(page_no, pos, record): one JSON request record per event, PAGE_SIZE events a page."""
    event_id, kind = F.col("event_id"), F.col("event_type")
    ts = F.col("ts")
    fields = {
        "unique_key": key,
        "created_date": _iso(ts),
        "closed_date": F.when(
            kind == "purchase", _iso(_after(ts, F.lit(5400)))
        ).when(kind == "error", _iso(_after(ts, F.lit(-60)))),
        "agency": kind,
        "agency_name": F.concat(F.lit("Desk "), kind),
        "complaint_type": F.concat(kind, F.lit(" request")),
        "descriptor": F.col("props"),
        "status": F.when(kind == "purchase", "Closed").otherwise("Open"),
        "open_data_channel_type": F.lit("online"),
        "borough": F.when(kind == "view", "Queens").when(kind == "click", "Bronx"),
        "incident_zip": (10000 + F.col("user_id") % 100).cast("string"),
        "latitude": F.lit("40.5"),
        "longitude": F.lit("-73.25"),
        "location": F.struct(F.col("value").alias("reading")),
        "source_field": F.lit("kept in raw_json only"),
    }
    events = read_table(spark, sf_dir, "events").repartition(_tasks(spark), "event_id")
    return events.select(
        F.floor(event_id / PAGE_SIZE).cast("bigint").alias("page_no"),
        (event_id % PAGE_SIZE).alias("pos"),
        F.to_json(F.struct(*[e.alias(name) for name, e in fields.items()])).alias("record"),
    )
