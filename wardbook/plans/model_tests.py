"""The declared tests of the models, and the report over all of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardbook.operators import quality

# Which columns each test covers.
NOT_NULL = {
    "stg_311_requests": ["unique_key", "created_date", "borough"],
    "dim_date": ["date_id", "full_date"],
    "dim_location": ["location_id", "location_key"],
    "dim_agency": ["agency_id"],
    "dim_complaint_type": ["complaint_type_id"],
    "dim_status": ["status_id", "status"],
    "dim_channel": ["channel_id", "open_data_channel_type"],
    "fct_311_complaint": ["complaint_key", "unique_key"],
    "fct_311_complaint_text": ["unique_key"],
    "int_complaints_flagged": ["unique_key", "created_at"],
    "fct_daily_metrics": ["metric_date"],
    "fct_borough_complaint_mix": ["borough", "complaint_type", "total_requests"],
    "fct_monthly_metrics": [
        "month_start",
        "created_count",
        "closed_count",
        "net_case_flow",
        "invalid_time_order_count",
        "missing_critical_fields_count",
        "missing_location_id_count",
        "missing_complaint_type_id_count",
        "missing_agency_id_count",
        "missing_status_id_count",
        "closed_at_status_mismatch_count",
    ],
}
# Columns without a value twice.
UNIQUE = {
    "stg_311_requests": ["unique_key"],
    "dim_date": ["date_id", "full_date"],
    "dim_location": ["location_id", "location_key"],
    "dim_agency": ["agency_id"],
    "dim_complaint_type": ["complaint_type_id"],
    "dim_status": ["status_id", "status"],
    "dim_channel": ["channel_id", "open_data_channel_type"],
    "fct_311_complaint": ["complaint_key", "unique_key"],
    "fct_311_complaint_text": ["unique_key"],
    "int_complaints_flagged": ["unique_key"],
    "fct_daily_metrics": ["metric_date"],
    "fct_monthly_metrics": ["month_start"],
}
# Columns without a combination twice.
COMPOSITE_UNIQUE = {
    "dim_agency": ["agency", "agency_name"],
    "dim_complaint_type": ["complaint_type", "descriptor", "descriptor_2"],
    "fct_borough_complaint_mix": ["borough", "complaint_type"],
}
# The boroughs.
ACCEPTED_BOROUGHS = [
    "STATEN ISLAND",
    "BRONX",
    "MANHATTAN",
    "UNSPECIFIED",
    "BROOKLYN",
    "QUEENS",
]
# Child, its column, parent, its column.
RELATIONSHIPS = [
    ("fct_311_complaint", "created_date_id", "dim_date", "date_id"),
    ("fct_311_complaint", "closed_date_id", "dim_date", "date_id"),
    ("fct_311_complaint", "resolution_action_date_id", "dim_date", "date_id"),
    ("fct_311_complaint", "location_id", "dim_location", "location_id"),
    ("fct_311_complaint", "agency_id", "dim_agency", "agency_id"),
    ("fct_311_complaint", "complaint_type_id", "dim_complaint_type", "complaint_type_id"),
    ("fct_311_complaint", "status_id", "dim_status", "status_id"),
    ("fct_311_complaint", "channel_id", "dim_channel", "channel_id"),
    ("fct_311_complaint_text", "unique_key", "fct_311_complaint", "unique_key"),
]


MODEL_NAMES = list(NOT_NULL)


def relationship(child: str, column: str, parent: str, field: str) -> str:
    return f"relationships {child}.{column} {parent}.{field}"


def _composite(model: str) -> str:
    return f"{model} {' '.join(COMPOSITE_UNIQUE[model])}"


def _tests() -> dict[str, tuple[str, str | None]]:
    """The tests by value: whose rows each counts, and the parent, if it has one."""
    outside = "stg_311_requests.borough outside"
    return {
        **{f"unique {model}.{c}": (f"{model}.{c}", None) for model, columns in UNIQUE.items() for c in columns},
        **{f"unique_composite_key {model}": (_composite(model), None) for model in COMPOSITE_UNIQUE},
        "accepted_values stg_311_requests.borough": (outside, None),
        **{relationship(*r): (f"{r[0]}.{r[1]}", f"{r[2]}.{r[3]}") for r in RELATIONSHIPS},
    }


TESTS = _tests()
BY_VALUE = list(TESTS)


def _groups(tests: dict[str, tuple[str, str | None]]) -> list[list[str]]:
    """The columns of these tests, those that are compared with each other together.

    A column is in one group, whatever tests it is in, so its values are shuffled once. Rows
    carry the places of group and column in these lists, not their names, to the shuffle.
    """
    parent_of = {column: parent for column, parent in tests.values() if parent}
    groups: dict[str, list[str]] = {}
    for column in dict.fromkeys(c for both in tests.values() for c in both if c):
        groups.setdefault(parent_of.get(column, column), []).append(column)
    return list(groups.values())


def _value(column: str) -> Column:
    """The text that a column's rows are counted by."""
    model, _, name = column.partition(".")
    if column == "stg_311_requests.borough outside":
        return F.when(~F.col("borough").isin(ACCEPTED_BOROUGHS), F.col("borough"))
    if name:
        return F.col(name).cast("string")
    return F.to_json(F.array(*[F.col(c).cast("string") for c in COMPOSITE_UNIQUE[column.split(" ")[0]]]))


def values(tables: dict[str, DataFrame], unique: bool = True) -> DataFrame:
    """(test, value, rows, parents) of the tests by value: uniqueness and accepted values,
    if unique, and relationships.

    Every table is scanned once: each row gives a value for each column, and all values are
    grouped together. Rows of one value are counted before the shuffle, so one that a
    third of all rows carry is a row a task. NULLs are in no test by value.
    """
    tests = {t: both for t, both in TESTS.items() if unique or both[1]}
    groups = _groups(tests)
    place = {c: (g, i) for g, columns in enumerate(groups) for i, c in enumerate(columns)}
    parts = []
    for model in MODEL_NAMES:
        own = [
            F.struct(
                F.lit(g).cast("smallint").alias("group"),
                _value(c).alias("value"),
                F.lit(i).cast("smallint").alias("column"),
            )
            for c, (g, i) in place.items()
            if model in (c.split(".")[0], c.split(" ")[0])
        ]
        if own:
            parts.append(tables[model].select(F.inline(F.array(*own))))
    most = max(len(columns) for columns in groups)
    counted = (
        reduce(DataFrame.unionByName, parts)
        .where("value IS NOT NULL")
        .groupBy("group", "value")
        .agg(*[F.count_if(F.col("column") == i).alias(f"n{i}") for i in range(most)])
    )

    def count(column: str | None) -> Column:
        return F.col(f"n{place[column][1]}") if column else F.lit(0).cast("bigint")

    told = [
        F.array(
            *[
                F.struct(F.lit(t).alias("test"), count(c).alias("rows"), count(parent).alias("parents"))
                for t, (c, parent) in tests.items()
                if place[c][0] == g
            ]
        )
        for g in range(len(groups))
    ]
    of_group = reduce(lambda found, g: found.when(F.col("group") == g, told[g]), range(1, len(told)), F.when(F.col("group") == 0, told[0]))
    return counted.select("value", F.inline(of_group)).where("rows > 0 OR parents > 0").select("test", "value", "rows", "parents")


def orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """(test, from_field, row_count): child values of the relationships without a parent."""
    found = values(tables, unique=False).where("rows > 0 AND parents = 0")
    return found.select("test", F.col("value").alias("from_field"), F.col("rows").alias("row_count"))


def _by_row(model: str) -> dict[str, Column]:
    """The tests of a model row by row: what fails one."""
    tests = {f"not_null {model}.{c}": F.col(c).isNull() for c in NOT_NULL[model]}
    if model == "int_complaints_flagged":
        tests[f"time_order_flag {model}"] = quality.wrong_time_order_flag()
    return tests


def _conditions(tables: dict[str, DataFrame]) -> DataFrame:
    """(test, failures) of the tests row by row, one scan a table."""
    return reduce(DataFrame.unionByName, [quality.counted(tables[m], _by_row(m)) for m in MODEL_NAMES])


def offending(tables: dict[str, DataFrame]) -> DataFrame:
    """(test, value, row_count): what failed each test that failed.

    For the tests by value, the value and how many rows hold it; for those row by row, the
    row as JSON, once for each such row; for the shares, their sum.
    """
    relationship_, accepted = F.col("test").startswith("relationships"), F.col("test").startswith("accepted_values")
    fails = F.when(relationship_, (F.col("parents") == 0) & (F.col("rows") > 0)).otherwise(accepted | (F.col("rows") > 1))
    parts = [values(tables).where(fails).select("test", "value", F.col("rows").alias("row_count"))]
    for model in MODEL_NAMES:
        failed = [F.when(condition, F.lit(test)) for test, condition in _by_row(model).items()]
        found = tables[model].select(
            F.explode(F.array_compact(F.array(*failed))).alias("test"), F.to_json(F.struct("*")).alias("value")
        )
        parts.append(found.withColumn("row_count", F.lit(1).cast("bigint")))
    shares = quality.shares_off_total(tables["fct_borough_complaint_mix"])
    name = F.lit("shares_total_100 fct_borough_complaint_mix").alias("test")
    parts.append(shares.select(name, F.col("pct_sum").cast("string").alias("value"), F.lit(1).cast("bigint").alias("row_count")))
    return reduce(DataFrame.unionByName, parts)


def report(tables: dict[str, DataFrame]) -> DataFrame:
    """(test, failures, passed) of every declared test, as one job.

    A relationship counts the child rows without a parent, the other tests the rows
    or values their check returns.
    """
    failing = F.when(F.col("test").startswith("relationships"), F.when(F.col("parents") == 0, F.col("rows"))).when(
        F.col("test").startswith("accepted_values") | (F.col("rows") > 1), F.lit(1)
    )
    by_value = values(tables).groupBy("test").agg(F.sum(failing).alias("failures"))
    # Tests that no value speaks to pass; the declared names are a row each.
    some = tables["stg_311_requests"].sparkSession.range(1)
    declared = some.select(F.explode(F.array(*[F.lit(n) for n in BY_VALUE])).alias("test"))
    by_value = declared.join(by_value, "test", "left")
    shares = quality.shares_off_total(tables["fct_borough_complaint_mix"]).agg(F.count("*").alias("failures"))
    parts = [
        _conditions(tables),
        by_value.select("test", F.coalesce("failures", F.lit(0)).alias("failures")),
        shares.select(F.lit("shares_total_100 fct_borough_complaint_mix").alias("test"), "failures"),
    ]
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("failures") == 0)
