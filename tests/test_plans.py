"""What the physical plans must look like at any size."""

import re

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardbook.plans import core, registry
from wardbook.plans.flags import complaints_flagged
from wardbook.plans.marts import borough_mix
from wardbook.plans.staging import stage_requests
from wardbook.schema import RAW_SCHEMA
from wardbook.sources.folders import shared_folder

SF_DIR = f"{TESTDATA}/sf0.001"
NAMES = list(registry.bind())


@pytest.fixture(scope="module")
def queries():
    return registry.bind()


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def executed(frame):
    """The plan as adaptive execution left it."""
    execution = frame._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_query_leaves_the_jvm_or_crosses_rows(spark, queries, name):
    plan = physical(queries[name](spark, SF_DIR))
    for operator in (
        "CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "MapPartitions",
    ):
        assert operator not in plan


@pytest.mark.parametrize("name", NAMES)
def test_only_totals_and_limits_go_through_one_task(spark, queries, name):
    plan = physical(queries[name](spark, SF_DIR))
    for match in re.finditer(r"Exchange SinglePartition.*\n(.*)\n", plan):
        assert re.search(r"HashAggregate\(keys=\[\]|LocalLimit", match.group(1))


@pytest.fixture
def raw_path(spark, root):
    """A raw table on disk, so that scans show what they read."""
    spark.createDataFrame([], RAW_SCHEMA).write.parquet(f"{root}/raw")
    return f"{root}/raw"


def scans(plan):
    return re.findall(r"ReadSchema: struct<(.*?)>", plan)


def test_staging_is_one_projection(spark, raw_path):
    plan = physical(stage_requests(spark.read.schema(RAW_SCHEMA).parquet(raw_path)))
    assert "Exchange" not in plan
    assert plan.count("FileScan") == 1


def test_scans_read_only_what_a_model_needs(spark, raw_path):
    stg = stage_requests(spark.read.schema(RAW_SCHEMA).parquet(raw_path))
    assert scans(physical(core.dim_status(stg))) == ["status:string"]
    columns = {c.split(":")[0] for c in scans(physical(core.dim_date(stg)))[0].split(",")}
    assert columns == {"created_date", "closed_date", "resolution_action_updated_date"}


def test_cleaning_is_done_once_per_column(spark, raw_path):
    stg = stage_requests(spark.read.schema(RAW_SCHEMA).parquet(raw_path))
    plan = physical(stg.select("agency", "agency_key"))
    assert len(re.findall(r"upper\(agency#", plan)) == 1


def test_staging_compiles_to_methods_the_jvm_will_compile(spark, raw_path):
    """HotSpot leaves methods of more than 8,000 bytes to the interpreter."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stg = stage_requests(spark.read.schema(RAW_SCHEMA).parquet(raw_path))
        code = spark._jvm.PythonSQLUtils.explainString(stg._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000


def test_the_status_lookup_is_broadcast_by_its_file_size(spark, root):
    facts = spark.range(1000).selectExpr(
        "cast(id as string) complaint_key", "cast(id as string) unique_key",
        "timestamp_ntz'2026-07-01 00:00:00' created_at",
        "timestamp_ntz'2026-07-02 00:00:00' closed_at",
        "'l' location_id", "'a' agency_id", "'c' complaint_type_id", "'s' status_id",
    )
    facts.write.parquet(f"{root}/facts")
    spark.createDataFrame([("s", "OPEN")], "status_id string, status string").write.parquet(
        f"{root}/dim"
    )
    flagged = complaints_flagged(
        spark.read.parquet(f"{root}/facts"), spark.read.parquet(f"{root}/dim")
    )
    plan = physical(flagged)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    # Beyond the threshold the same query sorts and merges.
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert "SortMergeJoin" in physical(flagged.select("*", F.lit(1)))
        assert flagged.agg(F.sum("is_closed_at_status_mismatch")).first()[0] == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


HOT_FLAGGED = T.StructType(
    [
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("location_id", T.StringType()),
        T.StructField("complaint_type_id", T.StringType()),
    ]
)


def hot_mix(spark, root):
    """A third of 30,000 requests stand on one location."""
    spark.range(30000).selectExpr(
        "timestamp_ntz'2026-07-01 00:00:00' created_at",
        "if(id % 3 = 0, 'hot', cast(id as string)) location_id",
        "cast(id % 2 as string) complaint_type_id",
    ).write.parquet(f"{root}/flagged")
    spark.range(30000).selectExpr(
        "if(id = 0, 'hot', cast(id as string)) location_id", "'BRONX' borough"
    ).write.parquet(f"{root}/locations")
    spark.range(2).selectExpr(
        "cast(id as string) complaint_type_id", "concat('T', id) complaint_type"
    ).write.parquet(f"{root}/types")
    return borough_mix(*(spark.read.parquet(f"{root}/{t}") for t in ("flagged", "locations", "types")))


def test_borough_mix_counts_before_it_joins(spark, root):
    mix = hot_mix(spark, root)
    assert {(r["complaint_type"], r["total_requests"]) for r in mix.collect()} == {
        ("T0", 15000), ("T1", 15000),
    }
    plan = physical(mix)
    # Printed from the root down: the lookup stands above the grouping.
    assert plan.index("Join [location_id") < plan.index("HashAggregate(keys=[location_id")


def test_the_grand_total_reuses_the_groups(spark, root):
    assert "ReusedExchange" in executed(hot_mix(spark, root))


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert folder == (configured.rstrip("/") if configured else folder)
    assert shared_folder(spark) == folder


@pytest.mark.parametrize("name, most", [("dq_relationships", 2), ("dq_report", 4)])
def test_the_suite_scans_the_fact_few_times(spark, queries, name, most):
    plan = queries[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet[^\n]*/fct_311_complaint\b(?!_)", plan)
    assert 1 <= len(scans) <= most


def test_the_test_input_reads_whole_lookup_tables(spark):
    plan = physical(queries_of("surrogate_keys", spark))
    assert not re.search(r"PushedFilters: \[[^\]]*(LessThan|GreaterThan)[^\]]*(s_suppkey|p_partkey)", plan)


def queries_of(name, spark):
    return registry.bind()[name](spark, SF_DIR)


def test_orders_stay_spread_over_all_tasks_while_they_are_looked_up(spark):
    plan = physical(registry.bind()["raw_normalized"](spark, f"{TESTDATA}/sf0.01"))
    assert plan.count("BroadcastHashJoin") == 5
    assert "BuildLeft" not in plan  # the orders are on the left
    assert re.search(r"Exchange hashpartitioning\(o_orderkey#\d+L?, \d+\), REPARTITION_BY_NUM", plan)
