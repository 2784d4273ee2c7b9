"""Running totals over a whole table, and intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardbook.sources.folders import scratch_folder, written


def kept_table(rows: DataFrame, purpose: str, light: bool = False) -> DataFrame:
    """rows written once to the folder that all executors share, and read back.

    light: rows much fewer or shorter than those they were made from, which are written
    to an eighth of the files, so that small files do not add up.
    """
    if light:
        rows = rows.coalesce(max(1, partitions_of(rows) // 8))
    return written(rows, scratch_folder(rows.sparkSession, f"llm-{purpose}"))


def packed(carried: list[str]) -> Column:
    """The columns of these names, whatever they are, as one struct column `row`."""
    return F.struct(*[F.col(f"`{c}`") for c in carried], F.lit(0).alias("")).alias("row")


def unpacked(carried: list[str]) -> list[Column]:
    """The columns of packed() again."""
    return [F.col("row").getField(c).alias(c) for c in carried]


#: Rows that Spark hands to Python at once. Its default, 10,000, would hold tens of MB of
#: text several times over in every task.
ROWS_AT_ONCE = 1000


def bound_batches(spark: SparkSession) -> None:
    """Bound the batches that the session hands to Python from now on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_AT_ONCE)


def partitions_of(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def running_totals(rows: DataFrame, order: list[Column], totals: dict[str, Column], purpose: str) -> DataFrame:
    """rows with, for each name, the total of its column over all rows up to this one.

    The rows are sorted by range into partitions; each sums up its own, and the sums of
    the partitions before it, one row a partition, are added. No task sees all rows.
    Rows that tie in the order get totals in some order of their own.
    """
    spread = rows.repartitionByRange(partitions_of(rows), *order).withColumn("__part", F.spark_partition_id())
    spread = kept_table(spread, purpose)
    sums = spread.groupBy("__part").agg(*[F.sum(c).alias(f"__sum_{n}") for n, c in totals.items()])
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(
        "__part", *[F.coalesce(F.sum(f"__sum_{n}").over(earlier), F.lit(0)).alias(f"__sum_{n}") for n in totals]
    )
    within = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # One row a partition: the broadcast side is as long as the number of partitions.
    return (
        spread.join(F.broadcast(before), "__part")
        .select(
            *[F.col(f"`{c}`") for c in rows.columns],
            *[(F.sum(c).over(within) + F.col(f"__sum_{n}")).alias(n) for n, c in totals.items()],
        )
    )
