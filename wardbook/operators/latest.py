"""Latest version per key, and the keyed upsert in closed form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def arrival_order() -> list[Column]:
    """Latest arrival first: page, then creation time with NULL last, position and file."""
    return [
        F.col("run_no").desc(),
        F.col("page_no").desc(),
        F.col("created_date").desc_nulls_last(),
        F.col("pos").desc(),
        F.col("page_file").desc(),
    ]


def latest_per_key(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of each key under an order.

    ``row_number() = 1`` plans as a group limit on both sides of the shuffle: each
    task ships at most one row per key, so a key that holds a third of the input
    costs the shuffle one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def merged(target: DataFrame, pages: DataFrame, key: str = "unique_key") -> DataFrame:
    """target after upserting every page in page order, in one pass.

    ``target`` has the row columns; ``pages`` has them plus page_no and pos. Any page
    row beats the target row of its key, and a later page beats an earlier one.
    """
    before_all = {"page_no": F.lit(-1).cast("bigint"), "pos": F.lit(0).cast("bigint")}
    stored = target.withColumns(before_all)
    order = [
        F.col("page_no").desc(),
        F.col("created_date").desc_nulls_last(),
        F.col("pos").desc(),
    ]
    newest = latest_per_key(stored.unionByName(pages.select(stored.columns)), key, order)
    return newest.select(target.columns)
