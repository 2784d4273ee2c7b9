"""From raw documents to a training mix: the stages in order, and the run of all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardbook.llm import stages
from wardbook.llm.tables import kept_table

#: Each takes (spark, docs, sf_dir); its result is written as Parquet and read as the next one's docs.
STAGES = stages.STAGES

#: A trained network, joins by similarity and keyed surrogates: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = kept_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
