"""Sessions for tests and benchmarks, and settings worth having on a cluster."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

SHUFFLE_PARTITION_BYTES = 256 * 1024**2


def cluster_settings(shuffled_bytes: int, cores: int) -> dict[str, str]:
    """Settings for jobs that shuffle up to this much.

    Adaptive execution joins small partitions but cannot split an aggregation's large
    ones, so the partition count follows the data; coalescing takes care of the rest.
    """
    partitions = max(cores, math.ceil(shuffled_bytes / SHUFFLE_PARTITION_BYTES))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.shuffle.partitions": str(partitions),
        # Quantile sketches per day: past this many groups a task sorts its rows.
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    }


def local_session(cores: int | str = 8, **settings: str) -> SparkSession:
    """A quiet single-machine session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wardbook")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "4096")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
