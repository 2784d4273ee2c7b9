"""Where each key of the raw table is: an index of keys and days beside it.

Keys are dealt to buckets by hash. A bucket is a few folders of entries, one for each
change that touched it, and the entry of a key's latest change holds; a bucket of many
folders is rewritten as one. So a batch reads and adds to the buckets of its own keys only,
and what it writes is as long as the batch.

The index is published after the table and names the table's manifest that it belongs to.
If that is not the current one, because a run ended between the two or the table is
older than the index, it is made anew from the table's narrow columns.
"""

from __future__ import annotations

import uuid
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardbook.schema import ARRIVAL_COLUMNS, PARTITION_COLUMN
from wardbook.sources.versions import current, publish

KEY = "unique_key"
BUCKETS = 64
#: Folders of a bucket before they are rewritten as one.
MOST_FOLDERS = 8
#: The entry of the manifest with the number of the table's.
TABLE = "table"
ENTRY = T.StructType(
    [
        T.StructField(KEY, T.StringType()),
        *[T.StructField(c, T.LongType()) for c in ARRIVAL_COLUMNS],
        T.StructField(PARTITION_COLUMN, T.DateType()),
        T.StructField("change", T.LongType()),
    ]
)


def bucket_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _root(path: str) -> str:
    return f"{path}/_index"


def _folders(spark: SparkSession, path: str) -> dict[int, list[str]]:
    """The folders of each bucket."""
    found = defaultdict(list)
    for name, folder in sorted((current(spark, _root(path)) or {}).items()):
        if name != TABLE:
            found[int(name.split("/")[0])].append(folder)
    return found


def is_current(spark: SparkSession, path: str, number: int) -> bool:
    """Whether the index belongs to the table's manifest of that number."""
    return (current(spark, _root(path)) or {}).get(TABLE) == str(number)


def buckets_of(keys: DataFrame) -> list[int]:
    """The buckets that these keys are in: at most BUCKETS numbers."""
    return sorted(r[0] for r in keys.select(bucket_of(F.col(KEY)).alias("bucket")).distinct().collect())


def entries(spark: SparkSession, path: str, buckets: list[int]) -> DataFrame:
    """key, arrival and day of the stored rows of all keys in these buckets."""
    folders = _folders(spark, path)
    paths = [f"{_root(path)}/{f}" for b in buckets for f in folders.get(b, [])]
    if not paths:
        return spark.createDataFrame([], ENTRY).drop("change")
    place = F.struct("change", *ARRIVAL_COLUMNS, PARTITION_COLUMN)
    # Maxima are taken before the shuffle: a key with many changes is no one task's work.
    latest = spark.read.schema(ENTRY).parquet(*paths).groupBy(KEY).agg(F.max(place).alias("place"))
    return latest.select(KEY, *[f"place.{c}" for c in (*ARRIVAL_COLUMNS, PARTITION_COLUMN)])


def add(spark: SparkSession, path: str, places: DataFrame, number: int) -> None:
    """Record where the rows of these keys are now, as of the table's manifest of that number."""
    folders = _folders(spark, path)
    rows = _dated(places, number)
    touched = buckets_of(rows)
    crowded = [b for b in touched if len(folders.get(b, [])) >= MOST_FOLDERS]
    if crowded:
        older = entries(spark, path, crowded).join(rows.select(KEY).hint("merge"), KEY, "left_anti")
        rows = rows.unionByName(_dated(older, number))
    change = _write(rows, path)
    kept = {b: [] if b in crowded else f for b, f in folders.items()}
    for b in touched:
        kept[b] = [*kept.get(b, []), f"{change}/bucket={b}"]
    _publish(spark, path, kept, number)


def rebuild(spark: SparkSession, path: str, places: DataFrame, number: int) -> None:
    """Make the index anew from key, arrival and day of all stored rows."""
    rows = _dated(places, number)
    change = _write(rows, path)
    _publish(spark, path, {b: [f"{change}/bucket={b}"] for b in buckets_of(rows)}, number)


def _dated(places: DataFrame, number: int) -> DataFrame:
    return places.select(KEY, *ARRIVAL_COLUMNS, PARTITION_COLUMN, F.lit(number).cast("bigint").alias("change"))


def _write(rows: DataFrame, path: str) -> str:
    change = f"change-{uuid.uuid4().hex}"
    (
        rows.withColumn("bucket", bucket_of(F.col(KEY)))
        .hint("rebalance", "bucket")
        .sortWithinPartitions("bucket", KEY)
        .write.partitionBy("bucket")
        .parquet(f"{_root(path)}/{change}")
    )
    return change


def _publish(spark: SparkSession, path: str, folders: dict[int, list[str]], number: int) -> None:
    named = {f"{b:05d}/{i:05d}": f for b, each in folders.items() for i, f in enumerate(each)}
    publish(spark, _root(path), named | {TABLE: str(number)})
