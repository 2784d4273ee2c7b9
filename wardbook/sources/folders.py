"""Folders every executor can reach, and tables written to them."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

REMOVAL_THREADS = 16


@cache
def _local_folder(_application: str) -> str:
    return tempfile.mkdtemp(prefix="wardbook-")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, from spark.checkpoint.dir.

    Only a session of one process (master local or local[...]) without the setting gets a
    temporary folder: there the one machine is all there is.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        return _local_folder(spark.sparkContext.applicationId)
    raise ValueError("Set spark.checkpoint.dir to a folder all executors share.")


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name under the shared folder; writing to it creates it."""
    return f"{shared_folder(spark)}/wardbook-{purpose}-{uuid.uuid4().hex}"


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _hadoop(spark, path)
    return fs.exists(hadoop_path)


def state(spark: SparkSession, folder: str, tables: list[str]) -> tuple:
    """Size and time of each table in a folder: another state means other rows."""
    found = []
    for table in tables:
        fs, path = _hadoop(spark, f"{folder}/{table}.parquet")
        if fs.exists(path):
            size = fs.getContentSummary(path).getLength()
            found.append((table, size, fs.getFileStatus(path).getModificationTime()))
    return tuple(found)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder if it is there."""
    fs, hadoop_path = _hadoop(spark, path)
    fs.delete(hadoop_path, True)


def remove_all(spark: SparkSession, root: str, folders: set[str], kept: set[str]) -> None:
    """Delete these folders under root, none of which holds one that is kept.

    Folders of a folder that holds nothing to keep go with it at once, the others side by side.
    """
    whole = {f.split("/")[0] for f in folders} - {k.split("/")[0] for k in kept}
    single = {f for f in folders if f.split("/")[0] not in whole}
    with ThreadPoolExecutor(REMOVAL_THREADS) as pool:
        list(pool.map(lambda f: remove(spark, f"{root}/{f}"), sorted(whole | single)))


@contextmanager
def many_tasks(spark: SparkSession) -> Iterator[None]:
    """Shuffles in here keep all their partitions.

    Writing many small files takes a task's time for each file, whatever their bytes, by
    which adaptive execution would join partitions.
    """
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, sorted; none if it is not there."""
    fs, path = _hadoop(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []


def text_of(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _hadoop(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that readers see whole or not at all: it is renamed into place."""
    beside = f"{path}.{uuid.uuid4().hex}.tmp"
    fs, hadoop_path = _hadoop(spark, beside)
    stream = fs.create(hadoop_path)
    stream.writeBytes(text)
    stream.close()
    if not fs.rename(hadoop_path, spark._jvm.org.apache.hadoop.fs.Path(path)):
        fs.delete(hadoop_path, False)
        raise FileExistsError(path)


def written(rows: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """rows written as Parquet and read back: later plans see their size, not their lineage."""
    rows.write.mode(mode).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
