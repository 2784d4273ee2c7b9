"""Pages of JSON request records.

A page is one file that holds one JSON array, and its number is in the file's name, as in
``page-0007.json``, or in the folder directly above it, as in ``page_no=7/...``. Or many
pages are in one file, a JSON object ``{"page_no": 7, "rows": [...]}`` a line, so that the
number of files does not grow with every page. Numbers give the order pages were fetched
in. Files that carry the same number are one page; equal positions in it go by file path.
An empty file is no page: Spark reads nothing from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardbook.functions.dates import utc_timestamp
from wardbook.schema import PAYLOAD_SCHEMA, RAW_COLUMNS, TIMESTAMP_COLUMNS

# Fixed value: rows per fetched page.
PAGE_SIZE = 1000

FILE_NUMBER = r"/page-(\d+)(?:\.[^/]*)?$"
FOLDER_NUMBER = r"/page_no=(\d+)/[^/]+$"
PAGE_COLUMNS = ["page_no", "page_file"]


def _or_fail(value: Column, *message: Column | str) -> Column:
    parts = [F.lit(m) if isinstance(m, str) else m.cast("string") for m in message]
    return F.coalesce(value, F.raise_error(F.concat(*parts)))


def page_number(path: Column) -> Column:
    """The number in a page file's path; a path without one fails the job."""
    found = [F.nullif(F.regexp_extract(path, p, 1), F.lit("")) for p in (FILE_NUMBER, FOLDER_NUMBER)]
    return _or_fail(F.coalesce(*found), "No page number in ", path).cast("bigint")


def page_files(files: DataFrame) -> DataFrame:
    """(page_no, page_file, value): one row per page file, from whole files as text."""
    path = F.col("_metadata.file_path")
    return files.select(page_number(path).alias("page_no"), path.alias("page_file"), "value")


def page_lines(lines: DataFrame) -> DataFrame:
    """(page_no, page_file, records): one row per line of files of many pages.

    A line that is no single JSON object with a page_no and rows fails the job.
    """
    path = F.col("_metadata.file_path")
    page = _single("value", "struct<page_no: bigint, rows: array<string>>")
    read = lines.select(path.alias("page_file"), page.alias("page"))
    number = _or_fail(F.col("page.page_no"), "No page with a page_no on a line of ", F.col("page_file"))
    return read.select(
        number.alias("page_no"),
        "page_file",
        _or_fail(F.col("page.rows"), "No JSON array on page ", number, " of ", F.col("page_file")).alias("records"),
    )


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The pages of a folder of one file a page."""
    return page_files(spark.read.option("recursiveFileLookup", True).text(folder, wholetext=True))


def read_page_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The pages of a folder of files with a page a line."""
    return page_lines(spark.read.option("recursiveFileLookup", True).text(folder))


def _single(column: str, kind: str) -> Column:
    """The one JSON value of a kind in a text, NULL if anything but blanks is beside it.

    JSON reading stops where the first value ends. Between brackets, what follows it
    makes another element or an error, so one reading does for both.
    """
    values = F.from_json(F.concat(F.lit("["), column, F.lit("]")), f"array<{kind}>")
    # In a lambda, because the same expression written twice is read twice outside of generated code.
    return F.get(F.transform(F.array(values), lambda v: F.when(F.size(v) == 1, F.get(v, F.lit(0)))), F.lit(0))


def page_rows(pages: DataFrame) -> DataFrame:
    """(page_no, page_file, pos, record): the elements of every page.

    pages: page_no, page_file if it is known, and value, the page's text, or records. A
    text that is not one JSON array, and nothing else, fails the job.
    """
    named = pages if "page_file" in pages.columns else pages.withColumn("page_file", F.lit(""))
    records = F.col("records")
    if "records" not in pages.columns:
        records = _or_fail(_single("value", "array<string>"), "No JSON array on page ", F.col("page_no"))
    # The outer form, because Spark puts a filter on the array before the plain one
    # and would parse every page several times for it.
    rows = named.select(*PAGE_COLUMNS, F.posexplode_outer(records).alias("pos", "record"))
    return rows.where(F.col("pos").isNotNull()).withColumn("pos", F.col("pos").cast("bigint"))


def normalized(rows: DataFrame) -> DataFrame:
    """Page rows as raw request rows, with page_no, page_file and pos.

    Missing fields are NULL, unknown ones stay in raw_json only, and a record without
    a unique_key fails the job.
    """
    payload = F.from_json("record", PAYLOAD_SCHEMA)

    def field(name: str) -> Column:
        value = F.col(f"payload.{name}")
        if name == "unique_key":
            missing = F.raise_error(F.lit("A page record has no unique_key"))
            return F.coalesce(value, missing.cast("string"))
        return utc_timestamp(value) if name in TIMESTAMP_COLUMNS else value

    return rows.withColumn("payload", payload).select(
        *[field(c).alias(c) for c in RAW_COLUMNS if c != "raw_json"],
        F.col("record").alias("raw_json"),
        *PAGE_COLUMNS,
        "pos",
    )


def write_pages(records: DataFrame, folder: str) -> None:
    """Write (page_no, pos, record) rows as page files, one line per record.

    The rows of a page are streamed into its file in order, never held together.
    """
    page = Window.partitionBy("page_no").orderBy("pos")
    opening = F.when(F.row_number().over(page) == 1, "[").otherwise(",")
    closing = F.when(F.lead("pos").over(page).isNull(), "]").otherwise("")
    lines = records.withColumn("value", F.concat(opening, "record", closing))
    (
        lines.sortWithinPartitions("page_no", "pos")
        .select("page_no", "value")
        .write.partitionBy("page_no")
        .text(folder)
    )


def write_page_lines(records: DataFrame, folder: str) -> None:
    """Write (page_no, pos, record) rows as files of many pages, a page a line.

    A page is one fetch, of a bounded number of records, so a line is one too.
    """
    ordered = F.array_sort(F.collect_list(F.struct("pos", "record")))
    rows = F.array_join(F.transform(ordered, lambda x: x["record"]), ",")
    line = F.concat(F.lit('{"page_no":'), F.col("page_no").cast("string"), F.lit(',"rows":['), rows, F.lit("]}"))
    records.groupBy("page_no").agg(line.alias("value")).select("value").write.text(folder)
