"""Hand-made rows."""

import datetime as dt
import json

from pyspark.sql import types as T

from wardbook.schema import RAW_COLUMNS, RAW_SCHEMA

BATCH_SCHEMA = T.StructType(
    [
        *RAW_SCHEMA.fields,
        T.StructField("page_no", T.LongType()),
        T.StructField("pos", T.LongType()),
    ]
)


def at(day, hour=0, minute=0, second=0, micro=0):
    return dt.datetime(2026, 7, day, hour, minute, second, micro)


def raw_row(**fields):
    return tuple(fields.get(c) for c in RAW_COLUMNS)


def raw_frame(spark, *rows):
    return spark.createDataFrame([raw_row(**r) for r in rows], RAW_SCHEMA)


def batch_frame(spark, *rows):
    """Normalized page rows; page_no and pos default to 0 and the list position."""
    values = [
        (*raw_row(**r), r.get("page_no", 0), r.get("pos", i)) for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(values, BATCH_SCHEMA)


def write_page(folder, number, payload):
    folder.mkdir(parents=True, exist_ok=True)
    text = payload if isinstance(payload, str) else json.dumps(payload)
    (folder / f"page-{number:04d}.json").write_text(text)
