"""Rows that may have one of some keys, found without moving any row."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each key, and of all of them at most: 8 MB. A bitmap of Spark's has 32,768.
BITS_A_KEY, BITMAP, BITMAPS = 64, 32_768, 2_048


def perhaps(rows: DataFrame, keys: DataFrame, hashed: Column) -> DataFrame:
    """The rows of these keys, and few others: each key sets a bit, and rows whose bit is not
    set go. All tasks get the bitmaps, which are bounded; with very many keys, more rows stay.

    hashed: 64 well mixed bits of the key, from columns of both; rows without them go.
    """
    bitmaps = min(BITMAPS, max(1, ceil(keys.count() * BITS_A_KEY / BITMAP)))
    slot = F.pmod(hashed, F.lit(bitmaps * BITMAP).cast("long"))
    part, bit = F.floor(slot / BITMAP).cast("int").alias("part"), (slot % BITMAP).cast("long").alias("bit")
    # Dealt before they are grouped, so that no task makes a bitmap of each part.
    maps = keys.select(part, bit).repartition("part").groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits"))
    byte = F.conv(F.hex(F.substring("bits", (F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    found = rows.select("*", part, bit).join(F.broadcast(maps), "part")
    return found.where(F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1).drop("part", "bit", "bits")
