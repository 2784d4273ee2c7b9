"""Substring dedup by level-wise doubling.

A window of so many words that occurs twice holds shorter windows that occur twice. Short
windows are counted first; only where one is repeated are windows of twice the length
counted, and so on up to the full length, until no candidates survive.

Below the full length a window need not be counted at every word. Each full window is
represented by one short window in it, the one of the lowest hash, the first of equals.
Equal full windows choose alike, so if the chosen one occurs only once, so does the full
window. Neighbouring full windows mostly choose the same one, which makes few of them.

Texts are told apart by 128 bits, and equal texts are one text that occurs several times.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardbook.llm.tables import bound_batches, kept_table
from wardbook.llm.words import BASES, Words, lists, pieces, ranges, window_hashes, within, words_of

WINDOW_WORDS = 35
KEY = ("k1", "k2")


def lengths(window: int) -> list[int]:
    """Window lengths of the levels: each at most twice the one before, the last the full one."""
    return [-(-window // 4), -(-window // 2), window]


def text_key() -> list[Column]:
    """128 bits of a text."""
    return [F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(WINDOW_WORDS), F.col("text")).alias("k2")]


def lowest(values: np.ndarray, count: int) -> np.ndarray:
    """For each run of so many values, the place of the lowest, the first of equals."""
    place, span = np.arange(len(values)), 1
    while span < count:
        step = min(span, count - span)
        left, right = place[: len(place) - step], place[step:]
        place = np.where(values[left] <= values[right], left, right)
        span += step
    return place


def chosen(hashes: np.ndarray, starts: np.ndarray, window: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each full window, the place of the short window that represents it; and the
    hashes of all short windows."""
    short = window_hashes(hashes, length)
    if not len(starts):
        return starts, short
    return lowest(short, window - length + 1)[starts], short


def _survivors(piece: pa.RecordBatch, words: Words, hashes: np.ndarray, window: int, levels: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The first words of the full windows that all levels so far have left, and their texts.

    The places that a level found repeated are in the column named after its length, by text.
    """
    starts, texts = within(words.first, window)
    for length in levels:
        found = piece.column(f"at{length}")
        counts = np.asarray(found.value_lengths().fill_null(0))
        alive = np.zeros(len(hashes) + 1, bool)
        alive[np.asarray(found.flatten()) + np.repeat(words.first[:-1], counts)] = True
        keep = alive[chosen(hashes, starts, window, length)[0]]
        starts, texts = starts[keep], texts[keep]
    return starts, texts


def _by_text(values: list[np.ndarray], places: np.ndarray, words: Words, kinds: list[pa.DataType]) -> list[pa.Array]:
    """Columns of lists, a list for each text, from values and places in the order of words."""
    texts = np.searchsorted(words.first, places, "right") - 1
    counts = np.bincount(texts, minlength=len(words.first) - 1)
    columns = [lists(v.view(np.int64) if v.dtype == np.uint64 else v, counts, k) for v, k in zip(values, kinds, strict=True)]
    return [*columns, lists((places - words.first[:-1][texts]).astype(np.int32), counts, pa.int32())]


def _sampled(piece: pa.RecordBatch, window: int, levels: list[int], length: int) -> tuple[Words, list[pa.Array]]:
    words = words_of(piece.column("text"))
    hashes = words.hashes()
    starts, _ = _survivors(piece, words, hashes, window, levels)
    places, short = chosen(hashes, starts, window, length)
    places = np.unique(places)
    return words, _by_text([short[places]], places, words, [pa.int64()])


def _first_level(documents: DataFrame, carried: list[str], window: int) -> DataFrame:
    """For each document its key, n_words, the digest of its words, and its representatives."""
    length = lengths(window)[0]
    rows = documents.select(
        *[F.col(f"`{c}`") for c in carried], F.coalesce("text", F.lit("")).alias("text")
    ).select("*", *text_key())
    kept = rows.drop("text").schema
    for name, kind in (
        ("n_words", T.LongType()),
        ("kept_sha256", T.StringType()),
        ("hash", T.ArrayType(T.LongType())),
        ("place", T.ArrayType(T.IntegerType())),
    ):
        kept = kept.add(name, kind)
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            words, columns = _sampled(piece, window, [], length)
            whole = [
                hashlib.sha256(b" ".join(words.data[a:b].tobytes().split())).hexdigest()
                for a, b in zip(words.offsets[:-1], words.offsets[1:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *[piece.column(c) for c in (*carried, *KEY)],
                    pa.array(words.counts, pa.int64()),
                    pa.array(whole, pa.string()),
                    *columns,
                ],
                names,
            )

    return rows.mapInArrow(run, kept)


def _next_level(texts: DataFrame, window: int, levels: list[int], length: int) -> DataFrame:
    """For each text, the representatives of that length of the windows left by the levels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            _, columns = _sampled(piece, window, levels, length)
            yield pa.RecordBatch.from_arrays(
                [*[piece.column(c) for c in (*KEY, "m")], *columns], [*KEY, "m", "hash", "place"]
            )

    return texts.mapInArrow(run, "k1 long, k2 long, m long, hash array<bigint>, place array<int>")


def _full_windows(texts: DataFrame, window: int, levels: list[int]) -> DataFrame:
    """For each text, 128 bits of every full window left by the levels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            words = words_of(piece.column("text"))
            hashes = words.hashes()
            starts, _ = _survivors(piece, words, hashes, window, levels)
            bits = [window_hashes(hashes, window, base)[starts] for base in BASES]
            columns = _by_text(bits, starts, words, [pa.int64(), pa.int64()])
            yield pa.RecordBatch.from_arrays(
                [*[piece.column(c) for c in (*KEY, "m")], *columns], [*KEY, "m", "hash", "more", "place"]
            )

    return texts.mapInArrow(run, "k1 long, k2 long, m long, hash array<bigint>, more array<bigint>, place array<int>")


def _repeated(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """For each text, the places of its windows that occur more than once in the table.

    rows: a text's key, how often it occurs, and lists of hashes and places. Counts are
    added up before they are shuffled, and written: the join then reads both sides by
    shuffles of its own, and a window that a third of all texts share is split between tasks.
    """
    each = rows.select(*KEY, "m", F.explode(F.arrays_zip(*by, "place")).alias("w")).select(
        *KEY, "m", *[F.col(f"w.{c}").alias(c) for c in by], "w.place"
    )
    often = kept_table(each.groupBy(*by).agg(F.sum("m").alias("n")).where("n > 1").select(*by), f"often-{name}", light=True)
    return each.select(*KEY, *by, "place").join(often, by).groupBy(*KEY).agg(F.collect_set("place").alias(name))


def _removals(texts: DataFrame, window: int) -> DataFrame:
    """For each text, from the starts of its repeated windows: n_removed and the digest of what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            words = words_of(piece.column("text"))
            found = piece.column("starts")
            counts = np.asarray(found.value_lengths().fill_null(0))
            starts = np.asarray(found.flatten()) + np.repeat(words.first[:-1], counts)
            drop = np.zeros(len(words.starts), bool)
            drop[ranges(starts, np.full(len(starts), window))] = True
            removed = np.add.reduceat(np.append(drop, False), words.first[:-1], dtype=np.int64)
            digests = []
            for a, b, u, v in zip(words.first[:-1], words.first[1:], words.offsets[:-1], words.offsets[1:], strict=True):
                each = words.data[u:v].tobytes().split()
                digests.append(hashlib.sha256(b" ".join([each[i] for i in np.flatnonzero(~drop[a:b])])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [piece.column("k1"), piece.column("k2"), pa.array(removed, pa.int64()), pa.array(digests)],
                [*KEY, "n_removed", "left_sha256"],
            )

    return texts.mapInArrow(run, "k1 long, k2 long, n_removed long, left_sha256 string")


def deduplicated(documents: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """documents' columns but text, with n_words, n_removed and kept_sha256.

    A word is removed if a window of so many consecutive words of its text covers it whose
    words also start anywhere else, in the same text or another. All windows are judged on
    the input. kept_sha256 is the SHA-256 of the words that are left, joined by one space.
    Words are separated by ASCII blanks and otherwise unchanged. A null or empty text has
    no words; a text shorter than the window loses none. Of texts that occur twice, every
    word is in a repeated window if they are long enough, so both lose all. Other columns
    are carried along; those called k1, k2, hash, place, left_sha256 or as the result's are
    left out.
    """
    bound_batches(documents.sparkSession)
    short, middle, full = lengths(window)
    taken = ("text", "k1", "k2", "n_words", "n_removed", "kept_sha256", "hash", "place", "left_sha256")
    carried = [c for c in documents.columns if c.lower() not in taken]
    first = kept_table(_first_level(documents, carried, window), "first-level")
    alive = _repeated(first.withColumn("m", F.lit(1).cast("long")), ["hash"], f"at{short}")
    # One row for each text that has a candidate, and how often it occurs. Both sides of the
    # join are dealt by the text's key.
    once = documents.where("text IS NOT NULL").select("text", *text_key()).groupBy(*KEY).agg(
        F.any_value("text").alias("text"), F.count(F.lit(1)).alias("m")
    )
    texts = kept_table(once.join(alive, list(KEY)), "candidates")
    more = kept_table(_repeated(_next_level(texts, window, [short], middle), ["hash"], f"at{middle}"), "doubled")
    texts = texts.join(more, list(KEY))
    starts = _repeated(_full_windows(texts, window, [short, middle]), ["hash", "more"], "starts")
    found = kept_table(starts, "repeated")
    removed = _removals(texts.select(*KEY, "text").join(found, list(KEY)), window)
    return first.join(removed, list(KEY), "left").select(
        *[F.col(f"`{c}`") for c in carried],
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("left_sha256", "kept_sha256").alias("kept_sha256"),
    )
