"""Alignment of two tokenizers' tokens by sparse incidence matrices.

Of each text, A has a row for each token of the first vocabulary and a column for each byte,
with ones where the token's bytes are; B the same of the second one. The product of A and
B transposed has a row for each token of the first, a column for each of the second, and the
number of bytes that they share: the overlap links. Those of tokens that end together cut the
text into groups. Incidence of tokens and groups, multiplied in the same way, links all
tokens of a group.

Matrices are compressed rows; products go by rows, after Gustavson: each entry of a row
brings in a row of the other matrix, and what meets in a column is added up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardbook.llm.tables import bound_batches, kept_table, packed, unpacked
from wardbook.llm.vocabularies import BYTE_BPE, PIECE_BPE, Bytes, byte_vocabulary, piece_vocabulary, segments
from wardbook.llm.words import lists, pieces, ranges, text_bytes

DIGESTS = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps", "n_shared", "groups_sha256")


@dataclass
class Rows:
    """A sparse matrix of compressed rows."""

    first: np.ndarray  # the first entry of each row, and the number of entries
    columns: np.ndarray
    values: np.ndarray
    width: int

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def transposed(self) -> Rows:
        order = np.argsort(self.columns, kind="stable")
        first = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Rows(first, self.rows()[order], self.values[order], len(self.first) - 1)

    def entries_of_product(self, other: Rows) -> np.ndarray:
        """The number of entries that each row brings in, before what meets is added up."""
        brought = np.concatenate([[0], np.cumsum(other.counts[self.columns])])
        return brought[self.first[1:]] - brought[self.first[:-1]]

    def times(self, other: Rows) -> Rows:
        brought = other.counts[self.columns]
        from_other = ranges(other.first[self.columns], brought)
        key = np.repeat(self.rows(), brought) * other.width + other.columns[from_other]
        values = np.repeat(self.values, brought) * other.values[from_other]
        if (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, values = key[order], values[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        at = np.flatnonzero(new)
        row, column = np.divmod(key[at], max(other.width, 1))
        first = np.searchsorted(row, np.arange(len(self.first)))
        return Rows(first, column, np.add.reduceat(values, at) if len(at) else values, other.width)


def incidence(starts: np.ndarray, ends: np.ndarray, width: int) -> Rows:
    """A row for each token, with ones in the columns from its start to its end."""
    sizes = ends - starts
    return Rows(np.concatenate([[0], np.cumsum(sizes)]), ranges(starts, sizes), np.ones(int(sizes.sum()), np.int64), width)


@dataclass
class Side:
    """The tokens of some texts by one vocabulary."""

    ids: np.ndarray
    first: np.ndarray  # the first token of each text, and their number
    vocabulary: Bytes

    def bytes_of_texts(self) -> np.ndarray:
        before = np.concatenate([[0], np.cumsum(self.vocabulary.lengths[self.ids])])
        return np.diff(before[self.first])

    def only(self, texts: np.ndarray) -> Side:
        """The same texts, without tokens but those of these."""
        counts = np.diff(self.first)
        ids = self.ids[np.repeat(texts, counts)]
        return Side(ids, np.concatenate([[0], np.cumsum(np.where(texts, counts, 0))]), self.vocabulary)


@dataclass
class Alignment:
    """The tokens of some texts and how they align. Byte offsets count from the first text's start."""

    a: Side
    b: Side
    a_ends: np.ndarray  # the byte after each token
    b_ends: np.ndarray
    overlap: Rows  # bytes that tokens share
    link_a: np.ndarray  # tokens that end together: the links
    link_b: np.ndarray
    group_ends: np.ndarray  # the byte after each group

    def groups_of(self, ends: np.ndarray) -> np.ndarray:
        """The group of each token, from its end."""
        return np.searchsorted(self.group_ends, ends)

    def by_groups(self) -> tuple[Rows, Rows]:
        """Incidence of tokens and groups on either side."""
        out = []
        for ends in (self.a_ends, self.b_ends):
            group = self.groups_of(ends)
            out.append(incidence(group, group + 1, len(self.group_ends)))
        return out[0], out[1]

    def shared_groups(self) -> Rows:
        """Ones for all pairs of tokens in one group."""
        a, b = self.by_groups()
        return a.times(b.transposed())


def _encoded(texts: list[str], a_path: str, b_path: str) -> tuple[Side, Side]:
    a, b = byte_vocabulary(a_path), piece_vocabulary(b_path)
    ids, counts = ([], []), ([], [])
    for text in texts:
        parts = segments(text) if text else []
        for side, found in enumerate(([a.ids(" " + p) for p in parts], [b.ids(p) for p in parts])):
            ids[side].extend(found)
            counts[side].append(sum(map(len, found)))
    return tuple(
        Side(
            np.concatenate([np.zeros(0, np.int32), *ids[side]]),
            np.concatenate([[0], np.cumsum(np.array(counts[side], np.int64))]),
            vocabulary.bytes,
        )
        for side, vocabulary in enumerate((a, b))
    )


def aligned_texts(column: pa.Array, a_path: str, b_path: str) -> Alignment:
    """The alignment of each text, a space before it. A text that is null, empty, or whose
    tokens' bytes on either side are not the text's has no tokens."""
    a, b = _encoded(column.to_pylist(), a_path, b_path)
    data, offsets = text_bytes(column)
    sizes = np.diff(offsets)
    whole = (sizes > 0) & (a.bytes_of_texts() == sizes + 1) & (b.bytes_of_texts() == sizes + 1)
    a, b = a.only(whole), b.only(whole)
    # What the tokens must spell: each text after a space.
    lengths = np.where(whole, sizes + 1, 0)
    starts = np.cumsum(lengths) - lengths
    wanted = np.full(int(lengths.sum()), ord(" "), np.uint8)
    inside = np.ones(len(wanted), bool)
    inside[starts[whole]] = False
    wanted[inside] = data[np.repeat(whole, sizes)]
    for side in (a, b):
        wrong = np.flatnonzero(side.vocabulary.joined(side.ids) != wanted)
        whole[np.searchsorted(starts, wrong, "right") - 1] = False
    if not whole[lengths > 0].all():
        a, b = a.only(whole), b.only(whole)
    a_ends, b_ends = (np.cumsum(s.vocabulary.lengths[s.ids]) for s in (a, b))
    width = int(a_ends[-1]) if len(a_ends) else 0
    by_byte = [
        incidence(e - s.vocabulary.lengths[s.ids], e, width) for s, e in ((a, a_ends), (b, b_ends))
    ]
    overlap = by_byte[0].times(by_byte[1].transposed())
    rows = overlap.rows()
    together = a_ends[rows] == b_ends[overlap.columns]
    link_a, link_b = rows[together], overlap.columns[together]
    return Alignment(a, b, a_ends, b_ends, overlap, link_a, link_b, a_ends[link_a])


def _numbers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of the numbers below size, a row each, and how many they are."""
    each = np.array([str(i) for i in range(size)], "S")
    return each.view(np.uint8).reshape(size, -1), np.char.str_len(each)


_DIGITS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def written_groups(found: Alignment) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all groups as text, `a1,a2|b1;a3|b2,b3`, one text after the other, each with
    a separator at its end; and where each text starts, and the end."""
    a_group, b_group = found.groups_of(found.a_ends), found.groups_of(found.b_ends)
    n = len(found.group_ends)
    a_before = np.searchsorted(a_group, np.arange(n + 1))
    b_before = np.searchsorted(b_group, np.arange(n + 1))
    ids = np.zeros(len(a_group) + len(b_group), np.int64)
    last = np.full(len(ids), ord(","), np.uint8)
    a_place = np.arange(len(a_group)) + b_before[a_group]
    b_place = np.arange(len(b_group)) + a_before[b_group + 1]
    ids[a_place], ids[b_place] = found.a.ids, found.b.ids
    if n:
        last[a_before[1:] + b_before[:-1] - 1] = ord("|")
        last[a_before[1:] + b_before[1:] - 1] = ord(";")
    size = max(found.a.vocabulary.size, found.b.vocabulary.size)
    if size not in _DIGITS:
        _DIGITS[size] = _numbers(size)
    digits, lengths = _DIGITS[size]
    sizes = lengths[ids] + 1
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for place in range(digits.shape[1]):
        some = sizes > place + 1
        out[(ends - sizes)[some] + place] = digits[ids[some], place]
    out[ends - 1] = last
    return out, np.concatenate([[0], ends])[found.a.first + found.b.first]


def _per_text(found: Alignment, places: np.ndarray, side: Side) -> np.ndarray:
    """How many of these tokens each text has."""
    return np.diff(np.searchsorted(places, side.first))


def _digests(found: Alignment) -> tuple[list[pa.Array], pa.Array]:
    """The columns named in DIGESTS, and for each text the pairs of its links."""
    a, b = found.a, found.b
    links = _per_text(found, found.link_a, a)
    by_groups = found.by_groups()
    shared = by_groups[0].entries_of_product(by_groups[1].transposed())
    data, at = written_groups(found)
    data = data.tobytes()
    sha = [
        hashlib.sha256(data[low : high - 1]).hexdigest() if high > low else ""
        for low, high in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)
    ]
    # Groups and links are one to one: no token is empty, so at most one of each side ends at a byte.
    counts = [
        np.diff(a.first),
        np.diff(b.first),
        links,
        links,
        np.diff(found.overlap.first[a.first]),
        np.diff(np.concatenate([[0], np.cumsum(shared)])[a.first]),
    ]
    pairs = a.ids[found.link_a].astype(np.int64) * b.vocabulary.size + b.ids[found.link_b]
    return [*[pa.array(c, pa.int64()) for c in counts], pa.array(sha, pa.string())], lists(pairs, links, pa.int64())


def _carried(documents: DataFrame, taken: tuple[str, ...]) -> list[str]:
    return [c for c in documents.columns if c.lower() not in ("text", *taken)]


def aligned(documents: DataFrame, a_path: str = BYTE_BPE, b_path: str = PIECE_BPE) -> DataFrame:
    """documents' columns but text, with the tokens of each text and their links.

    a_ids and b_ids: the tokens by either vocabulary, of a space and the text; the strings of
    special tokens are plain text. a_ends and b_ends: the byte after each, counted from the
    space. group_ends: the bytes at which tokens of both end, which cut them into groups.
    overlaps: the overlap links, structs of the places of an A token and a B token, from 0, and
    the number of bytes they share. A text that is null, empty, or whose tokens' bytes are
    not its own has empty lists. Columns of the same names are left out.
    """
    added = ("a_ids", "a_ends", "b_ids", "b_ends", "group_ends", "overlaps")
    carried = _carried(documents, added)
    bound_batches(documents.sparkSession)
    rows = documents.select(packed(carried), "text")
    schema = rows.drop("text").schema
    for name in added[:-1]:
        schema = schema.add(name, T.ArrayType(T.IntegerType()))
    link = T.StructType([T.StructField(n, T.IntegerType()) for n in ("a", "b", "bytes")])
    schema = schema.add("overlaps", T.ArrayType(link))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            found = aligned_texts(piece.column("text"), a_path, b_path)
            a, b, overlap = found.a, found.b, found.overlap
            sizes = a.bytes_of_texts()
            before = np.cumsum(sizes) - sizes

            def column(values: np.ndarray, counts: np.ndarray, shift: np.ndarray) -> pa.Array:
                return lists((values - np.repeat(shift, counts)).astype(np.int32), counts, pa.int32())

            n_a, n_b, links = np.diff(a.first), np.diff(b.first), _per_text(found, found.link_a, a)
            n_overlaps = np.diff(overlap.first[a.first])
            nothing = np.zeros(piece.num_rows, np.int64)
            parts = [
                column(overlap.rows(), n_overlaps, a.first[:-1]),
                column(overlap.columns, n_overlaps, b.first[:-1]),
                column(overlap.values, n_overlaps, nothing),
            ]
            fields = [pa.field(n, pa.int32()) for n in ("a", "b", "bytes")]
            structs = pa.StructArray.from_arrays([p.values for p in parts], fields=fields)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("row"),
                    column(a.ids, n_a, nothing),
                    column(found.a_ends, n_a, before),
                    column(b.ids, n_b, nothing),
                    column(found.b_ends, n_b, before),
                    column(found.group_ends, links, before),
                    pa.ListArray.from_arrays(parts[0].offsets, structs),
                ],
                [f.name for f in schema],
            )

    return rows.mapInArrow(run, schema).select(*unpacked(carried), *added)


def _digested(documents: DataFrame, carried: list[str], a_path: str, b_path: str) -> DataFrame:
    rows = documents.select(packed(carried), "text")
    schema = rows.drop("text").schema
    for name in DIGESTS[:-1]:
        schema = schema.add(name, T.LongType())
    schema = schema.add(DIGESTS[-1], T.StringType()).add("pairs", T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            columns, pairs = _digests(aligned_texts(piece.column("text"), a_path, b_path))
            yield pa.RecordBatch.from_arrays([piece.column("row"), *columns, pairs], [f.name for f in schema])

    return rows.mapInArrow(run, schema)


def alignment_scores(documents: DataFrame, a_path: str = BYTE_BPE, b_path: str = PIECE_BPE) -> DataFrame:
    """documents' columns but text, with n_a, n_b, n_groups, n_links, n_overlaps, n_shared,
    groups_sha256, n_best and count_sum.

    See aligned(). n_links counts the pairs of tokens that end together, n_overlaps the
    overlap links, n_shared the pairs of tokens in one group. A pair of ids counts as often
    as links of all texts hold it; count_sum adds that up over a text's links, n_best counts the
    links whose pair counts highest of all with their B id. groups_sha256 is that of the
    groups' ids, `a1,a2|b1;a3|b2,b3`; '' for a text without tokens, whose numbers are 0.
    Repeated rows count repeatedly; an empty table gives an empty result; very long texts are
    encoded in parts. Other columns are carried along; those named as the result's, or pairs,
    are left out.
    """
    added = (*DIGESTS, "pairs", "n_best", "count_sum")
    carried = _carried(documents, added)
    spark = documents.sparkSession
    bound_batches(spark)
    width = piece_vocabulary(b_path).bytes.size
    found = kept_table(_digested(documents, carried, a_path, b_path), "aligned")
    # Tokens that end together are suffixes of each other, so there are no more pairs than
    # tokens have suffixes, some hundred thousand, however long the corpus.
    counts = found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")).toArrow()
    pairs, n = counts.column("pair").to_numpy(), counts.column("n").to_numpy()
    order = np.argsort(pairs)
    pairs, n = pairs[order], n[order]
    most = np.zeros(width, np.int64)
    np.maximum.at(most, pairs % width, n)
    sent = spark.sparkContext.broadcast((pairs, n, n == most[pairs % width]))
    kept = ["row", *DIGESTS]
    schema = found.drop("pairs").schema.add("n_best", T.LongType()).add("count_sum", T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = sent.value
        for batch in batches:
            links = batch.column("pairs")
            first = np.concatenate([[0], np.cumsum(np.asarray(links.value_lengths()))])
            place = np.searchsorted(known, np.asarray(links.flatten()))
            sums = [np.concatenate([[0], np.cumsum(x[place], dtype=np.int64)])[first] for x in (best, n)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], *[pa.array(np.diff(s), pa.int64()) for s in sums]],
                [f.name for f in schema],
            )

    return found.mapInArrow(run, schema).select(*unpacked(carried), *DIGESTS, "n_best", "count_sum")
