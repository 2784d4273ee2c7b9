"""Packing documents into sequences by column generation for the cutting-stock problem.

Each document is cut into full sequences and a rest shorter than one. The lengths of all
rests make a histogram of classes a few tokens wide. A pattern says how many rests of each class share a
sequence; a linear program covers the histogram with the fewest patterns. It starts with
patterns of one class each and prices further ones by a knapsack over the dual values until none
would help. Whole multiples of its patterns are used, and the few rests left over by rounding are packed best fit.

All rests are ranked by length across the cluster, and each class's are dealt to the patterns
by rank. As the histogram tells the exact length at every rank, so it does what each sequence
leaves free. Where that is more than a little, it is filled: the emptiest sequences are taken
apart and their rests cut to fill the others.

The plan is made from the histogram alone, so its size and work do not grow with the documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardbook.llm.tables import bound_batches, kept_table, packed, running_totals, unpacked
from wardbook.llm.vocabularies import BYTE_BPE, byte_vocabulary, segments
from wardbook.llm.words import lists, pieces

PIECE = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@dataclass(frozen=True)
class PackRules:
    size: int = 1024  # tokens of a sequence
    width: int = 8  # lengths of a class
    end_id: int = 0  # after each document
    free: int = 16  # tokens that a sequence may leave free; more are filled
    gain: float = 1e-3  # of the objective, that a further pattern must promise
    columns: int = 4000  # patterns that are priced at most


@dataclass
class Plan:
    """Where each rest goes, by its rank.

    Rests of ranks from first[i] to below first[i + 1] are placed whole at offset[i], one in each sequence
    from sequence[i] on, if they are no donors. Donors, whose sequence is -1, are laid end to end
    from stream[i] on; the stream is cut into the gaps: count[j] gaps of size gap[j], from
    gap_stream[j] on, in sequences from gap_sequence[j] on at gap_offset[j].
    """

    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    stream: np.ndarray
    gap_stream: np.ndarray
    gap: np.ndarray
    gap_sequence: np.ndarray
    gap_offset: np.ndarray
    sequences: int


def best_pattern(values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of classes 1, 2, ... whose sizes add up to the capacity at most."""
    best = np.zeros(capacity + 1)
    choice = np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        with_each = values[:room] + best[room - 1 :: -1][:room]
        k = int(with_each.argmax())
        best[room], choice[room] = best[room - 1], 0
        if with_each[k] > best[room] + 1e-12:
            best[room], choice[room] = with_each[k], k + 1
    pattern, room = np.zeros(len(values), np.int64), capacity
    while room:
        if choice[room]:
            pattern[choice[room] - 1] += 1
        room -= max(int(choice[room]), 1)
    return float(best[capacity]), pattern


def patterns(demand: np.ndarray, rules: PackRules) -> tuple[np.ndarray, np.ndarray]:
    """Patterns, a row each with the number of rests of each class, and how often each is used
    (a fraction) to cover the demand with the fewest sequences: the revised simplex method."""
    classes = np.flatnonzero(demand)
    capacity = rules.size // rules.width
    if not len(classes):
        return np.zeros((0, len(demand)), np.int64), np.zeros(0)
    alone = capacity // (classes + 1)
    used = demand[classes] / alone
    basis = np.zeros((len(classes), len(demand)), np.int64)
    basis[np.arange(len(classes)), classes] = alone
    inverse = np.diag(1.0 / alone)
    for _ in range(rules.columns):
        duals = np.zeros(len(demand))
        duals[classes] = inverse.sum(axis=0)
        value, pattern = best_pattern(duals, capacity)
        # No solution has fewer sequences than this one's divided by the value.
        if value <= 1 + rules.gain:
            break
        step = inverse @ pattern[classes]
        bound = np.where(step > 1e-9, used / np.where(step > 1e-9, step, 1), np.inf)
        leaves = int(bound.argmin())
        amount = bound[leaves]
        used = np.maximum(used - amount * step, 0)
        used[leaves] = amount
        row = inverse[leaves] / step[leaves]
        inverse -= step[:, None] * row
        inverse[leaves] = row
        basis[leaves] = pattern
    return basis, used


def _rounded(histogram: np.ndarray, rules: PackRules) -> list[tuple[list[int], int]]:
    """Sequences as (the ranks of their first rests, how many such sequences follow by rank).

    histogram: rests of each length, from 0 to the size. Ranks order all rests by length.
    """
    n_classes = rules.size // rules.width
    of = (np.arange(rules.size + 1) + rules.width - 1) // rules.width - 1  # the class of a length
    demand = np.bincount(of[1:], histogram[1:], minlength=n_classes).astype(np.int64)
    basis, used = patterns(demand, rules)
    next_rank = np.concatenate([[0], np.cumsum(demand)])[:-1] + histogram[0]
    left = demand.copy()
    out = []
    for k in np.argsort(-used, kind="stable"):
        some = basis[k] > 0
        count = min(int(used[k] + 1e-6), int((left[some] // basis[k][some]).min()))
        if not count:
            continue
        ranks = []
        for c in np.flatnonzero(some)[::-1]:
            for _ in range(basis[k][c]):
                ranks.append(int(next_rank[c]))
                next_rank[c] += count
            left[c] -= basis[k][c] * count
        out.append((ranks, count))
    lengths_up_to = np.cumsum(histogram)
    room: list[list[list[int]]] = [[] for _ in range(rules.size + 1)]
    for c in np.flatnonzero(left)[::-1]:
        for rank in range(int(next_rank[c] + left[c]) - 1, int(next_rank[c]) - 1, -1):
            length = int(np.searchsorted(lengths_up_to, rank, "right"))
            fits = next((r for r in range(length, rules.size) if room[r]), None)
            ranks = room[fits].pop() if fits is not None else []
            ranks.append(rank)
            room[(fits if fits is not None else rules.size) - length].append(ranks)
    out.extend((ranks, 1) for each in room for ranks in each)
    return out


def planned(histogram: np.ndarray, rules: PackRules = PackRules()) -> Plan:
    up_to = np.cumsum(histogram)

    def length_of(rank: int) -> int:
        return int(np.searchsorted(up_to, rank, "right"))

    # Cut where a slot's length changes: then all sequences of an entry leave the same room.
    exact = []  # (free tokens, ranks, lengths, count)
    for ranks, count in _rounded(histogram, rules):
        done = 0
        while done < count:
            lengths = [length_of(r + done) for r in ranks]
            run = min(int(up_to[n]) - (r + done) for r, n in zip(ranks, lengths, strict=True))
            run = min(run, count - done)
            exact.append((rules.size - sum(lengths), [r + done for r in ranks], lengths, run))
            done += run
    exact.sort(key=lambda e: e[0])
    # Take the emptiest sequences apart until they fill all gaps of the others.
    gaps = sum(e[0] * e[3] for e in exact if e[0] > rules.free)
    donors, kept, tokens = [], list(exact), 0
    while kept and kept[-1][0] > rules.free:
        free, ranks, lengths, count = kept[-1]
        # Each one gives what it holds and no longer has a gap of its own.
        most = -(-(gaps - tokens) // rules.size)
        some = min(count, max(0, most))
        if not some:
            break
        kept.pop()
        if some < count:
            kept.append((free, ranks, lengths, count - some))
        donors.append(([r + count - some for r in ranks], lengths, some))
        tokens += sum(lengths) * some
        gaps -= free * some
    entries, fills, sequence = [], [], 0  # entries: first rank, count, sequence, offset, stream
    at = 0
    for free, ranks, lengths, count in kept:
        offset = 0
        for rank, length in zip(ranks, lengths, strict=True):
            entries.append((rank, sequence, offset, 0))
            offset += length
        if free > rules.free and tokens:
            fills.append((at, free, sequence, offset))
            at += free * count
        sequence += count
    stream = 0
    for ranks, lengths, count in donors:
        for rank, length in zip(ranks, lengths, strict=True):
            entries.append((rank, -1, 0, stream))
            stream += length * count
    if stream > at:  # what no gap takes fills sequences of its own
        fills.append((at, rules.size, sequence, 0))
        sequence += -(-(stream - at) // rules.size)
    entries.sort()
    first, sequences, offsets, streams = (np.array(c, np.int64) for c in zip(*entries, strict=True)) if entries else [np.zeros(0, np.int64)] * 4
    fill = np.array(fills, np.int64).reshape(-1, 4)
    return Plan(first, sequences, offsets, streams, *fill.T, sequence)


def _tokens(text: str | None, path: str, rules: PackRules) -> np.ndarray:
    """The ids of a text, which is cut where no token can be, and the id at its end."""
    vocabulary = byte_vocabulary(path)
    parts = segments(text) if text else []
    found = [vocabulary.ids(p if i == 0 else " " + p, special=True) for i, p in enumerate(parts)]
    return np.concatenate([*found, [rules.end_id]]).astype("<u4")


def _tokenized(documents: DataFrame, carried: list[str], path: str, rules: PackRules) -> DataFrame:
    """For each document its tokens' number, the checksums of its full pieces, the ids of the
    rest, 2 bytes each if that is enough, and the task and place that it was read at."""
    kind = np.uint16 if byte_vocabulary(path).bytes.size <= 1 << 16 else np.uint32
    rows = documents.select(packed(carried), "text")
    schema = rows.drop("text").schema
    for name, each in (
        ("doc_tokens", T.LongType()),
        ("crcs", T.ArrayType(T.LongType())),
        ("rest", T.BinaryType()),
        ("rest_length", T.LongType()),
        ("task", T.LongType()),
        ("place_in_task", T.LongType()),
    ):
        schema = schema.add(name, each)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, place = TaskContext.get().partitionId(), 0
        for piece in pieces(batches, "text"):
            counts, crcs, rests = [], [], []
            for text in piece.column("text").to_pylist():
                ids = _tokens(text, path, rules)
                full = len(ids) // rules.size
                counts.append(len(ids))
                crcs.append([zlib.crc32(ids[k * rules.size : (k + 1) * rules.size]) for k in range(full)])
                rests.append(ids[full * rules.size :].astype(kind).tobytes())
            n = len(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("row"),
                    pa.array(counts, pa.int64()),
                    lists(np.array([c for each in crcs for c in each], np.int64), np.array([len(c) for c in crcs]), pa.int64()),
                    pa.array(rests, pa.binary()),
                    pa.array(np.array(counts) % rules.size),
                    pa.array(np.full(n, task, np.int64)),
                    pa.array(np.arange(place, place + n)),
                ],
                [f.name for f in schema],
            )
            place += n

    return rows.mapInArrow(run, schema)


def _placed(rest: np.ndarray, rank: int, plan: Plan) -> list[tuple[int, int, int, int, int]]:
    """start in the rest, length, checksum, sequence and offset of its pieces."""
    i = int(np.searchsorted(plan.first, rank, "right")) - 1
    if plan.sequence[i] >= 0:
        return [(0, len(rest), zlib.crc32(rest), int(plan.sequence[i] + rank - plan.first[i]), int(plan.offset[i]))]
    at = int(plan.stream[i] + (rank - plan.first[i]) * len(rest))
    out, start = [], 0
    while start < len(rest):
        j = int(np.searchsorted(plan.gap_stream, at, "right")) - 1
        gap = int(plan.gap[j])
        number, inside = divmod(at - int(plan.gap_stream[j]), gap)
        length = min(gap - inside, len(rest) - start)
        out.append(
            (start, length, zlib.crc32(rest[start : start + length]), int(plan.gap_sequence[j]) + number, int(plan.gap_offset[j]) + inside)
        )
        start += length
        at += length
    return out


def packed_pieces(documents: DataFrame, path: str = BYTE_BPE, rules: PackRules = PackRules()) -> DataFrame:
    """The pieces that documents are cut into, one row each: documents' columns but text, with
    start, length, ids_crc32, doc_tokens, sequence_id and offset.

    A document's tokens are the ids of its text by the vocabulary of that file, in which the strings of special
    tokens stand for these, and an end id. A null or empty text has the end id alone. start
    counts the document's tokens before the piece; ids_crc32 is the CRC of its ids, four bytes
    each, low ones first; offset counts the sequence's tokens before it. The pieces of a sequence leave no
    gap between them, and at most rules.free tokens at its end; only the last one may be shorter.
    Repeated rows are documents of their own. An empty table gives an empty result. Very long
    texts are encoded in parts. Other columns are carried along; those named as the result's
    are left out.
    """
    carried = [c for c in documents.columns if c.lower() not in ("text", *PIECE)]
    spark = documents.sparkSession
    bound_batches(spark)
    wide = 2 if byte_vocabulary(path).bytes.size <= 1 << 16 else 4
    found = kept_table(_tokenized(documents, carried, path, rules), "tokens")
    # One row for each length of a rest.
    counted = found.groupBy("rest_length").agg(F.count(F.lit(1)).alias("n")).toArrow()
    histogram = np.zeros(rules.size + 1, np.int64)
    histogram[counted.column("rest_length").to_numpy()] = counted.column("n").to_numpy()
    plan = planned(histogram, rules)
    sent = spark.sparkContext.broadcast(plan)
    ranked = running_totals(
        found,
        [F.col("rest_length"), F.col("task"), F.col("place_in_task")],
        {"rank": F.lit(1), "full": F.size("crcs")},
        "rests",
    )
    rows = ranked.select("row", "doc_tokens", "crcs", "rest", F.col("rank") - 1, F.col("full") - F.size("crcs"))
    rows = rows.toDF("row", "doc_tokens", "crcs", "rest", "rank", "full_before")
    schema = rows.select("row").schema
    for name in PIECE:
        schema = schema.add(name, T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = sent.value
        for batch in batches:
            source, out = [], []
            columns = [batch.column(c).to_pylist() for c in ("doc_tokens", "crcs", "rest", "rank", "full_before")]
            for i, (tokens, crcs, rest, rank, before) in enumerate(zip(*columns, strict=True)):
                for k, crc in enumerate(crcs):
                    out.append((k * rules.size, rules.size, crc, tokens, plan.sequences + before + k, 0))
                if rest:
                    ids = np.frombuffer(rest, f"<u{wide}").astype("<u4")
                    shift = len(crcs) * rules.size
                    out.extend((shift + s, n, crc, tokens, q, o) for s, n, crc, q, o in _placed(ids, rank, plan))
                source.extend([i] * (len(out) - len(source)))
            values = np.array(out, np.int64).reshape(-1, len(PIECE))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(pa.array(source, pa.int64())), *[pa.array(v) for v in values.T]],
                [f.name for f in schema],
            )

    return rows.mapInArrow(run, schema).select(*unpacked(carried), *PIECE)
