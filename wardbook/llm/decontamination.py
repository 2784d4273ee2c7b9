"""Benchmark decontamination: windows of a document that are nearly a benchmark item.

Windows of the items' sizes slide over every document; each has a SimHash of its
shingles. Fingerprints are cut into blocks, and a table by block value names the items
within the block's share of the radius: two fingerprints within the radius agree that
far in one block at least, so no pair within the radius is missed. Fingerprints bound no
similarity, so the rare shingles of every item, of which each similar window has one, are
looked up as well, as a second net. The candidates of both are verified by the exact
weighted similarity of window and item: no leak is missed.

Documents are read where they lie and nothing is shuffled. Items, which are few, are
sent to the tasks a bounded block at a time; each block is one pass over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardbook.llm.tables import bound_batches
from wardbook.llm.words import pieces, plain_words_of, ranges, window_hashes, within

BITS, BLOCKS = 64, 4
BLOCK_BITS = BITS // BLOCKS
LANES, ONE_EACH = 16, np.uint64(0x0001000100010001)
WINDOWS_AT_ONCE = 1 << 16
#: Windows of fewer shingles are counted in planes of bits, many at a time.
LONG = 128
SEEN_BITS = 22


@dataclass(frozen=True)
class LeakRules:
    """Words are runs of letters and digits, in lower case."""

    similarity: float = 0.8
    shingle: int = 5
    block_radius: int = 3  # of a block; all fingerprints within 4 * 3 + 3 = 15 bits are found
    length_ratio: float = 1.12  # between one window length and the next
    steps: int = 12  # windows that start within one window's length
    items_at_once: int = 2048
    bytes_at_once: int = 1 << 25  # of the items' texts
    lookup: bool = True  # of rare shingles; without it the fingerprints alone find candidates

    @property
    def radius(self) -> int:
        return BLOCKS * (self.block_radius + 1) - 1


@dataclass(frozen=True)
class Items:
    """Benchmark items: ids, and the shingles of each."""

    ids: list[int | None]
    shingles: list[np.ndarray]


@dataclass
class Shingles:
    """The shingles of some texts, one text after the other, and where each text starts."""

    hashes: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, column: pa.Array, length: int) -> Shingles:
        words = plain_words_of(column)
        starts, texts = within(words.first, length)
        counts = np.bincount(texts, minlength=len(column))
        return cls(window_hashes(words.hashes(), length)[starts], np.concatenate([[0], np.cumsum(counts)]))

    def ones(self) -> np.ndarray:
        """For each bit, how many of the shingles before each place have it.

        Four counts of 16 bits share a number. They run over into each other, but the
        difference of two rows is right as long as its own counts fit.
        """
        total = np.zeros((LANES, len(self.hashes) + 1), np.uint64)
        for lane in range(LANES):
            np.cumsum((self.hashes >> np.uint64(lane)) & ONE_EACH, out=total[lane, 1:])
        return np.ascontiguousarray(total.T)


def fingerprints(before: np.ndarray, upto: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """SimHashes of runs of fewer than 2**15 shingles, from the counts of ones before each
    run and up to its end; a shingle that occurs twice weighs twice."""
    have = (upto - before).view(np.uint16)
    half = (sizes // 2).astype(np.uint16)[:, None]
    return np.packbits(have > half, axis=1).view(np.uint64)[:, 0]


def _bit_order() -> np.ndarray:
    """For each byte of a hash and each value of it, its bits where fingerprints() puts them."""
    tables = []
    for byte in range(8):
        ones = Shingles(np.arange(256, dtype=np.uint64) << np.uint64(8 * byte), None).ones()
        tables.append(fingerprints(ones[:-1], ones[1:], np.ones(256, np.int64)))
    return np.array(tables)


_BIT_ORDER = _bit_order()

#: A count for each bit of a hash: the numbers with the lowest bits of all counts, with the next, ...
Planes = list[np.ndarray]


def _added(a: Planes, b: Planes, most: int) -> Planes:
    """The sums of counts, none of them over most."""
    planes: Planes = []
    carry: Planes = []
    for i in range(most.bit_length()):
        x, *others = a[i : i + 1] + b[i : i + 1] + carry
        carry = []
        last = i + 1 == most.bit_length()
        for y in others:
            if not last:
                carry.append(x & y)
            x = x ^ y
        carry = [carry[0] | carry[1]] if len(carry) == 2 else carry  # never both
        planes.append(x)
    return planes


class RunCounts:
    """How many shingles of each run of fewer than LONG have each bit.

    The counts of runs of 1, 2, 4, ... shingles are kept, from every shingle on; each is the
    sum of two of half the length, and every other run is a sum of some of them.
    """

    def __init__(self, hashes: np.ndarray, longest: int):
        ordered = np.zeros_like(hashes)
        for byte, table in enumerate(_BIT_ORDER):
            ordered |= table.take(hashes.view(np.uint8)[byte::8])
        self.doubled: list[Planes] = [[ordered]]
        for power in range(1, longest.bit_length()):
            half, n = 1 << power - 1, max(0, len(hashes) - (1 << power) + 1)
            have = self.doubled[-1]
            self.doubled.append(_added([p[:n] for p in have], [p[half : half + n] for p in have], 2 * half))

    def fingerprints(self, start: int, stop: int, step: int, length: int) -> np.ndarray:
        """fingerprints() of the runs of this length that start at start, start + step, ... before stop."""
        planes: Planes = []
        done = 0
        for power, have in enumerate(self.doubled):
            if length >> power & 1:
                part = [p[start + done : stop + done : step] for p in have]
                done += 1 << power
                planes = _added(planes, part, done)
        more = None  # than half the length, by the bits up to each plane
        for i, plane in enumerate(planes):
            if length // 2 >> i & 1:
                more = more if more is None else more & plane
            else:
                more = plane if more is None else more | plane
        return np.ascontiguousarray(more)


class Index:
    """Items by the length of window they are sought with, and by blocks of their fingerprints."""

    def __init__(self, items: Items, rules: LeakRules):
        self.items, self.rules = items, rules
        flips = [
            sum(1 << b for b in some)
            for n in range(rules.block_radius + 1)
            for some in combinations(range(BLOCK_BITS), n)
        ]
        self.classes = []
        members: dict[int, list[int]] = {}
        for at, shingles in enumerate(items.shingles):
            if len(shingles):
                level = round(np.log(len(shingles)) / np.log(rules.length_ratio))
                members.setdefault(level, []).append(at)
        for _, some in sorted(members.items()):
            sizes = [len(items.shingles[i]) for i in some]
            prints = np.concatenate(
                [
                    fingerprints(*s.ones()[[0, -1], None], np.array([len(s.hashes)]))
                    for s in (Shingles(items.shingles[i], None) for i in some)
                ]
            )
            groups = []
            for at in range(0, len(some), 64):  # a bit of a number for each item
                part = prints[at : at + 64]
                kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if 8 * k(0).nbytes >= len(part))
                tables = np.zeros((BLOCKS, 1 << BLOCK_BITS), kind)
                for place, blocks in enumerate(part.view(np.uint16).reshape(-1, BLOCKS)):
                    for block, value in enumerate(blocks):
                        tables[block, int(value) ^ np.array(flips)] |= kind(1 << place)
                groups.append((np.array(some[at : at + 64]), part, tables))
            self.classes.append((round(float(np.median(sizes))), groups))
        self.distinct = [np.unique(s, return_counts=True) for s in items.shingles]
        self.sizes = np.array([len(s) for s in items.shingles], np.int64)
        self._index_rare()

    def _index_rare(self) -> None:
        """Of each item, those shingles that the fewest items have and that outweigh all that
        a similar window can lack.

        A window of w shingles that shares s with an item of n has s >= r (n + w) / (1 + r) at
        the least similarity r; w is n, or less in a shorter document, and w >= s, so that
        s >= r n: it lacks (1 - r) n at most.
        """
        every, owners = np.unique(np.concatenate([np.zeros(0, np.uint64), *(d for d, _ in self.distinct)]), return_counts=True)
        rare, of = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for at, (shingles, weights) in enumerate(self.distinct):
            order = np.lexsort((shingles, owners[np.searchsorted(every, shingles)]))
            lacking = int((1 - self.rules.similarity) * self.sizes[at] + 1e-6)
            enough = int(np.searchsorted(weights[order].cumsum(), lacking, "right")) + 1
            rare.append(shingles[order[:enough]])
            of.append(np.full(len(rare[-1]), at))
        shingles, of = np.concatenate(rare), np.concatenate(of)
        order = np.argsort(shingles, kind="stable")
        self.owners = of[order]
        self.rare, self.rare_first = np.unique(shingles[order], return_index=True)
        self.rare_counts = np.diff(np.append(self.rare_first, len(order)))
        self.seen = np.zeros(1 << SEEN_BITS, bool)
        self.seen[self.rare >> np.uint64(64 - SEEN_BITS)] = True

    def rare_places(self, texts: Shingles) -> tuple[np.ndarray, np.ndarray]:
        """Where the texts have a rare shingle of an item, and which."""
        place = np.flatnonzero(self.seen.take((texts.hashes >> np.uint64(64 - SEEN_BITS)).view(np.int64)))
        at = np.searchsorted(self.rare, texts.hashes[place])
        hit = self.rare[np.minimum(at, len(self.rare) - 1)] == texts.hashes[place] if len(place) else np.zeros(0, bool)
        return place[hit], at[hit]

    def around_rare(self, texts: Shingles) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the parts of a text that hold all windows of an item's size with
        a rare shingle of it, and the item."""
        place, at = self.rare_places(texts)
        items = self.owners[ranges(self.rare_first[at], self.rare_counts[at])]
        place = np.repeat(place, self.rare_counts[at])
        of = np.searchsorted(texts.first, place, "right") - 1
        starts = np.maximum(place - self.sizes[items] + 1, texts.first[of])
        return starts, np.minimum(place + self.sizes[items], texts.first[of + 1]), items

    def candidates(self, texts: Shingles) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Starts and ends of windows and the item that each is within the radius of."""
        if len(texts.hashes) and self.classes:
            yield from self._whole(texts)
            yield from self._cut_or_long(texts)

    def _whole(self, texts: Shingles) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """candidates() among the windows of fewer than LONG shingles that lie in one text."""
        n = len(texts.hashes)
        short = [(length, groups) for length, groups in self.classes if length < LONG]
        if not short:
            return
        longest = max(length for length, _ in short)
        part = -(-n // -(-n // WINDOWS_AT_ONCE))
        for at in range(0, n, part):
            runs = RunCounts(texts.hashes[at : at + part + longest - 1], longest)
            for length, groups in short:
                step = max(1, length // self.rules.steps)
                first = -(-at // step) * step
                stop = min(at + part, n - length + 1)
                if first >= stop:
                    continue
                found = runs.fingerprints(first - at, stop - at, step, length)
                for window, item in self._within_radius(found, groups):
                    start = first + step * window
                    whole = start + length <= texts.first[np.searchsorted(texts.first, start, "right")]
                    yield start[whole], start[whole] + length, item[whole]

    def _cut_or_long(self, texts: Shingles) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """candidates() among the windows that a text's end cuts off and the long ones, which are
        counted one by one."""
        first, stop = texts.first[:-1], texts.first[1:]
        longest = max(length for length, _ in self.classes)
        lasts = np.minimum(stop - first, longest) if longest < LONG else stop - first
        ones = Shingles(texts.hashes[ranges(stop - lasts, lasts)], None).ones()
        shift = np.cumsum(lasts) - stop
        for length, groups in self.classes:
            step = max(1, length // self.rules.steps)
            # A document shorter than the window is a window, if an item of this size can match it.
            least = int(np.ceil(self.rules.similarity * length * 0.9))
            low = -(-(np.maximum(first, stop - length + 1) if length < LONG else first) // step)
            counts = np.maximum((stop - least) // step + 1 - low, 0)
            starts, of = step * ranges(low, counts), np.repeat(np.arange(len(first)), counts)
            for at in range(0, len(starts), WINDOWS_AT_ONCE):
                start, text = starts[at : at + WINDOWS_AT_ONCE], of[at : at + WINDOWS_AT_ONCE]
                end = np.minimum(start + length, stop[text])
                before, upto = (ones.take(places + shift[text], axis=0) for places in (start, end))
                found = fingerprints(before, upto, end - start)
                for window, item in self._within_radius(found, groups):
                    yield start[window], end[window], item

    def _within_radius(self, found: np.ndarray, groups: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Which of the windows with these fingerprints are within the radius of an item, and the items."""
        blocks = found.view(np.uint16).reshape(-1, BLOCKS)
        for items, prints, tables in groups:
            shift = tables.itemsize.bit_length() + 2  # 8 * itemsize bits a window
            near = tables[0].take(blocks[:, 0])
            for block in range(1, BLOCKS):
                near |= tables[block].take(blocks[:, block])
            near = near.view(np.uint8)
            some = np.flatnonzero(near != 0)
            place = np.flatnonzero(np.unpackbits(near.take(some), bitorder="little").view(bool))
            bit = (some.take(place >> 3) << 3) + (place & 7)
            window, item = bit >> shift, bit & (1 << shift) - 1
            close = np.flatnonzero(np.bitwise_count(found.take(window) ^ prints.take(item)) <= self.rules.radius)
            if len(close):
                yield window[close], items[item[close]]

    def leaks(self, column: pa.Array) -> list[tuple[int, int, float, int]]:
        """Of each text and item that leak: the text's place, the item's, the similarity and
        the first word of the best window, the first of equals."""
        texts = Shingles.of(column, self.rules.shingle)
        spans: dict[tuple[int, int], list[tuple[int, int]]] = {}
        second = [self.around_rare(texts)] if self.rules.lookup else []
        for starts, ends, items in chain(self.candidates(texts), second):
            of = np.searchsorted(texts.first, starts, "right") - 1
            for key, start, end in zip(zip(of.tolist(), items.tolist(), strict=True), starts.tolist(), ends.tolist(), strict=True):
                spans.setdefault(key, []).append((start, end))
        found = []
        for (text, item), windows in sorted(spans.items()):
            best = self.verified(texts, text, item, windows)
            if best and best[0] >= self.rules.similarity:
                found.append((text, item, *best))
        return found

    def verified(self, texts: Shingles, text: int, item: int, windows: list[tuple[int, int]]) -> tuple[float, int] | None:
        """The highest weighted similarity of the item to a window of its size that starts
        around a candidate, and the window's first word in the text; None if it is too low."""
        first, stop = int(texts.first[text]), int(texts.first[text + 1])
        wanted, weights = self.distinct[item]
        size = int(self.sizes[item])
        best = None
        for low, high in _merged(windows, size):
            low, high = max(first, low), min(stop, high)
            part = texts.hashes[low:high]
            place = np.minimum(np.searchsorted(wanted, part), len(wanted) - 1)
            hit = wanted[place] == part
            span = min(size, len(part))
            # A window shares no more than it has of the item's shingles, and no more than all parts have.
            all_hits = min(span, int(np.count_nonzero(hit)))
            if all_hits / (size + span - all_hits) < self.rules.similarity:
                continue
            most = np.concatenate([[0], np.cumsum(hit)])
            most = most[span:] - most[: len(most) - span]
            enough = np.flatnonzero(most / (size + span - most) >= self.rules.similarity)
            if not len(enough):
                continue
            low += int(enough[0])
            place, hit = place[enough[0] : enough[-1] + span], hit[enough[0] : enough[-1] + span]
            hit = np.flatnonzero(hit)
            shared = _shared(hit, place[hit], weights, span, len(place))
            similar = shared / (size + span - shared)
            at = int(similar.argmax())
            if best is None or similar[at] > best[0]:
                best = (float(similar[at]), low + at - first)
        return best


def _shared(places: np.ndarray, kinds: np.ndarray, weights: np.ndarray, span: int, n: int) -> np.ndarray:
    """For each window of span among n places, how many of these kinds' places it has, of
    each kind no more than its weight.

    A place counts in the windows it is in that start after the place of its kind that lies
    as many back as the kind weighs: memory is linear in the places, whatever the kinds.
    """
    order = np.argsort(kinds, kind="stable")
    places, kinds = places[order], kinds[order]
    back = np.arange(len(places)) - weights[kinds]
    full = np.where(back >= np.searchsorted(kinds, kinds), places[np.maximum(back, 0)], -1)
    begin = np.maximum(np.maximum(full, places - span) + 1, 0)
    change = np.bincount(begin, minlength=n + 1) - np.bincount(places + 1, minlength=n + 1)
    return change.cumsum()[: n - span + 1]


def _merged(windows: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    """The windows, with half a window on either side, as parts that don't overlap."""
    parts: list[list[int]] = []
    for start, end in sorted(windows):
        low, high = start - size // 2, end + size // 2
        if parts and low <= parts[-1][1]:
            parts[-1][1] = max(parts[-1][1], high)
        else:
            parts.append([low, high])
    return [(low, high) for low, high in parts]


def item_blocks(benchmark: DataFrame, rules: LeakRules) -> Iterator[Items]:
    """The items, by hash, in blocks of items_at_once and bytes_at_once or so; those without text left out."""
    rows = benchmark.select("item_id", "text").where("text IS NOT NULL")
    size = rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    blocks = max(1, -(-size["rows"] // rules.items_at_once), -(-size["bytes"] // rules.bytes_at_once))
    for block in range(blocks):
        # A block is of that size on average, whatever the benchmark's.
        some = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).toArrow()
        some = some.sort_by([("item_id", "ascending"), ("text", "ascending")])
        shingles = Shingles.of(some["text"].combine_chunks(), rules.shingle)
        each = np.split(shingles.hashes, shingles.first[1:-1])
        yield Items(some["item_id"].to_pylist(), each[: some.num_rows])


def leaks(documents: DataFrame, benchmark: DataFrame, rules: LeakRules = LeakRules()) -> DataFrame:
    """The documents' columns but text, item_id, similarity and first_word, a row for each
    document and item that leaks into it.

    first_word counts the words (letters and digits) before the best window. Whole texts
    are read. Null and empty texts, and texts or items of fewer than five words, have no
    shingle and never match. An item that is longer than a document is compared with all
    of it. Repeated rows and repeated items are each reported; an empty table on either
    side gives an empty result. Columns of documents with the result's names are left out.
    """
    bound_batches(documents.sparkSession)
    carried = [c for c in documents.columns if c.lower() not in ("text", "item_id", "similarity", "first_word")]
    rows = documents.select(*[F.col(f"`{c}`") for c in carried], "text")
    kept = T.StructType(
        rows.select(*[F.col(f"`{c}`") for c in carried]).schema.fields
        + [T.StructField("item_id", T.LongType()), T.StructField("similarity", T.DoubleType()), T.StructField("first_word", T.LongType())]
    )

    def passed(items: Items) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(items, rules)
            for piece in pieces(batches, "text"):
                found = index.leaks(piece.column("text"))
                if found:
                    text, item, similar, word = zip(*found, strict=True)
                    of = piece.take(pa.array(text))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *[of.column(c) for c in carried],
                            pa.array([items.ids[i] for i in item], pa.int64()),
                            pa.array(similar, pa.float64()),
                            pa.array(word, pa.int64()),
                        ],
                        [*carried, "item_id", "similarity", "first_word"],
                    )

        return rows.mapInArrow(run, kept)

    return reduce(DataFrame.unionByName, [passed(items) for items in item_blocks(benchmark, rules)])


def decontaminated(documents: DataFrame, benchmark: DataFrame, rules: LeakRules = LeakRules()) -> DataFrame:
    """The documents into which no item leaks, in all columns. See leaks() for the cases."""
    bound_batches(documents.sparkSession)
    for items in item_blocks(benchmark, rules):

        def run(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            index = Index(items, rules)
            for piece in pieces(batches, "text"):
                clean = np.ones(piece.num_rows, bool)
                clean[[text for text, *_ in index.leaks(piece.column("text"))]] = False
                yield piece.filter(pa.array(clean))

        documents = documents.mapInArrow(run, documents.schema)
    return documents
