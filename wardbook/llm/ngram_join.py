"""Jaccard join of texts on word n-grams, by chosen paths.

In each run every set of n-grams samples, with a hash all sets share, about two of its own
n-grams; each is a bucket. Buckets that are too large are split again by a further sample,
down to a last level, unless most of one stays together, as it does if its sets are similar. Similar sets choose alike, so a pair meets in some bucket of a run
with a known chance, and the runs are repeated until a pair at the threshold is met with
the target recall. Within buckets all pairs are compared, first by sketch, then exactly.

Equal texts are one set with several copies. A pair that meets in several buckets counts
in the lowest of them alone, which both sets' lists of buckets tell. Buckets that are not split
may be of any size: they are compared block by block, so that no task holds one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import ceil, exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.llm.components import components
from wardbook.llm.tables import bound_batches, kept_table
from wardbook.llm.words import lists, mix, pieces, window_hashes, within, words_of
from wardbook.operators.perhaps import perhaps

KEY = ("k1", "k2")
CELL = ("path", "i", "j")
#: 64-bit words of a sketch.
SKETCH = ("s1", "s2", "s3", "s4")


@dataclass(frozen=True)
class JoinRules:
    similarity: float = 0.8
    words: int = 5
    samples: float = 2.0  # n-grams that a set samples for one bucket, on average
    levels: int = 3
    bucket: int = 256  # sets of a bucket that is not split
    block: int = 640  # sets of a block, where a bucket is larger
    recall: float = 0.9999  # of pairs at the threshold; more similar ones are met more often
    sketch_distance: int = 88  # bits of 256; a pair at the threshold differs in 39, with a deviation of 6

    @property
    def runs(self) -> int:
        """Sets of similarity s share s of the larger one's n-grams at least, so a level of
        theirs has samples * s common buckets on average. Runs, until one survives all levels."""
        met = 1.0
        for _ in range(self.levels):
            met = 1 - exp(-self.samples * self.similarity * met)
        return ceil(log(1 - self.recall) / log(1 - met))


def ngrams(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of each text, ascending, one text after the other, and where each
    text starts. A text of fewer words is one n-gram of all of them."""
    words = words_of(column)
    hashes = words.hashes()
    starts, texts = within(words.first, n)
    found, of = [window_hashes(hashes, n)[starts]], [texts]
    for short in range(1, n):
        some = np.flatnonzero(words.counts == short)
        if len(some):
            found.append(window_hashes(hashes, short)[words.first[:-1][some]])
            of.append(some)
    grams, of = np.concatenate(found), np.concatenate(of)
    order = np.lexsort((grams, of))
    grams, of = grams[order], of[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (of[1:] != of[:-1])
    grams, of = grams[new], of[new]
    return grams, np.searchsorted(of, np.arange(len(column) + 1))


def sketches(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """SimHashes of 256 bits."""
    out = np.zeros((len(first) - 1, len(SKETCH)), np.uint64)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        half = np.diff(first)[some][:, None]
        for word in range(len(SKETCH)):
            hashes = mix(grams, word) if word else grams
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
            ones = np.add.reduceat(bits, first[some], axis=0, dtype=np.int32)
            out[some, word] = np.packbits(2 * ones > half, axis=1).view(np.uint64)[:, 0]
    return out


def samples(grams: np.ndarray, first: np.ndarray, rules: JoinRules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-grams that each set samples: slot (run * levels + level), n-gram and set, by set."""
    sizes = np.diff(first)
    share = np.minimum(rules.samples / np.maximum(sizes, 1) * 2.0**32, 2.0**32 - 1).astype(np.uint32)
    share = np.repeat(share, sizes)
    slots, places = [], []
    count = rules.runs * rules.levels
    for slot in range(0, count, 2):  # one hash is enough for two slots
        halves = mix(grams, 1000 + slot).view(np.uint32).reshape(-1, 2)
        for half in range(min(2, count - slot)):
            place = np.flatnonzero(halves[:, half] <= share)
            places.append(place)
            slots.append(np.full(len(place), slot + half, np.int32))
    slots, places = np.concatenate(slots), np.concatenate(places)
    sets = np.searchsorted(first, places, "right") - 1
    order = np.argsort(sets, kind="stable")
    return slots[order], grams[places[order]], sets[order]


def keyed(documents: DataFrame) -> DataFrame:
    """documents with k1 and k2, 128 bits of the text; null if it is null or has no word."""
    worded = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return documents.withColumns(
        {
            "k1": F.when(worded, F.xxhash64("text")),
            "k2": F.when(worded, F.xxhash64(F.lit("ngrams"), F.col("text"))),
        }
    )


def _described(texts: DataFrame, rules: JoinRules) -> DataFrame:
    """For each text its key, number of n-grams, sketch and samples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            grams, first = ngrams(piece.column("text"), rules.words)
            slots, tokens, sets = samples(grams, first, rules)
            counts = np.bincount(sets, minlength=piece.num_rows)
            sketch = sketches(grams, first).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *[piece.column(c) for c in (*KEY, "doc_id")],
                    pa.array(np.diff(first), pa.int32()),
                    *[pa.array(sketch[:, word]) for word in range(len(SKETCH))],
                    lists(slots, counts, pa.int32()),
                    lists(tokens.view(np.int64), counts, pa.int64()),
                ],
                [*KEY, "doc_id", "size", *SKETCH, "slots", "tokens"],
            )

    words = ", ".join(f"{c} long" for c in SKETCH)
    return texts.mapInArrow(
        run, f"k1 long, k2 long, doc_id long, size int, {words}, slots array<int>, tokens array<bigint>"
    )


def _leaves(classes: DataFrame, rules: JoinRules) -> DataFrame:
    """The buckets that are compared: path, n, the sets in it, and the key of each."""
    sampled = classes.select(*KEY, F.explode(F.arrays_zip("slots", "tokens")).alias("s")).select(
        *KEY,
        (F.col("s.slots") % rules.levels).alias("level"),
        F.floor(F.col("s.slots") / rules.levels).cast("int").alias("run"),
        F.col("s.tokens").alias("token"),
    )
    found, large = [], None
    entries = sampled.where("level = 0").select(
        *KEY, "run", F.xxhash64("run", "token").alias("path"), F.lit(0).cast("long").alias("of"), F.lit(0).cast("long").alias("of_n")
    )
    for level in range(rules.levels):
        sizes = entries.groupBy("path", "of", "of_n").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        # Written, so that the joins split a bucket of a third of all sets between tasks.
        sizes = kept_table(sizes, f"sizes-{level}", light=True)
        if large is not None:
            # A bucket that stays mostly together is one of similar sets: it is compared as it is.
            dense = sizes.groupBy("of", "of_n").agg(F.max("n").alias("most")).where("2 * most >= of_n").select("of")
            dense = kept_table(dense, f"dense-{level}", light=True)
            found.append(large.join(dense, large["path"] == dense["of"], "left_semi").select("path", "n", *KEY))
            sizes = sizes.join(dense, "of", "left_anti")
        shared = kept_table(entries.drop("of", "of_n").join(sizes.select("path", "n"), "path"), f"paths-{level}", light=level > 0)
        if level == rules.levels - 1:
            found.append(shared.select("path", "n", *KEY))
            break
        found.append(shared.where(F.col("n") <= rules.bucket).select("path", "n", *KEY))
        large = shared.where(F.col("n") > rules.bucket)
        if large.isEmpty():
            break
        tokens = sampled.where(F.col("level") == level + 1).drop("level")
        entries = large.join(tokens, [*KEY, "run"]).select(
            *KEY, "run", F.xxhash64("path", "token").alias("path"), F.col("path").alias("of"), F.col("n").alias("of_n")
        )
        entries = kept_table(entries, f"split-{level}", light=True)
    return reduce(DataFrame.unionByName, found)


def _dealt(leaves: DataFrame, rules: JoinRules) -> DataFrame:
    """leaves with block, i and j: a bucket's sets are dealt to blocks, and each pair of
    blocks is a cell. A bucket of up to one block is one cell."""
    blocks = F.ceil(F.col("n") / rules.block).cast("int")
    block = F.pmod(F.xxhash64(*KEY), blocks).cast("int")
    return (
        leaves.withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
        .drop("other")
    )


def _together(rows: DataFrame) -> DataFrame:
    return rows.repartition(*CELL).sortWithinPartitions(*CELL, *KEY)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Whole cells of rows sorted by cell: batches, and the first row of each cell and the end."""
    rest = None

    def cut(rows: pa.RecordBatch) -> np.ndarray:
        new = np.zeros(rows.num_rows, bool)
        for c in CELL:
            values = rows.column(c).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return np.concatenate([[0], np.flatnonzero(new), [rows.num_rows]])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.concat_batches([rest, batch]) if rest is not None else batch
        at = cut(rows)
        rest = rows.slice(at[-2])
        if len(at) > 2:
            yield rows.slice(0, at[-2]), at[:-1]
    if rest is not None:
        yield rest, np.array([0, rest.num_rows])


def _first_here(paths: pa.Array, path: int, low: int, high: int) -> np.ndarray:
    """For all pairs of rows, whether they share none of the buckets below this one."""
    offsets = paths.offsets.to_numpy()[low : high + 1]
    values = paths.values.to_numpy()[offsets[0] : offsets[-1]]
    rows = np.repeat(np.arange(high - low), np.diff(offsets))
    below = values < path
    known, place = np.unique(values[below], return_inverse=True)
    has = np.zeros((high - low, len(known)), np.float32)
    has[rows[below], place] = 1
    return has @ has.T == 0


def _pairs(rows: pa.RecordBatch, low: int, high: int) -> np.ndarray:
    """The pairs of a cell, each once: of one block, or across its two blocks."""
    n = high - low
    wanted = np.triu(np.ones((n, n), bool), 1)
    if rows.column("i")[low].as_py() != rows.column("j")[low].as_py():
        block = rows.column("block").to_numpy()[low:high]
        wanted &= block[:, None] != block[None]
    return wanted


def _near(cells: DataFrame, rules: JoinRules) -> DataFrame:
    """The members of cells that have a partner of like size, near by sketch, whom they meet there first.

    Sets of similarity s have sizes of which the smaller is s of the larger one at least.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, at in _groups(batches):
            sketch = [rows.column(c).to_numpy() for c in SKETCH]
            sizes = rows.column("size").to_numpy()
            paths = rows.column("paths")
            path = rows.column("path").to_numpy()
            keep = np.zeros(rows.num_rows, bool)
            for low, high in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                if high - low < 2:
                    continue
                apart = np.zeros((high - low, high - low), np.int16)
                for words in sketch:
                    some = words[low:high].view(np.uint64)
                    apart += np.bitwise_count(some[:, None] ^ some[None])
                near = (apart <= rules.sketch_distance) & _pairs(rows, low, high)
                if near.any():
                    size = sizes[low:high]
                    least, most = np.minimum(size[:, None], size[None]), np.maximum(size[:, None], size[None])
                    near &= least >= rules.similarity * most - 1e-9
                if near.any():
                    near &= _first_here(paths, path[low], low, high)
                    keep[low:high] = near.any(axis=0) | near.any(axis=1)
            yield rows.select([*CELL, "block", *KEY, "paths"]).filter(pa.array(keep))

    return cells.mapInArrow(run, "path long, i int, j int, block int, k1 long, k2 long, paths array<bigint>")


def _shared(grams: pa.ListArray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of n-grams that all pairs of rows share, and of each row's."""
    offsets = grams.offsets.to_numpy()[low : high + 1]
    values = grams.values.to_numpy()[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    n = high - low
    if n == 2:
        both = len(np.intersect1d(values[: sizes[0]], values[sizes[0] :], assume_unique=True))
        return np.array([[sizes[0], both], [both, sizes[1]]]), sizes
    # Most n-grams are one set's alone; only the others can be shared.
    order = np.argsort(values, kind="stable")
    values, rows = values[order], np.repeat(np.arange(n), sizes)[order]
    same = values[1:] == values[:-1]
    several = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    known, place = np.unique(values[several], return_inverse=True)
    rows = rows[several]
    shared = np.diag(sizes - np.bincount(rows, minlength=n)).astype(np.float32)
    width = 8192  # columns of n-grams at once
    for first in range(0, len(known), width):
        a, b = np.searchsorted(place, [first, first + width])
        has = np.zeros((n, min(width, len(known) - first)), np.float32)
        has[rows[a:b], place[a:b] - first] = 1
        shared += has @ has.T
    return shared, sizes


def _linked(cells: DataFrame, rules: JoinRules) -> DataFrame:
    """For each member of a cell with links: their number, and the lowest key it is tied to there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, at in _groups(_with_ngrams(batches, rules)):
            path = rows.column("path").to_numpy()
            links, root = np.zeros(rows.num_rows, np.int64), np.arange(rows.num_rows)
            for low, high in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                if high - low < 2:
                    continue
                shared, sizes = _shared(rows.column("grams"), low, high)
                union = sizes[:, None] + sizes[None] - shared
                similar = (shared >= rules.similarity * union - 1e-9) & _pairs(rows, low, high)
                if similar.any():
                    similar &= _first_here(rows.column("paths"), path[low], low, high)
                    similar |= similar.T
                    links[low:high] = similar.sum(axis=1)
                    root[low:high] = low + _lowest(similar)
            some = pa.array(links > 0)
            tied = rows.take(pa.array(root))
            yield pa.RecordBatch.from_arrays(
                [rows.column("k1"), rows.column("k2"), pa.array(links), tied.column("k1"), tied.column("k2")],
                [*KEY, "n_links", "r1", "r2"],
            ).filter(some)

    return cells.mapInArrow(run, "k1 long, k2 long, n_links long, r1 long, r2 long")


def _lowest(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links, the lowest row of its component."""
    label = np.arange(len(linked))
    while True:
        to = np.minimum(label, np.where(linked, label[None], len(label)).min(axis=1))
        if (to == label).all():
            return label
        label = to


def _texts(keyed_documents: DataFrame, keys: DataFrame) -> DataFrame:
    """The texts of these keys, and few others, each once. Texts that no key asks for are left
    out before the others are dealt by the key."""
    asked = perhaps(keyed_documents.where("k1 IS NOT NULL"), keys, F.col("k1"))
    return asked.groupBy(*KEY).agg(F.any_value("text").alias("text"))


def _with_ngrams(batches: Iterator[pa.RecordBatch], rules: JoinRules) -> Iterator[pa.RecordBatch]:
    """The batches with the n-grams of their texts in the texts' place."""
    for batch in batches:
        found = []
        for piece in pieces([batch], "text"):
            grams, first = ngrams(piece.column("text"), rules.words)
            found.append(lists(grams.view(np.int64), np.diff(first), pa.int64()))
        if found:
            yield batch.drop_columns(["text"]).append_column("grams", pa.concat_arrays(found))


def text_classes(documents: DataFrame, rules: JoinRules = JoinRules()) -> DataFrame:
    """One row for each different text: k1, k2, rep_id, copies, n_links, class_id, winner.

    rep_id is the lowest doc_id of the text's copies, nulls apart; n_links the number of
    other texts of Jaccard similarity 0.8 or more on sets of five-word n-grams; class_id
    the lowest rep_id of all texts that links connect it with; winner marks one text of
    each such group, that of class_id. Words are separated by ASCII blanks and otherwise
    unchanged. Null and wordless texts have no row.
    """
    bound_batches(documents.sparkSession)
    rows = keyed(documents.select("doc_id", "text"))
    described = _described(rows.where("k1 IS NOT NULL"), rules)
    classes = kept_table(
        described.groupBy(*KEY).agg(
            F.min("doc_id").alias("rep_id"),
            F.count(F.lit(1)).alias("copies"),
            *[F.any_value(c).alias(c) for c in ("size", *SKETCH, "slots", "tokens")],
        ),
        "classes",
    )
    leaves = _leaves(classes, rules)
    met = leaves.groupBy(*KEY).agg(F.array_sort(F.collect_set("path")).alias("paths"))
    members = met.join(classes.select(*KEY, "size", *SKETCH), list(KEY))
    cells = _dealt(leaves, rules).join(members, list(KEY))
    near = kept_table(_near(_together(cells.select(*CELL, "block", *KEY, "size", *SKETCH, "paths")), rules), "near")
    texts = _texts(rows.select(*KEY, "text"), near.select(*KEY).distinct())
    linked = kept_table(_linked(_together(near.join(texts, list(KEY))), rules), "linked")
    key = F.struct(*KEY)
    tied = components(linked.select(key.alias("a"), F.struct(F.col("r1").alias("k1"), F.col("r2").alias("k2")).alias("b")))
    counts = linked.groupBy(*KEY).agg(F.sum("n_links").alias("n_links"))
    tied = tied.select("node.*", "root")
    named = (
        classes.select(*KEY, "rep_id", "copies")
        .join(counts, list(KEY), "left")
        .join(tied, list(KEY), "left")
        .select(*KEY, "rep_id", "copies", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", key).alias("root"))
    )
    first = F.min(F.struct(F.col("rep_id").isNull(), "rep_id", *KEY)).alias("first")
    groups = named.groupBy("root").agg(first)
    return named.join(groups, "root").select(
        *KEY,
        "rep_id",
        "copies",
        "n_links",
        F.col("first.rep_id").alias("class_id"),
        ((F.col("first.k1") == F.col("k1")) & (F.col("first.k2") == F.col("k2"))).alias("winner"),
    )


def joined(documents: DataFrame, rules: JoinRules = JoinRules()) -> DataFrame:
    """documents' columns but text, with class_id, n_links, rep_id and copies.

    One row a document; see text_classes(). Documents of one class_id are copies of each
    other or connected by links; rep_id names the document's own text. A null or wordless
    text is in no group: its class_id and rep_id are its own doc_id, with 0 links and 1
    copy. Texts of fewer than five words have one n-gram, of all their words. Repeated
    rows are copies. If all doc_ids of a group are null, so is its class_id. An empty
    table gives an empty result. Columns of documents called k1, k2 or as the result's
    are left out.
    """
    added = ("class_id", "n_links", "rep_id", "copies")
    carried = [c for c in documents.columns if c.lower() not in (*added, "text", "k1", "k2")]
    classes = text_classes(documents, rules).drop("winner")
    rows = keyed(documents.select(*[F.col(f"`{c}`") for c in carried], "text")).drop("text")
    alone = F.col("k1").isNull()
    return rows.join(classes, list(KEY), "left").select(
        *[F.col(f"`{c}`") for c in carried],
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("rep_id")).alias("rep_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
    )


def one_of_each(documents: DataFrame, rules: JoinRules = JoinRules()) -> DataFrame:
    """documents, one of each group: the row of its class_id; null and wordless texts all stay.

    The winners' rows are found by the text's key, by which both sides are dealt; of rows
    with the same doc_id and text, one stays.
    """
    winners = kept_table(text_classes(documents, rules).where("winner").select(*KEY, "class_id"), "winners")
    rows = keyed(documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), "text"))
    mine = F.col("row")["doc_id"].eqNullSafe(F.col("class_id"))
    kept = rows.join(winners, list(KEY)).where(mine).dropDuplicates(list(KEY))
    return rows.where("k1 IS NULL").select("row.*").unionByName(kept.select("row.*"))
