"""Language identification by a byte convolutional network.

Filters of several widths run over fixed-length windows of a text's UTF-8 bytes; each
filter's largest answer in a window goes into a softmax over the languages. A text's
probabilities are those of its windows, weighted by their bytes. The network is trained
with numpy on the driver, on a bounded sample of labelled texts, and applied in Spark
tasks to whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardbook.llm.tables import bound_batches
from wardbook.llm.words import pieces, ranges, text_bytes

UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageRules:
    """per_language and most_texts bound the sample that the network is trained on."""

    per_language: int = 500
    most_texts: int = 8000
    window: int = 256  # bytes
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16  # of each width
    epochs: int = 10
    batch: int = 64
    rate: float = 0.01
    decay: float = 1e-4
    seed: int = 7


@dataclass(frozen=True)
class LanguageModel:
    """languages: the learned values, by code point. filters: for each width, weights by
    place, byte and filter; byte 0, which fills short windows, weighs nothing."""

    languages: tuple[str, ...]
    window: int
    filters: tuple[np.ndarray, ...]
    biases: np.ndarray  # of all filters
    dense: np.ndarray
    offsets: np.ndarray  # of the languages


def sample(documents: DataFrame, rules: LanguageRules) -> DataFrame:
    """At most per_language snippets of each language, most_texts in all: lang and snippet.

    A keyed hash of the id picks the texts and the place of the snippet in each, whatever
    the order of rows. Rows without text or lang teach nothing.
    """
    place = F.xxhash64("doc_id", F.lit(rules.seed))
    span = F.greatest(F.length("text") - rules.window, F.lit(1))
    snippets = documents.where("text IS NOT NULL AND lang IS NOT NULL").select(
        "lang", place.alias("place"), F.substring("text", F.pmod(place, span).cast("int") + 1, rules.window).alias("snippet")
    )
    # First in groups of input splits, then among what is left of them: a language's last task
    # reads as many rows as the root of the number of splits, not as the splits.
    groups = ceil(sqrt(max(1, snippets.rdd.getNumPartitions())))
    few = snippets.withColumn("group", F.spark_partition_id() % groups)
    for by in (["lang", "group"], ["lang"]):
        ranked = Window.partitionBy(*by).orderBy("place", "snippet")
        few = few.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= rules.per_language)
    return few.orderBy("rank", "place", "lang", "snippet").limit(rules.most_texts).select("lang", "snippet")


def windows(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts' bytes, in lower case, as rows of one length filled up with 0; the text
    of each row, and its number of bytes. An empty text has one row of 0."""
    data, offsets = text_bytes(pc.utf8_lower(column))
    sizes = np.diff(offsets)
    rows = np.maximum(-(-sizes // length), 1)
    text = np.repeat(np.arange(len(rows)), rows)
    at = ranges(np.zeros(len(rows), np.int64), rows) * length
    used = np.minimum(sizes[text] - at, length)
    out = np.zeros((len(text), length), np.uint8)
    out[np.arange(length) < used[:, None]] = data
    return out, text, used


def _answers(model: LanguageModel, rows: np.ndarray, tables: list) -> np.ndarray:
    """The largest answer of every filter in every row."""
    n, length = rows.shape
    most = max(len(f) for f in model.filters)
    wide = np.zeros((n, length + most), np.int32)
    wide[:, :length] = rows
    pair = wide[:, :-1] * 256 + wide[:, 1:]
    found = []
    for parts in tables:
        total = None
        for at, table in parts:
            ids = (pair if len(table) > 256 else wide)[:, at : at + length]
            got = np.take(table, ids, axis=0)
            total = got if total is None else np.add(total, got, out=total)
        found.append(total.max(axis=1))
    return np.concatenate(found, axis=1)


def _tables(model: LanguageModel) -> list:
    """Each width's filters as tables of byte pairs, and of a last single byte: fewer lookups."""
    tables = []
    for f in model.filters:
        parts = [(at, (f[at][:, None] + f[at + 1][None]).reshape(1 << 16, -1)) for at in range(0, len(f) - 1, 2)]
        if len(f) % 2:
            parts.append((len(f) - 1, f[-1]))
        tables.append(parts)
    return tables


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def probabilities(model: LanguageModel, column: pa.Array, tables: list | None = None) -> np.ndarray:
    """The probability of each language, for each text: the mean of its windows'."""
    rows, text, used = windows(column, model.window)
    tables = tables or _tables(model)
    answers = [_answers(model, rows[i : i + 256], tables) for i in range(0, len(rows), 256)]
    hidden = np.maximum(np.concatenate(answers) + model.biases, 0)
    each = _softmax(hidden @ model.dense + model.offsets) * np.maximum(used, 1)[:, None]
    first = np.searchsorted(text, np.arange(len(column)))
    total = np.add.reduceat(each, first, axis=0)
    return total / total.sum(axis=1, keepdims=True)


def fitted(languages: list[str], snippets: list[str], rules: LanguageRules = LanguageRules()) -> LanguageModel | None:
    """A network from labelled snippets; None if there are none.

    Every snippet is seen whole and cut short at random, so that short texts are learned
    too. Adam steps on the cross entropy; the largest answer passes its slope on to the
    bytes that gave it.
    """
    if not snippets:
        return None
    chance = np.random.default_rng(rules.seed)
    known = tuple(sorted(set(languages)))
    y = np.searchsorted(np.array(known), np.array(languages))
    x, text, used = windows(pa.array(snippets, pa.string()), rules.window)
    whole = np.searchsorted(text, np.arange(len(snippets)))  # the first window of each snippet
    x, used = x[whole], used[whole]
    cut = np.minimum(used, chance.integers(12, rules.window + 1, len(x)))
    x = np.concatenate([x, np.where(np.arange(rules.window) < cut[:, None], x, 0)])
    y = np.concatenate([y, y])
    count = len(rules.widths) * rules.filters
    values = [chance.normal(0, 0.3, (w, 256, rules.filters)).astype(np.float32) for w in rules.widths]
    values += [
        np.zeros(count, np.float32),
        chance.normal(0, 1 / np.sqrt(count), (count, len(known))).astype(np.float32),
        np.zeros(len(known), np.float32),
    ]
    first = [np.zeros_like(v) for v in values]
    second = [np.zeros_like(v) for v in values]
    step = 0
    for epoch in range(rules.epochs):
        order = chance.permutation(len(x))
        for at in range(0, len(x), rules.batch):
            rows, labels = x[order[at : at + rules.batch]], y[order[at : at + rules.batch]]
            slopes = _slopes(values, rows, labels, rules)
            step += 1
            rate = rules.rate * (1 - epoch / rules.epochs)
            for v, g, a, b in zip(values, slopes, first, second, strict=True):
                g = g + rules.decay * v
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                v -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
            for v in values[:-3]:
                v[:, 0] = 0
    return LanguageModel(known, rules.window, tuple(values[:-3]), *values[-3:])


def _slopes(values: list[np.ndarray], rows: np.ndarray, labels: np.ndarray, rules: LanguageRules) -> list[np.ndarray]:
    *filters, biases, dense, offsets = values
    n, length = rows.shape
    wide = np.zeros((n, length + max(rules.widths)), np.intp)
    wide[:, :length] = rows
    tops, places = [], []
    for f in filters:
        total = np.take(f[0], wide[:, :length], axis=0)
        for at in range(1, len(f)):
            total += np.take(f[at], wide[:, at : at + length], axis=0)
        place = total.argmax(axis=1)
        places.append(place)
        tops.append(np.take_along_axis(total, place[:, None], axis=1)[:, 0])
    raw = np.concatenate(tops, axis=1) + biases
    hidden = np.maximum(raw, 0)
    wrong = _softmax(hidden @ dense + offsets)
    wrong[np.arange(n), labels] -= 1
    wrong /= n
    back = (wrong @ dense.T) * (raw > 0)
    slopes = []
    for k, f in enumerate(filters):
        part = back[:, k * rules.filters : (k + 1) * rules.filters]
        slope = np.zeros_like(f)
        of = np.broadcast_to(np.arange(rules.filters), part.shape)
        for at in range(len(f)):
            np.add.at(slope[at], (wide[np.arange(n)[:, None], places[k] + at], of), part)
        slopes.append(slope)
    return [*slopes, back.sum(axis=0), hidden.T @ wrong, wrong.sum(axis=0)]


def trained(documents: DataFrame, rules: LanguageRules = LanguageRules()) -> LanguageModel | None:
    """A network from the documents' text and lang; None if no row has both."""
    bound_batches(documents.sparkSession)
    rows = sample(documents, rules).toArrow().to_pylist()
    rows.sort(key=lambda r: (r["lang"], r["snippet"]))
    return fitted([r["lang"] for r in rows], [r["snippet"] for r in rows], rules)


def identified(documents: DataFrame, model: LanguageModel | None, keep_text: bool = False) -> DataFrame:
    """documents with lang_pred and score, the probability of that language.

    Whole texts are read. lang_pred is `und`, with score 0, if the text is null or has no
    letter, or if nothing was learned; of equally likely languages, the first by code
    point is named. Rows are judged one by one, repeated ones alike. text is left out
    unless keep_text; other columns are carried along, and lang_pred and score replaced.
    """
    bound_batches(documents.sparkSession)
    taken = ("lang_pred", "score", "__letters") + (() if keep_text else ("text",))
    carried = [c for c in documents.columns if c.lower() not in taken]
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("__letters")
    rows = documents.select(
        *[F.col(f"`{c}`") for c in carried], *([] if keep_text else ["text"]), letters
    )
    kept = documents.select(*[F.col(f"`{c}`") for c in carried]).schema
    kept = kept.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(model) if model else None
        for piece in pieces(batches, "text"):
            known = piece.column("__letters").to_numpy(zero_copy_only=False)
            if model:
                likely = probabilities(model, piece.column("text"), tables)
                best = likely.argmax(axis=1)
                names = np.where(known, np.array(model.languages, object)[best], UNDETERMINED)
                score = np.where(known, likely[np.arange(len(best)), best], 0.0).astype(float)
            else:
                names, score = np.full(len(known), UNDETERMINED, object), np.zeros(len(known))
            yield pa.RecordBatch.from_arrays(
                [*[piece.column(c) for c in carried], pa.array(names, pa.string()), pa.array(score)],
                [*carried, "lang_pred", "score"],
            )

    return rows.mapInArrow(run, kept)
