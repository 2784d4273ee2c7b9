"""Toxicity: a linear classifier of words, trained so that naming a group changes nothing.

Labelled sentences are paired with copies in which identity terms are swapped for others;
training penalises the squared difference of a pair's scores. A group's name, which is
frequent in abuse, then carries no weight of its own.

The sample's words are counted in Spark; the weights, which fit in memory whatever the
corpus is, are fitted on the driver with numpy and sent to the tasks that score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.llm.tables import bound_batches
from wardbook.llm.words import Words, pieces, plain_words_of

# Identity terms, in groups within which they are swapped.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "frauen", "männer", "femmes", "hommes", "mujeres", "hombres"),
    ("woman", "man", "girl", "boy", "frau", "mann", "femme", "homme", "mujer", "hombre"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "muslime", "christ", "jude", "musulman", "chrétien", "juif", "musulmán", "cristiano", "judío"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "african", "european", "latino", "arab"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer", "heterosexual", "schwul", "lesbisch"),
    ("immigrant", "refugee", "foreigner", "native", "migrant", "ausländer", "flüchtling", "étranger", "extranjero"),
    ("disabled", "blind", "deaf", "autistic", "behindert", "handicapé", "discapacitado"),
    ("old", "young", "elderly", "alt", "jung", "vieux", "jeune", "viejo", "joven"),
)

#: Bytes of the beginnings of words that are features beside the words.
BEGINNINGS = (5, 7)


@dataclass(frozen=True)
class ToxicityRules:
    """most_labelled bounds the labelled documents that training sees, half of each label."""

    most_labelled: int = 4000
    buckets: int = 1 << 18
    least_documents: int = 4  # a word of fewer documents of the sample has no weight
    most_features: int = 3000  # the words whose shares of the two labels differ most
    l1: float = 0.001
    l2: float = 1e-4
    counterfactual: float = 5.0
    steps: int = 200
    terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS


@dataclass(frozen=True)
class ToxicityModel:
    """Buckets with a weight, ascending, their weights, and the bias."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float
    of: int
    losses: list = field(default_factory=list, compare=False)


def _bucketed(column: pa.Array, of: int) -> tuple[Words, list[np.ndarray]]:
    """The words of the texts in lower case, without punctuation, and the buckets of
    each: one of the word, and one of each beginning, for inflected and compound forms."""
    words = plain_words_of(column)
    features = [words.hashes(), *words.hashes(*BEGINNINGS)]
    return words, [(f % np.uint64(of)).astype(np.int64) for f in features]


def term_buckets(terms: tuple[tuple[str, ...], ...], of: int) -> list[list[np.ndarray]]:
    """Of each group of terms, the distinct buckets of each term."""
    return [[np.unique(b) for b in np.stack(_bucketed(pa.array(group), of)[1], axis=1)] for group in terms]


def sample(documents: DataFrame, labels: DataFrame, rules: ToxicityRules) -> DataFrame:
    """At most most_labelled labelled documents, as toxic, place and buckets (the distinct ones).

    A keyed hash of the id picks them, half of each label, whatever the order of rows.
    Rows without id, label or text teach nothing; an id with several labels is as toxic
    as the highest. Of several rows of one id, the text of the lowest hash is taken: each
    task keeps one row of an id, so that no more than these are shuffled and collected.
    """
    marked = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    marked = marked.withColumn("place", F.xxhash64("doc_id"))
    half = rules.most_labelled // 2
    picked = marked.where("toxic > 0").orderBy("place", "doc_id").limit(half)
    picked = picked.unionByName(marked.where("toxic <= 0").orderBy("place", "doc_id").limit(half))
    # The picked ids are at most most_labelled rows.
    texts = (
        documents.select("doc_id", "text")
        .where("text IS NOT NULL")
        .join(F.broadcast(picked), "doc_id")
        .select(F.col("doc_id").cast("string"), "toxic", "place", F.xxhash64("text").alias("hash"), "text")
    )
    of = rules.buckets

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = {}  # of each id, its row so far; at most most_labelled ids
        for piece in pieces(batches, "text"):
            lowest = {}
            for at, (doc_id, hash_) in enumerate(zip(piece.column("doc_id").to_pylist(), piece.column("hash").to_pylist(), strict=True)):
                have = lowest.get(doc_id) or kept.get(doc_id)
                if have is None or hash_ < have[0]:
                    lowest[doc_id] = (hash_, at)
            if not lowest:
                continue
            rows = piece.take(pa.array([at for _, at in lowest.values()]))
            words, ids = _bucketed(rows.column("text"), of)
            toxic, place = rows.column("toxic").to_pylist(), rows.column("place").to_pylist()
            for i, (doc_id, (hash_, _)) in enumerate(lowest.items()):
                a, b = words.first[i : i + 2]
                distinct = np.unique(np.concatenate([f[a:b] for f in ids])).astype(np.int32)
                kept[doc_id] = (hash_, toxic[i], place[i], distinct)
        found = [(doc_id, *row) for doc_id, row in kept.items()]
        for at in range(0, len(found), 1000):
            columns = zip(*found[at : at + 1000], strict=True)
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32()))
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "hash", "toxic", "place", "buckets"])

    each = texts.mapInArrow(buckets, "doc_id string, hash long, toxic int, place long, buckets array<int>")
    one = each.groupBy("doc_id", "toxic", "place").agg(F.min(F.struct("hash", "buckets")).alias("one"))
    return one.select("toxic", "place", "one.buckets")


class _Rows:
    """Documents as 0/1 rows over columns, and products with them."""

    def __init__(self, rows: list[np.ndarray], width: int):
        self.n, self.width = len(rows), width
        self.row = np.repeat(np.arange(self.n, dtype=np.int32), [len(r) for r in rows])
        self.column = np.concatenate(rows).astype(np.int32) if rows else np.zeros(0, np.int32)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.column], self.n)

    def back(self, slopes: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, slopes[self.row], self.width)


def _renumbered(rows: list[np.ndarray], known: np.ndarray, of: int) -> list[np.ndarray]:
    """The rows' known buckets, as places in known."""
    place = np.full(of, -1, np.int32)
    place[known] = np.arange(len(known))
    found = [place[r] for r in rows]
    return [np.sort(f[f >= 0]) for f in found]


def _swapped(rows: list[np.ndarray], groups: list[list[np.ndarray]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Pairs of rows that differ in an identity term.

    Each row that names a term is paired with copies that name each other term of the
    group instead. So that no term goes untested, every term is also named in one
    labelled row, and paired with the next term there and with none.
    """
    left, right = [], []
    everything = np.unique(np.concatenate([t for g in groups for t in g])) if groups else np.zeros(0, np.int64)
    for row in rows:
        if not np.isin(everything, row).any():
            continue
        for group in groups:
            for term in group:
                if np.isin(term, row).all():
                    for other in group:
                        if other is not term:
                            left.append(row)
                            right.append(np.union1d(np.setdiff1d(row, term), other))
    at = 0
    for group in groups if rows else []:
        for term, other in zip(group, group[1:] + group[:1], strict=True):
            row = np.setdiff1d(rows[at % len(rows)], everything)
            left += [np.union1d(row, term), np.union1d(row, term)]
            right += [np.union1d(row, other), row]
            at += 1
    return left, right


def fitted(toxic: np.ndarray, rows: list[np.ndarray], rules: ToxicityRules = ToxicityRules()) -> ToxicityModel:
    """Weights from 0/1 labels and the distinct buckets of each document.

    Proximal gradient steps with momentum on the logistic loss, each label weighing half,
    plus counterfactual times the mean squared difference of the pairs' logits.
    """
    if not len(toxic) or toxic.min() == toxic.max():
        share = float(toxic.mean()) if len(toxic) else 0.0
        bias = 4.0 if share > 0.5 else -4.0
        return ToxicityModel(np.zeros(0, np.int64), np.zeros(0), bias, rules.buckets)
    groups = term_buckets(rules.terms, rules.buckets)
    counts = np.bincount(np.concatenate(rows), minlength=rules.buckets)
    often = np.flatnonzero(counts >= rules.least_documents)
    y = toxic.astype(float)
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    every = _Rows(_renumbered(rows, often, rules.buckets), len(often))
    apart = np.abs(every.back(share * (2 * y - 1))) / np.sqrt(every.back(share))
    often = often[np.argsort(-apart, kind="stable")[: rules.most_features]]
    known = np.union1d(often, np.concatenate([t for g in groups for t in g]))
    columns = _renumbered(rows, known, rules.buckets)
    del every
    pairs = _swapped(columns, [[np.searchsorted(known, t) for t in g] for g in groups])
    x, width = _Rows(columns, len(known)), len(known)
    a, b = _Rows(pairs[0], width), _Rows(pairs[1], width)
    # Few columns of a row carry weight; a step by the typical row length stays stable with backtracking.
    weights, bias, step = np.zeros(width), 0.0, 1.0
    ahead, ahead_bias, momentum, losses = weights, bias, 1.0, []

    def loss(w: np.ndarray, c: float) -> tuple[float, np.ndarray, np.ndarray]:
        z = x.times(w) + c
        gaps = a.times(w) - b.times(w)
        value = np.sum(share * (np.logaddexp(0, z) - y * z)) + rules.counterfactual * np.mean(gaps**2)
        return value + rules.l2 * np.sum(w * w), z, gaps

    for _ in range(rules.steps):
        value, z, gaps = loss(ahead, ahead_bias)
        slope = share * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        pull = 2 * rules.counterfactual * gaps / len(gaps)
        down = x.back(slope) + a.back(pull) - b.back(pull) + 2 * rules.l2 * ahead
        down_bias = slope.sum()
        while True:
            to = ahead - step * down
            to = np.sign(to) * np.maximum(np.abs(to) - step * rules.l1, 0)
            to_bias = ahead_bias - step * down_bias
            moved, moved_bias = to - ahead, to_bias - ahead_bias
            bound = value + moved @ down + moved_bias * down_bias + (moved @ moved + moved_bias**2) / (2 * step)
            if loss(to, to_bias)[0] <= bound + 1e-12 or step < 1e-6:
                break
            step /= 2
        faster = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = to + (momentum - 1) / faster * (to - weights)
        ahead_bias = to_bias + (momentum - 1) / faster * (to_bias - bias)
        losses.append(value)
        small = np.abs(to - weights).max(initial=0) < 1e-4
        weights, bias, momentum = to, to_bias, faster
        if small:
            break
    bias -= _threshold(x.times(weights) + bias, y)
    used = np.flatnonzero(weights)
    return ToxicityModel(known[used], weights[used], float(bias), rules.buckets, losses)


def _threshold(logits: np.ndarray, y: np.ndarray) -> float:
    """The logit between two labelled documents at which the F1 of label 1 is highest."""
    order = np.argsort(-logits, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][logits[order][:-1] == logits[order][1:]] = 0  # ties are not cut
    at = int(np.argmax(f1))
    below = logits[order[min(at + 1, len(y) - 1)]]
    return float((logits[order[at]] + below) / 2)


def trained(documents: DataFrame, labels: DataFrame, rules: ToxicityRules = ToxicityRules()) -> ToxicityModel:
    """A model from the labelled documents; without two labels, one that scores all alike."""
    bound_batches(documents.sparkSession)
    collected = sample(documents, labels, rules).toArrow().combine_chunks()
    toxic, place = (collected[c].to_numpy().astype(int) for c in ("toxic", "place"))
    order = np.lexsort((place, toxic))
    if not len(order):
        return fitted(toxic, [], rules)
    buckets = collected["buckets"].chunk(0)
    rows = np.split(buckets.flatten().to_numpy(), buckets.offsets.to_numpy()[1:-1])
    return fitted(np.minimum(toxic[order], 1), [rows[i] for i in order], rules)


def scores(model: ToxicityModel, column: pa.Array) -> np.ndarray:
    """The score of each text: the logistic of the bias and the weights of its distinct words."""
    words, features = _bucketed(column, model.of)
    total = np.full(len(words.first) - 1, model.bias)
    if len(model.buckets):
        weighted = np.zeros(model.of, bool)
        weighted[model.buckets] = True
        found = []
        for ids in features:
            hit = np.flatnonzero(weighted[ids])
            text = np.searchsorted(words.first, hit, "right") - 1
            found.append(text * len(model.buckets) + np.searchsorted(model.buckets, ids[hit]))
        both = np.unique(np.concatenate(found))
        np.add.at(total, both // len(model.buckets), model.weights[both % len(model.buckets)])
    return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def scored(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """documents' columns but text, with score (0 to 1).

    Whole texts are scored, a bounded piece at a time. A null or wordless text has the
    score of no words. Every row is scored by itself, repeated ones alike; other columns
    are carried along, and one called score is replaced.
    """
    bound_batches(documents.sparkSession)
    carried = [c for c in documents.columns if c.lower() not in ("text", "score")]
    rows = documents.select("text", *[F.col(f"`{c}`") for c in carried])
    kept = rows.drop("text").schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            columns = [piece.column(c) for c in carried]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(scores(model, piece.column("text")))], [*carried, "score"]
            )

    return rows.mapInArrow(run, kept)
