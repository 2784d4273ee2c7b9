"""The trained operators: language identification and toxicity."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.tables import TESTDATA, by_id, documents, prose
from wardbook.llm import language, toxicity
from wardbook.llm.registry import QUERIES

SF = f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="module")
def languages():
    chance = random.Random(1)
    words = {"aa": "the of and to with that".split(), "bb": "der die und nicht über mit".split(), "cc": "и не что это как его".split()}
    rows = [(k, " ".join(chance.choice(v) for _ in range(40))) for k, v in words.items() for _ in range(60)]
    return words, language.fitted(*map(list, zip(*rows, strict=True)), language.LanguageRules(epochs=6))


def test_language_on_held_out_documents(spark):
    lang = by_id(spark.read.parquet(f"{SF}/documents.parquet"), "lang")
    rows = QUERIES["op2_language"](spark, SF).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and len(held) > 200
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.99 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edge_cases(spark, languages):
    words, model = languages
    chance = random.Random(2)
    long = " ".join(chance.choice(words["bb"]) for _ in range(100_000))
    frame = documents(spark, None, "", "123 !? 456", "THE OF AND TO", long, long, "что это").selectExpr("*", "1.5D AS score")
    out = language.identified(frame, model)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "lang_pred", "score"]
    rows = by_id(out, "lang_pred", "score")
    assert [rows[i] for i in range(3)] == [("und", 0.0)] * 3
    assert [rows[i][0] for i in range(3, 7)] == ["aa", "bb", "bb", "cc"] and rows[4] == rows[5]
    assert by_id(language.identified(frame, None), "lang_pred")[4] == "und"
    kept = language.identified(frame, model, keep_text=True)
    assert "text" in kept.columns and kept.where("text IS NULL").count() == 1
    assert language.identified(frame.limit(0), model).count() == 0
    assert language.trained(frame.limit(0)) is None
    assert language.trained(documents(spark, None, "a", langs=["x", None])) is None


def test_language_reads_whole_texts(languages):
    words, model = languages
    text = " ".join(words["aa"] * 5) + " " + " ".join(words["cc"] * 60)
    assert model.languages[int(language.probabilities(model, pa.array([text])).argmax())] == "cc"


def test_language_slopes_are_those_of_the_loss():
    rules = language.LanguageRules(window=12, widths=(2, 3), filters=3)
    chance = np.random.default_rng(3)
    values = [chance.normal(size=(w, 256, 3)) for w in rules.widths] + [chance.normal(size=6), chance.normal(size=(6, 2)), chance.normal(size=2)]
    rows, labels = chance.integers(1, 256, (5, 12)).astype(np.uint8), np.array([0, 1, 1, 0, 1])

    def loss():
        model = language.LanguageModel(("a", "b"), 12, tuple(values[:2]), *values[2:])
        hidden = np.maximum(language._answers(model, rows, language._tables(model)) + model.biases, 0)
        return -np.log(language._softmax(hidden @ model.dense + model.offsets)[np.arange(5), labels]).mean()

    slopes = language._slopes(values, rows, labels, rules)
    for v, g in zip(values, slopes, strict=True):
        for at in np.argsort(-np.abs(g).ravel())[:3]:
            old = v.flat[at]
            v.flat[at] = old + 1e-5
            up = loss()
            v.flat[at] = old - 1e-5
            assert abs((up - loss()) / 2e-5 - g.flat[at]) < 1e-4
            v.flat[at] = old


def test_toxicity_on_held_out_documents(spark):
    folder = f"{TESTDATA}/sf0.1"
    toxic = by_id(spark.read.parquet(f"{folder}/labels.parquet"), "toxic")
    rows = [r for r in QUERIES["op10_toxicity"](spark, folder).collect() if r["held_out"] and r["doc_id"] in toxic]
    high = [r["score"] for r in rows if toxic[r["doc_id"]]]
    low = [r["score"] for r in rows if not toxic[r["doc_id"]]]
    ranked = np.mean([[(a > b) + 0.5 * (a == b) for b in low] for a in high])
    assert len(high) > 50 and ranked > 0.97
    assert np.mean([s < 0.5 for s in low]) > 0.98


def sentences(chance, n, bias):
    """Sentences of which the abusive ones say so, and mostly name one group as well."""
    texts, labels = [], []
    for i in range(n):
        words = prose(chance, 12, 200).split()
        label = i % 2
        if label:
            words.insert(3, chance.choice(["stupid", "trash"]))
        if chance.random() < (bias if label else 0.1):
            words.insert(6, "muslim")
        texts.append(" ".join(words))
        labels.append(label)
    return texts, np.array(labels)


def test_naming_a_group_changes_nothing():
    texts, labels = sentences(random.Random(1), 600, bias=0.9)

    def model(weight):
        rules = toxicity.ToxicityRules(counterfactual=weight)
        words, features = toxicity._bucketed(pa.array(texts), rules.buckets)
        rows = [np.unique(np.concatenate([f[a:b] for f in features])) for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
        return toxicity.fitted(labels, rows, rules)

    def gap(m):
        neutral, named = toxicity.scores(m, pa.array(["my neighbour went home", "my muslim neighbour went home"]))
        return abs(np.log(named / (1 - named)) - np.log(neutral / (1 - neutral)))

    plain, regular = model(0.0), model(50.0)
    assert gap(plain) > 0.3 and gap(regular) < 0.2 * gap(plain)
    found = toxicity.scores(regular, pa.array(texts)) >= 0.5
    assert (found == labels).mean() > 0.98


def test_toxicity_edge_cases(spark):
    texts, labels = sentences(random.Random(2), 80, bias=0.2)
    frame = documents(spark, *texts)
    marks = spark.createDataFrame([(i, int(x)) for i, x in enumerate(labels)] + [(None, 1), (0, None), (5, 0), (5, 1), (999, 1)], "doc_id long, toxic int")
    model = toxicity.trained(frame, marks)
    some = documents(spark, None, "", "STUPID!!", "stupid", "stupid", "word " * 100_000, ids=[1, 2, 3, 4, 4, None]).selectExpr("*", "'s' AS score", "3 AS toxic")
    out = toxicity.scored(some, model)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "toxic", "score"]
    rows = {r["doc_id"]: r["score"] for r in out.collect()}
    assert len(rows) == 5 and all(0 <= s <= 1 for s in rows.values())
    assert rows[1] == rows[2] < rows[3] == rows[4]
    for none in (marks.limit(0), marks.where("toxic = 1")):
        assert len(set(by_id(toxicity.scored(some, toxicity.trained(frame, none)), "score").values())) == 1
    assert toxicity.scored(some.limit(0), model).count() == 0


def test_the_sample_has_one_row_of_each_document(spark):
    texts = [f"text number{i % 50}" for i in range(300)] + ["stupid thing", "nice thing"]
    frame = documents(spark, *texts, ids=[1] * 300 + [2, 3])
    marks = spark.createDataFrame([(1, 0), (2, 1), (3, 0)], "doc_id long, toxic int")
    rules = toxicity.ToxicityRules(most_labelled=4)
    outs = [toxicity.sample(f, marks, rules).collect() for f in (frame.repartition(5), frame.coalesce(1), frame.orderBy("text"))]
    assert [sorted(r["toxic"] for r in out) for out in outs] == [[0, 0, 1]] * 3
    assert sorted(outs[0]) == sorted(outs[1]) == sorted(outs[2])


def test_toxic_words_count_in_any_punctuation():
    words, [buckets, *_] = toxicity._bucketed(pa.array(["so stupid they", "so “stupid” they", "so\u00a0«stupid…» they"]), 1 << 18)
    assert words.counts.tolist() == [3] * 3
    assert buckets.tolist() == buckets[:3].tolist() * 3


def test_the_sample_is_bounded_and_the_same_in_any_order(spark):
    texts, labels = sentences(random.Random(3), 60, bias=0.2)
    frame = documents(spark, *texts)
    marks = spark.createDataFrame([(i, int(x)) for i, x in enumerate(labels)], "doc_id long, toxic int")
    rules = toxicity.ToxicityRules(most_labelled=20)
    first = toxicity.sample(frame, marks, rules).collect()
    assert len(first) == 20 and sum(r["toxic"] for r in first) == 10
    again = toxicity.sample(frame.repartition(5), marks.repartition(3), rules).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))
