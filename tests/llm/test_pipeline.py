import duckdb
import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline
from tests.llm.tables import TESTDATA, documents
from tests.llm.test_decontamination import brute as leaks
from tests.llm.test_mixing import level
from tests.llm.test_ngram_join import brute as groups
from wardbook.llm import language, registry, stages

SF = f"{TESTDATA}/sf0.01"


def value(x):
    return repr(float(x)) if isinstance(x, float) else repr(x)


@pytest.mark.parametrize("name", registry.statements())
def test_queries_match_their_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    expected = connection.execute(registry.statements()[name])
    columns = [c[0] for c in expected.description]
    rows = sorted(tuple(map(value, r)) for r in expected.fetchall())
    got = registry.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(tuple(map(value, (r[c] for c in columns))) for r in got.collect()) == rows


def test_everything_is_registered():
    numbers = {int(name[2:].split("_")[0]) for name in __spark_entry__.queries() if name.startswith("op")}
    assert numbers == set(range(1, 14)) and "pipeline" in __spark_entry__.queries()
    assert set(registry.statements()) <= set(__spark_entry__.oracle_sql())


def test_stages_as_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    tables = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF)
        assert i == 4 or docs.columns == columns
        tables.append({r["doc_id"]: r.asDict() for r in docs.collect()})
        docs = spark.createDataFrame(list(tables[-1].values()), docs.schema)
    start = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    known, single, clean, private, mixed = tables
    assert len(known) >= 0.99 * len(start)
    ids = sorted(known)
    classes = groups([known[i]["text"] for i in ids])
    assert sorted(single) == sorted({ids[c] for c, *_ in classes})
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    ids = sorted(single)
    leaked = {ids[i] for i, _ in leaks([single[i]["text"] for i in ids], items)}
    assert set(clean) == set(single) - leaked and leaked
    assert set(private) == set(clean)
    assert all(r["n_chars"] == len(r["text"]) for r in private.values())
    sizes = {}
    for r in private.values():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(r["text"].split())
    order = sorted(sizes)
    targets = dict(zip(order, level([sizes[s] for s in order], [1 + i % 3 for i in range(len(order))], 3), strict=True))
    for s in order:
        rows = [r for r in mixed.values() if r["source"] == s]
        assert abs(rows[0]["target"] - targets[s]) < 1e-6
        assert abs(sum(r["taken"] for r in rows) - targets[s]) <= max(len(r["text"].split()) for r in private.values())


def test_documents_of_many_languages_and_without_labels_stay(spark, monkeypatch):
    names = tuple(f"l{i:02}" for i in range(12))

    def likely(first):  # a network that finds the first language so likely, the others equally
        offsets = np.log([first] + [(1 - first) / 11] * 11)
        shape = {w: np.zeros((w, 256, 2), np.float32) for w in (2, 3, 4)}
        return language.LanguageModel(names, 256, tuple(shape.values()), np.zeros(6), np.zeros((6, 12)), offsets)

    for first, kept in ((0.2, 2), (0.09, 0)):
        monkeypatch.setattr(language, "trained", lambda docs, first=first: likely(first))
        assert stages.keep_languages(spark, documents(spark, "some text", "123", None, "more"), SF).count() == kept
    monkeypatch.undo()
    unlabelled = documents(spark, "some text", "123", None, "more", langs=[None] * 4)
    out = stages.keep_languages(spark, unlabelled, SF)
    assert out.columns == unlabelled.columns and [r["doc_id"] for r in out.collect()] == [0, 3]


def test_the_run_is_the_stages(spark):
    out = corpus_pipeline.run(spark, f"{TESTDATA}/sf0.001")
    assert out.columns == ["doc_id", "source", "size", "source_size", "target", "taken"] and out.count() > 50


def test_stages_of_nothing_and_of_nulls(spark):
    for docs in (documents(spark, "a").limit(0), documents(spark, None, None, ids=[None, None], langs=[None, None], sources=[None, None])):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, f"{TESTDATA}/sf0.001")
        assert docs.count() == 0


@pytest.mark.parametrize("name", ["__letters", "score", "lang_pred", "n_replaced", "__found", "__news", "row", "k1", "Odd.name"])
def test_stages_keep_columns_of_any_name(spark, name):
    texts = ["A letter to Mr John Smith came today.", "12", None, "Un autre texte arrive ici."]
    docs = documents(spark, *texts, langs=["en", "en", "fr", "fr"]).selectExpr("*", f"concat('own ', doc_id) AS `{name}`")
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", name]
    kept = docs.collect()
    assert {r["doc_id"] for r in kept} == {0, 3}
    assert all(r[name] == f"own {r['doc_id']}" for r in kept)
