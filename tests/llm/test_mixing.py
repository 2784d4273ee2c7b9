import random

from tests.llm.tables import documents
from wardbook.llm.mixing import MixRules, mixed


def level(sizes, weights, most):
    """Targets by reshaing the excess until none is above."""
    total, targets, open_ = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    left = total
    while open_:
        weight = sum(weights[i] for i in open_)
        over = {i for i in open_ if left * weights[i] / weight > most * sizes[i]}
        if not over:
            for i in open_:
                targets[i] = left * weights[i] / weight
            break
        for i in over:
            targets[i] = most * sizes[i]
            left -= targets[i]
        open_ -= over
    return targets


def run(frame, rules=MixRules()):
    rows = mixed(frame, rules).collect()
    sources = {}
    for r in rows:
        s = sources.setdefault(r["source"], {"size": 0, "taken": 0, "longest": 0, "target": r["target"], "source_size": r["source_size"]})
        s["size"] += r["size"]
        s["taken"] += r["taken"]
        s["longest"] = max(s["longest"], r["size"])
        assert 0 <= r["taken"] <= rules.most_copies * r["size"]
    return rows, sources


def table(spark, counts, seed=1):
    chance = random.Random(seed)
    texts, sources = [], []
    for source, n in counts.items():
        for _ in range(n):
            texts.append("w " * chance.randrange(1, 40))
            sources.append(source)
    return documents(spark, *texts, sources=sources)


def test_targets_and_words_taken(spark):
    frame = table(spark, {"b": 300, "a": 20, "c": 40, None: 30, "Z": 25})
    rows, sources = run(frame, MixRules(bucket_rows=50))
    order = ["Z", "a", "b", "c", None]
    sizes = [sources[s]["size"] for s in order]
    for s, target in zip(order, level(sizes, [1, 2, 3, 1, 2], 3), strict=True):
        assert abs(sources[s]["target"] - target) < 1e-6
        assert abs(sources[s]["taken"] - target) <= sources[s]["longest"]
        assert sources[s]["source_size"] == sources[s]["size"]
    assert sum(r["taken"] for r in rows) == sum(sizes)


def test_small_sources_stop_at_three_copies(spark):
    _, sources = run(table(spark, {"a": 200, "b": 5, "c": 3}))
    assert sources["b"]["target"] == sources["b"]["taken"] == 3 * sources["b"]["size"]
    assert sources["c"]["target"] == 3 * sources["c"]["size"]
    assert abs(sources["a"]["taken"] - sources["a"]["target"]) <= sources["a"]["longest"]


def test_reruns_and_other_partitions_agree(spark):
    frame = table(spark, {"a": 50, "b": 60})
    first = sorted((r["doc_id"], r["taken"]) for r in mixed(frame).collect())
    assert first == sorted((r["doc_id"], r["taken"]) for r in mixed(frame.repartition(7)).collect())


def test_nulls_empty_texts_and_repeated_rows(spark):
    frame = documents(spark, None, "", "a b c", "a b c", "a b c", ids=[None, 1, 2, 2, None], sources=["s", None, "s", "s", "t"])
    frame = frame.withColumnRenamed("n_chars", "size").selectExpr("*", "'b' AS before", "'c' AS cut", "1 AS place", "2 AS part")
    rows, _ = run(frame)
    assert len(rows) == 5 and {(r["before"], r["cut"], r["place"], r["part"]) for r in rows} == {("b", "c", 1, 2)}
    assert sorted(r["taken"] for r in rows if r["size"] == 0) == [0, 0]
    assert sum(r["taken"] for r in rows) == 9


def test_empty_and_wordless_tables(spark):
    assert mixed(documents(spark, "a").limit(0)).count() == 0
    rows, _ = run(documents(spark, None, " "))
    assert [(r["taken"], r["target"]) for r in rows] == [(0, 0.0)] * 2
