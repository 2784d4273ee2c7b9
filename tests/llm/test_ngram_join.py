import random
import re
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tests.llm.tables import documents, prose
from wardbook.llm.components import components
from wardbook.llm.ngram_join import JoinRules, _described, _near, joined, keyed, one_of_each
from wardbook.operators.perhaps import perhaps

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def grams(text):
    words = WORD.findall(text)
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(texts):
    """For each place: class, links, representative, copies."""
    ids = {}
    for i, t in enumerate(texts):
        if t and WORD.search(t):
            ids.setdefault(t, []).append(i)
    known = [(t, grams(t)) for t in ids]
    links, parent = Counter(), {t: t for t in ids}

    def find(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for (a, x), (b, y) in combinations(known, 2):
        if len(x & y) >= 0.8 * len(x | y) - 1e-9:
            links[a] += 1
            links[b] += 1
            parent[find(a)] = find(b)
    lowest = {}
    for t in ids:
        lowest[find(t)] = min(lowest.get(find(t), len(texts)), ids[t][0])
    return [
        (lowest[find(t)], links[t], ids[t][0], len(ids[t])) if t in ids else (i, 0, i, 1) for i, t in enumerate(texts)
    ]


def corpus(seed=1, families=12, members=8, words=120):
    chance = random.Random(seed)
    passage = prose(chance, 60)
    texts = [None, "", " \n", "one", "one two", "one two", "a b c d e", "a b c d e f"]
    for _ in range(families):
        base = prose(chance, words).split()
        for _ in range(members):
            some = list(base)
            for _ in range(chance.randrange(0, 6)):
                some[chance.randrange(len(some))] = "x" + str(chance.randrange(5))
            texts.append(" ".join(some))
    for _ in range(40):
        texts.append(prose(chance, 80) + " " + passage)
    return texts + texts[10:14] * 3


def run(spark, texts, rules=JoinRules()):
    rows = joined(documents(spark, *texts), rules).collect()
    return [(r["class_id"], r["n_links"], r["rep_id"], r["copies"]) for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_as_brute_force(spark):
    texts = corpus()
    assert run(spark, texts) == brute(texts)


def test_large_buckets_are_split_and_compared_block_by_block(spark):
    texts = corpus(seed=2, families=2, members=60)
    assert run(spark, texts, JoinRules(bucket=7, block=9, recall=0.99999)) == brute(texts)


def test_sets_at_the_threshold(spark):
    words = [f"w{i}" for i in range(40)]
    # 36 and 32 n-grams, then 36 and 28: similarity 0.89 and 0.78; and 45 of 36, exactly 0.8.
    texts = [" ".join(words), " ".join(words[4:]), " ".join(words[8:]), " ".join([f"v{i}" for i in range(49)]), " ".join([f"v{i}" for i in range(40)])]
    assert run(spark, texts) == brute(texts)
    assert [r[1] for r in run(spark, texts)] == [1, 2, 1, 1, 1]


def test_runs_reach_the_target_recall():
    assert JoinRules().runs > JoinRules(recall=0.9).runs
    assert JoinRules(recall=0.999999).runs > JoinRules().runs


def test_one_of_each_group_stays(spark):
    texts = corpus(seed=3)
    groups = [c for c, *_ in brute(texts)]
    frame = documents(spark, *texts).selectExpr("*", "1 AS n_links")
    out = one_of_each(frame)
    assert out.columns == frame.columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(set(groups))


def test_null_ids_other_columns_and_empty_tables(spark):
    frame = documents(spark, "a b c d e f", "a b c d e f", None, ids=[None, None, None]).selectExpr("*", "'y' AS k1", "0 AS copies")
    out = joined(frame)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "class_id", "n_links", "rep_id", "copies"]
    assert sorted(r["copies"] for r in out.collect()) == [1, 2, 2]
    single = one_of_each(frame)
    assert single.columns == frame.columns and single.count() == 2
    assert joined(frame.limit(0)).count() == 0
    assert one_of_each(documents(spark, "a").limit(0)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    chance = random.Random(seed)
    pairs = [(chance.randrange(300), chance.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame([*pairs, (None, 1)], "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}


def test_unrelated_texts_of_a_bucket_are_not_compared_in_full(spark):
    chance = random.Random(4)
    texts = [prose(chance, 100 + i % 40) for i in range(240)]
    texts += [texts[0] + " one more", " ".join(texts[1].split()[:60])]
    rows = keyed(documents(spark, *texts))
    sets = _described(rows, JoinRules()).selectExpr("*", "7L AS path", "0 AS i", "0 AS j", "0 AS block", "array(7L) AS paths")
    near = _near(sets.coalesce(1), JoinRules()).select("k1", "k2").distinct()
    assert sorted(r["doc_id"] for r in rows.join(near, ["k1", "k2"]).collect()) == [0, 240]


def test_sets_near_by_sketch_have_like_sizes(spark):
    words = [f"w{i}" for i in range(104)]
    # 100 n-grams, then 80 and 79 of these: similarity 0.8 and 0.79.
    for n, kept in ((84, 2), (83, 0)):
        rows = keyed(documents(spark, " ".join(words), " ".join(words[:n])))
        sets = _described(rows, JoinRules()).selectExpr("*", "7L AS path", "0 AS i", "0 AS j", "0 AS block", "array(7L) AS paths")
        assert _near(sets.coalesce(1), JoinRules()).count() == kept


def test_texts_that_no_key_asks_for_are_left_out_early(spark):
    rows = keyed(documents(spark, *[f"a text {i}" for i in range(2000)], "a text 7", None, " "))
    keys = rows.where("doc_id IN (7, 1998, 2000)").select("k1", "k2").distinct()
    k1 = F.col("k1")
    found = perhaps(rows, keys, k1)
    assert found.columns == rows.columns
    got = {r["doc_id"] for r in found.collect()}
    assert {7, 1998, 2000} <= got and len(got) < 20
    assert {7, 1998, 2000} <= {r["doc_id"] for r in perhaps(rows, rows.select("k1", "k2").where("k1 IS NOT NULL"), k1).collect()}
    assert perhaps(rows, keys.limit(0), k1).count() == 0
