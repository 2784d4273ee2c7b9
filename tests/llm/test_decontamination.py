import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.tables import TESTDATA, documents, prose
from wardbook.llm import decontamination as D

ITEMS = "item_id long, text string"


def shingles(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def similarity(a, b):
    from collections import Counter

    a, b = Counter(a), Counter(b)
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def brute(texts, items, least=0.8):
    found = set()
    for i, text in enumerate(texts):
        have = shingles(text)
        for j, item in enumerate(items):
            want = shingles(item)
            if not want or not set(want) & set(have):
                continue
            size = min(len(want), len(have))
            if max(similarity(have[k : k + size], want) for k in range(len(have) - size + 1)) >= least - 1e-9:
                found.add((i, j))
    return found


def found(spark, texts, items):
    out = D.leaks(documents(spark, *texts), spark.createDataFrame(list(enumerate(items)), ITEMS))
    return {(r["doc_id"], r["item_id"]): r for r in out.collect()}


def test_exact_passages_are_found_wherever_they_are(spark):
    chance = random.Random(1)
    items = [prose(chance, n) for n in (5, 9, 16, 25, 40, 60, 150, 400)]
    texts = [prose(chance, a) + " " + item + " " + prose(chance, b) for item in items for a, b in ((0, 3), (100, 50), (7, 0))]
    texts += [t.upper().replace(" ", "!!\n") for t in texts] + [prose(chance, 300) for _ in range(30)]
    got = found(spark, texts, items)
    assert set(got) == brute(texts, items)
    assert {(i, i // 3) for i in range(24)} | {(24 + i, i // 3) for i in range(24)} == set(got)
    assert all(r["similarity"] == 1.0 for r in got.values())


def test_punctuation_and_blanks_beyond_ascii_separate_words(spark):
    chance = random.Random(7)
    items = [prose(chance, n) for n in (5, 9, 15, 21, 40)]
    marks = [("“", "”", " "), ("«\u00a0", "\u00a0»", "\u00a0"), ("—", "…", " – "), ("「", "。", "、"), ("‘", "’", "\u2003")]
    texts = [prose(chance, 30) + before + blank.join(item.split()) + after + prose(chance, 30) for item in items for before, after, blank in marks]
    got = found(spark, texts, items)
    assert set(got) == brute(texts, items) == {(i, i // 5) for i in range(25)}
    assert all(r["similarity"] == 1.0 for r in got.values())


def test_changed_passages_are_found_and_verified_exactly(spark):
    chance = random.Random(2)
    items = [prose(chance, n) for n in (30, 45, 60, 80) * 6]
    texts = []
    for item in items:
        for changes in (1, 2, 4):
            words = item.split()
            for _ in range(changes):
                words[chance.randrange(len(words))] = "other"
            texts.append(prose(chance, 40) + " " + " ".join(words) + " " + prose(chance, 60))
    got, expected = set(found(spark, texts, items)), brute(texts, items)
    assert got <= expected
    assert len(got) >= 0.95 * len(expected) and len(expected) > 10


def test_all_leaks_are_those_of_brute_force(spark):
    chance = random.Random(8)
    items = [prose(chance, n) for n in [9, 14, 20, 28, 34, 50, 75, 104, 150, 204] * 6]
    items += [("again and again and " * 8 + prose(chance, 20)), prose(chance, 30)]
    texts = []
    for item in items:
        for share in (0.01, 0.02, 0.025, 0.03):
            words = item.split()
            for at in chance.sample(range(len(words)), max(1, round(share * len(words)))):
                words[at] = "other"
            around = chance.choice((0, 1, 7, 40))
            texts.append(prose(chance, around) + " " + " ".join(words) + " " + prose(chance, 2 * around))
        texts.append(" ".join(item.split()[: -(-len(item.split()) * 83 // 100)]))
    expected = brute(texts, items)
    assert set(found(spark, texts, items)) == expected
    assert 100 < len(expected) < len(texts)


def test_fingerprints_alone_find_nearly_all(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")
    items = spark.read.parquet(f"{TESTDATA}/sf0.01/benchmark.parquet")

    def pairs(**rules):
        return {(r["doc_id"], r["item_id"]) for r in D.leaks(docs, items, D.LeakRules(**rules)).collect()}

    alone, both = pairs(lookup=False), pairs()
    assert alone <= both and len(alone) >= 0.95 * len(both) > 20


def test_shared_shingles_of_windows():
    chance = np.random.default_rng(9)
    for _ in range(200):
        n, kinds = int(chance.integers(1, 60)), int(chance.integers(1, 9))
        weights = chance.integers(1, 4, kinds)
        part = chance.integers(-1, kinds, n)
        span = int(chance.integers(1, n + 1))
        places = np.flatnonzero(part >= 0)
        got = D._shared(places, part[places], weights, span, n)
        for start in range(n - span + 1):
            window = part[start : start + span]
            assert got[start] == sum(min(int((window == k).sum()), int(weights[k])) for k in range(kinds))
    assert D._shared(np.zeros(0, int), np.zeros(0, int), np.ones(1, int), 2, 3).tolist() == [0, 0]


def test_long_items_take_linear_memory():
    chance = random.Random(10)
    item = prose(chance, 20_000)
    words = item.split()
    for at in chance.sample(range(len(words)), 300):
        words[at] = "other"
    texts = [item, prose(chance, 500) + " " + " ".join(words), prose(chance, 3_000)]
    shingles_ = D.Shingles.of(pa.array([item]), 5).hashes
    index = D.Index(D.Items([1], [shingles_]), D.LeakRules())
    tracemalloc.start()
    found = index.leaks(pa.array(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(text, item_) for text, item_, *_ in found] == [(0, 0), (1, 0)] and found[0][2] == 1.0
    assert peak < 200 << 20


def test_all_fingerprints_within_the_radius_are_candidates():
    chance = np.random.default_rng(3)
    rules = D.LeakRules()
    items = D.Items(list(range(90)), [chance.integers(0, 2**63, 40).astype(np.uint64) for _ in range(90)])
    index = D.Index(items, rules)
    [(_, groups)] = index.classes
    assert len(groups) == 2
    for members, prints, tables in groups:
        for distance in (0, 1, 8, 15):
            flipped = prints.copy()
            for i in range(len(flipped)):
                for bit in chance.choice(64, distance, replace=False):
                    flipped[i] ^= np.uint64(1 << int(bit))
            blocks = flipped.view(np.uint16).reshape(-1, D.BLOCKS)
            near = tables[0].take(blocks[:, 0])
            for block in range(1, D.BLOCKS):
                near |= tables[block].take(blocks[:, block])
            assert all(int(n) >> i & 1 for i, n in enumerate(near))


def test_fingerprints_of_long_texts():
    chance = np.random.default_rng(4)
    texts = D.Shingles(chance.integers(0, 2**63, 200_000).astype(np.uint64), None)
    ones = texts.ones()
    bits = np.unpackbits(texts.hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    for start in (0, 131_000, 199_000):
        got = D.fingerprints(ones[[start]], ones[[start + 999]], np.array([999]))[0]
        expected = (2 * bits[start : start + 999].sum(axis=0) > 999).astype(int)
        # Lane by lane: bit l + 16 k is the k-th count of lane l.
        order = [lane + 16 * k for lane in range(16) for k in range(4)]
        assert np.unpackbits(np.array([got]).view(np.uint8)).tolist() == expected[order].tolist()


def test_runs_counted_in_planes_have_the_fingerprints_of_runs_counted_one_by_one():
    chance = np.random.default_rng(11)
    hashes = chance.integers(0, 2**64, 700, dtype=np.uint64)
    hashes[100:160] = hashes[100]
    hashes[200:300] &= np.uint64(0xFF)
    hashes[300:400] |= np.uint64(0xFFFF << 40)
    ones = D.Shingles(hashes, None).ones()
    for length in range(1, D.LONG):
        runs = D.RunCounts(hashes, max(length, int(chance.integers(1, D.LONG))))
        step, start = int(chance.integers(1, 12)), int(chance.integers(0, 90))
        for stop in (len(hashes) - length + 1, start + step + 1, start):
            places = np.arange(start, stop, step)
            expected = D.fingerprints(ones[places], ones[places + length], np.full(len(places), length))
            assert runs.fingerprints(start, stop, step, length).tolist() == expected.tolist()


@pytest.mark.parametrize("at_once", [7, D.WINDOWS_AT_ONCE])
def test_candidates_are_all_windows_within_the_radius(monkeypatch, at_once):
    chance = random.Random(12)
    items = [prose(chance, n) for n in (5, 6, 9, 20, 21, 60, 130, 131, 132, 180, 400)]
    texts = ["", None, "one two"]
    for item in items:
        words = item.split()
        cut = chance.randrange(len(words) // 5 + 1)
        texts += [item, " ".join(words[cut:]), prose(chance, 37) + " " + item + " " + prose(chance, 11), " ".join(words[: len(words) - cut])]
    texts.append(None)
    rules = D.LeakRules()
    for least, most in ((0, 130), (0, 1000), (131, 1000), (5, 7)):
        some = [item for item in items if least < len(item.split()) < most]
        index = D.Index(D.Items(list(range(len(some))), [D.Shingles.of(pa.array([item]), 5).hashes for item in some]), rules)
        found = D.Shingles.of(pa.array(texts), 5)
        ones, expected = found.ones(), set()
        for length, groups in index.classes:
            for first, stop in zip(found.first, found.first[1:]):
                step = max(1, length // rules.steps)
                for start in range(-(-first // step) * step, stop, step):
                    end = min(start + length, stop)
                    if end - start >= rules.similarity * length * 0.9:
                        [got] = D.fingerprints(ones[[start]], ones[[end]], np.array([end - start]))
                        for members, prints, _ in groups:
                            expected |= {(start, end, item) for item, p in zip(members, prints) if int(got ^ p).bit_count() <= rules.radius}
        monkeypatch.setattr(D, "WINDOWS_AT_ONCE", at_once)
        got = [row for batch in index.candidates(found) for row in zip(*(c.tolist() for c in batch))]
        assert len(got) == len(set(got)) and set(got) == expected and expected


def test_only_windows_cut_by_the_ends_of_texts_are_counted_one_by_one(monkeypatch):
    chance = random.Random(13)
    items = [D.Shingles.of(pa.array([prose(chance, n)]), 5).hashes for n in (14, 30, 60, 100)]
    index = D.Index(D.Items([0, 1, 2, 3], items), D.LeakRules())
    texts = D.Shingles.of(pa.array([prose(chance, 2000) for _ in range(5)]), 5)
    counted, count = [], D.fingerprints
    monkeypatch.setattr(D, "fingerprints", lambda *a: counted.append(len(a[2])) or count(*a))
    list(index.candidates(texts))
    windows = sum(len(texts.hashes) // max(1, length // 12) for length, _ in index.classes)
    assert 0 < sum(counted) < windows / 100


def test_edge_cases(spark):
    chance = random.Random(5)
    item = prose(chance, 20)
    texts = [None, "", "one two three", item, item, "x" * 200_000, prose(chance, 60_000) + " " + item, item[: len(item) // 2]]
    items = [item, item, None, "", "a b c", prose(chance, 30)]
    got = found(spark, texts, items)
    assert set(got) == {(i, j) for i in (3, 4, 6) for j in (0, 1)}
    assert got[6, 0]["first_word"] == 60_000
    empty = spark.createDataFrame([], ITEMS)
    assert D.leaks(documents(spark, item), empty).count() == 0
    assert D.decontaminated(documents(spark, item), empty).count() == 1
    assert D.leaks(documents(spark, item).limit(0), spark.createDataFrame([(1, item)], ITEMS)).count() == 0


def test_other_columns_and_blocks_of_items(spark):
    chance = random.Random(6)
    items = [prose(chance, 20) for _ in range(12)]
    frame = documents(spark, *items, prose(chance, 50)).selectExpr("*", "'x' AS item_id", "doc_id AS first")
    rules = D.LeakRules(items_at_once=5)
    benchmark = spark.createDataFrame(list(enumerate(items)), ITEMS)
    out = D.leaks(frame, benchmark, rules)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "first", "item_id", "similarity", "first_word"]
    assert sorted((r["doc_id"], r["item_id"]) for r in out.collect()) == [(i, i) for i in range(12)]
    clean = D.decontaminated(frame, benchmark, rules)
    assert clean.columns == frame.columns and [r["doc_id"] for r in clean.collect()] == [12]


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_as_brute_force_on_the_test_tables(spark, sf):
    docs = spark.read.parquet(f"{TESTDATA}/{sf}/documents.parquet")
    items = spark.read.parquet(f"{TESTDATA}/{sf}/benchmark.parquet")
    rows, wanted = docs.select("doc_id", "text").collect(), items.collect()
    expected = brute([r["text"] for r in rows], [r["text"] for r in wanted])
    got = {(r["doc_id"], r["item_id"]) for r in D.leaks(docs, items).collect()}
    assert got == {(rows[i]["doc_id"], wanted[j]["item_id"]) for i, j in expected}


def test_null_text_arrow_column():
    assert len(D.Shingles.of(pa.array([None, None], pa.string()), 5).hashes) == 0
