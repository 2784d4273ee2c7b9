import hashlib
import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.tables import documents, prose
from wardbook.llm.substrings import deduplicated, lengths, lowest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, window):
    words = [WORD.findall(t or "") for t in texts]
    count = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {j for i in range(len(w) - window + 1) if count[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def run(spark, texts, window=35):
    rows = deduplicated(documents(spark, *texts), window).collect()
    return [(r["n_words"], r["n_removed"], r["kept_sha256"]) for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_as_brute_force(spark):
    chance = random.Random(1)
    passages = [prose(chance, n) for n in (34, 35, 36, 70, 200)]
    texts = [None, "", "a b", " ".join("ab"[i % 2] for i in range(90)), "x " * 50, "y " * 35, "z " * 36]
    for _ in range(60):
        parts = [prose(chance, chance.randrange(1, 80)), chance.choice(passages), prose(chance, 20), chance.choice(passages)]
        texts.append("\n".join(parts))
    texts += texts[10:14] + [texts[20] + " and more", "q" * 100_000, prose(chance, 20_000)]
    texts.append(texts[-1] + " " + passages[0])
    assert run(spark, texts) == brute(texts, 35)


def test_few_different_words(spark):
    chance = random.Random(2)
    texts = [" ".join(chance.choice("abc") for _ in range(chance.randrange(5, 60))) for _ in range(80)]
    for window in (5, 8, 13):
        assert run(spark, texts, window) == brute(texts, window)


def test_words_keep_their_punctuation_and_case(spark):
    a = " ".join(f"Word{i}," for i in range(40))
    assert [r[1] for r in run(spark, [a, a.lower(), a.replace(",", "")])] == [0, 0, 0]
    assert [r[1] for r in run(spark, [a, a.replace(" ", "\t\r\n")])] == [40, 40]


def test_other_columns_nulls_and_empty_tables(spark):
    frame = documents(spark, "a " * 40, None, "b", ids=[None, None, 3]).selectExpr("*", "'x' AS k1", "2 AS place", "lang AS extra")
    out = deduplicated(frame)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "extra", "n_words", "n_removed", "kept_sha256"]
    assert sorted((r["n_words"], r["n_removed"]) for r in out.collect()) == [(0, 0), (1, 0), (40, 40)]
    assert deduplicated(frame.limit(0)).count() == 0


def test_lengths_double_up_to_the_window():
    for window in range(1, 100):
        a, b, c = lengths(window)
        assert c == window and b <= 2 * a and c <= 2 * b and 1 <= a <= b <= c


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=40), st.integers(1, 12))
def test_lowest_is_the_first_of_the_lowest(values, count):
    if count <= len(values):
        got = lowest(np.array(values), count)
        assert got.tolist() == [i + int(np.argmin(values[i : i + count])) for i in range(len(values) - count + 1)]
