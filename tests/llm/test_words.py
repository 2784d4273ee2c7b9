import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from wardbook.llm.words import BASES, NOT_ALNUM, lists, pieces, plain_words_of, ranges, window_hashes, within, words_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x0b\x1f\x00ß语!", max_size=40)), max_size=6)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    words = words_of(pa.array(texts, pa.string()))
    found = [bytes(words.data[a:b]).decode() for a, b in zip(words.starts, words.ends, strict=True)]
    expected = [WORD.findall(t or "") for t in texts]
    assert found == [w for ws in expected for w in ws]
    assert words.counts.tolist() == [len(ws) for ws in expected]


def test_words_without_punctuation():
    words = words_of(pa.array(["Don't stop!! É-mail #1", None, "..."]), NOT_ALNUM)
    found = [bytes(words.data[a:b]).decode() for a, b in zip(words.starts, words.ends, strict=True)]
    assert found == ["Don", "t", "stop", "É", "mail", "1"]
    assert words.counts.tolist() == [6, 0, 0]


def test_plain_words_of_any_script():
    words = plain_words_of(pa.array(["“Don’t” stop…\u00a0É-mail «№1»", None, "中文。 हिन्दी—e\u0301x_1"]))
    found = [bytes(words.data[a:b]).decode() for a, b in zip(words.starts, words.ends, strict=True)]
    assert found == ["don", "t", "stop", "é", "mail", "1", "中文", "हिन्दी", "e\u0301x", "1"]
    assert words.counts.tolist() == [6, 0, 4]


def test_equal_words_and_windows_have_equal_hashes_wherever_they_are():
    chance = random.Random(1)
    texts = [" ".join(chance.choice(["aa", "b", "ccc", "é"]) for _ in range(50)) for _ in range(20)]
    words = words_of(pa.array(texts))
    hashes = words.hashes()
    plain = [bytes(words.data[a:b]) for a, b in zip(words.starts, words.ends, strict=True)]
    assert len(set(zip(plain, hashes.tolist(), strict=True))) == len(set(plain)) == len(set(hashes.tolist()))
    starts, texts_of = within(words.first, 7)
    assert len(starts) == 20 * 44 and texts_of.max() == 19
    for base in BASES:
        windows = window_hashes(hashes, 7, base)[starts]
        content = [tuple(plain[s : s + 7]) for s in starts]
        assert len(set(zip(content, windows.tolist(), strict=True))) == len(set(content)) == len(set(windows.tolist()))


def test_pieces_cover_all_rows_within_the_bound():
    batch = pa.record_batch([pa.array(["x" * 5, None, "", "y" * 50, "z"] * 3)], ["text"])
    cut = list(pieces(iter([batch, batch.slice(0, 0)]), "text", most=10))
    assert pa.concat_batches(cut).equals(batch)
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p["text"].to_pylist()) <= 10 for p in cut)


def test_ranges_and_lists():
    assert ranges(np.array([5, 0, 9]), np.array([2, 0, 3])).tolist() == [5, 6, 9, 10, 11]
    assert lists(np.array([1, 2, 3]), np.array([2, 0, 1]), pa.int64()).to_pylist() == [[1, 2], [], [3]]
