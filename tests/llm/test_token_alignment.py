import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.tables import by_id, documents, prose
from wardbook.llm.token_alignment import DIGESTS, Rows, aligned, aligned_texts, alignment_scores, incidence
from wardbook.llm.vocabularies import BYTE_BPE, PIECE_BPE, byte_vocabulary, piece_vocabulary, segments

PIECES = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)


def tokenizer():
    found = Tokenizer.from_file(BYTE_BPE)
    found.encode_special_tokens = True
    return found


PLAIN = tokenizer()


def byte_level():
    """What each character of a byte-level vocabulary stands for, from its own single-byte tokens."""
    out = {}
    for b in range(128):
        out[PLAIN.encode(chr(b), add_special_tokens=False).tokens[0]] = bytes([b])
    for c in [*range(128, 0x2000), *(c for c in range(0x2000, 0x110000, 991) if not 0xD800 <= c <= 0xDFFF)]:
        encoded = chr(c).encode()
        text = "".join(PLAIN.encode(chr(c), add_special_tokens=False).tokens)
        out |= {x: encoded[i : i + 1] for i, x in enumerate(text)}
    return out


LEVEL = byte_level()


def spelled(text):
    a = PLAIN.encode(" " + text, add_special_tokens=False)
    a_bytes = [b"".join(LEVEL[c] for c in t) for t in a.tokens]
    b = PIECES.encode(text)
    b_bytes = [
        bytes([int(p[3:5], 16)]) if PIECES.is_byte(i) else p.replace("▁", " ").encode()
        for i, p in zip(b, PIECES.id_to_piece(b), strict=True)
    ]
    return a.ids, a_bytes, b, b_bytes


def brute(texts):
    rows, links = [], []
    for text in texts:
        own = []
        row = dict.fromkeys(("n_a", "n_b", "n_groups", "n_links", "n_overlaps", "n_shared"), 0) | {"groups_sha256": ""}
        if text:
            a, a_bytes, b, b_bytes = spelled(text)
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                a_ends = np.cumsum([len(x) for x in a_bytes]).tolist()
                b_ends = np.cumsum([len(x) for x in b_bytes]).tolist()
                both = sorted(set(a_ends) & set(b_ends))
                groups, low = [], 0
                for high in both:
                    groups.append(([x for x, e in zip(a, a_ends) if low < e <= high], [x for x, e in zip(b, b_ends) if low < e <= high]))
                    low = high
                own = [(x, y) for x, e in zip(a, a_ends) for y, f in zip(b, b_ends) if e == f] if len(text) < 400 else [
                    (a[a_ends.index(e)], b[b_ends.index(e)]) for e in both
                ]
                said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
                spans = [(e - len(x), e) for x, e in zip(a_bytes, a_ends)]
                others = [(e - len(x), e) for x, e in zip(b_bytes, b_ends)]
                row = {
                    "n_a": len(a),
                    "n_b": len(b),
                    "n_groups": len(groups),
                    "n_links": len(own),
                    "n_overlaps": sum(u < y and x < v for u, v in spans for x, y in others),
                    "n_shared": sum(len(x) * len(y) for x, y in groups),
                    "groups_sha256": hashlib.sha256(said.encode()).hexdigest(),
                }
        rows.append(row)
        links.append(own)
    count = Counter(x for own in links for x in own)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    for row, own in zip(rows, links, strict=True):
        row["n_best"] = sum(count[x] == best[x[1]] for x in own)
        row["count_sum"] = sum(count[x] for x in own)
    return rows


TEXTS = [
    None,
    "",
    " ",
    "a",
    "Hello, world! <|endoftext|> <s> </s> <unk> <0x41>",
    "two  spaces\tand\r\nlines \n\n",
    "Straße, café, naïve; 中文字 и кириллица 🙂 ﬁne",
    "▁already ▁marked",
    "\x00 zero \x7f",
    "qqqq" * 60,
    "1234567890" * 20,
    " leading and trailing ",
    "é   ​ ﻿",
]


def test_as_brute_force(spark):
    chance = random.Random(3)
    texts = [*TEXTS, *[prose(chance, chance.randrange(1, 60)) for _ in range(30)]]
    texts += texts[-3:]
    rows = alignment_scores(documents(spark, *texts)).collect()
    found = [{k: r[k] for k in (*DIGESTS, "n_best", "count_sum")} for r in sorted(rows, key=lambda r: r["doc_id"])]
    assert found == brute(texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=4))
def test_any_text(texts):
    found = aligned_texts(pa.array(texts), BYTE_BPE, PIECE_BPE)
    for i, (text, row) in enumerate(zip(texts, brute(texts), strict=True)):
        low, high = found.a.first[i : i + 2]
        assert high - low == row["n_a"], text
        assert ((found.link_a >= low) & (found.link_a < high)).sum() == row["n_links"]
    assert found.shared_groups().values.sum() == sum(r["n_shared"] for r in brute(texts))


def test_the_operators_own_output(spark):
    rows = by_id(aligned(documents(spark, "unbelievable things", None)), "a_ids", "b_ids", "a_ends", "b_ends", "group_ends", "overlaps")
    a, b, a_ends, b_ends, group_ends, overlaps = rows[0]
    ids, a_bytes, pieces, b_bytes = spelled("unbelievable things")
    assert (a, b) == (ids, pieces)
    assert a_ends == np.cumsum([len(x) for x in a_bytes]).tolist() and b_ends == np.cumsum([len(x) for x in b_bytes]).tolist()
    assert group_ends == sorted(set(a_ends) & set(b_ends))
    assert sum(x["bytes"] for x in overlaps) == len(" unbelievable things")
    assert rows[1] == ([], [], [], [], [], [])


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 6), st.integers(1, 6), st.integers(1, 6), st.randoms())
def test_products_of_rows(n, k, m, chance):
    a = np.array([[chance.choice([0, 0, 1, 3]) for _ in range(k)] for _ in range(n)])
    b = np.array([[chance.choice([0, 2, 1]) for _ in range(m)] for _ in range(k)])

    def packed(x):
        return Rows(np.concatenate([[0], np.cumsum((x != 0).sum(axis=1))]), np.nonzero(x)[1], x[x != 0], x.shape[1])

    def unpacked(x):
        out = np.zeros((len(x.first) - 1, x.width), int)
        out[x.rows(), x.columns] = x.values
        return out

    assert (unpacked(packed(a).times(packed(b))) == a @ b).all()
    assert (unpacked(packed(a).transposed()) == a.T).all()
    assert packed(a).entries_of_product(packed(b)).tolist() == [sum((b[j] != 0).sum() for j in np.nonzero(r)[0]) for r in a]


def test_incidence():
    found = incidence(np.array([0, 2]), np.array([2, 3]), 3)
    assert found.first.tolist() == [0, 2, 3] and found.columns.tolist() == [0, 1, 2]


def test_ids_are_those_of_the_vocabulary_s_own_library():
    found = byte_vocabulary(BYTE_BPE)
    special = Tokenizer.from_file(BYTE_BPE)
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for low in range(0, len(points), 2500):
        text = "".join(f"a{chr(c)}b1{chr(c)}2 {chr(c)} '{chr(c)}\n{chr(c)}{chr(c)} " for c in points[low : low + 2500])
        assert found.ids(text).tolist() == PLAIN.encode(text, add_special_tokens=False).ids
    for text in ("x <|endoftext|> y", "x  <|endoftext|>  y<|endoftext|>", "it's  we'LL  \n"):
        assert found.ids(text).tolist() == PLAIN.encode(text, add_special_tokens=False).ids
        assert found.ids(text, special=True).tolist() == special.encode(text, add_special_tokens=False).ids


def test_parts_of_long_texts_have_the_same_tokens():
    chance = random.Random(4)
    text = "".join(chance.choice(["ab", "é", " ", " ", "  ", "\n", "don't ", "12 ", "中", "- ", " "]) for _ in range(4000))
    parts = segments(text, 50)
    assert len(parts) > 40 and " ".join(parts) == text
    a, b = byte_vocabulary(BYTE_BPE), piece_vocabulary(PIECE_BPE)
    assert np.concatenate([a.ids(" " + p) for p in parts]).tolist() == a.ids(" " + text).tolist()
    assert np.concatenate([b.ids(p) for p in parts]).tolist() == b.ids(text).tolist()
    pieces = [PIECES.id_to_piece(i) for i in range(PIECES.get_piece_size())]
    assert not [p for p in pieces if "▁" in p.lstrip("▁")]


def test_very_long_texts_empty_tables_and_clashing_names(spark):
    chance = random.Random(5)
    texts = [prose(chance, 150_000), "q" * 300_000]
    rows = by_id(alignment_scores(documents(spark, *texts)), "n_a", "n_b", "groups_sha256")
    for i, text in enumerate(texts):
        ids, _, pieces, _ = spelled(text)
        assert rows[i][:2] == (len(ids), len(pieces))
    frame = documents(spark, "x", ids=[None]).selectExpr("*", "1 AS n_a", "2 AS pairs", "3 AS a_ids", "lang AS `odd.name`")
    out = alignment_scores(frame)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "a_ids", "odd.name", *DIGESTS, "n_best", "count_sum"]
    assert out.count() == 1
    assert alignment_scores(frame.limit(0)).count() == 0
    assert "pairs" in aligned(frame).columns and aligned(frame.limit(0)).count() == 0
    assert public_tokenizers.path("byte_bpe_50k.json") == BYTE_BPE
