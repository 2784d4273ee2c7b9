import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.tables import documents, prose
from wardbook.llm.packing import PIECE, PackRules, best_pattern, packed_pieces, patterns, planned
from wardbook.llm.vocabularies import BYTE_BPE

IDS = Tokenizer.from_file(BYTE_BPE)


def check(rows, texts, rules=PackRules(), by="doc_id"):
    """All that a packing must be, from the tokenizer's own library; the share of padding."""
    of, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        of[r[by]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(of) == set(range(len(texts)))
    for i, text in enumerate(texts):
        ids = np.array([*IDS.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(of[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    filled = []
    for each in sequences.values():
        at = 0
        for offset, length in sorted(each):
            assert offset == at
            at += length
        assert at <= rules.size
        filled.append(at)
    short = [n for n in filled if n < rules.size - rules.free]
    assert len(short) <= 1
    return 1 - sum(filled) / (len(filled) * rules.size)


def test_every_token_once_and_little_padding(spark):
    chance = random.Random(6)
    texts = [None, "", "a", "x <|endoftext|>  y", "q" * 5000, " " * 3000, prose(chance, 30_000)]
    texts += [prose(chance, chance.randrange(1, 700)) for _ in range(150)]
    texts += [prose(chance, 150)] * 40
    rows = packed_pieces(documents(spark, *texts)).collect()
    assert check(rows, texts) < 0.02
    again = packed_pieces(documents(spark, *texts)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_full_sequences_only_and_small_ones(spark):
    word = " a"
    texts = [word * n for n in (15, 31, 15, 7, 0, 1, 14, 16, 33)]
    rules = PackRules(size=16, width=2, free=1)
    check(packed_pieces(documents(spark, *texts), rules=rules).collect(), texts, rules)


def pieces_of(histogram, plan):
    """Which tokens of a sequence each rank's rest takes, as the plan says."""
    out, up_to = defaultdict(list), np.cumsum(histogram)
    for rank in range(int(histogram[0]), int(histogram.sum())):
        length = int(np.searchsorted(up_to, rank, "right"))
        i = int(np.searchsorted(plan.first, rank, "right")) - 1
        if plan.sequence[i] >= 0:
            out[plan.sequence[i] + rank - plan.first[i]].append((plan.offset[i], length))
            continue
        at, left = plan.stream[i] + (rank - plan.first[i]) * length, length
        while left:
            j = int(np.searchsorted(plan.gap_stream, at, "right")) - 1
            number, inside = divmod(at - plan.gap_stream[j], plan.gap[j])
            n = min(plan.gap[j] - inside, left)
            out[plan.gap_sequence[j] + number].append((plan.gap_offset[j] + inside, n))
            at, left = at + n, left - n
    return out


@pytest.mark.parametrize("shape", ["uniform", "one", "large", "small", "mixed", "none", "two"])
def test_plans(shape):
    chance = np.random.default_rng(7)
    lengths = {
        "uniform": chance.integers(0, 1024, 3000),
        "one": np.full(500, 700),
        "large": chance.integers(520, 1024, 1500),
        "small": chance.integers(0, 40, 3000),
        "mixed": np.concatenate([np.full(800, 600), chance.integers(1, 500, 700)]),
        "none": np.zeros(5, int),
        "two": np.array([1000, 30]),
    }[shape]
    histogram = np.bincount(lengths, minlength=1025)
    plan = planned(histogram)
    found = pieces_of(histogram, plan)
    assert len(found) == plan.sequences
    free = []
    for each in found.values():
        at = 0
        for offset, length in sorted(each):
            assert offset == at
            at += length
        assert at <= 1024
        free.append(1024 - at)
    assert sum(f > 16 for f in free) <= 1
    assert plan.sequences <= 1 + lengths.sum() / 1024 * 1.016


def test_best_patterns_as_brute_force():
    chance = np.random.default_rng(8)
    for _ in range(50):
        values = chance.random(6) * np.arange(1, 7)

        def brute(room):
            return max([0.0, *[values[k] + brute(room - k - 1) for k in range(min(room, 6))]])

        value, pattern = best_pattern(np.concatenate([values, np.zeros(2)]), 8)
        assert abs(value - brute(8)) < 1e-9 and (pattern * np.arange(1, 9)).sum() <= 8
        assert abs((pattern[:6] * values).sum() - value) < 1e-9


def test_patterns_cover_the_demand():
    chance = np.random.default_rng(9)
    demand = chance.integers(0, 1000, 128) * (chance.random(128) < 0.6)
    basis, used = patterns(demand, PackRules())
    assert (used >= 0).all() and np.allclose(used @ basis, demand, atol=1e-4)
    assert ((basis * np.arange(1, 129)).sum(axis=1) <= 128).all()
    few = patterns(np.bincount([95, 31], [30, 30], 128).astype(int), PackRules())[1].sum()
    assert abs(few - 30) < 1e-6  # 96 + 32 fill a sequence


def test_other_columns_nulls_and_empty_tables(spark):
    frame = documents(spark, "a b", None, ids=[None, None]).selectExpr("*", "1 AS row", "2 AS START", "3 AS rank", "lang AS `odd.name`")
    out = packed_pieces(frame)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "row", "rank", "odd.name", *PIECE]
    assert out.count() == 2
    assert packed_pieces(frame.limit(0)).count() == 0
    assert packed_pieces(documents(spark, None).select("text")).columns == list(PIECE)
