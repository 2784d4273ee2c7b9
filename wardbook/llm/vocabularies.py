"""Token ids of texts by the public tokenizers, as numpy arrays.

Each worker process loads a vocabulary once. A byte-level vocabulary is run by tiktoken,
which gives the same ids as its own library several times faster; a test compares the two
on every character.
"""

from __future__ import annotations

import json
import re
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import sentencepiece
import tiktoken

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
#: Characters that are encoded at once.
SEGMENT_CHARS = 1 << 18
_CUT = re.compile(r"(?<=\S) (?=\S)")


def segments(text: str, most: int = SEGMENT_CHARS) -> list[str]:
    """The text cut at spaces between other characters than blanks, into parts of about so
    many characters. Neither vocabulary has a token across such a place, so the tokens of
    the parts, a space before each, are those of the whole text."""
    if len(text) <= most:
        return [text]
    out, start = [], 0
    while start + most < len(text):
        found = _CUT.search(text, start + most)
        if not found:
            break
        out.append(text[start : found.start()])
        start = found.end()
    return [*out, text[start:]]


def _byte_values() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte: the printable ones of
    Latin-1 for themselves, and those from U+0100 on for the others, in order."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Bytes:
    """The bytes of each token of a vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.size = len(tokens)
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of these tokens, one after the other."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        shift = self.offsets[ids] - (ends - lengths)
        return self.data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(shift, lengths)]


class ByteVocabulary:
    """A byte-level BPE vocabulary, from the JSON file of `tokenizers`."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        special = {t["content"]: t["id"] for t in whole["added_tokens"]}
        value = _byte_values()
        ranks = {
            bytes(value[c] for c in token): i for token, i in whole["model"]["vocab"].items() if token not in special
        }
        tokens = [b""] * (1 + max([*ranks.values(), *special.values()]))
        for token, i in chain(ranks.items(), ((t.encode(), i) for t, i in special.items())):
            tokens[i] = token
        self.bytes = Bytes(tokens)
        self._special = special
        self._encoding = tiktoken.Encoding(
            path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
        )

    def ids(self, text: str, special: bool = False) -> np.ndarray:
        """special: the strings of special tokens stand for these; else they are plain text."""
        if special and any(s in text for s in self._special):
            return np.array(self._encoding.encode(text, allowed_special="all"), np.int32)
        return np.array(self._encoding.encode_ordinary(text), np.int32)


class PieceVocabulary:
    """A BPE vocabulary of pieces with a fallback to bytes, from a model file of `sentencepiece`."""

    def __init__(self, path: str):
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        self.bytes = Bytes(
            [
                bytes([int(p[3:5], 16)]) if self._model.is_byte(i) else p.replace("▁", " ").encode()
                for i, p in enumerate(pieces)
            ]
        )

    def ids(self, text: str) -> np.ndarray:
        return np.array(self._model.encode(text, num_threads=1), np.int32)


@cache
def byte_vocabulary(path: str) -> ByteVocabulary:
    return ByteVocabulary(path)


@cache
def piece_vocabulary(path: str) -> PieceVocabulary:
    return PieceVocabulary(path)
