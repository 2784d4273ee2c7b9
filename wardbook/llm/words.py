"""Words, hashes and windows of many texts at once, as numpy arrays.

Everything here works on the UTF-8 bytes of an Arrow column, a bounded piece at a time,
inside a Spark task. Null texts count as empty ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a task turns into arrays at once; a longer text makes its own piece.
PIECE_BYTES = 1 << 18

#: [^\x20\x09-\x0D]+ : the bytes that separate words.
BLANKS = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
#: Separators of words without punctuation: every ASCII byte but letters and digits, and
#: beyond ASCII every character but letters, their marks, and digits.
NOT_ALNUM = bytes(b for b in range(128) if not chr(b).isalnum())
_NOT_ALNUM_BEYOND = r"[^\x00-\x7F\p{L}\p{M}\p{N}]+"

_FIRST = np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xBF58476D1CE4E5B9)
_THIRD = np.uint64(0x94D049BB133111EB)
#: Odd bases of the polynomial hashes of windows; the second makes 128 bits of a window.
BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_BYTE_BASE = 0xE7037ED1A0B428DB


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """64 well mixed bits of each 64-bit value."""
    x = values + np.uint64((seed * int(_FIRST) + int(_FIRST)) & (2**64 - 1))
    x ^= x >> np.uint64(30)
    x *= _SECOND
    x ^= x >> np.uint64(27)
    x *= _THIRD
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(256, dtype=np.uint64), 7)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64, for i below n."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 2**64), np.uint64)
        up[0] = down[0] = 1
        have = _POWERS[base] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return have[0][:n], have[1][:n]


@dataclass
class Words:
    """The words of some texts, one after the other."""

    data: np.ndarray  # the texts' bytes
    offsets: np.ndarray  # where each text starts in data, and the end
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray  # byte after each word
    first: np.ndarray  # first word of each text, and the number of words

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def texts(self) -> np.ndarray:
        """The text that each word is of."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, *prefixes: int, base: int = _BYTE_BASE) -> np.ndarray | list[np.ndarray]:
        """64 bits of each word; or, of each word's first bytes, for each number of them.
        Another odd base gives another 64 bits."""
        up, down = _powers(base, len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[self.data] * up[:-1], out=sums[1:])
        before, scale = sums[self.starts], down[self.starts]
        if not prefixes:
            return mix((sums[self.ends] - before) * scale)
        return [mix((sums[np.minimum(self.ends, self.starts + n)] - before) * scale, n) for n in prefixes]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offset of each text, nulls as empty."""
    if pa.types.is_large_string(column.type):
        width = np.int64
    else:
        column, width = column.cast(pa.string()), np.int32
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that each holds at most so many bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def words_of(column: pa.Array, separators: bytes = BLANKS) -> Words:
    """The words of each text: its longest runs of bytes that are no separators."""
    data, offsets = text_bytes(column)
    table = np.ones(256, bool)
    table[list(separators)] = False
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = table[data]
    begins = inside[1:-1] & ~inside[:-2]
    stops = inside[1:-1] & ~inside[2:]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]  # words end where texts do
    begins[edges] = inside[1:-1][edges]
    lasts = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    stops[lasts] = inside[1:-1][lasts]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def plain_words_of(column: pa.Array) -> Words:
    """The words of each text in lower case: its longest runs of letters, with their marks, and digits."""
    return words_of(pc.replace_substring_regex(pc.utf8_lower(column), _NOT_ALNUM_BEYOND, " "), NOT_ALNUM)


def window_hashes(hashes: np.ndarray, length: int, base: int = BASES[0]) -> np.ndarray:
    """64 bits of each run of so many words, by its first word; runs may cross texts."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(base, len(hashes))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up, out=sums[1:])
    return mix((sums[length:] - sums[:n]) * down[:n])


def within(first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The first words of the windows that stay in one text, and the text of each."""
    counts = np.maximum(np.diff(first) - length + 1, 0)
    texts = np.repeat(np.arange(len(counts)), counts)
    before = np.concatenate([[0], np.cumsum(counts)])[:-1]
    return np.arange(counts.sum()) - before[texts] + first[:-1][texts], texts


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... : counts[i] numbers from each start."""
    before = np.cumsum(counts) - counts
    return np.arange(counts.sum()) - np.repeat(before - starts, counts)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Consecutive values as one list of each count."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
