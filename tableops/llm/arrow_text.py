"""Arrow string columns as byte arrays: blocks of texts, word hashes and fixed-size bitmaps for numpy code."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts are worked on in blocks of about this many bytes, to bound the memory of a Python worker.
BLOCK_BYTES = 1 << 20

_U = np.uint64
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) != "_"]] = True


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts of a string column, one after another, and the end of each; null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column), np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets[1:] - offsets[0]


def text_blocks(ends: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of together about ``most`` bytes; a longer text is a range of its own."""
    first, begin = 0, 0
    while first < len(ends):
        last = max(int(np.searchsorted(ends, begin + most, "right")), first + 1)
        yield first, last
        first, begin = last, int(ends[last - 1])


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


class Powers:
    """Powers of an odd number modulo 2 ** 64, grown when needed."""

    def __init__(self, base: int):
        self.base = _U(base)
        self.table = np.ones(1, _U)

    def __call__(self, n: int) -> np.ndarray:
        if len(self.table) < n:
            self.table = np.cumprod(np.append(_U(1), np.full(max(n + n // 8, 1 << 16), self.base)))
        return self.table


WORD_POWERS = Powers(0x9E3779B97F4A7C15)
#: Of the inverse modulo 2 ** 64: takes a word's place in its block off its sum
WORD_PLACES = Powers(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: What a byte counts in a word's hash: one more than its lower-case letter, white space nothing
_LETTERS = np.where(_SPACE, _U(0), LOWER.astype(_U) + _U(1))


def word_hashes(data: np.ndarray, ends: np.ndarray, punctuation: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words (runs of other than ASCII white space, A-Z lower-cased), and words per text.

    ``punctuation``: runs of ASCII punctuation are words of their own.
    """
    if not len(data):
        return np.zeros(0, _U), np.zeros(len(ends), np.int64)
    inside = ~_SPACE[data]
    first = inside.copy()
    if punctuation:
        kind = _PUNCTUATION[data]
        first[1:] &= ~inside[:-1] | (kind[1:] != kind[:-1])
    else:
        first[1:] &= ~inside[:-1]
    begins = np.concatenate(([0], ends[:-1]))
    begins = begins[begins < len(data)]
    first[begins] = inside[begins]
    last = inside
    last[:-1] &= ~inside[1:] | first[1:]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last)
    per_text = np.diff(np.concatenate(([0], np.searchsorted(starts, ends))))
    if not len(starts):
        return np.zeros(0, _U), per_text
    # letters times powers of their places in the block, added up; a word is a difference of two sums, moved to place 0
    sums = np.take(_LETTERS, data)
    sums *= WORD_POWERS(len(data))[: len(data)]
    letters = np.take(sums, starts)
    np.cumsum(sums, out=sums)
    letters += np.take(sums, stops) - np.take(sums, starts)
    letters *= np.take(WORD_PLACES(len(data)), starts)
    return mixed(letters + (stops - starts + 1).astype(_U)), per_text


def word_blocks(column: pa.Array, punctuation: bool = False, texts: int = 1 << 16) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, last text, word hashes, words per text) of blocks of a string column, of ``texts`` at most."""
    data, ends = bytes_of(column)
    for first, last in text_blocks(ends):
        for a in range(first, last, texts):
            b = min(a + texts, last)
            begin = int(ends[a - 1]) if a else 0
            words, per_text = word_hashes(data[begin : int(ends[b - 1])], ends[a:b] - begin, punctuation)
            yield a, b, words, per_text


class Index:
    """Position of 64-bit keys in an array of distinct keys, or -1: open addressing, probed for whole arrays."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.shift = 64 - max(10, int(2 * len(keys)).bit_length())
        self.table = np.full(1 << (64 - self.shift), -1, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.table[slot] < 0
            self.table[slot[free]] = left[free]
            lost = self.table[slot] != left
            left, slot = left[lost], (slot[lost] + 1) & (len(self.table) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _U(0x9E3779B97F4A7C15)) >> _U(self.shift)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        slot = self._slot(keys)
        at = self.table[slot]
        more = np.flatnonzero((at >= 0) & (self.keys[at] != keys))
        while len(more):
            slot[more] = (slot[more] + 1) & (len(self.table) - 1)
            at[more] = self.table[slot[more]]
            more = more[(at[more] >= 0) & (self.keys[at[more]] != keys[more])]
        return at


def fixed_bitmap(cells: DataFrame, cell: Column, bits: int) -> np.ndarray:
    """The set of ``cell`` values (below ``2 ** bits``) as a bitmap of 2 ** (bits - 3) bytes, whatever their number."""
    one = (cell + 1).cast("long")
    rows = (
        cells.select(F.bitmap_bucket_number(one).alias("b"), F.bitmap_bit_position(one).alias("p"))
        .groupBy("b")
        .agg(F.bitmap_construct_agg("p").alias("m"))
        .collect()
    )
    out = np.zeros(max(1 << (bits - 3), 4096), np.uint8)
    for r in rows:
        out[(r["b"] - 1) * 4096 : r["b"] * 4096] = np.frombuffer(r["m"], np.uint8)
    return out


def in_bitmap(bitmap: np.ndarray, cells: np.ndarray) -> np.ndarray:
    cells = cells.astype(np.int64)
    return (bitmap[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 > 0
