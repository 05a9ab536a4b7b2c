"""Vectorised word and shingle arithmetic over Arrow batches of whole texts.

A batch is worked through in blocks of a few megabytes, so that a task holds one
block's arrays at a time whatever the batch holds; a text longer than a block is a
block of its own. A null text counts as an empty one everywhere in this package.

Words are maximal runs of characters outside space, tab, LF, VT, FF and CR. None of
these bytes occurs inside a longer UTF-8 sequence, so all of it works on raw bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 21
SHINGLE_WORDS = 5
WORD = np.ones(256, bool)
WORD[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(which: str, n: int) -> np.ndarray:
    """The first n powers of the hash base ("up") or of its inverse ("down"), mod 2**64."""
    have = _POWERS[which]
    if len(have) < n:
        base = np.full(max(n, BLOCK_BYTES + 1), _BASE if which == "up" else _INVERSE, np.uint64)
        base[0] = 1
        have = np.multiply.accumulate(base)
        if n <= BLOCK_BYTES + 1:
            _POWERS[which] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (a new array)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Block:
    """Consecutive rows lo:hi of a batch; text i is data[offsets[i]:offsets[i + 1]]."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return self.hi - self.lo

    def of(self, positions: np.ndarray) -> np.ndarray:
        """The text that each byte position belongs to."""
        return np.searchsorted(self.offsets, positions, side="right") - 1

    def bytes(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and n + 1 offsets into them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    data, offsets = utf8(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield Block(lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


@dataclass
class Words:
    """Word i of a block is data[start[i]:end[i]]; text t has words first[t]:first[t + 1]."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def runs(inside: np.ndarray, offsets: np.ndarray) -> Words:
    """Maximal runs of true values that do not cross a text's end."""
    n = len(inside)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return Words(start, end, np.searchsorted(start, offsets))


def words(block: Block) -> Words:
    return runs(WORD[block.data], block.offsets)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, of_byte: np.ndarray = _BYTE) -> np.ndarray:
    """A 64-bit hash of each byte span, equal for equal bytes wherever they stand."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(of_byte[data] * powers("up", len(data)), out=total[1:])
    return mix((total[end] - total[start]) * powers("down", len(data) + 1)[start] + (end - start).astype(np.uint64))


def word_hashes(block: Block, spans: Words, lower: bool = True) -> np.ndarray:
    return span_hashes(LOWER[block.data] if lower else block.data, spans.start, spans.end)


def ngram_hashes(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word windows inside texts, and the index of each one's first word."""
    count = np.maximum(np.diff(first) - (n - 1), 0)
    if not count.sum():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
    total = np.zeros(len(at), np.uint64)
    for k in range(n):
        total *= np.uint64(_BASE)
        total += hashes[at + k]
    return mix(total), at


def shingle_sets(block: Block, n: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-word shingles of each text, A-Z lower-cased, as sorted 64-bit hashes.

    A text with fewer words gives its whole sequence as one shingle, one without words
    nothing. Text t has shingles first[t]:first[t + 1] of the first array returned.
    """
    spans = words(block)
    hashes = word_hashes(block, spans)
    grams, at = ngram_hashes(hashes, spans.first, n)
    owner = np.searchsorted(spans.first, at, side="right") - 1
    n_words = np.diff(spans.first)
    for k in range(1, n):
        short = np.flatnonzero(n_words == k)
        if len(short):
            total = np.zeros(len(short), np.uint64)
            for j in range(k):
                total = total * np.uint64(_BASE) + hashes[spans.first[short] + j]
            grams, owner = np.concatenate((grams, mix(total + np.uint64(k)))), np.concatenate((owner, short))
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[fresh], owner[fresh]
    return grams, np.searchsorted(owner, np.arange(len(block) + 1))
