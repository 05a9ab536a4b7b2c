"""Burrows-Wheeler transforms of shards, merged by iterative interleave refinement.

A shard is a text of bytes seen as a circle. Its suffixes are put in the order of their first LENGTH
bytes; rank j's k-step predecessor LF^k(j) is the rank of the suffix that starts k bytes earlier.

``merge`` interleaves any number of shards without sorting their suffixes again: within a shard the
order stays as it is, and only the interleave changes. Suffixes are first dealt out by one byte.
If the interleave is right for k bytes, then sending its entries, in order, to their k-step predecessors and
dealing these out stably to the intervals (entries with equal first k bytes) of the predecessors
makes it right for 2k bytes. Where an interval falls apart in a round, the common prefix of the
neighbours is shorter than the round's depth; entries still together after the last round share LENGTH
bytes: the repeated intervals.
"""

from __future__ import annotations

import numpy as np


def _stable(keys: np.ndarray) -> np.ndarray:
    """A stable argsort of nonnegative 32-bit keys, 16 bits at a time."""
    order = np.argsort(keys.astype(np.uint16), kind="stable")
    high = keys >> 16
    return order[np.argsort(high[order].astype(np.uint16), kind="stable")] if len(keys) and high.max() else order


def _classes(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Numbers from 0 of runs of equal sorted keys, by entry."""
    fresh = np.zeros(len(order), bool)
    for key in keys:
        fresh[1:] |= key[1:] != key[:-1]
    out = np.empty(len(order), np.int32)
    out[order] = np.cumsum(fresh)
    return out


def transform(text: np.ndarray, length: int) -> np.ndarray:
    """The suffixes of a circular text in the order of their first ``length`` bytes (ties by position)."""
    n = len(text)
    rank, depth = text.astype(np.int32), 1
    order = np.arange(n)
    while depth < length:
        step = min(depth, length - depth)
        after = np.roll(rank, -step)
        order = _stable(after)
        order = order[_stable(rank[order])]
        rank = _classes(order, rank[order], after[order])
        depth += step
    return order if length > 1 else _stable(rank)


def merge(texts: list[np.ndarray], length: int) -> np.ndarray:
    """For each byte position of the joined texts the number of its interval of equal ``length`` bytes.

    Positions whose ``length`` bytes run over the end of their text see its beginning there.
    """
    sizes = np.array([len(t) for t in texts])
    base = np.cumsum(sizes) - sizes
    # Shard by shard: position of each rank, then rank of each position (numbered through all shards).
    position = np.concatenate([transform(t, length) + b for t, b in zip(texts, base)])
    rank = np.empty(len(position), np.int64)
    rank[position] = np.arange(len(position))
    begin, size = np.repeat(base, sizes), np.repeat(sizes, sizes)

    def before(entries: np.ndarray, k: int) -> np.ndarray:
        """LF^k: the entries of the suffixes that start k bytes earlier."""
        at, b, s = position[entries], begin[entries], size[entries]
        return rank[b + (at - b - k) % s]

    symbols = np.concatenate(texts)[position].astype(np.int32)
    order = _stable(symbols)  # within a shard ranks ascend, so this keeps each shard's own order
    interval = _classes(order, symbols[order])
    depth = 1
    while depth < length:
        step = min(depth, length - depth)
        sent = before(order, step)
        keys = interval[sent]
        dealt = _stable(keys)
        interval = _classes(sent[dealt], keys[dealt], interval[order][dealt])
        order = sent[dealt]
        depth += step
    return interval[rank]
