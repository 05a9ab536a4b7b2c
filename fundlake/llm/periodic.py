"""Periodic runs of words, found by string synchronising sets.

A run is a stretch of words with smallest period q (words q apart are equal) of at least 2 * q words that no
neighbouring word continues. All of them are found, exactly:

1. Periods up to ``small`` are found by comparing the words with themselves, shifted.
2. Larger periods are taken by dyadic scales Q <= q < 2 Q, shortest first, with t = (Q + 1) // 3. A position is
   synchronising if among the windows of t words that start there and at the t positions after, the one with the least
   hash is the first or the last; windows of a period of at most t / 3 do not count. Membership depends on
   the next 2 t words only, so what repeats at distance q brings its synchronising positions along, and each stretch of t positions
   has one unless the 3 t - 1 words from its start have a period of at most t / 3. Two positions q apart whose 2 t
   words are equal propose q there. Equal contexts stand more than t / 3 apart (else they would be of small period), so
   a position has a bounded number of partners.
3. A run without such a pair has equal halves of a small period p <= t / 3 (as abcabcab abcabcab): its halves lie
   in two runs of period p, known by then, that touch or overlap. Each such pair of runs proposes the distances that
   bring their periods into step.

Proposals are extended word by word to both sides; a hash never decides that words are equal. A stretch whose bounds were
found with a smaller period is that run.

Texts are worked through in blocks of a few megabytes, a longer text in a block of its own (some 100 bytes of working memory a word).
Hashes only order windows and group contexts: a collision can cost time but no run.

Defined cases: a null text is an empty one (no runs, an empty text); repeated rows and ids count each on its
own; any other column of the input is ignored; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from fundlake.llm.text import WORD, Block, Words, blocks, mix, powers, words

LEAST_WORDS = 12
SMALL = 16
_NEVER = np.uint64((1 << 64) - 1)


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([False], same, [False])).view(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _small_runs(w: np.ndarray, small: int) -> np.ndarray:
    """(start, end, period) of all runs with periods up to ``small``."""
    found, bounds = [np.zeros((0, 3), np.int64)], np.zeros(0, np.int64)
    for q in range(1, min(small, len(w) // 2) + 1):
        start, end = _stretches(w[q:] == w[:-q])
        long = end - start >= q
        start, end = start[long], end[long] + q
        key = start * (len(w) + 1) + end
        new = ~np.isin(key, bounds)
        found.append(np.stack((start[new], end[new], np.full(new.sum(), q)), 1))
        bounds = np.concatenate((bounds, key[new]))
    return np.concatenate(found)


def _least_of_next(x: np.ndarray, n: int) -> np.ndarray:
    """min(x[i : i + n]) for each i, with two running minima over blocks of n."""
    padded = np.full(-(-len(x) // n) * n, _NEVER)
    padded[: len(x)] = x
    upward = np.minimum.accumulate(padded.reshape(-1, n), axis=1).ravel()
    downward = np.minimum.accumulate(padded.reshape(-1, n)[:, ::-1], axis=1)[:, ::-1].ravel()
    m = len(x) - n + 1
    return np.minimum(downward[:m], upward[n - 1 : n - 1 + m])


def _synchronising(w: np.ndarray, sums: np.ndarray, t: int, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Synchronising positions for windows of t words, and hashes of the 2 t words from each."""
    down = powers("down", len(w) + 1)
    m = len(w) - t + 1
    key = mix((sums[t:] - sums[:-t]) * down[:m]) >> np.uint64(1)
    tight = runs[(3 * runs[:, 2] <= t) & (runs[:, 1] - runs[:, 0] >= t)]
    if len(tight):
        inside = np.zeros(m + 1, np.int32)
        np.add.at(inside, tight[:, 0], 1)
        np.add.at(inside, tight[:, 1] - t + 1, -1)
        key[np.cumsum(inside[:-1]) > 0] = _NEVER
    least = _least_of_next(key, t + 1)
    first = len(least)
    at = np.flatnonzero((least != _NEVER) & ((least == key[:first]) | (least == key[t : t + first])))
    return at, (sums[at + 2 * t] - sums[at]) * down[at]


def _partners(at: np.ndarray, context: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of all positions with equal contexts lo <= distance < hi apart."""
    order = np.lexsort((at, context))
    at, context = at[order], context[order]
    starts, gaps = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    alive = np.arange(len(at))
    step = 1
    while len(alive := alive[alive + step < len(at)]):
        gap = at[alive + step] - at[alive]
        near = (context[alive] == context[alive + step]) & (gap < hi)
        alive, gap = alive[near], gap[near]
        starts.append(at[alive[gap >= lo]])
        gaps.append(gap[gap >= lo])
        step += 1
    return np.concatenate(starts), np.concatenate(gaps)


def _equal_from(w: np.ndarray, i: int, q: int) -> int:
    """The first j >= i with w[j] != w[j + q]."""
    step, last = 32, len(w) - q
    while i < last:
        differ = np.flatnonzero(w[i : min(i + step, last)] != w[i + q : min(i + step, last) + q])
        if len(differ):
            return i + int(differ[0])
        i, step = min(i + step, last), step * 2
    return last


def _equal_back(w: np.ndarray, i: int, q: int) -> int:
    """The least j such that w[j:i] equals w[j + q:i + q]."""
    step = 32
    while i > 0:
        lo = max(i - step, 0)
        differ = np.flatnonzero(w[lo:i] != w[lo + q : i + q])
        if len(differ):
            return lo + int(differ[-1]) + 1
        i, step = lo, step * 2
    return 0


def _turn(w: np.ndarray, a: int, b: int, p: int) -> int | None:
    """c with w[a + k] == w[b + (k + c) % p] for all k < p."""
    one, twice = w[a : a + p], np.concatenate((w[b : b + p], w[b : b + p]))
    for c in np.flatnonzero(twice[:p] == one[0]):
        if (twice[c : c + p] == one).all():
            return int(c)
    return None


def _in_step(w: np.ndarray, runs: np.ndarray, t: int, lo: int, hi: int) -> Iterator[tuple[int, int, int]]:
    """(period, from, to) proposed by pairs of touching runs of one small period: w[from:to] repeats a period on."""
    tight = runs[(3 * runs[:, 2] <= t) & (runs[:, 1] - runs[:, 0] >= lo)]
    tight = tight[np.lexsort((tight[:, 0], tight[:, 2]))]
    for (a, a_end, p), (b, b_end, same) in zip(tight[:-1].tolist(), tight[1:].tolist()):
        if p != same or not a_end - p < b <= a_end or (c := _turn(w, a, b, p)) is None:
            continue
        first = lo + (c + b - a - lo) % p
        for q in range(first, min(hi, a_end - a + 1, b_end - b + 1), p):
            start, end = max(a, b - q), min(a_end, b_end - q)
            if start < end:
                yield q, start, end


def find_runs(w: np.ndarray, longest: int | None = None, small: int = SMALL) -> np.ndarray:
    """(start, end, period) of all runs of a sequence of numbers, sorted by start and period.

    ``longest``: no run is longer than this (the longest text of several that are joined).
    """
    longest = len(w) if longest is None else longest
    runs = _small_runs(w, small)
    if longest < 2 * (small + 1):
        return runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    long = runs[runs[:, 1] - runs[:, 0] > 2 * small]
    seen = set(zip(long[:, 0].tolist(), long[:, 1].tolist()))
    sums = np.zeros(len(w) + 1, np.uint64)
    np.cumsum(mix(w.astype(np.uint64) + np.uint64(1)) * powers("up", len(w)), out=sums[1:])
    scale = small + 1
    while 2 * scale <= longest:
        t = (scale + 1) // 3
        at, gap = _partners(*_synchronising(w, sums, t, runs), scale, 2 * scale)
        proposed = [(int(q), int(i), int(i)) for i, q in zip(at, gap)]
        proposed += _in_step(w, runs, t, scale, 2 * scale)
        new, known_q, known_lo, known_hi = [], 0, 0, 0
        for q, lo, hi in sorted(proposed):
            if q == known_q and known_lo <= lo < known_hi:
                continue
            known_q, known_lo, known_hi = q, _equal_back(w, lo, q), _equal_from(w, hi, q)
            if known_hi - known_lo >= q and (known_lo, known_hi + q) not in seen:
                seen.add((known_lo, known_hi + q))
                new.append((known_lo, known_hi + q, q))
        if new:
            runs = np.concatenate((runs, np.array(new, np.int64)))
        scale *= 2
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _word_ids(block: Block, spans: Words) -> np.ndarray:
    """Equal numbers for equal words."""
    ends = np.zeros(len(spans.start) + 1, np.int64)
    np.cumsum(spans.end - spans.start, out=ends[1:])
    letters = block.data[WORD[block.data]]
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(spans.start), [None, pa.py_buffer(ends), pa.py_buffer(letters)])
    return column.dictionary_encode().indices.to_numpy().astype(np.int64)


def block_runs(block: Block, least: int = LEAST_WORDS, small: int = SMALL) -> tuple[Words, np.ndarray]:
    """The words of a block, and (text, start, end, period) of its runs; start and end count a text's words."""
    spans = words(block)
    ids = _word_ids(block, spans)
    count = np.diff(spans.first)
    runs = [np.zeros((0, 4), np.int64)]
    # Texts of like length go together, so that a scale is not computed over texts too short for it.
    for lo, hi in ((least, 16 * small), (16 * small, len(ids) + 1)):
        texts = np.flatnonzero((count >= lo) & (count < hi))
        if not len(texts):
            continue
        # Each text is closed by a number of its own, so no run passes from one to the next.
        begin = np.concatenate(([0], np.cumsum(count[texts] + 1)))
        joined = np.full(begin[-1], -1, np.int64)
        inside = np.ones(begin[-1], bool)
        inside[begin[1:] - 1] = False
        owned = np.zeros(len(count), bool)
        owned[texts] = True
        joined[inside] = ids[np.repeat(owned, count)]
        joined[~inside] = len(ids) + np.arange(len(texts))
        found = find_runs(joined, int(count[texts].max()), small)
        found = found[found[:, 1] - found[:, 0] >= least]
        text = np.searchsorted(begin, found[:, 0], side="right") - 1
        runs.append(np.stack((texts[text], found[:, 0] - begin[text], found[:, 1] - begin[text], found[:, 2]), 1))
    found = np.concatenate(runs)
    return spans, found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


def _collapsed(block: Block, spans: Words, runs: np.ndarray) -> pa.Array:
    """Words outside the repetitions (of a run, all after its first period), joined by one space."""
    covered = np.zeros(len(spans.start) + 1, np.int64)
    np.add.at(covered, spans.first[runs[:, 0]] + runs[:, 1] + runs[:, 3], 1)
    np.add.at(covered, spans.first[runs[:, 0]] + runs[:, 2], -1)
    kept = np.cumsum(covered[:-1]) == 0
    start, size = spans.start[kept], (spans.end - spans.start)[kept]
    first = np.concatenate(([0], np.cumsum(kept)))[spans.first]
    more = np.ones(len(start), np.int64)
    more[first[1:][np.diff(first) > 0] - 1] = 0
    ends = np.concatenate(([0], np.cumsum(size + more)))
    source = np.repeat(start - ends[:-1], size + more) + np.arange(ends[-1])
    out = block.data[np.minimum(source, max(len(block.data) - 1, 0))] if len(source) else np.zeros(0, np.uint8)
    out[ends[1:][more == 1] - 1] = 0x20
    column = pa.LargeStringArray.from_buffers(len(block), pa.py_buffer(ends[first].astype(np.int64)), pa.py_buffer(out))
    return column.cast(pa.string())


def _scan(batches: Iterator[pa.RecordBatch], least: int, small: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch.column(1)):
            spans, runs = block_runs(block, least, small)
            upto = np.searchsorted(runs[:, 0], np.arange(len(block) + 1))
            entry = pa.StructArray.from_arrays([pa.array(runs[:, 1]), pa.array(runs[:, 2] - runs[:, 1]), pa.array(runs[:, 3])], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(block.lo, len(block)), pa.array(np.diff(spans.first)),
                 pa.ListArray.from_arrays(pa.array(upto, pa.int32()), entry).cast(schema.field("runs").type), _collapsed(block, spans, runs)], schema=schema)


def find(docs: DataFrame, least: int = LEAST_WORDS, small: int = SMALL) -> DataFrame:
    """doc_id, n_words, runs (of ``least`` words or more, by start and period) and collapsed, the text without repetitions."""
    key = docs.schema["doc_id"].dataType
    entry = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema([("doc_id", to_arrow_type(key)), ("n_words", pa.int64()), ("runs", pa.list_(entry)), ("collapsed", pa.string())])
    return docs.select("doc_id", "text").mapInArrow(
        partial(_scan, least=least, small=small, schema=schema),
        f"doc_id {key.simpleString()}, n_words BIGINT, runs ARRAY<STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>>, collapsed STRING")
