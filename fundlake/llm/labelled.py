"""Bounded samples of labelled rows, and hashed-text features for linear models."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.llm.text import Block, mix, ngram_hashes, word_hashes, words

DIMENSIONS = 1 << 16
_BYTE_CLASS = np.full(256, 4, np.uint64)
_BYTE_CLASS[ord("a") : ord("z") + 1] = 0
_BYTE_CLASS[ord("A") : ord("Z") + 1] = 1
_BYTE_CLASS[ord("0") : ord("9") + 1] = 2
_BYTE_CLASS[128:] = 3


def crc_mod(column: Column, n: int) -> Column:
    """crc32 of the value as text, modulo n."""
    return F.crc32(column.cast("string").cast("binary")) % n


def sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` labelled texts: (doc_id, text, *label columns).

    Labels are thinned by a hash of their id before the join, so at most ``rows`` (give or take its
    square root) small rows are broadcast and the documents are only scanned. Rows with a
    null id or text are left out; of several label rows of one id the largest counts.
    """
    names = [c for c in labels.columns if c != "doc_id"]
    one = labels.where("doc_id is not null").groupBy("doc_id").agg(*(F.max(c).alias(c) for c in names))
    n = one.count()
    if n > rows:
        one = one.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(rows / n * (1 << 30))))
    texts = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    return texts.join(F.broadcast(one), "doc_id")


def features(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of one block: indices, values, row starts, and the number of words.

    Three families share the hashed space, each scaled to unit length in a text: words and
    word pairs (A-Z lower-cased), last two bytes of words, and word shapes (kinds of the first and the
    last byte, length up to 15).
    """
    spans = words(block)
    count = np.diff(spans.first)
    owner = np.repeat(np.arange(len(block)), count)
    lower = word_hashes(block, spans)
    pairs, at = ngram_hashes(lower, spans.first, 2)
    last = block.data[spans.end - 1].astype(np.uint64)
    before = block.data[np.maximum(spans.end - 2, spans.start)].astype(np.uint64)
    length = np.minimum(spans.end - spans.start, 15).astype(np.uint64)
    shape = _BYTE_CLASS[block.data[spans.start]] * np.uint64(80) + _BYTE_CLASS[block.data[spans.end - 1]] * np.uint64(16) + length
    families = ((np.concatenate((lower, pairs)), np.concatenate((owner, owner[at]))), (before << np.uint64(8) | last, owner), (shape, owner))
    rows, cells, values = [], [], []
    for salt, (keys, rows_of) in enumerate(families):
        cell = mix(keys + np.uint64(salt * 0x51ED2701)) & np.uint64(DIMENSIONS - 1)
        both, n = np.unique(rows_of.astype(np.uint64) << np.uint64(32) | cell, return_counts=True)
        row = (both >> np.uint64(32)).astype(np.int64)
        norm = np.sqrt(np.bincount(row, weights=n.astype(float) ** 2, minlength=len(block)))
        rows.append(row)
        cells.append((both & np.uint64(0xFFFFFFFF)).astype(np.int32))
        values.append((n / norm[row]).astype(np.float32))
    row, cell, value = (np.concatenate(x) for x in (rows, cells, values))
    order = np.argsort(row, kind="stable")
    return cell[order], value[order], np.searchsorted(row[order], np.arange(len(block) + 1)), count


def products(cells: np.ndarray, values: np.ndarray, first: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The dot product of every sparse row with each row of ``weights``: (rows, models)."""
    out = np.zeros((len(first) - 1, len(weights)))
    full = np.flatnonzero(np.diff(first))
    if len(full):
        for k, w in enumerate(weights):
            out[full, k] = np.add.reduceat(w[cells] * values, first[full], dtype=np.float64)
    return out


def descend(gradient, parameters: np.ndarray, steps: int, rate: float = 0.05) -> np.ndarray:
    """Adam over full batches: ``gradient(parameters)`` is the gradient of the mean loss."""
    mean, square = np.zeros_like(parameters), np.zeros_like(parameters)
    for t in range(1, steps + 1):
        g = gradient(parameters)
        mean += 0.1 * (g - mean)
        square += 0.001 * (g * g - square)
        parameters = parameters - rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
    return parameters
