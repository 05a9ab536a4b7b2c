"""Benchmark decontamination: size-partitioned MinHash containment search.

A short item inside a long document has a tiny Jaccard similarity with the whole. So items
are partitioned by size: class c holds items of 2**c to 2**(c+1) - 1 distinct shingles. For
every class a document is cut into blocks of half the class's largest size, and each three
blocks in a row are a window, so that every passage of an item's length lies whole in one. A window
that contains 75 % of an item has Jaccard similarity of 0.23 or more with it, whatever the
document's length. Of N_MINIMA independent minima at least one agrees then, but for a
chance below 0.77**40 = 3e-5 (verbatim items: below 1e-7). Blocks of a class are pairs of
the class below, so minima over all shingles are taken once, for the smallest class. An item and a document that
agree in a minimum are a candidate pair.

Candidates are verified exactly: shared distinct shingles of the whole document, as text,
over the item's distinct shingles, must reach ``threshold``.

The documents are read once and never shuffled. What their tasks know of the items is a bitmap
of BITMAP_BITS bits (8 MB, whatever the number of items) and a small one for each class and hash: a hit on it is only a reason
to send a minimum or a shingle on to the joins with the items, which decide. With very
many items more rows pass the bitmap, and results stay the same.

Words and lower-casing are as in ``text``. Defined cases: items of fewer than five words,
or null, contain no shingle and match nothing; null and short documents likewise; an item or a
document given twice gives one row a pair of ids; rows with a null id are not reported.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.llm.tables import stored
from fundlake.llm.text import LOWER, SHINGLE_WORDS, blocks, mix, ngram_hashes, word_hashes, words

N_MINIMA = 40
BITMAP_BITS = 1 << 26
COARSE_BITS = 1 << 14
COARSE_MASK = np.uint32(COARSE_BITS - 1)
_SALT = np.random.default_rng(11).integers(1, 1 << 32, 2 * N_MINIMA, dtype=np.uint32) | np.uint32(1)


def _grams(block):
    spans = words(block)
    grams, at = ngram_hashes(word_hashes(block, spans), spans.first, SHINGLE_WORDS)
    return spans, grams, at, np.searchsorted(spans.first, at, side="right") - 1


def _permuted(low: np.ndarray, k: int) -> np.ndarray:
    """One of the universal hashes of the shingles' low 32 bits (a bijection of them)."""
    return (low ^ _SALT[2 * k]) * _SALT[2 * k + 1]


def _key(values: np.ndarray, k: int, size_class: int) -> np.ndarray:
    return mix(values.astype(np.uint64) + np.uint64((k << 40) | (size_class << 48)))


def _bit(keys: np.ndarray) -> np.ndarray:
    return (keys & np.uint64(BITMAP_BITS - 1)).astype(np.int64)


def _shingle_texts(block, spans, at: np.ndarray) -> list[str]:
    lower = LOWER[block.data]
    return [
        b" ".join(lower[s:e].tobytes() for s, e in zip(spans.start[i : i + SHINGLE_WORDS], spans.end[i : i + SHINGLE_WORDS])).decode()
        for i in at
    ]


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = {"item_id": [], "size_class": [], "minima": [], "values": [], "hashes": [], "shingles": []}
        for block in blocks(batch["text"]):
            spans, grams, at, owner = _grams(block)
            for i in np.unique(owner):
                own, where = np.unique(grams[owner == i], return_index=True)
                size_class = len(own).bit_length() - 1
                least = [_permuted(own.astype(np.uint32), k).min(keepdims=True) for k in range(N_MINIMA)]
                keys = [int(_key(value, k, size_class).view(np.int64)[0]) for k, value in enumerate(least)]
                low = [int(value[0] & COARSE_MASK) for value in least]
                for name, value in zip(rows, (batch["item_id"][block.lo + int(i)].as_py(), size_class, keys, low, own.view(np.int64).tolist(),
                                              sorted(set(_shingle_texts(block, spans, at[owner == i][where]))))):
                    rows[name].append(value)
        yield pa.RecordBatch.from_pydict(rows, _ITEM_SCHEMA)


_ITEM_SCHEMA = pa.schema([("item_id", pa.int64()), ("size_class", pa.int32()), ("minima", pa.list_(pa.int64())), ("values", pa.list_(pa.int32())),
                          ("hashes", pa.list_(pa.int64())), ("shingles", pa.list_(pa.string()))])
_FOUND_SCHEMA = pa.schema([("doc_id", pa.int64()), ("minima", pa.list_(pa.int64())), ("shingles", pa.list_(pa.string()))])


@dataclass
class _Level:
    """Blocks of one class: starts (of the level below), document, and blocks whose next and next but one are of it too."""

    size_class: int
    starts: np.ndarray
    owner: np.ndarray
    follows: tuple[np.ndarray, np.ndarray]


def _levels(owner: np.ndarray, classes: list[int]) -> list[_Level]:
    """Of shingles in document order, for every class from the smallest to the largest."""
    out = []
    for c in range(min(classes), max(classes) + 1) if classes else ():
        # Half of the class's largest size; then two blocks of the class below.
        position = np.arange(len(owner)) - np.searchsorted(owner, owner)
        starts = np.flatnonzero(position % ((1 << c) if not out else 2) == 0)
        owner = owner[starts]
        out.append(_Level(c, starts, owner, tuple(owner[far:] == owner[:-far] for far in (1, 2))))
    return out


def _find(batches: Iterator[pa.RecordBatch], bitmap, classes: list[int]) -> Iterator[pa.RecordBatch]:
    """For each document with a minimum on the bitmap: those minima, and its shingles on the bitmap."""
    known, coarse = bitmap.value
    known = np.unpackbits(np.frombuffer(known, np.uint8)).view(bool)
    coarse = {at: np.unpackbits(np.frombuffer(bits, np.uint8)).view(bool) for at, bits in coarse.items()}
    for batch in batches:
        rows = {"doc_id": [], "minima": [], "shingles": []}
        for block in blocks(batch["text"]):
            spans, grams, at, owner = _grams(block)
            hits: list[tuple[np.ndarray, np.ndarray]] = []
            levels = _levels(owner, classes) if len(grams) else []
            low = grams.astype(np.uint32)
            for k in range(N_MINIMA if levels else 0):
                least = np.minimum.reduceat(_permuted(low, k), levels[0].starts)
                for level in levels:
                    if level.starts is not levels[0].starts:
                        least = np.minimum.reduceat(least, level.starts)
                    if level.size_class not in classes:
                        continue
                    window = least.copy()
                    for far, near in enumerate(level.follows, 1):
                        np.minimum(window[:-far], least[far:], out=window[:-far], where=near)
                    on = np.flatnonzero(coarse[level.size_class, k][window & COARSE_MASK])
                    if len(on):
                        keys = _key(window[on], k, level.size_class)
                        sure = known[_bit(keys)]
                        hits.append((level.owner[on[sure]], keys[sure]))
            hits = [hit for hit in hits if len(hit[0])]
            if not hits:
                continue
            docs, keys = (np.concatenate(x) for x in zip(*hits))
            shared = np.flatnonzero(known[_bit(mix(grams))])
            for i in np.unique(docs):
                mine = shared[owner[shared] == i]
                rows["doc_id"].append(batch["doc_id"][block.lo + int(i)].as_py())
                rows["minima"].append(np.unique(keys[docs == i]).view(np.int64).tolist())
                rows["shingles"].append(sorted(set(_shingle_texts(block, spans, at[mine]))))
        yield pa.RecordBatch.from_pydict(rows, _FOUND_SCHEMA)


def _bitmap(items: DataFrame) -> bytes:
    """The bits of all items' minima and shingles; at most BITMAP_BITS / 64 rows reach the driver."""
    keys = items.select(F.explode("minima").alias("key")).union(items.select(F.explode("mixed")))
    bit = F.col("key").bitwiseAND(F.lit(BITMAP_BITS - 1))
    words64 = keys.select(F.shiftright(bit, 6).alias("at"), F.expr("shiftleft(1L, cast(key & 63 AS INT))").alias("one"))
    rows = words64.groupBy("at").agg(F.bit_or("one").alias("bits")).toArrow()
    out = np.zeros(BITMAP_BITS // 64, np.int64)
    out[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    return np.packbits(np.unpackbits(out.view(np.uint8), bitorder="little")).tobytes()


def _coarse(items: DataFrame) -> dict[tuple[int, int], bytes]:
    """For each class and hash function the items' minima modulo COARSE_BITS: a bitmap that stays in a core's cache."""
    low = items.select("size_class", F.posexplode("values").alias("k", "low"))
    rows = low.groupBy("size_class", "k", F.shiftright("low", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(low & 63 AS INT))")).alias("bits")).collect()
    out: dict[tuple[int, int], np.ndarray] = {}
    for c, k, at, bits in rows:  # at most classes * N_MINIMA * COARSE_BITS / 64
        out.setdefault((c, k), np.zeros(COARSE_BITS // 64, np.int64))[at] = bits
    full = {at: np.packbits(np.unpackbits(bits.view(np.uint8), bitorder="little")).tobytes() for at, bits in out.items()}
    return {(c, k): full[c, k] for c, k in full}


def _with_mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _items(batches):
        flat = batch["hashes"].values.to_numpy(zero_copy_only=False).view(np.uint64)
        mixed = pa.ListArray.from_arrays(batch["hashes"].offsets, pa.array(mix(flat).view(np.int64)))
        yield pa.RecordBatch.from_arrays([*batch.columns, mixed], names=[*batch.schema.names, "mixed"])


def containments(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.75) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item) of every pair whose containment reaches ``threshold``."""
    spark = docs.sparkSession
    items = stored(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null")
        .mapInArrow(_with_mixed, "item_id long, size_class int, minima array<long>, values array<int>, hashes array<long>, shingles array<string>, mixed array<long>"),
        "items")
    classes = sorted(r[0] for r in items.select("size_class").distinct().collect())  # at most 64
    bitmap = spark.sparkContext.broadcast((_bitmap(items), _coarse(items)))
    found = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
        .mapInArrow(partial(_find, bitmap=bitmap, classes=classes), "doc_id long, minima array<long>, shingles array<string>"), "found")
    pairs = (
        found.select("doc_id", F.explode("minima").alias("key"))
        .join(items.select("item_id", F.explode("minima").alias("key")), "key").select("doc_id", "item_id").distinct()
    )
    both = pairs.join(found.select("doc_id", F.col("shingles").alias("x")), "doc_id").join(items.select("item_id", F.col("shingles").alias("y")), "item_id")
    exact = both.select("doc_id", "item_id", F.size(F.array_intersect("x", "y")).cast("long").alias("n_shared"), F.size("y").cast("long").alias("n_item"))
    return exact.where(F.col("n_shared") >= threshold * F.col("n_item")).groupBy("doc_id", "item_id").agg(F.max("n_shared").alias("n_shared"), F.max("n_item").alias("n_item"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.75) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; rows without doc_id are looked at by text."""
    named = docs.withColumn("_decontamination_row", F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")))
    found = containments(named.select(F.col("_decontamination_row").alias("doc_id"), "text"), benchmark, threshold)
    return named.join(found.select(F.col("doc_id").alias("_decontamination_row")).distinct(), "_decontamination_row", "left_anti").drop("_decontamination_row")
