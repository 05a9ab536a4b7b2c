"""Removal of repeated passages: every byte covered by a LENGTH-byte string that also starts earlier.

Order of starts: doc_id, then position. The steps:

1. Texts equal as a whole: the smallest id goes on, the others are repeated as a whole.
2. Anchors. In each LENGTH-byte window the least hash of its LENGTH/2-byte substrings marks an
   anchor, so equal windows have equal anchors, about one in 26 bytes. Anchors that occur once in the
   corpus cannot lie in a repeated window. This filter loses nothing; without it the exchange would need a row for
   each byte of the corpus. Only hashes travel: 6 bytes an anchor, packed by (block of texts, hash range).
3. Each document with shared anchors is read again. Around a shared anchor the segment of all windows that
   hold it is cut out. A shard is SHARD_BYTES of text in one task; segments equal within a shard go on once.
4. Segments meet by their anchor's hash. A bucket holds part of each shard; equal segments are taken
   together, and where an anchor has several different ones, the shards' Burrows-Wheeler transforms are
   merged by interleave refinement (``bwt.merge``). The repeated intervals of LENGTH bytes give the
   repeated windows: all but the earliest of each interval.
   An anchor that occurs over HOT_TIMES times would bring a segment from each document where its neighbours
   differ. Its segments are taken apart into windows instead, which meet by their own hashes in all buckets:
   only the earliest start of a window leaves a slice of a shard, the later ones are known to be repeats.
5. Repeated runs go back to their documents, which are read a last time to cut them out.

So neither a popular passage nor its edges are gathered in step 4: a bucket gets at most HOT_TIMES segments of an anchor, and
each window of the others once from each slice of a shard. Candidate filters use hashes; what is removed is compared
byte by byte in step 4 (equal segments by 64-bit hashes of 150 bytes within a bucket, whole texts and the
windows of hot anchors by 128 bits). Step 2 still brings 10 bytes for each occurrence of an anchor to one task.

Defined cases: null text is empty; texts shorter than LENGTH keep all; rows without doc_id come after
all others; of rows with one doc_id the order is that of a hash of the text, and a repeated row counts as a later copy.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.llm import bwt
from fundlake.llm.tables import discard, stored
from fundlake.llm.text import _BYTE, Block, blocks, mix, powers, span_hashes

LENGTH = 100
SHARD_BYTES = 16 << 20
BLOCK_BYTES = 1 << 19  # a task holds about 120 bytes for each of these
PART_ANCHORS = 1 << 19
BUCKET_BYTES = 1 << 20  # of all text; about as much text of segments
HOT_TIMES = 2048  # some 300 kB of segments
WINDOW_SLICE = 1 << 14  # segments taken apart at a time
_BYTE2 = np.random.default_rng(20240301).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LAST = (1 << 63) - 1


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minima of all runs of ``width`` values."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (width - span)], values[width - span :]) if span < width else values


def anchors(block: Block, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte position, hash and text of the anchors of a block; they depend on each text alone."""
    k = length // 2
    w, n = length - k + 1, len(block.data)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[block.data] * powers("up", n), out=total[1:])
    hashes = mix((total[k:] - total[:-k]) * powers("down", n + 1)[: n - k + 1])
    least = _least(hashes, w)
    inside = np.zeros(len(least), bool)  # windows that do not cross a text's end
    size = np.diff(block.offsets)
    edge = np.zeros(len(least) + 1, np.int64)
    long = np.flatnonzero(size >= length)
    np.add.at(edge, block.offsets[long], 1)
    np.add.at(edge, block.offsets[long + 1] - length + 1, -1)
    inside = np.cumsum(edge[:-1]) > 0
    # An anchor equals the least of one of the windows that hold it.
    marks = np.where(inside, least, np.uint64(0))
    padded = np.concatenate((np.zeros(w - 1, np.uint64), marks, np.zeros(w - 1, np.uint64)))
    at = np.flatnonzero(~_least(~padded, w) == hashes)
    return at, hashes[at], block.of(at)


def _planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of integers, all first bytes, then all second: repetitive for compressors."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unplanes(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return out.view("<u8").ravel()


def _survey(batches: Iterator[pa.RecordBatch], length: int, parts: int) -> Iterator[pa.RecordBatch]:
    """For each block its documents (part -1), and its anchors by hash range."""
    for batch in batches:
        for block in blocks(batch["text"], BLOCK_BYTES):
            at, hashes, of = anchors(block, length)
            if not len(at):
                continue
            name = uuid.uuid4().hex
            keys, h = (batch[c].slice(block.lo, len(block)).to_numpy() for c in ("key", "h1"))
            rows = {"block": [name], "part": [-1], "hashes": [np.stack((keys, h)).tobytes()], "places": [np.bincount(of, minlength=len(block)).astype("<u4").tobytes()]}
            # Anchors are least hashes and lie low, so their range is cut after mixing them again.
            part = (mix(hashes) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
            for p in range(parts):
                mine = order[cuts[p] : cuts[p + 1]]
                if len(mine):
                    for column, value in zip(rows, (name, p, _planes(hashes[mine] & np.uint64((1 << 48) - 1), 6), _planes(mine, 4))):
                        rows[column].append(value)
            yield pa.RecordBatch.from_pydict(rows, pa.schema([("block", pa.string()), ("part", pa.int32()), ("hashes", pa.binary()), ("places", pa.binary())]))


def _shared(table: pa.Table, hot: int) -> pa.Table:
    """Of one hash range: the anchors of each block whose hash occurs twice, and those whose hash occurs over ``hot`` times."""
    hashes = [_unplanes(x, 6) for x in table["hashes"].to_pylist()]
    places = [_unplanes(x, 4) for x in table["places"].to_pylist()]
    joined = np.concatenate(hashes)
    ordered = np.sort(joined)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    often = np.unique(ordered[hot:][ordered[hot:] == ordered[: max(len(ordered) - hot, 0)]])
    out = {"block": [], "places": [], "hot": []}
    for name, own, at in zip(table["block"].to_pylist(), hashes, places):
        if len(twice):
            found = twice[np.minimum(np.searchsorted(twice, own), len(twice) - 1)] == own
            if found.any():
                out["block"].append(name)
                out["places"].append(_planes(at[found], 4))
                out["hot"].append(_planes(at[np.isin(own, often)], 4) if len(often) else b"")
    return pa.table(out, pa.schema([("block", pa.string()), ("places", pa.binary()), ("hot", pa.binary())]))


def _by_document(listed: pa.Table, shared: pa.Table) -> pa.Table:
    """The shared anchors of each document of one block, as numbers within the document, and which of them are hot."""
    out = {"key": [], "h1": [], "shared": [], "hot": []}
    if len(listed) and len(shared):
        keys, h = np.frombuffer(listed["hashes"][0].as_py(), np.int64).reshape(2, -1)
        counts = np.frombuffer(listed["places"][0].as_py(), "<u4").astype(np.int64)
        first = np.concatenate(([0], np.cumsum(counts)))
        places = np.sort(np.concatenate([_unplanes(x, 4) for x in shared["places"].to_pylist()]).astype(np.int64))
        hot = np.isin(places, np.concatenate([_unplanes(x, 4) for x in shared["hot"].to_pylist()]).astype(np.int64))
        cuts = np.searchsorted(places, first)
        for i in np.flatnonzero(np.diff(cuts)):
            out["key"].append(int(keys[i]))
            out["h1"].append(int(h[i]))
            out["shared"].append((places[cuts[i] : cuts[i + 1]] - first[i]).astype("<u4").tobytes())
            out["hot"].append((places[cuts[i] : cuts[i + 1]][hot[cuts[i] : cuts[i + 1]]] - first[i]).astype("<u4").tobytes())
    return pa.table(out, pa.schema([("key", pa.int64()), ("h1", pa.int64()), ("shared", pa.binary()), ("hot", pa.binary())]))


_PACK = pa.schema([("bucket", pa.int64()), ("anchor", pa.binary()), ("key", pa.binary()), ("h1", pa.binary()), ("at", pa.binary()), ("size", pa.binary()), ("text", pa.binary())])
_COLUMNS = "bucket long, anchor binary, key binary, h1 binary, at binary, size binary, text binary"


def _runs(key, h, lo, hi) -> pa.Table:
    """Rows (key, h1, runs) of intervals by document."""
    order = np.lexsort((lo, h, key))
    key, h, lo, hi = key[order], h[order], lo[order], hi[order]
    fresh = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (h[1:] != h[:-1])))) if len(key) else np.zeros(0, int)
    ends = np.append(fresh[1:], len(key)) if len(fresh) else fresh
    pairs = np.stack((lo, hi), 1).astype("<i4")
    return pa.table({"key": key[fresh], "h1": h[fresh], "runs": pa.array([pairs[s:e].tobytes() for s, e in zip(fresh, ends)], pa.binary())},
                    pa.schema([("key", pa.int64()), ("h1", pa.int64()), ("runs", pa.binary())]))


def _first_of_equal(anchor, seg, key, h, at) -> tuple[np.ndarray, np.ndarray]:
    """Which segments are the earliest of the equal ones, and which start after those."""
    order = np.lexsort((at, h, key, seg, anchor))
    lead = np.ones(len(order), bool)
    lead[1:] = (seg[order][1:] != seg[order][:-1]) | (anchor[order][1:] != anchor[order][:-1])
    leader = order[np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))]
    first, later = np.zeros(len(order), bool), np.zeros(len(order), bool)
    first[order[lead]] = True
    # A segment can be cut out for several anchors with one hash; it is no repeat of itself.
    later[order] = (key[order] != key[leader]) | (h[order] != h[leader]) | (at[order] != at[leader])
    return first, later


def _cut(batches: Iterator[pa.RecordBatch], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Segments around shared anchors, once a shard, packed by bucket; repeats within the shard as runs.

    A run travels as a pack without anchors, in a bucket of its own choice; windows of hot anchors as a pack
    without sizes, with their two hashes in place of anchor and text.
    """
    held: list[tuple] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        anchor, seg, key, h, at, n, hot = (np.concatenate([part[k] for part in held]) for k in range(7))
        text = np.concatenate([part[7] for part in held])
        begin = np.cumsum(n) - n
        first, later = _first_of_equal(anchor, seg, key, h, at)
        rows = {name: [] for name in _PACK.names}

        def pack(bucket, mine, whole):
            body = b""
            if whole:
                body = text[np.repeat(begin[mine] - (np.cumsum(n[mine]) - n[mine]), n[mine]) + np.arange(n[mine].sum())].tobytes()
            values = (int(bucket), anchor[mine].tobytes() if whole else b"", key[mine].tobytes(), h[mine].tobytes(), at[mine].astype("<u4").tobytes(), n[mine].astype("<u2" if whole else "<u4").tobytes(), body)
            for name, value in zip(rows, values):
                rows[name].append(value)

        for chosen, whole in ((first & ~hot, True), (later, False)):
            mine = np.flatnonzero(chosen)
            bucket = mix(anchor[mine]) % np.uint64(buckets) if whole else mix(key[mine].view(np.uint64)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(bucket[order].astype(np.int64))) + 1):
                if len(part):
                    pack(bucket[part[0]], mine[part], whole)
        held.clear()
        yield pa.RecordBatch.from_pydict(rows, _PACK)
        apart = np.flatnonzero(first & hot)
        for s in range(0, len(apart), WINDOW_SLICE):
            mine = apart[s : s + WINDOW_SLICE]
            yield _windows(text, begin[mine], n[mine], key[mine], h[mine], at[mine], length, buckets)

    half = length // 2
    for batch in batches:
        shared, often = batch["shared"].to_pylist(), batch["hot"].to_pylist()
        for block in blocks(batch["text"], BLOCK_BYTES):
            at, hashes, of = anchors(block, length)
            first = np.searchsorted(of, np.arange(len(block)))
            chosen, hot = (np.concatenate([first[i] + np.frombuffer(x[block.lo + i], "<u4").astype(np.int64) for i in range(len(block))]) for x in (shared, often))
            hot = np.isin(chosen, hot)
            at, hashes, of = at[chosen], hashes[chosen], of[chosen]
            lo, hi = np.maximum(at - half, block.offsets[of]), np.minimum(at + length, block.offsets[of + 1])
            n = hi - lo
            keys, h = (batch[c].slice(block.lo, len(block)).to_numpy()[of] for c in ("key", "h1"))
            text = block.data[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            held.append((hashes, span_hashes(block.data, lo, hi), keys, h, lo - block.offsets[of], n, hot, text))
            size += len(block.data)
            if size >= SHARD_BYTES:
                yield from flush()
                size = 0
    if held:
        yield from flush()


def _windows(text, begin, n, key, h, at, length: int, buckets: int) -> pa.RecordBatch:
    """The windows of segments: the earliest of equal ones packed by bucket, the others as runs."""
    count = n - length + 1
    of = np.repeat(np.arange(len(n)), count)
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    w1, w2 = np.empty(len(of), np.uint64), np.empty(len(of), np.uint64)
    # In pieces of segments, whose bytes stay near each other and few.
    data = text[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    start = (np.cumsum(n) - n)[of] + step
    piece = 1 << 16
    for s in range(0, len(of), piece):
        mine = start[s : s + piece]
        low, high = mine[0], mine[-1] + length
        for out, table in ((w1, _BYTE), (w2, _BYTE2)):
            out[s : s + piece] = span_hashes(data[low:high], mine - low, mine - low + length, table)
    first, later = _first_of_equal(w1, w2, key[of], h[of], at[of] + step)
    rows = {name: [] for name in _PACK.names}
    mine = np.flatnonzero(first)
    bucket = mix(w1[mine]) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(bucket[order].astype(np.int64))) + 1):
        if len(part):
            x = mine[part]
            values = (int(bucket[part[0]]), w1[x].tobytes(), key[of[x]].tobytes(), h[of[x]].tobytes(), (at[of[x]] + step[x]).astype("<u4").tobytes(), b"", w2[x].tobytes())
            for name, value in zip(rows, values):
                rows[name].append(value)
    k, hh, lo, hi = _union(key[of[later]], h[of[later]], (at[of] + step)[later], (at[of] + step)[later] + length)
    bucket = mix(k.view(np.uint64)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    for x in np.split(order, np.flatnonzero(np.diff(bucket[order].astype(np.int64))) + 1):
        if len(x):
            values = (int(bucket[x[0]]), b"", k[x].tobytes(), hh[x].tobytes(), lo[x].astype("<u4").tobytes(), (hi - lo)[x].astype("<u4").tobytes(), b"")
            for name, value in zip(rows, values):
                rows[name].append(value)
    return pa.RecordBatch.from_pydict(rows, _PACK)


def _bucket(table: pa.Table, length: int) -> pa.Table:
    """The repeated runs that the segments and windows of one bucket show."""
    packs = [p for p in table.to_pylist()]
    done = [p for p in packs if not p["anchor"]]
    apart = [p for p in packs if p["anchor"] and not p["size"]]
    packs = [p for p in packs if p["anchor"] and p["size"]]
    read = lambda name, kind, of: [np.frombuffer(p[name], kind) for p in of]
    out_key, out_h = read("key", np.int64, done), read("h1", np.int64, done)
    out_lo = [x.astype(np.int64) for x in read("at", "<u4", done)]
    out_hi = [lo + x for lo, x in zip(out_lo, read("size", "<u4", done))]
    if apart:
        w1, w2, key, h, at = (np.concatenate(read(name, kind, apart)) for name, kind in (("anchor", np.uint64), ("text", np.uint64), ("key", np.int64), ("h1", np.int64), ("at", "<u4")))
        _, again = _first_of_equal(w1, w2, key, h, at)
        out_key.append(key[again])
        out_h.append(h[again])
        out_lo.append(at[again].astype(np.int64))
        out_hi.append(at[again].astype(np.int64) + length)
    if packs:
        anchor, key, h = (np.concatenate(read(name, kind, packs)) for name, kind in (("anchor", np.uint64), ("key", np.int64), ("h1", np.int64)))
        at, n = (np.concatenate(read(name, kind, packs)).astype(np.int64) for name, kind in (("at", "<u4"), ("size", "<u2")))
        text = np.frombuffer(b"".join(p["text"] for p in packs), np.uint8)
        shard = np.repeat(np.arange(len(packs)), [len(p["key"]) // 8 for p in packs])
        begin = np.cumsum(n) - n
        # Hashes of the segments: in pieces, each text being a pack's.
        seg = np.concatenate([
            span_hashes(text[begin[s] : begin[e - 1] + n[e - 1]], begin[s:e] - begin[s], begin[s:e] - begin[s] + n[s:e])
            for s, e in zip(np.searchsorted(shard, np.arange(len(packs))), np.searchsorted(shard, np.arange(len(packs)), side="right"))])
        first, again = _first_of_equal(anchor, seg, key, h, at)
        out_key.append(key[again])
        out_h.append(h[again])
        out_lo.append(at[again])
        out_hi.append(at[again] + n[again])
        # Anchors with one segment only have nothing left to compare.
        _, which, times = np.unique(anchor[first], return_inverse=True, return_counts=True)
        left = np.flatnonzero(first)[times[which] > 1]
        if len(left):
            order, windows = _repeated_windows(text, begin[left], n[left], shard[left], key[left], h[left], at[left], length)
            out_key.append(key[left][order])
            out_h.append(h[left][order])
            out_lo.append(windows)
            out_hi.append(windows + length)
    joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_key, out_h, out_lo, out_hi)]
    return _runs(*_union(*joined))


def _repeated_windows(text, begin, n, shard, key, h, at, length) -> tuple[np.ndarray, np.ndarray]:
    """Segment and document position of each window that occurs earlier, by merging the shards' transforms."""
    texts, sources = [], []
    for z in np.unique(shard):
        mine = np.flatnonzero(shard == z)
        where = np.repeat(begin[mine] - (np.cumsum(n[mine]) - n[mine]), n[mine]) + np.arange(n[mine].sum())
        texts.append(text[where])
        sources.append(mine)
    interval = bwt.merge(texts, length)
    segment = np.concatenate(sources)
    start = np.cumsum(n[segment]) - n[segment]  # of each segment in the joined texts
    count = n[segment] - length + 1
    of = np.repeat(np.arange(len(segment)), count)
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    _, document = np.unique(np.stack((key[segment], h[segment])), axis=1, return_inverse=True)
    place = document.ravel().astype(np.int64)[of] << 32 | (at[segment][of] + step)
    interval = interval[start[of] + step]
    order = np.argsort(interval, kind="stable")
    heads = np.flatnonzero(np.concatenate(([True], np.diff(interval[order]) != 0)))
    earliest = np.minimum.reduceat(place[order], heads)
    later = order[place[order] != np.repeat(earliest, np.diff(np.append(heads, len(order))))]
    return segment[of[later]], at[segment][of[later]] + step[later]


def _union(key, h, lo, hi):
    """Disjoint, maximal intervals of each document."""
    if not len(key):
        return key, h, lo, hi
    order = np.lexsort((lo, h, key))
    key, h, lo, hi = key[order], h[order], lo[order], hi[order]
    other = np.concatenate(([True], (key[1:] != key[:-1]) | (h[1:] != h[:-1])))
    group = np.cumsum(other) - 1
    reach = np.maximum.accumulate(hi + group * (1 << 33)) - group * (1 << 33)  # within a document
    fresh = other.copy()
    fresh[1:] |= lo[1:] > reach[:-1]
    heads = np.flatnonzero(fresh)
    return key[heads], h[heads], lo[heads], np.maximum.reduceat(hi, heads)


def _apply(batches: Iterator[pa.RecordBatch], length: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        runs, copies = batch["runs"].to_pylist(), batch["copy"].to_pylist()
        for block in blocks(batch["text"]):
            rows = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept_text": []}
            for i in range(len(block)):
                data, copy = block.data[block.offsets[i] : block.offsets[i + 1]], copies[block.lo + i]
                cover = np.zeros(len(data) + 1, np.int32)
                if copy and len(data) >= length:
                    cover[0] = 1
                for part in runs[block.lo + i] or ():
                    lo, hi = np.frombuffer(part, "<i4").reshape(-1, 2).T
                    np.add.at(cover, lo, 1)
                    np.add.at(cover, hi, -1)
                gone = np.cumsum(cover[:-1]) > 0
                kept = data[~gone].tobytes()
                rows["n_bytes"].append(len(data))
                rows["n_removed"].append(len(data) - len(kept))
                rows["n_spans"].append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
                rows["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                rows["kept_text"].append(kept.decode("utf-8", "replace") if with_text else None)
            columns = [batch[c].slice(block.lo, len(block)) for c in ("doc_id", "key", "h1")]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(v, pa.string() if k.startswith("kept") else pa.int64()) for k, v in rows.items())], names=["doc_id", "key", "h1", *rows])


def remove(docs: DataFrame, length: int = LENGTH, with_text: bool = False, hot: int = HOT_TIMES) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text (null unless asked for)."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("key"),
        F.xxhash64("text").alias("h1"), F.coalesce("text", F.lit("")).alias("text"))
    names = rows.select("key", "h1", F.xxhash64(F.lit(1), "text").alias("h2"), F.octet_length("text").alias("n"))
    n_bytes = names.agg(F.sum("n")).first()[0] or 0
    parts = max(16, int(n_bytes / 26 / PART_ANCHORS) + 1)
    buckets = max(64, int(n_bytes / BUCKET_BYTES) + 1)
    leaders = names.groupBy("h1", "h2").agg(F.min("key").alias("leader"), F.count("*").alias("n")).where("n > 1").select("h1", "h2", "leader")
    copies = stored(names.join(leaders, ["h1", "h2"]).where("key > leader").select("key", "h1").distinct(), "copies")

    survey = stored(rows.select("key", "h1", "text").mapInArrow(partial(_survey, length=length, parts=parts), "block string, part int, hashes binary, places binary"), "survey")
    shared = survey.where("part >= 0").groupBy("part").applyInArrow(lambda table: _shared(table, hot), "block string, places binary, hot binary")
    listed = survey.where("part < 0")
    flags = listed.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(_by_document, "key long, h1 long, shared binary, hot binary")
    flags = stored(flags.join(copies, ["key", "h1"], "left_anti"), "shared_anchors")
    discard(survey)  # the flags are stored; nothing reads the survey again

    cut = flags.join(rows.select("doc_id", "key", "h1", "text"), ["key", "h1"]).select("key", "h1", "text", "shared", "hot")
    packs = cut.mapInArrow(partial(_cut, length=length, buckets=buckets), _COLUMNS)
    runs = packs.groupBy("bucket").applyInArrow(lambda table: _bucket(table, length), "key long, h1 long, runs binary")
    found = runs.withColumn("copy", F.lit(False)).unionByName(copies.select("key", "h1", F.lit(None).cast("binary").alias("runs"), F.lit(True).alias("copy")))
    found = found.groupBy("key", "h1").agg(F.collect_list("runs").alias("runs"), F.max("copy").alias("copy"))
    whole = rows.select("doc_id", "key", "h1", "text").join(found, ["key", "h1"], "left").select("doc_id", "key", "h1", "text", "runs", F.coalesce("copy", F.lit(False)).alias("copy"))
    done = whole.mapInArrow(partial(_apply, length=length, with_text=with_text),
                            "doc_id long, key long, h1 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string")
    # Rows repeated as a whole were all treated as the first; the later ones are copies.
    counted = done.groupBy(*done.columns).agg(F.count("*").alias("times"))
    each = counted.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    again = (F.col("nth") > 1) & (F.col("n_bytes") >= length)
    return each.select(
        "doc_id", "n_bytes", F.when(again, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(again, 1).otherwise(F.col("n_spans")).cast("long").alias("n_spans"),
        F.when(again, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        F.when(again & F.col("kept_text").isNotNull(), "").otherwise(F.col("kept_text")).alias("kept_text"))
