"""Token ids in binary shards, found by key through a minimal perfect hash.

A store is a folder of shard files and a Spark table of their names. Rows are range-partitioned by
key, each task encodes its texts and writes one file, and shards follow each other in key order.
All integers are little-endian. A shard file is

    magic "FLTOKEN1", uint32 version, uint32 bytes an id (2 or 4), uint64 documents, ids, hash levels, slots
    per level: uint64 bits, then the bits (a multiple of 64) and a uint32 rank for each 64 of them
    by hash slot: uint64 fingerprint of the key, uint64 first id, uint32 number of ids, uint32 row
    by row: int64 key; by row: uint32 number of ids
    ids of all documents, one after the other

The hash is built level by level: keys that fall alone on a bit of a level's array own it, the others go
on to the next level. A key's slot is the rank of its bit. So a look-up reads a few words, one slot and
the ids, however many documents the shard has, and a key that isn't there fails
at the bits or at the stored fingerprint (a chance of 2**-64).

Files are written under a name of their own for each attempt and count only if the manifest row of
the attempt was kept, so lost executors and repeated tasks leave no half-written shard behind in the
store. They are written and read through pyarrow's file systems (local paths, HDFS, S3, GCS).

Encoding: ``_Encoder`` splits texts at the tokenizer's own pre-token boundaries with array operations
and has the library encode each distinct piece once; pieces never merge across boundaries. Texts
with a special token's string or with characters of which releases of Unicode may differ are
given to the library whole.

Defined cases: a null text is an empty one and has the end id only; rows without key are left out;
of rows with one key all are stored, and look-ups give the first; an empty table gives no shard.
"""

from __future__ import annotations

import os
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlake.llm.tables import stored
from fundlake.llm.text import mix
from fundlake.session import scratch_path

MAGIC, VERSION = b"FLTOKEN1", 1
SHARD_ROWS, SHARD_IDS = 8000, 1 << 23
#: Tasks that read shards back, at most; more shards share them.
MOST_READERS = 20_000
GAMMA = 2.0
SAFE_POINTS = 0x3000
CACHED_PIECES = 1 << 19
PART_CHARACTERS = 1 << 20
_POINT = np.random.default_rng(5).integers(1, 1 << 63, SAFE_POINTS, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
LETTER, NUMBER, SPACE, OTHER, UNSAFE = range(5)
#: The contractions that the tokenizer's pattern names.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


@lru_cache(1)
def _kinds() -> np.ndarray:
    """Of each code point below SAFE_POINTS, and of all above as the last: its kind in the pattern."""
    kinds = np.full(SAFE_POINTS + 1, OTHER, np.uint8)
    for c in range(SAFE_POINTS):
        category = unicodedata.category(chr(c))
        if category[0] == "L":
            kinds[c] = LETTER
        elif category[0] == "N":
            kinds[c] = NUMBER
        elif category in ("Zs", "Zl", "Zp") or 9 <= c <= 13 or c == 0x85:
            kinds[c] = SPACE
        elif category in ("Cn", "Mn", "Mc", "Me", "Cs", "Co"):
            kinds[c] = UNSAFE
    kinds[SAFE_POINTS] = UNSAFE
    return kinds


def piece_starts(points: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Where pieces start in joined texts, by the pattern of byte-level BPE.

    edge: true at each text's first character (and one past the end). Runs of one kind are pieces, and take one
    preceding blank along; of a run of space before something else the last character stands alone or is that
    blank; an apostrophe with a contraction's letters is a piece where a match can begin at it.
    """
    n = len(points)
    kind = _kinds()[np.minimum(points, SAFE_POINTS)]
    new = edge[:n].copy()
    new[1:] |= kind[1:] != kind[:-1]
    start = new.copy()
    space = kind == SPACE
    # The last space of a run that something follows in the same text.
    before = np.zeros(n, bool)
    before[:-1] = space[:-1] & ~space[1:] & ~edge[1:n]
    start |= before
    blank = before & (points == 0x20)
    start[1:] &= ~blank[:-1]
    # Contractions: an apostrophe that starts a piece.
    quotes = np.flatnonzero((points == 0x27) & start)
    if len(quotes):
        padded = np.concatenate((points, np.zeros(3, points.dtype)))
        end_of = np.concatenate((edge, np.ones(3, bool)))
        for letters in CONTRACTIONS:
            fits = np.ones(len(quotes), bool)
            for k, letter in enumerate(letters, 1):
                fits &= (padded[quotes + k] == ord(letter)) & ~end_of[quotes + k]
            hit = quotes[fits]
            for k in range(1, len(letters) + 1):
                start[hit + k] = False
            after = hit + len(letters) + 1
            inside = after < n
            start[after[inside]] = True
    return np.flatnonzero(start)


def _grow_powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


class _Encoder:
    """Encodes batches of texts; keeps the ids of pieces it has met (CACHED_PIECES at most)."""

    def __init__(self, path: str):
        # Spark runs a task a core: threads of the library would contend for these cores and hold memory of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.clear()

    def clear(self) -> None:
        # hashes ascend; slot[k] is the place of hashes[k] among first, where ids of pieces begin.
        self.hashes, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.first, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _library(self, texts: list[str]) -> list[list[int]]:
        out = []
        for at in range(0, len(texts), 2000):
            out += [e.ids for e in self.tokenizer.encode_batch_fast(texts[at : at + 2000], add_special_tokens=False)]
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        joined = [i for i, t in enumerate(texts) if t and not any(s in t for s in self.special)]
        arrays = [np.frombuffer(texts[i].encode("utf-32-le"), np.uint32) for i in joined]
        safe = [not (_kinds()[np.minimum(a, SAFE_POINTS)] == UNSAFE).any() for a in arrays]
        plain = [i for i, t in enumerate(texts) if t and i not in {j for j, s in zip(joined, safe) if s}]
        for i, ids in zip(plain, self._library([texts[i] for i in plain])):
            out[i] = np.array(ids, np.uint32)
        joined, arrays = [i for i, s in zip(joined, safe) if s], [a for a, s in zip(arrays, safe) if s]
        lo = 0
        while lo < len(arrays):  # parts of bounded size; a longer text is a part of its own
            hi, size = lo + 1, len(arrays[lo])
            while hi < len(arrays) and size + len(arrays[hi]) <= PART_CHARACTERS:
                size += len(arrays[hi])
                hi += 1
            for i, ids in zip(joined[lo:hi], self._part(arrays[lo:hi])):
                out[i] = ids
            lo = hi
        return out

    def _part(self, arrays: list[np.ndarray]) -> list[np.ndarray]:
        points = np.concatenate(arrays)
        edge = np.zeros(len(points) + 1, bool)
        ends = np.cumsum([len(a) for a in arrays])
        edge[np.concatenate(([0], ends))] = True
        start = piece_starts(points, edge)
        end = np.append(start[1:], len(points))
        total = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(_POINT[points] * _grow_powers(_STEP, len(points)), out=total[1:])
        hashes = mix((total[end] - total[start]) * _grow_powers(_BACK, len(points))[start] + (end - start).astype(np.uint64))
        distinct, where, piece = np.unique(hashes, return_index=True, return_inverse=True)
        self._learn(distinct, points, start[where], end[where])
        slot = self.slot[np.searchsorted(self.hashes, distinct)][piece]
        count = self.first[slot + 1] - self.first[slot]
        stop = np.cumsum(count)
        ids = self.ids[np.repeat(self.first[slot] - (stop - count), count) + np.arange(stop[-1])]
        cuts = np.concatenate(([0], stop))[np.searchsorted(start, ends)]
        return np.split(ids, cuts[:-1])

    def _learn(self, hashes: np.ndarray, points: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        if len(self.hashes) + len(hashes) > CACHED_PIECES:
            self.clear()
        unknown = np.flatnonzero(~np.isin(hashes, self.hashes, assume_unique=True))
        if not len(unknown):
            return
        text = points.tobytes().decode("utf-32-le")
        pieces = [text[s:e] for s, e in zip(start[unknown].tolist(), end[unknown].tolist())]
        new = self._library(pieces)
        at = np.searchsorted(self.hashes, hashes[unknown])
        self.slot = np.insert(self.slot, at, len(self.hashes) + np.arange(len(unknown)))
        self.hashes = np.insert(self.hashes, at, hashes[unknown])
        self.first = np.concatenate((self.first, len(self.ids) + np.cumsum([len(x) for x in new])))
        self.ids = np.concatenate((self.ids, np.fromiter(chain.from_iterable(new), np.uint32)))


@lru_cache(1)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def _level_bit(keys: np.ndarray, level: int, n_bits: int) -> np.ndarray:
    return (mix(keys + np.uint64((level + 1) * 0xD1B54A32D192ED03 & (1 << 64) - 1)) % np.uint64(n_bits)).astype(np.int64)


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return mix(keys.view(np.uint64) ^ np.uint64(0xA0761D6478BD642F))


class PerfectHash:
    """Levels of (bits as uint64 words, rank before each word); a key's slot is the rank of its first own bit."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]]):
        self.levels = levels

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """Of distinct 64-bit keys."""
        levels, rank, left = [], 0, keys.view(np.uint64)
        while len(left):
            n_words = max(1, int(-(-len(left) * GAMMA // 64)))
            bit = _level_bit(left, len(levels), n_words * 64)
            alone = np.bincount(bit, minlength=n_words * 64) == 1
            bits = np.packbits(alone, bitorder="little").view(np.uint64)
            before = rank + np.concatenate(([0], np.cumsum(alone.reshape(-1, 64).sum(1))[:-1]))
            levels.append((bits, before.astype(np.uint32)))
            rank += int(alone.sum())
            left = left[~alone[bit]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where no level has a bit for it. Other keys than the built ones may get any slot."""
        out, left, todo = np.full(len(keys), -1, np.int64), keys.view(np.uint64), np.arange(len(keys))
        for level, (bits, before) in enumerate(self.levels):
            bit = _level_bit(left[todo], level, len(bits) * 64)
            word, offset = bit >> 6, (bit & 63).astype(np.uint64)
            on = (bits[word] >> offset & np.uint64(1)).astype(bool)
            below = bits[word[on]] & ((np.uint64(1) << offset[on]) - np.uint64(1))
            out[todo[on]] = before[word[on]] + np.bitwise_count(below)
            todo = todo[~on]
            if not len(todo):
                break
        return out


def shard_bytes(keys: np.ndarray, encoded: list[np.ndarray], id_bytes: int) -> bytes:
    """A shard file; keys ascend (equal keys may follow each other)."""
    count = np.array([len(x) for x in encoded], np.uint32)
    begin = (np.cumsum(count, dtype=np.uint64) - count).astype(np.uint64)
    distinct, row = np.unique(keys, return_index=True)
    hashed = PerfectHash.build(distinct)
    slots = np.zeros(len(distinct), _SLOT)
    at = hashed.slots(distinct)
    slots["fingerprint"][at], slots["first"][at] = fingerprint(distinct), begin[row]
    slots["count"][at], slots["row"][at] = count[row], row
    parts = [MAGIC, struct.pack("<IIQQQQ", VERSION, id_bytes, len(keys), int(count.sum()), len(hashed.levels), len(distinct))]
    for bits, before in hashed.levels:
        parts += [struct.pack("<Q", len(bits) * 64), bits.astype("<u8").tobytes(), before.astype("<u4").tobytes()]
    return b"".join([*parts, slots.tobytes(), keys.astype("<i8").tobytes(), count.astype("<u4").tobytes(), np.concatenate(encoded).astype(f"<u{id_bytes}").tobytes()])


_SLOT = np.dtype([("fingerprint", "<u8"), ("first", "<u8"), ("count", "<u4"), ("row", "<u4")])


class Shard:
    """A shard file opened from any seekable file; only what a look-up touches is read."""

    def __init__(self, file):
        self.file = file
        if file.read(8) != MAGIC:
            raise ValueError("not a token shard")
        version, self.id_bytes, self.n_documents, self.n_ids, n_levels, self.n_slots = struct.unpack("<IIQQQQ", file.read(40))
        if version != VERSION:
            raise ValueError(f"token shard version {version}")
        levels = []
        for _ in range(n_levels):
            n_words = struct.unpack("<Q", file.read(8))[0] // 64
            levels.append((np.frombuffer(file.read(8 * n_words), "<u8"), np.frombuffer(file.read(4 * n_words), "<u4")))
        self.hash, self.slots_at = PerfectHash(levels), file.tell()
        self.keys_at = self.slots_at + self.n_slots * _SLOT.itemsize
        self.counts_at = self.keys_at + 8 * self.n_documents
        self.ids_at = self.counts_at + 4 * self.n_documents

    def _read(self, at: int, dtype, n: int) -> np.ndarray:
        self.file.seek(at)
        return np.frombuffer(self.file.read(np.dtype(dtype).itemsize * n), dtype)

    def get(self, key: int) -> np.ndarray | None:
        """The ids of the document with this key, or None."""
        probe = np.array([key], np.int64)
        at = int(self.hash.slots(probe)[0])
        if at < 0:
            return None
        slot = self._read(self.slots_at + at * _SLOT.itemsize, _SLOT, 1)[0]
        if slot["fingerprint"] != fingerprint(probe)[0]:
            return None
        return self.ids(int(slot["first"]), int(slot["count"]))

    def ids(self, first: int, count: int) -> np.ndarray:
        return self._read(self.ids_at + self.id_bytes * first, f"<u{self.id_bytes}", count).astype(np.uint32)

    def slots(self) -> np.ndarray:
        return self._read(self.slots_at, _SLOT, self.n_slots)

    def counts(self) -> np.ndarray:
        return self._read(self.counts_at, "<u4", self.n_documents)

    def keys(self) -> np.ndarray:
        return self._read(self.keys_at, "<i8", self.n_documents)


def _write(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end_id: int, shard_rows: int) -> Iterator[pa.RecordBatch]:
    """Writes the rows of a task as shards of bounded size; yields a manifest row for each."""
    encoder = _encoder(tokenizer)
    id_bytes = 2 if max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    system, root = pa.fs.FileSystem.from_uri(folder)
    keys: list[int] = []
    encoded: list[np.ndarray] = []
    n_ids = 0

    def flush() -> pa.RecordBatch:
        nonlocal n_ids
        name = f"{uuid.uuid4().hex}.tok"
        with system.open_output_stream(f"{root}/{name}") as out:
            out.write(shard_bytes(np.array(keys, np.int64), encoded, id_bytes))
        row = pa.RecordBatch.from_pydict({"first_key": [keys[0]], "last_key": [keys[-1]], "n_documents": [len(keys)], "n_ids": [n_ids], "name": [name]})
        keys.clear()
        encoded.clear()
        n_ids = 0
        return row

    for batch in batches:
        for lo in range(0, len(batch), 400):
            part = batch.slice(lo, 400)
            texts = [t or "" for t in part["text"].to_pylist()]
            for key, ids in zip(part["key"].to_pylist(), encoder.encode(texts)):
                keys.append(key)
                encoded.append(np.append(ids, np.uint32(end_id)).astype(f"u{id_bytes}"))
                n_ids += len(encoded[-1])
                if len(keys) >= shard_rows or n_ids >= SHARD_IDS:
                    yield flush()
    if keys:
        yield flush()


def write(
    docs: DataFrame, key: str, text: str, tokenizer: str, end_id: int, folder: str | None = None, shard_rows: int = SHARD_ROWS,
) -> tuple[DataFrame, str]:
    """Encode and store ``docs``; gives the manifest (a stored table) and the URI of the shards' folder.

    ``tokenizer`` is a path that every executor has; ``folder`` a URI that all reach.
    """
    spark = docs.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder or scratch_path(spark, "tokens"))
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)
    uri = system.makeQualified(path).toUri().toString()
    folder = "file://" + uri.removeprefix("file:") if uri.startswith("file:/") and not uri.startswith("file://") else uri
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).where("key is not null")
    # Rows of one key go by a hash of their texts, so that a repeated task writes the same order.
    ordered = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("key").sortWithinPartitions("key", "tie").drop("tie")
    manifest = ordered.mapInArrow(partial(_write, folder=folder, tokenizer=tokenizer, end_id=end_id, shard_rows=shard_rows),
                                  "first_key long, last_key long, n_documents long, n_ids long, name string")
    return stored(manifest, "manifest"), folder


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    system, root = pa.fs.FileSystem.from_uri(folder)
    for batch in batches:
        for name, base in zip(batch["name"].to_pylist(), batch["base"].to_pylist()):
            with system.open_input_file(f"{root}/{name}") as file:
                shard = Shard(file)
                keys, count = shard.keys(), shard.counts().astype(np.int64)
                begin = np.cumsum(count) - count
                # Each key's way through the hash must lead to the first row that has it.
                slot = shard.slots()[shard.hash.slots(keys)]
                leads = np.searchsorted(keys, keys)
                if (slot["fingerprint"] != fingerprint(keys)).any() or (slot["row"] != leads).any() or (slot["first"] != begin[leads]).any():
                    raise ValueError(f"damaged token shard {name}")
                crc = [zlib.crc32(shard.ids(b, n).astype("<u4").tobytes()) for b, n in zip(begin.tolist(), count.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(begin + base), pa.array(count), pa.array(crc, pa.int64())], names=["key", "start", "n_tokens", "ids_crc32"])


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every stored document, read from the shard files.

    start: ids of all documents before it. The running total is over the manifest, a row for each shard.
    """
    order = Window.orderBy("first_key", "last_key", "name").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.select("name", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("base"))
    # Manifest rows are tiny, what they stand for is not: a number that is given is not reduced at run time.
    n_tasks = max(1, min(manifest.count(), MOST_READERS))
    return based.repartition(n_tasks, "name").mapInArrow(partial(_read, folder=folder), "key long, start long, n_tokens long, ids_crc32 long")


def lookup(manifest: DataFrame, folder: str, keys: list[int]) -> dict[int, np.ndarray]:
    """The ids of a few documents by key: the manifest names the shard, its hash the place."""
    out = {}
    for key in keys:
        for row in manifest.where((F.col("first_key") <= key) & (F.col("last_key") >= key)).orderBy("first_key", "last_key", "name").collect():
            system, root = pa.fs.FileSystem.from_uri(folder)
            with system.open_input_file(f"{root}/{row['name']}") as file:
                if key not in out and (ids := Shard(file).get(key)) is not None:
                    out[key] = ids
    return out
