"""Near-duplicate documents by MinHash banding, verification and star components.

Universal hash minima of each text's distinct word shingles are cut into bands. Texts
that agree in a band are candidates. A link holds if 100 * intersection >= 75 * union
on the full shingle sets. Components come from alternating large-star and small-star.

Copies and crowded buckets, without pairs of everybody with everybody:

1. Texts with the same shingle set form one class, named by a number. Only classes go on.
2. Each member of a bucket is verified against the bucket's smallest member. That joins
   most of a group of thousands of near copies with a row per member.
3. What is left are buckets that still hold several components. Their members are cut into
   blocks of at most BLOCK_ROWS rows and BLOCK_BYTES of shingles (members of one component
   together); block pairs that share a bucket are compared inside a task: signatures
   first, then full sets, skipping what is already joined. A task emits at most one link a row.
   No pair of a bucket is left out, and no pair becomes a row.

Misses: a pair at exactly 0.75 agrees in none of 64 bands of 4 with probability 3e-11; its
256-value signature agrees in fewer than 163 places with probability about 3e-5. Both
fall fast with rising similarity.

Defined cases: a null or wordless text has an empty set (n_shingles 0), its own component
and is kept; rows that share a doc_id fall into one component, with whatever any of their texts is linked to; a row without doc_id takes
the component of equal texts and is not kept. Input order and other columns play no role.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlake.llm.tables import components, stored
from fundlake.llm.text import blocks, mix, shingle_sets

N_HASHES = 256
BAND_ROWS = 4
LEAST_AGREEING = 163  # of N_HASHES: 0.637
BLOCK_ROWS = 256
BLOCK_BYTES = 4 << 20
SALTS = 64
_RNG = np.random.default_rng(7)
_MULTIPLY = _RNG.integers(1, 1 << 63, N_HASHES, dtype=np.uint64) | np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, N_HASHES, dtype=np.uint64)
_SLICE = 1 << 15


def minima(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The N_HASHES minima of each non-empty set: (sets, N_HASHES) 32-bit values."""
    full = np.flatnonzero(np.diff(first))
    out = np.empty((len(full), N_HASHES), np.uint32)
    starts = first[full]
    lo = 0
    while lo < len(full):
        # As many whole sets as fit the slice: the arrays of one hash stay in the cache.
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + _SLICE)) - 1) if starts[-1] - starts[lo] >= _SLICE else len(full)
        part = grams[starts[lo] : first[full[hi - 1] + 1]]
        for k in range(N_HASHES):
            out[lo:hi, k] = np.minimum.reduceat((part * _MULTIPLY[k] + _ADD[k]) >> np.uint64(32), starts[lo:hi] - starts[lo])
        lo = hi
    return out


def _fingerprints(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """128 bits for each set; zero for an empty one."""
    total = np.zeros((len(first) - 1, 2), np.uint64)
    for k, salt in enumerate((0x1234567, 0x9ABCDEF1)):
        run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(grams ^ np.uint64(salt * 0x10001)), dtype=np.uint64)))
        total[:, k] = run[first[1:]] - run[first[:-1]]
    return total


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), _signed(values))


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bands = N_HASHES // BAND_ROWS
    for batch in batches:
        for block in blocks(batch["text"]):
            grams, first = shingle_sets(block)
            full = np.flatnonzero(np.diff(first))
            values = minima(grams, first)
            keys = np.zeros((len(full), bands), np.uint64)
            for r in range(BAND_ROWS):
                keys = keys * np.uint64(0x9E3779B97F4A7C15) + values[:, r::BAND_ROWS]
            keys = mix(keys + np.arange(bands, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
            prints = _fingerprints(grams, first)
            at = np.zeros(len(block) + 1, np.int64)
            at[1:][full] = bands
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].slice(block.lo, len(block)), pa.array(np.diff(first)), _signed(prints[:, 0]), _signed(prints[:, 1]), _lists(keys.ravel(), np.cumsum(at))],
                names=["doc_id", "n_shingles", "f1", "f2", "bands"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signature and shingles of the texts that have their class's fingerprint (an id may have other texts too)."""
    for batch in batches:
        for block in blocks(batch["text"]):
            grams, first = shingle_sets(block)
            prints = _fingerprints(grams, first).view(np.int64)
            wanted = np.stack([batch[name].slice(block.lo, len(block)).to_numpy() for name in ("f1", "f2")], 1)
            own = (prints == wanted).all(1) & (np.diff(first) > 0)
            low = minima(grams, first).astype(np.uint8)[own[np.flatnonzero(np.diff(first))]]  # the low byte of each minimum
            grams, first = grams[np.repeat(own, np.diff(first))], np.concatenate(([0], np.cumsum(np.diff(first)[own])))
            yield pa.RecordBatch.from_arrays(
                [batch["leader"].slice(block.lo, len(block)).filter(pa.array(own)), pa.array([row.tobytes() for row in low], pa.binary()), _lists(grams, first)],
                names=["leader", "signature", "shingles"],
            )


def _compare(table: pa.Table) -> pa.Table:
    """Links that join components of one block pair: a spanning forest, not all links."""
    ids, were = table["doc_id"].to_numpy(), table["component"].to_numpy()
    left = table["left"].to_numpy(zero_copy_only=False)
    right = table["right"].to_numpy(zero_copy_only=False)
    low = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint8).reshape(len(ids), N_HASHES)
    shingles = table["shingles"].combine_chunks()
    first, grams = shingles.offsets.to_numpy(), shingles.values.to_numpy()
    parent = {c: c for c in were.tolist()}

    def root(c):
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    found: list[tuple[int, int]] = []
    others = np.flatnonzero(right)
    for i in np.flatnonzero(left):
        rest = others[were[others] != were[i]]
        if not len(rest):
            continue
        alike = (low[rest] == low[i]).sum(1)
        for j in rest[alike >= LEAST_AGREEING]:
            a, b = root(were[i]), root(were[j])
            if a == b:
                continue
            x, y = grams[first[i] : first[i + 1]], grams[first[j] : first[j + 1]]
            common = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * common >= 75 * (len(x) + len(y) - common):
                parent[max(a, b)] = min(a, b)
                found.append((ids[i], ids[j]))
    return pa.table({name: pa.array([f[k] for f in found], pa.int64()) for k, name in enumerate("ab")})


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id long, text).

    A class of equal sets has a number of its own (``leader``), as one doc_id may lead several classes.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    described = stored(texts.mapInArrow(_describe, "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>"), "described")
    worded = described.where("n_shingles > 0 and doc_id is not null")
    leaders = worded.groupBy("f1", "f2", "n_shingles").agg(F.min_by("bands", "doc_id").alias("bands"), F.min("doc_id").alias("doc_id"))
    leaders = stored(leaders.withColumn("leader", F.monotonically_increasing_id()), "leaders")
    entries = stored(leaders.select("leader", F.explode("bands").alias("band")), "bands")
    buckets = stored(entries.groupBy("band").agg(F.min("leader").alias("centre"), F.count("*").alias("n")).where("n > 1"), "buckets")
    members = stored(entries.join(buckets, "band").select("band", "leader", "centre"), "members")
    candidates = leaders.join(members.select("leader").distinct(), "leader", "left_semi").select("leader", "doc_id", "f1", "f2")
    kept_texts = texts.join(candidates, "doc_id").withColumn("same", F.xxhash64("text")).dropDuplicates(["leader", "same"]).drop("doc_id", "same")
    sets = stored(kept_texts.select("leader", "f1", "f2", "text").mapInArrow(_sets, "leader long, signature binary, shingles array<long>"), "sets")

    stars = members.where("leader <> centre").select("leader", "centre").distinct()
    sized = F.size(F.array_intersect("x", "y"))
    joined = (
        stars.join(sets.select("leader", F.col("shingles").alias("x")), "leader")
        .join(sets.select(F.col("leader").alias("centre"), F.col("shingles").alias("y")), "centre")
        .where(100 * sized >= 75 * (F.size("x") + F.size("y") - sized))
        .select(F.col("leader").alias("a"), F.col("centre").alias("b"))
    )
    links = stored(joined, "star_links")
    more = stored(_between_components(members, sets, components(links)), "block_links")

    # Classes that share a doc_id are one document.
    number = leaders.select("f1", "f2", F.col("n_shingles").alias("n"), "leader")
    kind = F.struct("f1", "f2", "n_shingles")
    torn = worded.groupBy("doc_id").agg(F.min(kind).alias("lo"), F.max(kind).alias("hi")).where("lo <> hi").select("doc_id")
    of_torn = worded.join(torn, "doc_id", "left_semi").select("doc_id", "f1", "f2", F.col("n_shingles").alias("n")).distinct().join(number, ["f1", "f2", "n"]).select("doc_id", "leader")
    of_torn = stored(of_torn, "torn")
    ties = of_torn.join(of_torn.groupBy("doc_id").agg(F.min("leader").alias("least")), "doc_id").where("leader <> least").select(F.col("leader").alias("a"), F.col("least").alias("b"))

    whole = components(links.union(more).union(ties))
    led = leaders.select("leader", "doc_id").join(whole.select(F.col("node").alias("leader"), F.col("component").alias("joined")), "leader", "left")
    led = led.withColumn("joined", F.coalesce("joined", "leader"))
    smallest = led.groupBy("joined").agg(F.min("doc_id").alias("of_class"))
    named = number.join(led.select("leader", "joined"), "leader").join(smallest, "joined").select("f1", "f2", "n", "of_class")
    rows = described.select("doc_id", "n_shingles", "f1", "f2")
    with_words = rows.where("n_shingles > 0").join(
        named, (described.f1 == named.f1) & (described.f2 == named.f2) & (described.n_shingles == named.n), "left"
    ).select("doc_id", "n_shingles", F.coalesce("of_class", "doc_id").alias("component_id"))
    # A wordless row whose doc_id has words elsewhere goes with them.
    blank = rows.where("n_shingles = 0").select("doc_id", "n_shingles")
    elsewhere = with_words.join(blank.select("doc_id").distinct(), "doc_id", "left_semi").groupBy(F.col("doc_id").alias("id")).agg(F.min("component_id").alias("of_id"))
    wordless = blank.join(elsewhere, blank.doc_id == elsewhere.id, "left").select("doc_id", "n_shingles", F.coalesce("of_id", "doc_id").alias("component_id"))
    return with_words.union(wordless)


def _between_components(members: DataFrame, sets: DataFrame, known: DataFrame) -> DataFrame:
    """Links between different components that share a bucket (a spanning set of them)."""
    named = members.select("band", "leader", "centre").join(known.withColumnRenamed("node", "leader"), "leader", "left")
    named = named.withColumn("component", F.coalesce("component", "leader"))
    open_bands = named.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("band")
    rows = stored(named.join(open_bands, "band"), "open_buckets")
    sizes = sets.select("leader", (F.size("shingles") * 8 + N_HASHES).cast("long").alias("bytes"))
    homes = rows.groupBy("leader", "component").agg(F.min("centre").alias("home")).join(sizes, "leader")
    # A third of all classes may have one home: what is joined to its rows comes SALTS times, and a row asks for one of them.
    salt, salts = F.pmod(F.xxhash64("leader"), F.lit(SALTS)).alias("salt"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    crowd = homes.groupBy("home", "component").agg(F.count("*").alias("n")).where(F.col("n") >= BLOCK_ROWS // 2)
    crowd = crowd.select("home", "component", F.col("component").alias("own_pool"), salts)
    pooled = homes.select("*", salt).join(crowd, ["home", "component", "salt"], "left").withColumn("pool", F.coalesce("own_pool", F.lit(-1)))
    load = pooled.groupBy("home", "pool").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum("bytes") / BLOCK_BYTES)).alias("n_parts")).where("n_parts > 1")
    load = load.select("home", "pool", "n_parts", salts)
    pooled = pooled.join(load, ["home", "pool", "salt"], "left").withColumn("parts", F.coalesce("n_parts", F.lit(1)))
    spread = F.pmod(F.xxhash64("leader", F.lit("part")), "parts")
    # The block's own name; pure is its component where all its members share one.
    placed = stored(
        pooled.select("leader", "component", F.xxhash64("home", "pool", spread).alias("block"),
                                                   F.when(F.col("pool") != -1, F.col("pool")).alias("pure")), "blocks")
    seen = rows.select("band", "leader").join(placed.select("leader", "block", "pure"), "leader").select("band", "block", "pure").distinct()
    other = seen.select("band", F.col("block").alias("block2"), F.col("pure").alias("pure2"))
    pairs = stored(
        seen.join(other, "band").where("block <= block2 and (pure is null or pure2 is null or pure <> pure2)").select("block", "block2").distinct(),
        "block_pairs")
    pair = F.xxhash64("block", "block2").alias("pair")
    same = F.col("block") == F.col("block2")
    sides = pairs.select(pair, "block", F.lit(True).alias("left"), same.alias("right")).union(
        pairs.where("block <> block2").select(pair, F.col("block2").alias("block"), F.lit(False), F.lit(True)))
    inputs = sides.join(placed.select("block", "leader", "component"), "block").join(sets, "leader")
    inputs = inputs.select("pair", F.col("leader").alias("doc_id"), "component", "left", "right", "signature", "shingles")
    return inputs.groupBy("pair").applyInArrow(_compare, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    return classes(docs).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that lead their component, once each.

    Rows that share a doc_id are one document, of which one row remains (the text with the smallest hash). Rows without
    doc_id count as documents behind all others, equal texts as one.
    """
    behind = F.shiftrightunsigned(F.xxhash64("text"), 3) + F.lit(1 << 62)
    named = docs.withColumn("_neardup_row", F.coalesce(F.col("doc_id").cast("long"), behind))
    found = near_duplicates(named.select(F.col("_neardup_row").alias("doc_id"), "text")).where("kept")
    verdict = found.select(F.col("doc_id").alias("_neardup_row")).distinct()
    first = F.row_number().over(Window.partitionBy("_neardup_row").orderBy(F.xxhash64("text")))
    kept = named.join(verdict, "_neardup_row", "left_semi").withColumn("_neardup_place", first).where("_neardup_place = 1")
    return kept.drop("_neardup_row", "_neardup_place")
