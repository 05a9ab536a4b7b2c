"""Sharding by a k-d tree over metadata. DataFrame and SQL functions only.

Rows of equal text form one group: a point whose coordinates are the group's metadata and whose
weight is its bytes. A node that has to become several shards is split at the weighted
median (or the weighted fraction its shard counts ask for) along its widest dimension: the one whose
quartiles lie furthest apart relative to the whole table. All nodes of a level are split together.

A split point is found by refining weighted histograms: each round is one aggregate by
(node, dimension, bin), BINS rows at most for each pair, and narrows the interval BINS times,
until the bin holds too little to matter or is a single value. Splits and intervals are small tables joined to
the points, so plans do not grow with the number of shards. Ties in a dimension are
ordered by the group's hash, so a node of equal points can be split as well.

Groups stay whole. If a group is so heavy that the widest dimension's best cut misses its
target by more than TOLERANCE of a shard, the dimension with the nearest cut is taken. Only a
group over MOST_OF_SHARD of a shard's target (which no cut can place) is first divided by a hash of doc_id into
pieces, PIECES for each shard that it fills, each a point of its own: law `bytes` cannot hold otherwise.

Slots number a shard's rows from 0 without gaps: rows are counted by (shard, hash bucket), the
counts are added up, and a window numbers the rows of one bucket only. The number of buckets
follows the row count.

Defined cases: a null text weighs one byte and is a group of its own kind; null metadata are a value
below all others; repeated rows are copies of a group; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundlake.llm.tables import stored

BINS = 1024
TOLERANCE = 0.01
MOST_OF_SHARD = 0.5
PIECES = 24
BUCKET_ROWS = 2000
FILE_ROWS = 20_000
#: Keys are (value scaled to 20 bits, 42 bits of hash).
VALUE_BITS, TIE_BITS = 20, 42
_SPAN = 1 << (VALUE_BITS + TIE_BITS)


def size_of(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def metadata(docs: DataFrame) -> dict[str, Column]:
    """The default dimensions, each a double; text columns count by the hash of their value."""
    def named(column: str) -> Column:
        return F.coalesce(F.pmod(F.xxhash64(column), F.lit(1 << 20)).cast("double"), F.lit(-1.0)) if column in docs.columns else F.lit(0.0)

    return {"bytes": F.log2(size_of().cast("double")), "lang": named("lang"), "source": named("source"),
            "ascii": F.coalesce(F.octet_length("text") / F.greatest(F.char_length("text"), F.lit(1)), F.lit(0.0)).cast("double")}


def _identity() -> list[Column]:
    return [F.xxhash64("text").alias("_kd_g1"), F.xxhash64(F.lit(17), "text").alias("_kd_g2"), size_of().alias("_kd_g3")]


_KEY = ["_kd_g1", "_kd_g2", "_kd_g3"]


def _values(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {', '.join('(' + ', '.join(f'{x}L' for x in row) + ')' for row in rows)} AS t({columns})")


def assign(docs: DataFrame, n_shards: int | None = None, target_bytes: int | None = None, dimensions: dict[str, Column] | None = None) -> tuple[DataFrame, int]:
    """``docs`` with _kd_size (bytes) and _kd_shard (from 0), and the number of shards.

    Give the number of shards, or the bytes that none should much exceed.
    """
    dimensions = dimensions or metadata(docs)
    d = [f"_kd_d{k}" for k in range(len(dimensions))]
    piece = F.xxhash64("doc_id") if "doc_id" in docs.columns else F.lit(0).cast("long")
    rows = docs.select(*docs.columns, *(column.alias(name) for name, column in zip(d, dimensions.values())), *_identity(), piece.alias("_kd_own_piece"))
    # Narrow tables that are read many times come in few files.
    files = max(4, docs.count() // FILE_ROWS)
    groups = stored(rows.groupBy(*_KEY).agg(F.sum("_kd_g3").alias("_w"), *(F.min(x).alias(x) for x in d)).coalesce(files), "groups")
    weight, *ranges = groups.agg(F.sum("_w"), *(f(x) for x in d for f in (F.min, F.max))).first()
    weight = weight or 0
    if n_shards is None:
        n_shards = max(1, math.ceil(weight / max(1, target_bytes or 1)))
    heavy = groups.where(F.col("_w") > MOST_OF_SHARD * weight / n_shards)  # fewer than 2 * n_shards groups
    n_pieces = F.ceil(F.col("_w") * (PIECES * n_shards / max(weight, 1))).cast("long")
    marked = rows.drop(*d).join(heavy.select(*_KEY, n_pieces.alias("_kd_cut")), _KEY, "left")
    marked = marked.withColumn("_kd_piece", F.when(F.col("_kd_cut").isNotNull(), F.pmod("_kd_own_piece", "_kd_cut")).otherwise(F.lit(-1)).cast("long")).drop("_kd_cut", "_kd_own_piece")
    pieces = marked.where("_kd_piece >= 0").groupBy(*_KEY, "_kd_piece").agg(F.sum("_kd_g3").alias("_w"))
    points = groups.join(heavy.select(*_KEY), _KEY, "left_anti").select(*_KEY, F.lit(-1).cast("long").alias("_kd_piece"), "_w", *d).union(
        pieces.join(groups.select(*_KEY, *d), _KEY).select(*_KEY, "_kd_piece", "_w", *d))
    tie = F.shiftrightunsigned(F.xxhash64("_kd_g1", "_kd_g2", "_kd_piece"), 64 - TIE_BITS)
    keys = []
    for k, x in enumerate(d):
        lo, hi = ranges[2 * k] or 0.0, ranges[2 * k + 1] or 0.0
        level = F.floor((F.col(x) - F.lit(lo)) / F.lit((hi - lo) or 1.0) * F.lit((1 << VALUE_BITS) - 1)).cast("long")
        keys.append(F.shiftleft(level, TIE_BITS) + tie)
    keyed = stored(points.select(*_KEY, "_kd_piece", "_w", F.array(*keys).alias("_keys"), F.lit(0).cast("long").alias("_node")).coalesce(files), "points")
    placed = _grow(keyed, len(d), n_shards).select(*_KEY, "_kd_piece", F.col("_node").cast("int").alias("_kd_shard"))
    named = marked.join(placed, [*_KEY, "_kd_piece"]).select(*docs.columns, F.col("_kd_g3").alias("_kd_size"), "_kd_shard")
    return named, n_shards


def _grow(points: DataFrame, n_dims: int, n_shards: int) -> DataFrame:
    """Points with the shard as _node. A node is known by its first shard; ``open_nodes`` has its number of shards."""
    open_nodes = {0: n_shards} if n_shards > 1 else {}
    while open_nodes:
        inner = points.join(F.broadcast(_values(points.sparkSession, "_node", [(n,) for n in open_nodes])), "_node", "left_semi")
        cuts = _cuts(inner, n_dims, {n: (leaves // 2) / leaves for n, leaves in open_nodes.items()})
        table = _values(points.sparkSession, "_node, _cut_dim, _cut_at, _right", [
            (n, *cuts.get(n, (0, _SPAN // 2)), n + leaves // 2) for n, leaves in open_nodes.items()])
        moved = points.join(F.broadcast(table), "_node", "left")  # one row for each open node
        right = F.get("_keys", F.col("_cut_dim").cast("int")) >= F.col("_cut_at")
        # Stored level by level, so that no plan holds more than one level's joins.
        points = stored(moved.withColumn("_node", F.when(right, F.col("_right")).otherwise(F.col("_node"))).select(points.columns), "nodes")
        halves = [half for n, leaves in open_nodes.items() for half in ((n, leaves // 2), (n + leaves // 2, leaves - leaves // 2))]
        open_nodes = {n: leaves for n, leaves in halves if leaves > 1}
    return points


def _cuts(points: DataFrame, n_dims: int, fractions: dict[int, float]) -> dict[int, tuple[int, int]]:
    """For each node its dimension and the key from which rows go right."""
    entries = points.select("_node", "_w", F.posexplode("_keys").alias("_dim", "_key"))
    state = {(n, d): {"lo": 0, "width": _SPAN // BINS, "below": 0.0} for n in fractions for d in range(n_dims)}
    spread: dict[tuple[int, int], float] = {}
    totals: dict[tuple[int, int], float] = {}
    live = set(state)
    while live:
        table = _values(points.sparkSession, "_node, _dim, _lo, _width", [(n, d, state[n, d]["lo"], state[n, d]["width"]) for n, d in sorted(live)])
        inside = entries.join(F.broadcast(table), ["_node", "_dim"]).withColumn("_bin", F.floor((F.col("_key") - F.col("_lo")) / F.col("_width")).cast("long"))
        bins = inside.where((F.col("_key") >= F.col("_lo")) & (F.col("_bin") < BINS)).groupBy("_node", "_dim", "_bin").agg(F.sum("_w"), F.count("*")).collect()
        found: dict[tuple[int, int], list] = {}
        for n, d, b, w, c in bins:
            found.setdefault((n, d), []).append((b, float(w), c))
        for at in list(live):
            rows = sorted(found.get(at, []))
            if not rows:
                live.discard(at)
                continue
            if at not in totals:
                totals[at] = sum(w for _, w, _ in rows)
                spread[at] = (_mark(rows, 0.75 * totals[at]) - _mark(rows, 0.25 * totals[at])) / BINS
            s, aim = state[at], fractions[at[0]] * totals[at]
            run = s["below"]
            for b, w, c in rows:
                if run + w >= aim or b == rows[-1][0]:
                    break
                run += w
            start, width = s["lo"] + b * s["width"], s["width"]
            if width == 1 or c == 1 or w < 0.001 * totals[at]:
                live.discard(at)
                low = aim - run < run + w - aim and run > 0
                state[at] = {"cut": start if low else start + width, "miss": abs(aim - (run if low else run + w)) / totals[at]}
            else:
                state[at] = {"lo": start, "width": max(1, width // BINS), "below": run}
    out = {}
    for n in fractions:
        dims = [d for d in range(n_dims) if "cut" in state[n, d]]
        if dims:
            good = [d for d in dims if state[n, d]["miss"] <= TOLERANCE / 2]
            d = max(good, key=lambda d: spread[n, d]) if good else min(dims, key=lambda d: state[n, d]["miss"])
            out[n] = (d, state[n, d]["cut"])
    return out


def _mark(rows: list[tuple], weight: float) -> int:
    run = 0.0
    for b, w, _ in rows:
        run += w
        if run >= weight:
            return b
    return rows[-1][0]


def numbered(assigned: DataFrame, n_shards: int) -> DataFrame:
    """``assigned`` with _kd_slot: gapless from 0 in each shard."""
    order = [c for c in ("doc_id", "_kd_size") if c in assigned.columns]
    n_buckets = max(1, assigned.count() // (n_shards * BUCKET_ROWS))
    rows = assigned.withColumn("_kd_bucket", F.pmod(F.xxhash64(*order), F.lit(n_buckets)).cast("int"))
    counts = rows.groupBy("_kd_shard", "_kd_bucket").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_kd_shard").orderBy("_kd_bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_kd_shard", "_kd_bucket", F.coalesce(before, F.lit(0)).alias("_kd_before"))
    position = F.row_number().over(Window.partitionBy("_kd_shard", "_kd_bucket").orderBy(*order))
    return rows.join(offsets, ["_kd_shard", "_kd_bucket"]).withColumn("_kd_slot", F.col("_kd_before") + position - 1).drop("_kd_bucket", "_kd_before")
