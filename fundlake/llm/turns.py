"""Repair of conversation structure by Hirschberg's divide and conquer.

A conversation in order should have the role initials `(s?(ua)+)?`: nothing, or an optional system row and then
user and assistant in turn. Four states describe what has been put out so far: nothing, the system row, a user
row, an assistant row. Each row is kept (0), given the role user or assistant (1) or deleted (2; blank and
repeated rows must be), an empty row of either role may be inserted anywhere (5), and a truncated row that stays
costs 5 more. Of the cheapest edits those with the ASCII-least initials (D, I, K, R) are taken.

The edits of a piece of a conversation between two known states: forward costs of the first half and backward
costs of the second, four numbers each, meet in the middle; the best crossing state is kept and both halves are
solved alone. Beside each cost stands the rank of its least string among those of the other states. Every string of a
half ends with the edit of the half's last row, so none is a prefix of another and (cost, rank before, rank
behind) finds the least of the cheapest crossings. Nothing but these vectors and the crossings is held.

Spark does it in three steps. (1) Rows, without their texts, are counted by (conversation, turn, digest), range
sorted and cut into pieces of at most ``piece_rows`` rows, whatever conversation holds them: neither a long conversation
nor many copies of a row come to one task. (2) A conversation of several pieces is one problem whose rows are the
pieces, each a 4 x 4 table of costs and ranks; its crossings give the states between which each piece is solved, all in
parallel. (3) Edits and texts meet in one sorted stream by conversation, which digests the repaired rows as
they pass. A digest and an audit of one conversation are one row of the result, so this stream is one task per
conversation; it holds the edits (a byte a row) and one batch of texts.

Defined cases: a null role or text counts as one space; null turns come first; rows of one turn go by role, text
(their first 32 and 64 characters, then a digest of both); a null conv_id is a conversation like others; equal
rows are repeats of one another; other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fundlake.llm.tables import stored

PIECE_ROWS = 4096
BLANK = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"
RETURNED = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_NONE = 1 << 60
_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
#: What follows a user row is an assistant row; everywhere else a user row comes next.
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
_MUST_GO = 8


def _inserts(state: int) -> dict[int, int]:
    """States reached by insertions alone, and how many they take."""
    reached, n = {}, 0
    while state not in reached:
        reached[state] = n
        state, n = _NEXT[state], n + 1
    return reached


def _step(code: int) -> tuple[list, list]:
    """Cost and edits from each state to each for one row: code is 2 * initial (s, u, a, other) + truncated, or 8."""
    cost, edits = [[_NONE] * 4 for _ in range(4)], [[""] * 4 for _ in range(4)]
    initial, late = divmod(code, 2)
    for before in range(4):
        for at, n in _inserts(before).items():
            ways = [(2, "D", at)]
            if code != _MUST_GO:
                ways.append((1 + 5 * late, "R", _NEXT[at]))
                if initial + 1 == (_SYSTEM if initial == 0 else _NEXT[at]) and (initial > 0 or at == _NOTHING):
                    ways.append((5 * late, "K", initial + 1))
            for price, edit, after in ways:
                offer = (5 * n + price, "I" * n + edit)
                if offer < (cost[before][after], edits[before][after] or "~"):
                    cost[before][after], edits[before][after] = offer
    return cost, edits


def _end() -> tuple[list, list]:
    """Insertions that reach an accepting state; it is called state 0."""
    cost, edits = [[_NONE] * 4 for _ in range(4)], [[""] * 4 for _ in range(4)]
    for before in range(4):
        n = min(n for at, n in _inserts(before).items() if at in (_NOTHING, _ASSISTANT))
        cost[before][0], edits[before][0] = 5 * n, "I" * n
    return cost, edits


_STEPS = [_step(code) for code in range(_MUST_GO + 1)]
_END = _end()


def _forward(steps: list, entries: list[int]) -> tuple[list, list]:
    """cost[e][t] and rank[e][t] of the best way from entry e to state t over all steps, ranks over all of them."""
    cost = [[0 if s == e else _NONE for s in range(4)] for e in entries]
    rank = [[0] * 4 for _ in entries]
    for price, edits in steps:
        best: list[list] = [[None] * 4 for _ in entries]
        for e in range(len(entries)):
            for s in range(4):
                if cost[e][s] < _NONE:
                    for t in range(4):
                        if price[s][t] < _NONE:
                            way = (cost[e][s] + price[s][t], rank[e][s], edits[s][t])
                            if best[e][t] is None or way < best[e][t]:
                                best[e][t] = way
        order = {way: n for n, way in enumerate(sorted({w[1:] for row in best for w in row if w}))}
        cost = [[w[0] if w else _NONE for w in row] for row in best]
        rank = [[order[w[1:]] if w else 0 for w in row] for row in best]
    return cost, rank


def _backward(steps: list, leave: int) -> tuple[list, list]:
    """cost[s] and rank[s] of the best way from state s to ``leave`` over all steps."""
    cost, rank = [0 if s == leave else _NONE for s in range(4)], [0] * 4
    for price, edits in reversed(steps):
        best = [min(((price[s][t] + cost[t], edits[s][t], rank[t]) for t in range(4) if price[s][t] < _NONE and cost[t] < _NONE), default=None)
                for s in range(4)]
        order = {way: n for n, way in enumerate(sorted({w[1:] for w in best if w}))}
        cost = [w[0] if w else _NONE for w in best]
        rank = [order[w[1:]] if w else 0 for w in best]
    return cost, rank


def crossings(steps: list, entry: int, leave: int) -> list[int]:
    """The state after each step on the least of the cheapest ways from ``entry`` to ``leave``."""
    after = [leave] * len(steps)
    open_parts = [(0, len(steps), entry, leave)]
    while open_parts:
        lo, hi, a, b = open_parts.pop()
        if hi - lo < 2:
            continue
        mid = (lo + hi) // 2
        cost, rank = _forward(steps[lo:mid], [a])
        more, behind = _backward(steps[mid:hi], b)
        after[mid - 1] = min((cost[0][s] + more[s], rank[0][s], behind[s], s) for s in range(4))[-1]
        open_parts += [(lo, mid, a, after[mid - 1]), (mid, hi, after[mid - 1], b)]
    return after


def edits_of(codes: bytes, entry: int = 0, leave: int | None = None) -> tuple[int, str]:
    """Cost and edits of a piece; ``leave`` None: it is the last one of its conversation."""
    return _solved(codes, entry, leave) if len(codes) <= 16 else _solve(codes, entry, leave)


def _solve(codes: bytes, entry: int, leave: int | None) -> tuple[int, str]:
    steps = [_STEPS[c] for c in codes] + ([_END] if leave is None else [])
    after = crossings(steps, entry, 0 if leave is None else leave)
    ways = list(zip(steps, [entry, *after], after))
    return sum(price[s][t] for (price, _), s, t in ways), "".join(edits[s][t] for (_, edits), s, t in ways)


_solved = lru_cache(1 << 14)(_solve)


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def _keyed(rows: DataFrame) -> DataFrame:
    """Role and text without nulls, and the columns that order the rows of a conversation."""
    filled = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                         F.coalesce("text", F.lit(" ")).alias("text"))
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256)
    return filled.withColumns({"known": F.col("turn").isNotNull(), "at": F.coalesce("turn", F.lit(0)),
                               "head": F.concat_ws("\0", F.substring("role", 1, 32), F.substring("text", 1, 64)), "digest": digest})


_ORDER = ("known", "at", "head", "digest")


def _facts(keyed: DataFrame) -> DataFrame:
    """One row per different row of a conversation: its code, its copies and what is counted of them."""
    plain = keyed.select("conv_id", *_ORDER, _initial(F.col("role")).alias("initial"), (~F.col("text").rlike(BLANK)).alias("blank"),
                         (~F.col("text").rlike(ENDED)).alias("late"))
    different = plain.groupBy("conv_id", *_ORDER).agg(
        F.count("*").alias("n"), F.first("initial").alias("initial"), F.first("blank").alias("blank"), F.first("late").alias("late"))
    moment = F.struct("known", "at")
    earliest = different.groupBy(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest")).agg(F.min(moment).alias("_first"))
    joined = different.join(earliest, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest")))
    again = moment > F.col("_first")
    lives = ~F.col("blank") & ~again
    return joined.select(
        "conv_id", *_ORDER, "n",
        F.when(lives, 2 * F.col("initial") + F.col("late").cast("int")).otherwise(_MUST_GO).alias("code"),
        F.when(F.col("blank"), F.col("n")).otherwise(0).alias("blank"),
        F.when(F.col("blank"), 0).when(again, F.col("n")).otherwise(F.col("n") - 1).alias("duplicate"),
        (lives & F.col("late")).cast("long").alias("truncated"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _cut(batches: Iterator[pa.RecordBatch], limit: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Sorted rows as pieces: (conv_id, slice, no, codes, blank, duplicate, truncated)."""
    task, number, done = TaskContext.get().partitionId(), 0, []
    for conv, rows in groupby(_rows(batches), key=lambda row: row[0]):
        codes, counts = bytearray(), [0, 0, 0]
        for _, n, code, *found in rows:
            counts = [a + b for a, b in zip(counts, found)]
            codes.append(code)
            n -= 1
            while n or len(codes) >= limit:
                more = min(n, max(limit - len(codes), 0))
                codes += bytes([_MUST_GO]) * more
                n -= more
                if len(codes) >= limit:
                    done.append((conv, task, number, bytes(codes), *counts))
                    number, codes, counts = number + 1, bytearray(), [0, 0, 0]
                    if len(done) >= 256:
                        yield _batch(done, schema)
                        done = []
        if codes:
            done.append((conv, task, number, bytes(codes), *counts))
            number += 1
        if len(done) >= 2048:
            yield _batch(done, schema)
            done = []
    yield _batch(done, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _tabled(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Each piece as 16 costs and 16 ranks."""
    for batch in batches:
        done = []
        for conv, task, number, codes in _rows([batch]):
            cost, rank = _forward([_STEPS[c] for c in codes], list(range(4)))
            done.append((conv, task, number, sum(cost, []), sum(rank, [])))
        yield _batch(done, schema)


def _crossed(table: pa.Table) -> pa.Table:
    """The states between the pieces of one conversation."""
    pieces = sorted(_rows(table.to_batches()), key=lambda p: p[1:3])
    square = lambda flat: [flat[4 * s : 4 * s + 4] for s in range(4)]
    after = crossings([(square(p[3]), square(p[4])) for p in pieces] + [_END], _NOTHING, 0)[:-1]
    last = len(pieces) - 1
    return pa.table({"slice": pa.array([p[1] for p in pieces], pa.int32()), "no": pa.array([p[2] for p in pieces], pa.int32()),
                     "entry": pa.array([_NOTHING, *after[:-1]], pa.int32()),
                     "leave": pa.array([None if i == last else s for i, s in enumerate(after)], pa.int32())})


def _edited(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = []
        for conv, task, number, codes, blank, duplicate, truncated, entry, leave in _rows([batch]):
            cost, edits = edits_of(codes, entry or 0, leave)
            done.append((conv, task, number, edits, cost, blank, duplicate, truncated))
        yield _batch(done, schema)


def _stream(rows: DataFrame, piece_rows: int) -> DataFrame:
    """Per conversation its pieces in order (kind 0), then its rows with their texts (kind 1), one task each."""
    keyed = _keyed(rows)
    conv = keyed.schema["conv_id"].dataType
    order = ["conv_id", *_ORDER]
    sorted_rows = _facts(keyed).repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", F.col("n").cast("long"), F.col("code").cast("int"), *[F.col(c).cast("long") for c in ("blank", "duplicate", "truncated")])
    counts = ", blank BIGINT, duplicate BIGINT, truncated BIGINT"
    place, key = "slice INT, no INT", f"conv_id {conv.simpleString()}"
    arrow_place = [pa.field("conv_id", to_arrow_type(conv)), pa.field("slice", pa.int32()), pa.field("no", pa.int32())]
    arrow_counts = [pa.field(c, pa.int64()) for c in ("blank", "duplicate", "truncated")]
    cut = partial(_cut, limit=piece_rows, schema=pa.schema([*arrow_place, pa.field("codes", pa.binary()), *arrow_counts]))
    pieces = stored(sorted_rows.mapInArrow(cut, f"{key}, {place}, codes BINARY{counts}"), "pieces")

    several = pieces.groupBy(F.col("conv_id").alias("_conv")).agg(F.count("*").alias("_n")).where("_n > 1").select("_conv")
    parts = pieces.select("conv_id", "slice", "no", "codes").join(several, F.col("conv_id").eqNullSafe(F.col("_conv")), "left_semi")
    numbers = pa.list_(pa.int64())
    table = partial(_tabled, schema=pa.schema([*arrow_place, pa.field("cost", numbers), pa.field("rank", numbers)]))
    between = (parts.mapInArrow(table, f"{key}, {place}, cost ARRAY<BIGINT>, rank ARRAY<BIGINT>")
               .groupBy("conv_id").applyInArrow(_crossed, f"{place}, entry INT, leave INT"))

    edited = partial(_edited, schema=pa.schema([*arrow_place, pa.field("edits", pa.string()), pa.field("cost", pa.int64()), *arrow_counts]))
    solved = pieces.join(between, ["slice", "no"], "left").select(
        "conv_id", "slice", "no", "codes", "blank", "duplicate", "truncated", "entry", "leave"
    ).mapInArrow(edited, f"{key}, {place}, edits STRING, cost BIGINT{counts}")
    return solved.withColumn("kind", F.lit(0)).unionByName(keyed.withColumn("kind", F.lit(1)), allowMissingColumns=True)


_STREAMED = ("conv_id", "kind", "edits", "cost", "blank", "duplicate", "truncated", "turn", "role", "text")


def _in_order(stream: DataFrame) -> DataFrame:
    dealt = stream.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "slice", "no", *_ORDER)
    return dealt.select(*_STREAMED)


class _Walk:
    """One conversation of the stream: its repaired rows pass by, its figures are there afterwards."""

    def __init__(self, group: Iterator[tuple]):
        self.group, self.audit = group, ""
        self.figures = dict.fromkeys(RETURNED, 0)

    def __iter__(self) -> Iterator[tuple[str, str]]:
        figures, parts, state, place = self.figures, [], _NOTHING, 0
        first_turn = last_turn = before = None
        turns = 0
        for _, kind, edits, cost, blank, duplicate, truncated, turn, role, text in self.group:
            if kind < 0:
                continue
            if kind == 0:
                parts.append(edits)
                for name, value in (("cost", cost), ("blank", blank), ("duplicate", duplicate), ("truncated", truncated)):
                    figures[name] += value
                continue
            if parts:
                self.audit, parts = "".join(parts), []
            if turn is not None and turn != last_turn:
                first_turn, last_turn, turns = turn if first_turn is None else first_turn, turn, turns + 1
            if before is not None and before + role[:1] not in ("su", "ua", "au"):
                figures["illegal"] += 1
            before = role[:1]
            while self.audit[place] == "I":
                state, place = _NEXT[state], place + 1
                yield _ROLE[state], ""
            edit, place = self.audit[place], place + 1
            if edit == "K":
                state = _SYSTEM if role[:1] == "s" else _NEXT[state]
                yield role, text
            elif edit == "R":
                state = _NEXT[state]
                yield _ROLE[state], text
        for _ in self.audit[place:]:
            state = _NEXT[state]
            yield _ROLE[state], ""
        if first_turn is not None:
            figures["gaps"] = last_turn - first_turn + 1 - turns


def _report(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    done = []
    for conv, group in groupby(_rows(batches), key=lambda row: row[0]):
        walk, digest, between = _Walk(group), hashlib.sha256(), ""
        for role, text in walk:
            digest.update(f"{between}{role}:{text}".encode("utf-8", "surrogatepass"))
            between = "\n"
        done.append((conv, *(walk.figures[name] for name in RETURNED), walk.audit, digest.hexdigest()))
        if len(done) >= 2048:
            yield _batch(done, schema)
            done = []
    yield _batch(done, schema)


def _written(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    done, size = [], 0
    for conv, group in groupby(_rows(batches), key=lambda row: row[0]):
        for position, (role, text) in enumerate(_Walk(group)):
            done.append((conv, position, role, text))
            size += len(text) + 64
            if size >= 1 << 22:
                yield _batch(done, schema)
                done, size = [], 0
    yield _batch(done, schema)


def repair(rows: DataFrame, everyone: DataFrame | None = None, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Per conversation its faults, the cheapest edits (cost, audit) and a digest of the repaired rows.

    ``rows``: conv_id, turn, role, text. ``everyone``: further conv_ids to report, also without rows (zeros,
    empty audit, digest of nothing).
    """
    stream = _stream(rows, piece_rows)
    if everyone is not None:
        stream = stream.unionByName(everyone.select("conv_id").distinct().withColumn("kind", F.lit(-1)), allowMissingColumns=True)
    key = rows.select("conv_id").schema[0].dataType
    schema = pa.schema([("conv_id", to_arrow_type(key)), *((name, pa.int64()) for name in RETURNED), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    figures = ", ".join(f"{name} BIGINT" for name in RETURNED)
    return _in_order(stream).mapInArrow(
        partial(_report, schema=schema), f"conv_id {key.simpleString()}, {figures}, audit STRING, repaired_sha256 STRING")


def repaired(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The rows of the repaired conversations: conv_id, position (from 0), role, text."""
    key = rows.select("conv_id").schema[0].dataType
    schema = pa.schema([("conv_id", to_arrow_type(key)), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    return _in_order(_stream(rows, piece_rows)).mapInArrow(
        partial(_written, schema=schema), f"conv_id {key.simpleString()}, position BIGINT, role STRING, text STRING")
