"""Personal data, and the words that give it away: information-theoretic sanitisation.

Values of four kinds (email, ip, card, phone) are found by pattern: leftmost, not overlapping within a kind, then tested (an ip's
parts, a card's Luhn sum and number of digits, a phone's number of digits). Every value is a protected entity c with
information content IC(c) = -log2 p(c), p(c) its share of documents.

A term (a run of ASCII letters and digits or other characters above ASCII, A-Z lower-cased, three bytes or more) that stands
near entities may reveal them. The corpus tells how strongly: with n(c, t) documents in which t is
among the ``WINDOW`` terms on either side of c, and n(t) documents that hold t anywhere,

    p(c | t) = (n(c, t) - 1) / (n(t) - 1)         pointwise mutual information PMI(c; t) = log2(p(c | t) / p(c))

One document is left out, as what a term reveals in a document is what all the others tell about it; c and t must have met
amid different words, since copies of one passage say nothing about the two. Where PMI(c; t) is ``GENERALISED`` of IC(c) or more
the term is generalised wherever it stands, where ``REMOVED`` or more it is removed; below ``LEAST_BITS`` bits nothing of
worth is revealed (an address in every hundredth document protects nobody).

Spark: one scan finds entities and their contexts (counts combine before the shuffle), one counts the candidate terms, one
finds spans. The last two know terms by bitmaps of BITMAP_BITS bits, whatever their number; what passes by mistake
is dropped by a join. Rows are named by task and place in a stored table, so repeated ids do not mix.

Defined cases: a null text is an empty one; repeated rows and ids are each reported on their own; other columns are ignored;
an empty table gives no row.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fundlake.llm.tables import discard, stored
from fundlake.llm.text import LOWER, Block, Words, blocks, mix, runs, span_hashes

KINDS = ("email", "ip", "card", "phone", "term")
WINDOW = 8
LEAST_TERM_BYTES = 3
GENERALISED, REMOVED = 0.95, 0.999
LEAST_BITS = 8.0
BITMAP_BITS = 1 << 24
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only start where a row of digits does, and rows of digits are never cut: no quadratic search in long rows.
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class Found(NamedTuple):
    kind: int
    start: int
    end: int
    value: str


def _emails(text: str) -> Iterator[Found]:
    done, at = 0, text.find("@")
    while at >= 0:
        name = len(text[done:at]) - len(text[done:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if name else None
        done = domain.end() if domain else at + 1
        if domain:
            yield Found(0, at - name, done, text[at - name : done].lower())
        at = text.find("@", done)


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[Found]:
    """Values of the four kinds, by start, then kind."""
    found = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            for m in _IP.finditer(text):
                parts = [part.lstrip("0") or "0" for part in m.group().split(".")]
                if all(len(part) <= 3 and int(part) <= 255 for part in parts):
                    found.append(Found(1, m.start(), m.end(), ".".join(parts)))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = _NOT_DIGIT.sub("", m.group())
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append(Found(2, m.start(), m.end(), digits))
        if "+" in text:
            for m in _PHONE.finditer(text):
                digits = _NOT_DIGIT.sub("", m.group())
                if 9 <= len(digits) <= 15:
                    found.append(Found(3, m.start(), m.end(), digits))
    return sorted(found, key=lambda f: (f.start, f.kind))


def _entity(found: Found) -> int:
    return int.from_bytes(hashlib.blake2b(f"{found.kind}:{found.value}".encode(), digest_size=8).digest(), "big", signed=True)


def _terms(block: Block) -> tuple[Words, np.ndarray]:
    """Terms of a block, and their 64-bit hashes."""
    spans = runs(_TERM[block.data], block.offsets)
    long = spans.end - spans.start >= LEAST_TERM_BYTES
    start, end = spans.start[long], spans.end[long]
    return Words(start, end, np.searchsorted(start, block.offsets)), span_hashes(LOWER[block.data], start, end)


def _texts(column: pa.Array) -> list[str]:
    return [text or "" for text in column.to_pylist()]


_MET = pa.schema([("entity", pa.int64()), ("term", pa.int64()), ("context", pa.int64())])


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entity, term, context) of the terms near an entity, once a document; term null: the entity itself, entity null: any entity."""
    for batch in batches:
        found = [(text, spans) for text in _texts(batch.column(0)) if (spans := base_spans(text))]
        for block in blocks(pa.array([text for text, _ in found], pa.string())):
            terms, hashes = _terms(block)
            signed, rows = hashes.view(np.int64), []
            for i in range(len(block)):
                text, spans = found[block.lo + i]
                places = [(f, len(text[: f.start].encode()), len(text[: f.end].encode())) for f in spans]
                mine = np.arange(terms.first[i], terms.first[i + 1])
                start, end = terms.start[mine] - block.offsets[i], terms.end[mine] - block.offsets[i]
                free = np.ones(len(mine), bool)
                for _, lo, hi in places:
                    free &= (end <= lo) | (start >= hi)
                mine, start, end = mine[free], start[free], end[free]
                near: dict[int, tuple[int, set]] = {}
                for f, lo, hi in places:
                    before, behind = np.searchsorted(end, lo, side="right"), np.searchsorted(start, hi)
                    around = signed[mine[max(before - WINDOW, 0) : before]].tolist() + signed[mine[behind : behind + WINDOW]].tolist()
                    context, together = near.setdefault(_entity(f), (hash(tuple(around)), set()))
                    together.update(around)
                for entity, (context, together) in near.items():
                    rows.append((entity, None, context))
                    rows += [(entity, term, context) for term in together]
                rows += [(None, term, 0) for term in set().union(*(together for _, together in near.values()))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ([], [], []))], schema=_MET)


def _bits(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two places on the bitmap."""
    mask = np.uint64(BITMAP_BITS - 1)
    return hashes & mask, (hashes >> np.uint64(32)) & mask


def _bitmap(terms: DataFrame) -> bytes:
    """All terms' bits; at most BITMAP_BITS / 64 rows reach the driver."""
    mask = F.lit(BITMAP_BITS - 1)
    places = terms.select(F.explode(F.array(F.col("term").bitwiseAND(mask), F.shiftrightunsigned("term", 32).bitwiseAND(mask))).alias("bit"))
    words64 = places.select(F.shiftright("bit", 6).alias("at"), F.expr("shiftleft(1L, cast(bit & 63 AS INT))").alias("one"))
    rows = words64.groupBy("at").agg(F.bit_or("one").alias("bits")).toArrow()
    out = np.zeros(BITMAP_BITS // 64, np.int64)
    out[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    return out.tobytes()


def _unpacked(bitmap) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bitmap.value, np.uint8), bitorder="little").view(bool)


def _on(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    one, two = _bits(hashes)
    at = np.flatnonzero(known[one])
    return at[known[two[at]]]


def _counted(batches: Iterator[pa.RecordBatch], bitmap) -> Iterator[pa.RecordBatch]:
    """(term, documents) of the terms on the bitmap, summed over a block."""
    known = _unpacked(bitmap)
    for batch in batches:
        for block in blocks(batch.column(0)):
            terms, hashes = _terms(block)
            at = _on(known, hashes)
            owner = np.searchsorted(terms.first, at, side="right") - 1
            # Once a document: a term and its document in one number, a bijection for each document.
            _, first = np.unique(mix(hashes[at] ^ mix(owner.astype(np.uint64))), return_index=True)
            term, n = np.unique(hashes[at][first], return_counts=True)
            yield pa.RecordBatch.from_pydict({"term": term.view(np.int64), "n": n.astype(np.int64)})


def revealing_terms(docs: DataFrame) -> DataFrame:
    """(term, share): hashes of the terms whose disclosure of some entity reaches GENERALISED of its information."""
    spark, texts = docs.sparkSession, docs.select("text")
    total = docs.count()
    met = texts.mapInArrow(_meetings, "entity long, term long, context long").groupBy("entity", "term").agg(
        F.count("*").alias("n"), (F.min("context") != F.max("context")).alias("contexts_differ"))
    met = stored(met, "met")
    p = F.col("of_entity") / F.lit(float(max(total, 1)))
    given = (F.col("n") - 1) / F.greatest(F.col("of_term") - 1, F.lit(1))
    information = F.log2(F.when(given > 0, given) / p)
    share = information / -F.log2(p)
    reveals = (information >= LEAST_BITS) & (share >= GENERALISED)
    entities = met.where("term IS NULL").select("entity", F.col("n").alias("of_entity")).where(-F.log2(p) >= LEAST_BITS)
    pairs = met.where("entity IS NOT NULL AND term IS NOT NULL AND contexts_differ").select("entity", "term", "n").join(entities, "entity")
    # Documents with the term near any entity are some of all that hold it: what they rule out need not be counted.
    least = met.where("entity IS NULL").select("term", F.col("n").alias("of_term"))
    pairs = stored(pairs.join(least, "term").where(reveals).select("term", "n", "of_entity"), "pairs")
    bitmap = spark.sparkContext.broadcast(_bitmap(pairs.select("term").distinct()))
    holding = texts.mapInArrow(partial(_counted, bitmap=bitmap), "term long, n long").groupBy("term").agg(F.sum("n").alias("of_term"))
    out = stored(pairs.join(holding, "term").where(reveals).groupBy("term").agg(F.max(share).alias("share")), "revealing")
    discard(met)
    discard(pairs)
    return out


def _span_type() -> pa.DataType:
    return pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def _scan(batches: Iterator[pa.RecordBatch], bitmap, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Each row with its base spans, and its terms on the bitmap that do not overlap them."""
    known, task, number = _unpacked(bitmap), TaskContext.get().partitionId(), 0
    for batch in batches:
        texts = _texts(batch.column(1))
        for block in blocks(batch.column(1)):
            n = len(block)
            base = [base_spans(text) for text in texts[block.lo : block.hi]]
            terms, hashes = _terms(block)
            at = _on(known, hashes)
            leads = np.concatenate(([0], np.cumsum((block.data & 0xC0) != 0x80)))
            hits: list[list] = [[] for _ in range(n)]
            owner = np.searchsorted(terms.first, at, side="right") - 1
            start = leads[terms.start[at]] - leads[block.offsets[owner]]
            end = leads[terms.end[at]] - leads[block.offsets[owner]]
            for i, term, lo, hi in zip(owner.tolist(), hashes[at].view(np.int64).tolist(), start.tolist(), end.tolist()):
                if all(hi <= f.start or lo >= f.end for f in base[i]):
                    hits[i].append({"term": term, "start": lo, "end": hi})
            spans = [[{"kind": KINDS[f.kind], "start": f.start, "end": f.end} for f in found] for found in base]
            columns = [pa.array([task] * n, pa.int32()), pa.array(range(number, number + n), pa.int64()), batch.column(0).slice(block.lo, n),
                       pa.array(spans, schema.field("base").type), pa.array(hits, schema.field("hits").type)]
            yield pa.RecordBatch.from_arrays(columns + ([batch.column(1).slice(block.lo, n)] if "text" in schema.names else []), schema=schema)
            number += n


def find(docs: DataFrame, revealing: DataFrame | None = None, with_text: bool = False) -> DataFrame:
    """doc_id, base (the values' spans) and terms (spans of revealing terms with their share), in code points, by start.

    ``revealing``: result of ``revealing_terms``; None: computed from ``docs``. ``with_text`` keeps the text.
    """
    spark, key = docs.sparkSession, docs.schema["doc_id"].dataType
    revealing = revealing_terms(docs) if revealing is None else revealing
    bitmap = spark.sparkContext.broadcast(_bitmap(revealing))
    hit = pa.struct([("term", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
    fields = [("slice", pa.int32()), ("no", pa.int64()), ("doc_id", to_arrow_type(key)), ("base", pa.list_(_span_type())), ("hits", pa.list_(hit))]
    schema = pa.schema(fields + ([("text", pa.string())] if with_text else []))
    rows = stored(docs.select("doc_id", "text").mapInArrow(
        partial(_scan, bitmap=bitmap, schema=schema),
        f"slice INT, no BIGINT, doc_id {key.simpleString()}, base ARRAY<STRUCT<kind: STRING, start: BIGINT, end: BIGINT>>, "
        f"hits ARRAY<STRUCT<term: BIGINT, start: BIGINT, end: BIGINT>>{', text STRING' * with_text}"), "scanned")  # fmt: skip
    sure = rows.select("slice", "no", F.inline("hits")).join(revealing, "term")
    terms = sure.groupBy("slice", "no").agg(F.sort_array(F.collect_list(F.struct("start", "end", "share"))).alias("terms"))
    none = F.array().cast("array<struct<start: bigint, end: bigint, share: double>>")
    return rows.join(terms, ["slice", "no"], "left").select("doc_id", "base", F.coalesce("terms", none).alias("terms"), *(["text"] if with_text else []))


def _general(word: str) -> str:
    return "[NUMBER]" if word.isdigit() else "[NAME]" if word[:1].isupper() else "[WORD]"


def _rewrite(text: str | None, base: list[dict], terms: list[dict]) -> str | None:
    if text is None:
        return None
    edits = [(f["start"], f["end"], f"[{f['kind'].upper()}]") for f in base]
    edits += [(t["start"], t["end"], "" if t["share"] >= REMOVED else _general(text[t["start"] : t["end"]])) for t in terms]
    out, done = [], 0
    for start, end, instead in sorted(edits):
        if end > done:  # values of two kinds may overlap: what is left of the later one goes with the earlier
            out += [text[done:start], instead] if start >= done else []
            done = end
    return "".join([*out, text[done:]])


def _rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("text", "base", "terms")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([_rewrite(*row) for row in zip(*columns)], pa.string())], names=["doc_id", "text"])


def sanitise(docs: DataFrame, revealing: DataFrame | None = None) -> DataFrame:
    """doc_id and text with values replaced by their kinds, revealing terms generalised or removed."""
    found = find(docs, revealing, with_text=True)
    return found.mapInArrow(_rewritten, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text STRING")
