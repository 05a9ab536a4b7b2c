"""Language identification by cross-parsing entropy.

For every language a suffix automaton is built of a bounded sample of labelled text. A text is parsed
greedily against it: each phrase is the longest match, and the symbol that breaks a match starts
the next one. The language with the fewest phrases per symbol wins.

Texts are parsed in pieces of PIECE symbols, all pieces of a block in lockstep: one array
operation moves every piece by one symbol. A piece ends a phrase, for all languages alike.
Symbols are lower-cased letters; any run of other characters is one separator.

Bounds: at most SAMPLE_TEXTS distinct texts a language, of each its first SAMPLE_PREFIX characters
(training rows only), TOTAL_SYMBOLS symbols for all languages together. That also bounds an
automaton's table in a worker. Whole texts are parsed, in one pass without a shuffle.

Defined cases: null texts and texts without a letter are ``und`` with score 0; so is every text if nothing
was learned. Equal phrase counts go to the alphabetically first language.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlake.llm.text import blocks

PIECE = 200
SAMPLE_TEXTS = 64
SAMPLE_PREFIX = 4000
TOTAL_SYMBOLS = 160_000
MOST_LETTERS = 250
UNDETERMINED = "und"


@lru_cache(1)
def _folding() -> tuple[np.ndarray, np.ndarray]:
    """Of each code point: the lower-case letter it counts as (0: no letter), up to U+FFFF one by one."""
    fold = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if 0xD800 <= c < 0xE000:
            continue
        if (ch := chr(c)).isalpha():
            low = ch.lower()
            fold[c] = ord(low) if len(low) == 1 else c
    return fold, fold > 0


def _letters(text: str) -> np.ndarray:
    """Folded letters of a text, runs of other characters as one 0."""
    fold, _ = _folding()
    symbols = fold[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    keep = symbols > 0
    keep[1:] |= keep[:-1].copy()  # a separator after a letter stays
    return symbols[keep]


def _automaton(symbols: np.ndarray, width: int) -> np.ndarray:
    """The suffix automaton's transitions, row by state; 0 where there is none (state 0 is the root)."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols.tolist():
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p != -1:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    table = np.zeros((len(moves), width), np.int32)
    for state, row in enumerate(moves):
        for c, to in row.items():
            table[state, c] = to
    return table.ravel()


@lru_cache(2)
def _model(samples: tuple[tuple[str, str], ...]) -> tuple[np.ndarray, int, list[np.ndarray]]:
    """Symbol numbers by folded code point, their count, and an automaton a language. Once a worker."""
    texts = [_letters(t) for _, t in samples]
    points, counts = np.unique(np.concatenate(texts), return_counts=True)
    letters = points[points > 0][np.argsort(-counts[points > 0], kind="stable")][:MOST_LETTERS]
    number = np.full(0x110000, len(letters) + 1, np.uint8)  # letters never seen: no transitions
    number[letters] = np.arange(1, len(letters) + 1)
    number[0] = 0
    width = len(letters) + 2
    return number, width, [_automaton(number[t], width) for t in texts]


def _phrases(pieces: np.ndarray, lengths: np.ndarray, width: int, table: np.ndarray) -> np.ndarray:
    """Phrases of each piece; pieces are columns, longest first."""
    state = np.zeros(len(lengths), np.int64)
    count = (lengths > 0).astype(np.int64)
    for t in range(len(pieces)):
        n = int(np.searchsorted(-lengths, -t))
        if not n:
            break
        symbol = pieces[t, :n]
        to = table[state[:n] * width + symbol]
        if t:
            # No way on, or the symbol before was unknown to the language and a phrase by itself.
            broken = np.flatnonzero((to == 0) | (state[:n] == 0))
            to[broken] = table[symbol[broken]]
            count[broken] += 1
        state[:n] = to
    return count


def _predict(batches: Iterator[pa.RecordBatch], samples) -> Iterator[pa.RecordBatch]:
    names = [lang for lang, _ in samples.value]
    fold, is_letter = _folding()
    number, width, tables = _model(samples.value)
    for batch in batches:
        for block in blocks(batch["text"]):
            n = len(block)
            points = np.frombuffer(block.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
            chars = np.concatenate(([0], np.cumsum((block.data & 0xC0) != 0x80)))[block.offsets]
            folded = fold[points]
            letter = folded > 0
            keep = letter.copy()
            keep[1:] |= letter[:-1]
            inner = chars[1:-1]
            inner = inner[(inner > 0) & (inner < len(points))]
            keep[inner] = letter[inner]  # no separator is carried over from the text before
            kept = np.concatenate(([0], np.cumsum(keep)))[chars]
            symbols = number[folded[keep]]
            size = np.diff(kept)
            n_pieces = -(-size // PIECE)
            of = np.repeat(np.arange(n), n_pieces)
            at = kept[:-1][of] + PIECE * (np.arange(len(of)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces))
            length = np.minimum(PIECE, kept[1:][of] - at)
            order = np.argsort(-length, kind="stable")
            padded = np.concatenate((symbols, np.zeros(PIECE, np.uint8)))
            pieces = padded[at[order] + np.arange(PIECE)[:, None]] if len(of) else np.zeros((PIECE, 0), np.uint8)
            counts = np.stack([np.bincount(of[order], weights=_phrases(pieces, length[order], width, t), minlength=n) for t in tables])
            best = counts.argmin(0)
            ranked = np.sort(counts, 0)
            some = np.concatenate(([0], np.cumsum(letter)))[chars]
            some = np.diff(some) > 0
            if len(names) > 1:
                sure = 1 - ranked[0] / np.maximum(ranked[1], 1)
            else:
                sure = np.ones(n)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].slice(block.lo, n), pa.array([names[b] if s else UNDETERMINED for b, s in zip(best, some)], pa.string()),
                 pa.array(np.where(some, sure, 0.0)), pa.array(np.where(size > 0, ranked[0] / np.maximum(size, 1), 0.0))],
                names=["doc_id", "lang_pred", "score", "phrases_per_symbol"])


def learn(labelled: DataFrame) -> tuple[tuple[str, str], ...]:
    """(language, sample) pairs of (text, lang) rows. The vocabulary of languages must fit the driver."""
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    hashed = usable.select("lang", "text", F.xxhash64("text").alias("hash"))
    # Copies count once, however many: only distinct hashes are ranked. row_number() <= bound is cut in each
    # task before the exchange, so no language gathers its rows.
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash")).alias("n")
    chosen = hashed.select("lang", "hash").distinct().select("lang", "hash", rank).where(F.col("n") <= SAMPLE_TEXTS).select("lang", "hash")
    # At most SAMPLE_TEXTS rows a language are broadcast; copies of a chosen text meet map-side.
    first = hashed.join(F.broadcast(chosen), ["lang", "hash"]).groupBy("lang", "hash").agg(F.min(F.substring("text", 1, SAMPLE_PREFIX)).alias("part"))
    parts: dict[str, list[str]] = {}
    for lang, _, part in sorted(first.collect()):
        parts.setdefault(lang, []).append(part)
    share = TOTAL_SYMBOLS // max(1, len(parts))
    return tuple((lang, "\n".join(dict.fromkeys(texts))[:share]) for lang, texts in sorted(parts.items()))


def identify(docs: DataFrame, samples: tuple[tuple[str, str], ...]) -> DataFrame:
    """One row per document: doc_id, lang_pred, score (0 to 1), phrases_per_symbol."""
    if not samples:
        return docs.select("doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("phrases_per_symbol"))
    shared = docs.sparkSession.sparkContext.broadcast(samples)  # TOTAL_SYMBOLS characters at most
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(partial(_predict, samples=shared), f"doc_id {kind}, lang_pred string, score double, phrases_per_symbol double")
