"""Quality rules by compression bands.

zstandard is run over each whole text and over fixed chunks of CHUNK_BYTES. A text is
rejected if its ratio (bytes in / bytes out) lies outside the band of its length, or if more
than MOST_BAD_CHUNKS of its chunks lie outside the band of their length: repetitive text
compresses too well, random characters and encoded data too badly.

Bands come from the ratios of all documents, and of all chunks, by length class (half an octave, as longer
texts give the compressor more to refer to). With quartiles q25 and q50 of a class, the least ratio is
q25 - SPREADS * (q50 - q25) - SLACK * q25 and the most OVER * q50: quartiles do not move with junk in less than a
quarter of a class. In sf0.1 the lower limit cuts less than 1 % of ordinary text. OVER leaves room for texts with
some repeated lines (up to 1.25 * q50 there; repetitive text starts far above). Quantiles are exact to
1/BINS of the ratio's logarithm; counts by bin are all that leaves the scan. A class with fewer than LEAST_CLASS
members has too few for quantiles: it takes the least ratio of the next shorter class that has enough (BANDS, if
there is none), and the larger of that class's most and BANDS; chunks ask the texts' class first.

Below some 2 KB, hex digits compress as well as ordinary text, below 512 bytes random letters do too: no band of
ratios tells them apart.

``base_failed`` is the plain rule beside it: fewer than 50 words, or more than half of all words
in three-word windows that occur twice.

Defined cases: a null text is an empty one (no words, base_failed); a chunk shorter than
LEAST_BYTES is not judged; repeated rows and ids are judged each on its own.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.llm.text import Block, blocks, ngram_hashes, runs, span_hashes, words

LEVEL = 3
CHUNK_BYTES = 4096
LEAST_BYTES = 256
MOST_BAD_CHUNKS = 0.2
SPREADS, SLACK, OVER = 3.0, 0.01, 1.35
LEAST_CLASS = 40
BINS = 2000
#: From so many bytes on: least and most ratio, where a class has too few members of its own.
BANDS = ((256, 1.02, 3.2), (512, 1.15, 3.5), (1024, 1.30, 4.0), (4096, 1.36, 5.0), (16384, 1.40, 7.0), (65536, 1.40, 9.0))
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _class(n_bytes: int) -> int:
    """Half octaves of the length: exact at powers of two."""
    octave = n_bytes.bit_length() - 1
    return 2 * octave + (n_bytes * n_bytes >= 1 << (2 * octave + 1))


def _fixed(n_bytes: int) -> tuple[float, float]:
    return next((lo, hi) for least, lo, hi in reversed(BANDS) if n_bytes >= least)


class Bands:
    """Least and most ratio by length, of texts and of chunks; from (chunk, class, bin, n) counts."""

    def __init__(self, counts=()):
        by_class: dict[tuple[bool, int], list[tuple[int, int]]] = {}
        for chunk, cls, at, n in counts:
            by_class.setdefault((chunk, cls), []).append((at, n))
        self.known = {key: limits for key, bins in by_class.items() if (limits := self._limits(sorted(bins)))}

    @staticmethod
    def _limits(bins: list[tuple[int, int]]) -> tuple[float, float] | None:
        upto = np.cumsum([n for _, n in bins])
        if upto[-1] < LEAST_CLASS:
            return None
        q25, q50 = (np.exp((bins[int(np.searchsorted(upto, -(-upto[-1] * k // 4)))][0] + 0.5) / BINS) for k in (1, 2))
        return float(q25 - SPREADS * (q50 - q25) - SLACK * q25), float(OVER * q50)

    def of(self, n_bytes: int, chunk: bool) -> tuple[float, float]:
        cls = _class(n_bytes)
        for kind in (True, False) if chunk else (False,):
            if (kind, cls) in self.known:
                return self.known[kind, cls]
        lo, hi = _fixed(n_bytes)
        shorter = max((c for kind, c in self.known if not kind and c < cls), default=None)
        return (lo, hi) if shorter is None else (self.known[False, shorter][0], max(hi, self.known[False, shorter][1]))


def _repeats(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each entry: whether its owner has it twice, and whether it stood before."""
    order = np.lexsort((np.arange(len(hashes)), hashes, owner))
    same = np.zeros(len(hashes) + 1, bool)
    same[1:-1] = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice, before = np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
    twice[order], before[order] = same[:-1] | same[1:], same[:-1]
    return twice, before


def word_statistics(block: Block) -> dict[str, np.ndarray]:
    """The five counts of each text of a block."""
    n, data = len(block), block.data
    spans = words(block)
    inside = np.zeros(len(data) + 1, np.int32)
    inside[spans.start] += 1
    inside[spans.end] -= 1
    letters = (np.cumsum(inside[:-1]) > 0) & ((data & 0xC0) != 0x80)
    total = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[block.offsets])

    grams, at = ngram_hashes(span_hashes(data, spans.start, spans.end), spans.first, 3)
    twice, _ = _repeats(grams, np.searchsorted(spans.first, at, side="right") - 1)
    covered = np.zeros(len(spans.start), bool)
    for k in range(3):
        covered[at[twice] + k] = True

    lines = runs(data != 0x0A, block.offsets)
    wordy = np.searchsorted(spans.start, lines.end) > np.searchsorted(spans.start, lines.start)
    start, end = lines.start[wordy], lines.end[wordy]
    _, before = _repeats(span_hashes(data, start, end), block.of(start))
    return {
        "n_words": np.diff(spans.first),
        "word_chars": total(letters),
        "n_symbols": total(_SYMBOL[data]),
        "n_dup_lines": np.bincount(block.of(start)[before], minlength=n),
        "n_repeat_words": np.diff(np.concatenate(([0], np.cumsum(covered)))[spans.first]),
    }


def _ratios(press: zstandard.ZstdCompressor, text: bytes) -> tuple[float, list[tuple[int, float]]]:
    """The ratio of a text, and length and ratio of each of its chunks that is judged."""
    chunks = [text[at : at + CHUNK_BYTES] for at in range(0, len(text), CHUNK_BYTES)] if len(text) > CHUNK_BYTES else []
    return len(text) / len(press.compress(text)), [(len(c), len(c) / len(press.compress(c))) for c in chunks if len(c) >= LEAST_BYTES]


def _press() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's texts and chunks by length class and bin of the ratio."""
    press, counts = _press(), Counter()
    for batch in batches:
        for block in blocks(batch["text"]):
            for i in np.flatnonzero(np.diff(block.offsets) >= LEAST_BYTES):
                text = block.bytes(i)
                ratio, chunks = _ratios(press, text)
                counts[False, _class(len(text)), int(np.floor(np.log(ratio) * BINS))] += 1
                for n, r in chunks:
                    counts[True, _class(n), int(np.floor(np.log(r) * BINS))] += 1
    if counts:
        columns = [pa.array(c) for c in zip(*counts)]
        yield pa.RecordBatch.from_arrays([*columns[:1], *(c.cast(pa.int64()) for c in columns[1:]), pa.array(counts.values(), pa.int64())], names=["chunk", "class", "bin", "n"])


def learn(docs: DataFrame) -> Bands:
    """Bands from all texts; a few thousand counts at most for each length class reach the driver."""
    counts = docs.select("text").mapInArrow(_survey, "chunk boolean, class long, bin long, n long")
    return Bands(tuple(r) for r in counts.groupBy("chunk", "class", "bin").agg(F.sum("n").alias("n")).collect())


def _judge(batches: Iterator[pa.RecordBatch], bands: Bands) -> Iterator[pa.RecordBatch]:
    press = _press()
    for batch in batches:
        for block in blocks(batch["text"]):
            ratios, bad = np.full(len(block), np.nan), np.zeros(len(block))
            verdict = np.ones(len(block), bool)
            for i in range(len(block)):
                text = block.bytes(i)
                if len(text) < LEAST_BYTES:
                    continue
                ratios[i], chunks = _ratios(press, text)
                for n, r in chunks:
                    lo, hi = bands.of(n, True)
                    bad[i] += (not lo <= r <= hi) / len(chunks)
                lo, hi = bands.of(len(text), False)
                verdict[i] = lo <= ratios[i] <= hi and bad[i] <= MOST_BAD_CHUNKS
            counts = word_statistics(block)
            columns = [batch["doc_id"].slice(block.lo, len(block)), *(pa.array(v.astype(np.int64)) for v in counts.values()),
                       pa.array(ratios, from_pandas=True), pa.array(bad), pa.array(verdict)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *counts, "ratio", "bad_chunks", "in_band"])


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: counts, ratio (null below LEAST_BYTES), share of bad chunks, verdicts by the bands of ``docs``."""
    counts = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    kind = docs.schema["doc_id"].dataType.simpleString()
    judged = docs.select("doc_id", "text").mapInArrow(partial(_judge, bands=learn(docs)), f"doc_id {kind}, {counts}, ratio double, bad_chunks double, in_band boolean")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & F.col("in_band"))
