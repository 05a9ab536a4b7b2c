"""Toxicity by compression distance: two zstandard dictionaries, short windows, calibrated thresholds.

Both dictionaries start with the one that zstandard trains on windows of ordinary text. The toxic one
goes on with passages of toxic text. As the dictionaries share tables and content, a window's two compressed lengths
differ only by what toxic passages save. A text is judged by the largest saving of its windows (WINDOW_BYTES long, STEP_BYTES
apart, A-Z lower-cased); a monotone fit turns savings into probabilities, which gives the threshold.

Passages are words of toxic text that chance does not explain. A word counts once a text, with its neighbours there, and
equal neighbours count once, so copies of a text add nothing. Of its n countings x are in toxic text; if the label
did not matter, x would be binomial with the toxic share q of all countings, and its tail is at most exp(-n KL(x/n, q)). Words for which
that times the number of different words is at most ALPHA are taken (of ALPHAS the one that fits texts left out best), so the border follows the size of the sample: a few texts
suffice for a word that hardly ever stands elsewhere, and the expected number of chance words is at most ALPHA at any size. Words are
taken one by one, the strongest first; a text that holds k of those taken counts as 1 / (1 + k) from then on, so a family of
alike texts brings in a word or two, not all it has in common. (Passages chosen by zstandard's own trainer, from toxic windows or
from what ordinary text does not hold of them, gave areas under the curve of 0.55 to 0.9 on held-out texts of sf0.1: the
trainer fills its space with the commonest remains, and windows differ by noise.)

Probabilities are calibrated on savings that were not used: the sample falls into FOLDS by a hash of the text, and a fold is measured
with the passages of the others.

Everything learned comes from a sample of about SAMPLE_ROWS labelled texts (parameter ``rows``),
counted by Spark; at most BASE_WINDOWS windows and PASSAGE_BYTES of words reach the driver. All
documents are scored over whole texts in one pass without a shuffle.

Defined cases: a null or empty text has no window and gets the lowest score; without labels of both
classes every score is 0; repeated rows and ids are scored one by one.
"""

from __future__ import annotations

import logging
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.llm.labelled import sample
from fundlake.llm.tables import stored
from fundlake.llm.text import LOWER, Block, blocks

logger = logging.getLogger(__name__)
SAMPLE_ROWS = 20_000
WINDOW_BYTES, STEP_BYTES = 48, 16
LEVEL = 1
BASE_BYTES, BASE_WINDOWS = 8192, 20_000
PASSAGE_BYTES = 16_384
#: Expected number of words that come in by chance: at most the first; the one of these that predicts folds left out best is used.
ALPHAS = (0.05, 1e-4, 1e-8, 1e-16)
FOLDS = 3
MOST_SAVED = 40


@dataclass(frozen=True)
class Model:
    """Two dictionaries, and the probability of label 1 at each saving from 0 to MOST_SAVED bytes."""

    ordinary: bytes
    toxic: bytes
    probability: tuple[float, ...]


@lru_cache(16)
def _press(content: bytes) -> zstandard.ZstdCompressor:
    kept = zstandard.ZstdCompressionDict(content)
    kept.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=kept, write_content_size=False, write_checksum=False, write_dict_id=False)


def _windows(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offset, length and text of every window of a block."""
    size = np.diff(block.offsets)
    count = np.where(size > 0, 1 + np.maximum(-(-(size - WINDOW_BYTES) // STEP_BYTES), 0), 0)
    of = np.repeat(np.arange(len(block)), count)
    k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = block.offsets[:-1][of] + k * STEP_BYTES
    return at, np.minimum(WINDOW_BYTES, block.offsets[1:][of] - at), of


def _all_savings(block: Block, ordinary: bytes, toxic: tuple[bytes, ...]) -> np.ndarray:
    """Of each text the most bytes that each toxic dictionary saves on a window: (dictionaries, texts)."""
    at, length, of = _windows(block)
    best = np.zeros((len(toxic), len(block)), np.int64)
    if not len(at):
        return best
    data = zstandard.BufferWithSegments(LOWER[block.data].tobytes(), np.stack((at, length), 1).astype(np.uint64).tobytes())
    sizes = []
    for content in (ordinary, *toxic):
        out = _press(content).multi_compress_to_buffer(data)
        sizes.append(np.fromiter((len(out[i]) for i in range(len(out))), np.int64, len(out)))
    for row, size in zip(best, sizes[1:]):
        np.maximum.at(row, of, sizes[0] - size)
    return np.minimum(best, MOST_SAVED)


def savings(block: Block, model: Model) -> np.ndarray:
    """Of each text the most bytes that the toxic dictionary saves on a window."""
    return _all_savings(block, model.ordinary, (model.toxic,))[0]


def _score(batches: Iterator[pa.RecordBatch], model: Model, keep: tuple[str, ...], label: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch["text"]):
            columns = [batch[name].slice(block.lo, len(block)) for name in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(savings(block, model))], names=[*keep, label])


def _measured(batches: Iterator[pa.RecordBatch], ordinary: bytes, toxic: tuple[bytes, ...]) -> Iterator[pa.RecordBatch]:
    """(label, savings by toxic dictionary) of each text."""
    for batch in batches:
        for block in blocks(batch["text"]):
            found = _all_savings(block, ordinary, toxic)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, found.size + 1, len(toxic)), pa.int32()), pa.array(found.T.ravel()))
            yield pa.RecordBatch.from_arrays([batch["label"].slice(block.lo, len(block)), lists], names=["label", "saved"])


def _sampled_windows(batches: Iterator[pa.RecordBatch], share: int) -> Iterator[pa.RecordBatch]:
    """One of ``share`` windows, lower-cased."""
    for batch in batches:
        for block in blocks(batch["text"]):
            at, length, _ = _windows(block)
            lower, pick = LOWER[block.data], np.arange(0, len(at), share)
            yield pa.RecordBatch.from_arrays([pa.array([lower[a : a + n].tobytes() for a, n in zip(at[pick], length[pick])], pa.binary())], names=["window"])


_BARE = b".,!?;:\"'()[]*#$%&|<>-"


def _first_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, fold, text_id, word, context) of each different word of a text, with its neighbours where it stands first."""
    for batch in batches:
        rows: list[tuple] = []
        for label, fold, text_id, text in zip(*(batch[name].to_pylist() for name in ("label", "fold", "text_id", "text"))):
            tokens = LOWER[np.frombuffer(text.encode(), np.uint8)].tobytes().split()
            seen: dict[bytes, int] = {}
            for i, token in enumerate(tokens):
                if (word := token.strip(_BARE)) and word not in seen:
                    seen[word] = i
            for word, i in seen.items():
                before, after = tokens[i - 1] if i else b"", tokens[i + 1] if i + 1 < len(tokens) else b""
                rows.append((label, fold, text_id, word, zlib.crc32(before + b" " + after)))
        columns = list(zip(*rows)) or [()] * 5
        types = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["label", "fold", "text_id", "word", "context"])


def evidence(x: np.ndarray, n: np.ndarray, share: float) -> np.ndarray:
    """Minus the logarithm of a bound on the chance of x or more toxic of n countings; 0 for words no commoner in toxic text."""
    rate = x / np.maximum(n, 1e-12)
    with np.errstate(divide="ignore", invalid="ignore"):
        distance = rate * np.log(rate / share) + np.where(rate < 1, (1 - rate) * np.log((1 - rate) / (1 - share)), 0.0)
    return np.where(rate > share, n * np.nan_to_num(distance, nan=0.0), 0.0)


def _taken(words: np.ndarray, texts: np.ndarray, toxic: np.ndarray, scale: np.ndarray, share: float, least: float, sizes: np.ndarray) -> list[tuple[int, float]]:
    """Word numbers in the order they are taken, each with its strength, from (word, text) entries; ``scale``: countings over texts of a word."""
    if not len(words) or not 0 < share < 1:
        return []
    weight, order, size = np.ones(texts.max() + 1), [], 0
    open_words = np.ones(len(scale), bool)
    while True:
        w = weight[texts]
        x = np.bincount(words, w * toxic, len(scale)) * scale
        n = np.bincount(words, w, len(scale)) * scale
        strength = np.where(open_words, evidence(x, n, share), -1.0)
        best = int(strength.argmax())
        size += int(sizes[best])
        if strength[best] < least or size > PASSAGE_BYTES:
            return order
        order.append((best, float(strength[best])))
        open_words[best] = False
        held = texts[words == best]
        weight[held] = 1 / (1 / weight[held] + 1)


def _passages(rows: DataFrame) -> list[list[list[bytes]]]:
    """Words at each of ALPHAS, for the whole sample, then for the sample without each of its folds."""
    places = stored(rows.mapInArrow(_first_places, "label int, fold int, text_id long, word binary, context long"), "places")
    one = places.groupBy("word", "label", "context").agg(F.bit_or(F.expr("shiftleft(1, fold)")).alias("folds"))
    sides = [(1 << FOLDS) - 1] + [(1 << FOLDS) - 1 - (1 << k) for k in range(FOLDS)]
    there = [F.col("folds").bitwiseAND(F.lit(side)) != 0 for side in sides]
    counts = stored(one.groupBy("word").agg(*[F.count_if(t & (F.col("label") == label)).alias(f"{name}{k}") for k, t in enumerate(there) for label, name in ((1, "x"), (0, "y"))]), "words")
    sums = counts.agg(*[f for k in range(len(sides)) for f in (F.sum(f"x{k}"), F.sum(f"y{k}"), F.count_if(F.col(f"x{k}") + F.col(f"y{k}") > 0))]).first()
    sums = [tuple(v or 0 for v in sums[3 * k : 3 * k + 3]) for k in range(len(sides))]
    shares = [x / (x + y) if x + y else 0.0 for x, y, _ in sums]
    least = [np.log(max(different, 1) / max(ALPHAS)) for *_, different in sums]
    # As in evidence(): what stands out in all of the sample or without a fold; the strongest, as many as there is room for.
    hopes = []
    for k, q in enumerate(shares):
        if 0 < q < 1:
            x, n = F.col(f"x{k}"), F.col(f"x{k}") + F.col(f"y{k}")
            other = F.when(x < n, (n - x) * F.log((n - x) / (n * (1 - q)))).otherwise(0.0)
            hopes.append(F.when(x > q * n, x * F.log(x / (n * q)) + other - least[k]).otherwise(-1.0))
    if not hopes:
        return [[[] for _ in ALPHAS] for _ in sides]
    hope = F.greatest(*hopes) if len(hopes) > 1 else hopes[0]
    chosen = counts.withColumn("hope", hope).where("hope >= 0").orderBy(F.desc("hope"), "word").limit(PASSAGE_BYTES // 8).select("word", *[f"{c}{k}" for k in range(len(sides)) for c in "xy"])
    table = chosen.collect()
    if not table:
        return [[[] for _ in ALPHAS] for _ in sides]
    names = [bytes(row[0]) for row in table]
    entries = places.join(F.broadcast(chosen.select("word")), "word").select("word", "text_id", "label", "fold").distinct().toArrow()
    number = {name: i for i, name in enumerate(names)}
    words = np.array([number[w.as_py()] for w in entries["word"]], np.int64)
    _, texts = np.unique(entries["text_id"].to_numpy(), return_inverse=True)
    toxic, fold = entries["label"].to_numpy().astype(float), entries["fold"].to_numpy()
    sizes = np.array([len(name) + 3 for name in names])
    out = []
    for k in range(len(sides)):
        kept = fold != k - 1
        held = np.bincount(words[kept], minlength=len(names))
        countings = np.array([row[1 + 2 * k] + row[2 + 2 * k] for row in table])
        order = _taken(words[kept], texts[kept], toxic[kept], countings / np.maximum(held, 1), shares[k], least[k], sizes)
        # A level is the words before the first that is too weak for it.
        weakest = np.minimum.accumulate([strength for _, strength in order]) if order else np.zeros(0)
        out.append([[names[i] for (i, _), w in zip(order, weakest) if w >= least[k] + np.log(max(ALPHAS) / alpha)] for alpha in ALPHAS])
    return out


def _monotone(positive: np.ndarray, all_rows: np.ndarray) -> np.ndarray:
    """Rates that rise with the saving (pooled adjacent violators), by maximum likelihood."""
    pools: list[list[float]] = []
    for p, n in zip(positive, all_rows):
        pools.append([p, n, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.concatenate([np.full(int(k), p / n if n else 0.0) for p, n, k in pools])


def _likelihood(positive: np.ndarray, all_rows: np.ndarray) -> float:
    """Log-likelihood of the labels under the monotone fit."""
    p = np.clip(_monotone(positive, all_rows), 1e-6, 1 - 1e-6)
    return float((positive * np.log(p) + (all_rows - positive) * np.log(1 - p)).sum())


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model | None:
    """The model of (doc_id, label 0 or 1) rows, or None without rows of both labels."""
    chosen = sample(docs, labels.where("label is not null").selectExpr("doc_id", "cast(label as int) as label"), rows)
    fold = F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold")
    chosen = stored(chosen.select("text", "label").dropDuplicates(["text"]).select("text", "label", fold, F.xxhash64("text").alias("text_id")), "labelled")
    counts = dict(chosen.groupBy("label").agg(F.sum(F.octet_length("text") / STEP_BYTES + 1)).collect())
    if len(counts) < 2:
        return None
    share = max(1, int(counts[0] // BASE_WINDOWS) + 1)
    windows = chosen.where("label = 0").select("text").mapInArrow(partial(_sampled_windows, share=share), "window binary").collect()
    ordinary = zstandard.train_dictionary(BASE_BYTES, [bytes(w[0]) for w in windows], level=LEVEL).as_bytes() if len(windows) >= 256 else b"".join(bytes(w[0]) for w in windows)

    def toxic(words: list[bytes]) -> bytes:
        return ordinary + b"".join(b"  " + word + b" " for word in reversed(words)) + b" "

    whole, *without = _passages(chosen)
    positive, both = np.zeros((len(ALPHAS), MOST_SAVED + 1)), np.full((len(ALPHAS), MOST_SAVED + 1), 1e-6)
    for k, levels in enumerate(without):
        measured = chosen.where(F.col("fold") == k).select("label", "text").mapInArrow(
            partial(_measured, ordinary=ordinary, toxic=tuple(map(toxic, levels))), "label int, saved array<long>")
        for level, saved, p, n in measured.select("label", F.posexplode("saved").alias("level", "bytes")).groupBy("level", "bytes").agg(F.sum("label"), F.count("*")).collect():
            positive[level, saved] += p
            both[level, saved] += n
    fits = [_likelihood(p, n) for p, n in zip(positive, both)]
    best = int(np.argmax(fits))
    logger.info("toxicity: words by level %s, log-likelihoods %s", [len(words) for words in whole], [round(f, 1) for f in fits])
    positive, both, model = positive[best], both[best], Model(ordinary, toxic(whole[best]), ())
    positive[-1], both[-1] = positive[-1] + 0.5, both[-1] + 0.5  # unseen savings count as the largest seen
    return Model(model.ordinary, model.toxic, tuple(np.clip(_monotone(positive, both), 0.0, 1.0).tolist()))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per document: doc_id, saved, score, predicted."""
    if model is None:
        return docs.selectExpr("doc_id", "cast(0 as long) as saved", "0.0D as score", "0 as predicted")
    kind = docs.schema["doc_id"].dataType.simpleString()
    saved = docs.select("doc_id", "text").mapInArrow(partial(_score, model=model, keep=("doc_id",), label="saved"), f"doc_id {kind}, saved long")
    scored = saved.withColumn("score", F.get(F.array(*(F.lit(p) for p in model.probability)), F.col("saved").cast("int")))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
