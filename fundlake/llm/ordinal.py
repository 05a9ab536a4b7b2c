"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= k) = sigmoid(threshold_k - w . x): one weight vector over hashed text for all grades
and ordered thresholds (the first free, the others positive increments above it). Each text gets its
expected grade and the probability of the selected grade or a better one, by which it is kept.

The fit runs in one task on a sample of at most about SAMPLE_ROWS labelled texts (the bound is
the parameter ``rows``); everything is scored, in one pass over whole texts without a shuffle.

Defined cases: a null text is an empty one and gets the thresholds' own probabilities; without
labelled rows, or with one grade only, there is no model: grade and probability
are null and every row is kept. Ratings may be any integers; null ratings are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fundlake.llm.labelled import DIMENSIONS, descend, features, products, sample
from fundlake.llm.text import blocks

SAMPLE_ROWS = 8000
LEAST_TAIL = 0.5
STEPS = 120
PENALTY = 1e-5


@dataclass
class Model:
    """Grades in order, thresholds between them, and weights of the hashed text."""

    grades: np.ndarray
    thresholds: np.ndarray
    weights: np.ndarray

    def probabilities(self, at: np.ndarray) -> np.ndarray:
        """(rows, grades) from w . x."""
        below = 1 / (1 + np.exp(-np.clip(self.thresholds - at[:, None], -40, 40)))
        edges = np.concatenate((np.zeros((len(at), 1)), below, np.ones((len(at), 1))), 1)
        return np.diff(edges, axis=1)


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch["text"]):
            cells, values, first, _ = features(block)
            at = pa.array(first.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch["rating"].slice(block.lo, len(block)), pa.ListArray.from_arrays(at, pa.array(cells)), pa.ListArray.from_arrays(at, pa.array(values))],
                names=["rating", "cells", "values"])


def flat(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells, values and row starts of gathered sparse rows."""
    cells, values = table["cells"].combine_chunks(), table["values"].combine_chunks()
    lengths = cells.value_lengths().to_numpy()
    return cells.flatten().to_numpy(), values.flatten().to_numpy(), np.concatenate(([0], np.cumsum(lengths)))


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    batches = list(batches)
    if not batches:
        return
    table = pa.Table.from_batches(batches)
    ratings = table["rating"].to_numpy()
    grades, y = np.unique(ratings, return_inverse=True)
    if len(grades) < 2:
        return
    cells, values, first = flat(table)
    row_of = np.repeat(np.arange(len(y)), np.diff(first))
    m = len(grades) - 1

    def thresholds(p):
        return p[DIMENSIONS] + np.concatenate(([0.0], np.cumsum(np.exp(p[DIMENSIONS + 1 :]))))

    def gradient(p):
        at = products(cells, values, first, p[None, :DIMENSIONS])[:, 0]
        cut = np.concatenate(([-np.inf], thresholds(p), [np.inf]))
        sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        hi, lo = sigmoid(cut[y + 1] - at), sigmoid(cut[y] - at)
        hi, lo = np.where(y == m, 1.0, hi), np.where(y == 0, 0.0, lo)
        mass = np.maximum(hi - lo, 1e-9)
        up, down = hi * (1 - hi) / mass, lo * (1 - lo) / mass
        out = np.zeros_like(p)
        out[:DIMENSIONS] = np.bincount(cells, weights=values * ((up - down) / len(y))[row_of], minlength=DIMENSIONS) + PENALTY * p[:DIMENSIONS]
        of_cut = np.bincount(np.minimum(y, m - 1), weights=np.where(y < m, -up, 0), minlength=m) + np.bincount(np.maximum(y - 1, 0), weights=np.where(y > 0, down, 0), minlength=m)
        of_cut /= len(y)
        out[DIMENSIONS] = of_cut.sum()
        out[DIMENSIONS + 1 :] = np.exp(p[DIMENSIONS + 1 :]) * np.cumsum(of_cut[::-1])[::-1][1:]
        return out

    p = descend(gradient, np.zeros(DIMENSIONS + m), STEPS)
    yield pa.RecordBatch.from_pydict({"grades": [grades.tolist()], "thresholds": [thresholds(p).tolist()], "weights": [p[:DIMENSIONS].astype(np.float32).tobytes()]},
                                     pa.schema([("grades", pa.list_(pa.int64())), ("thresholds", pa.list_(pa.float64())), ("weights", pa.binary())]))


def fit(docs: DataFrame, ratings: DataFrame, rows: int = SAMPLE_ROWS) -> Model | None:
    """The model of (doc_id, rating) rows, or None if they hold fewer than two grades."""
    graded = sample(docs, ratings.selectExpr("doc_id", "cast(rating as long) as rating").where("rating is not null"), rows)
    found = (
        graded.select("text", "rating").mapInArrow(_sparse, "rating long, cells array<int>, values array<float>").repartition(1)
        .mapInArrow(_fit, "grades array<long>, thresholds array<double>, weights binary").collect()
    )
    if not found:
        return None
    return Model(np.array(found[0][0]), np.array(found[0][1]), np.frombuffer(found[0][2], np.float32))


def _scores(column, model, least: float) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """lo, hi, expected grade and tail probability of each block of a text column."""
    model = model.value
    for block in blocks(column):
        cells, values, first, _ = features(block)
        p = model.probabilities(products(cells, values, first, model.weights[None])[:, 0])
        yield block.lo, block.hi, p @ model.grades, p[:, model.grades >= least].sum(1)


def _grade(batches, model, least: float):
    for batch in batches:
        for lo, hi, grade, tail in _scores(batch["text"], model, least):
            yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(lo, hi - lo), pa.array(grade), pa.array(tail)], names=["doc_id", "expected_grade", "tail_probability"])


def _select(batches, model, least: float, least_tail: float):
    for batch in batches:
        for lo, hi, _, tail in _scores(batch["text"], model, least):
            yield batch.slice(lo, hi - lo).filter(pa.array(tail >= least_tail))


def grade(docs: DataFrame, model: Model | None, least: float, least_tail: float = LEAST_TAIL) -> DataFrame:
    """One row per document: doc_id, expected_grade, tail_probability of ``least`` or better, kept."""
    if model is None:
        return docs.selectExpr("doc_id", "cast(null as double) as expected_grade", "cast(null as double) as tail_probability", "true as kept")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMENSIONS weights: 256 KB
    kind = docs.schema["doc_id"].dataType.simpleString()
    graded = docs.select("doc_id", "text").mapInArrow(partial(_grade, model=shared, least=least), f"doc_id {kind}, expected_grade double, tail_probability double")
    return graded.selectExpr("*", f"tail_probability >= {least_tail!r} as kept")


def select(docs: DataFrame, model: Model | None, least: float, least_tail: float = LEAST_TAIL) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(partial(_select, model=shared, least=least, least_tail=least_tail), docs.schema)
