"""Mixing sources to target weights by soft membership.

A softmax classifier, fitted on labelled rows, gives each document a posterior over domains.
Nonnegative rates r (how often a document is to be used) then solve

    min  1/2 * sum_d (sum_i r_i n_i p_id / N - target_d)^2 / share_d + RIDGE/2 * sum_i n_i / N * (r_i - 1)^2

with n_i the words of a document, N their total and share_d the domain's share at rates of 1: expected
domain totals meet the targets, and among such rates the ones closest to using each document once are taken.

At the optimum r_i = max(0, 1 - p_i . g / RIDGE), where g are D residuals that maximise the dual, a smooth concave
function with a piecewise constant Hessian. So Newton's method with step halving runs on D numbers: an iteration is one
aggregate over (n_i, p_i) that gives value, gradient and Hessian (D * D sums reach the driver), nothing is rewritten,
and a document's rate depends on g alone. The duality gap of these rates is 1/2 * sum_d gradient_d^2 / share_d; the
iterations end when it is at most GAP, which bounds the weighted mean square distance of the rates from the optimum by
2 * GAP / RIDGE, or when no step raises the dual any more in floating point, which is logged. So are the reached domain totals
beside the targets.

The fit of the classifier is bounded (about SAMPLE_ROWS rows, parameter ``rows``); everything
else covers all documents. Defined cases: null texts are empty, have no words and keep
rate 1 minus what their posterior asks for; domains without labelled rows cannot be told
apart and their weight goes to the others; without a classifier all rates are 1.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlake.llm.labelled import DIMENSIONS, descend, features, products, sample
from fundlake.llm.ordinal import flat
from fundlake.llm.tables import stored
from fundlake.llm.text import blocks

SAMPLE_ROWS = 6000
STEPS = 80
PENALTY = 1e-5
RIDGE = 0.01
GAP = 1e-11
MISS = 0.01
logger = logging.getLogger(__name__)


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch["text"]):
            cells, values, first, _ = features(block)
            at = pa.array(first.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch["domain"].slice(block.lo, len(block)), pa.ListArray.from_arrays(at, pa.array(cells)), pa.ListArray.from_arrays(at, pa.array(values))],
                names=["domain", "cells", "values"])


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    batches = list(batches)
    if not batches:
        return
    table = pa.Table.from_batches(batches)
    names, y = np.unique(np.array(table["domain"].to_pylist()), return_inverse=True)
    cells, values, first = flat(table)
    row_of = np.repeat(np.arange(len(y)), np.diff(first))
    k = len(names)

    def gradient(p):
        w = p.reshape(k, DIMENSIONS + 1)
        at = products(cells, values, first, w[:, :-1]) + w[:, -1]
        at = np.exp(at - at.max(1, keepdims=True))
        error = at / at.sum(1, keepdims=True)
        error[np.arange(len(y)), y] -= 1
        error /= len(y)
        out = PENALTY * w
        for d in range(k):
            out[d, :-1] += np.bincount(cells, weights=values * error[row_of, d], minlength=DIMENSIONS)
            out[d, -1] += error[:, d].sum()
        return out.ravel()

    w = descend(gradient, np.zeros(k * (DIMENSIONS + 1)), STEPS).reshape(k, -1)
    yield pa.RecordBatch.from_pydict({"domain": names.tolist(), "weights": [row.astype(np.float32).tobytes() for row in w]},
                                     pa.schema([("domain", pa.string()), ("weights", pa.binary())]))


def fit(docs: DataFrame, domains: DataFrame, rows: int = SAMPLE_ROWS) -> dict[str, np.ndarray]:
    """Weights of each domain in (doc_id, domain) rows; empty without labelled text."""
    chosen = sample(docs, domains.where("domain is not null").selectExpr("doc_id", "cast(domain as string) as domain"), rows)
    found = (
        chosen.select("text", "domain").mapInArrow(_sparse, "domain string, cells array<int>, values array<float>").repartition(1)
        .mapInArrow(_fit, "domain string, weights binary").collect()
    )
    return {name: np.frombuffer(w, np.float32) for name, w in sorted(found)}


def _posteriors(batches: Iterator[pa.RecordBatch], weights) -> Iterator[pa.RecordBatch]:
    w = np.stack(weights.value)
    for batch in batches:
        for block in blocks(batch["text"]):
            cells, values, first, count = features(block)
            at = products(cells, values, first, w[:, :-1]) + w[:, -1]
            at = np.exp(at - at.max(1, keepdims=True))
            p = pa.array((at / at.sum(1, keepdims=True)).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(p) + 1, len(w), dtype=np.int32)), p)
            others = [batch[name].slice(block.lo, len(block)) for name in batch.schema.names]
            yield pa.RecordBatch.from_arrays([*others, pa.array(count), lists], names=[*batch.schema.names, "_mix_tokens", "_mix_posterior"])


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _rate(g: np.ndarray) -> Column:
    """A document's rate at the residuals ``g``."""
    return F.greatest(F.lit(0.0), 1.0 - _dot(F.col("_mix_posterior"), F.array(*map(F.lit, g.tolist()))) / RIDGE)


def solve(points: DataFrame, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """The residuals g that give the rates, the domain totals at these rates (shares of all words), and their duality gap."""
    k = len(wanted)
    total = points.agg(F.sum("_mix_tokens")).first()[0] or 0
    if not total:
        return np.zeros(k), np.zeros(k), 0.0
    t, p = F.col("_mix_tokens"), [F.get("_mix_posterior", F.lit(d)) for d in range(k)]
    upper = [(d, e) for d in range(k) for e in range(d, k)]

    def at(g):
        # Of a document: n_i * (RIDGE/2 * (r - 1)^2 + r * p.g), n_i r p_d, and n_i p_d p_e where r > 0.
        r = F.col("r")
        value = F.sum(t * (RIDGE / 2 * (r - 1) * (r - 1) + r * _dot(F.col("_mix_posterior"), F.array(*map(F.lit, g.tolist())))))
        sums = points.withColumn("r", _rate(g)).agg(value, *(F.sum(t * r * x) for x in p), *(F.sum(F.when(r > 0, t * p[d] * p[e]).otherwise(0.0)) for d, e in upper)).first()
        found = np.array(sums, float) / total
        curve = np.zeros((k, k))
        for (d, e), x in zip(upper, found[1 + k :]):
            curve[d, e] = curve[e, d] = x
        return found[0], found[1 : 1 + k], curve

    g = np.zeros(k)
    value, reached, curve = at(g)
    share = np.maximum(reached, 1e-9)  # at rates of 1
    while True:
        gradient = reached - wanted - share * g
        gap = float((gradient**2 / share).sum() / 2)
        if gap <= GAP:
            break
        step = np.linalg.solve(curve / RIDGE + np.diag(share), gradient)
        dual, slope, length = value - wanted @ g - (share * g * g).sum() / 2, gradient @ step, 1.0
        while True:
            ahead = g + length * step
            new = at(ahead)
            if new[0] - wanted @ ahead - (share * ahead * ahead).sum() / 2 >= dual + 1e-4 * length * slope or length * slope <= 1e-15 * max(1.0, abs(dual)):
                break
            length /= 2
        if new[0] - wanted @ ahead - (share * ahead * ahead).sum() / 2 <= dual:
            logger.warning("mixing: no step raises the dual any more at a duality gap of %g (wanted: %g)", gap, GAP)
            break
        g, (value, reached, curve) = ahead, new
    return g, reached, gap


def rates(docs: DataFrame, weights: dict[str, np.ndarray], targets: dict[str, float]) -> DataFrame:
    """``docs`` with rate and n_tokens (and the posterior by domain, in alphabetical order) as _mix_* columns."""
    if not weights:
        return docs.withColumns({"_mix_tokens": F.lit(0).cast("long"), "_mix_posterior": F.array().cast("array<double>"), "_mix_rate": F.lit(1.0)})
    names = sorted(weights)
    shared = docs.sparkSession.sparkContext.broadcast([weights[n] for n in names])  # a row of DIMENSIONS weights for each domain
    added = [T.StructField("_mix_tokens", T.LongType()), T.StructField("_mix_posterior", T.ArrayType(T.DoubleType()))]
    schema = T.StructType([*docs.schema.fields, *added])
    rows = docs.mapInArrow(partial(_posteriors, weights=shared), schema)
    wanted = np.array([max(0.0, targets.get(n, 0.0)) for n in names])
    wanted = wanted / wanted.sum() if wanted.sum() else np.full(len(names), 1 / len(names))
    # The iterations read a narrow table; the posteriors of the result are computed once more, not carried along.
    points = stored(docs.select("text").mapInArrow(partial(_posteriors, weights=shared), T.StructType([docs.schema["text"], *added])).drop("text"), "posteriors")
    g, reached, gap = solve(points, wanted)
    missed = np.abs(reached - wanted).max() > MISS
    logger.log(logging.WARNING if missed else logging.INFO, "mixing: share of words by domain, reached and wanted: %s; duality gap %g",
               {n: (round(float(a), 4), round(float(b), 4)) for n, a, b in zip(names, reached, wanted)}, gap)
    return rows.withColumn("_mix_rate", _rate(g))


def totals(docs: DataFrame, weights: dict[str, np.ndarray], targets: dict[str, float]) -> DataFrame:
    """(domain, wanted, reached, gap): shares of all words that the rates give each domain, beside the targets."""
    schema = "domain STRING, wanted DOUBLE, reached DOUBLE, gap DOUBLE"
    if not weights:
        return docs.sparkSession.createDataFrame([], schema)
    names = sorted(weights)
    shared = docs.sparkSession.sparkContext.broadcast([weights[n] for n in names])
    fields = T.StructType([docs.schema["text"], T.StructField("_mix_tokens", T.LongType()), T.StructField("_mix_posterior", T.ArrayType(T.DoubleType()))])
    points = stored(docs.select("text").mapInArrow(partial(_posteriors, weights=shared), fields).drop("text"), "posteriors")
    wanted = np.array([max(0.0, targets.get(n, 0.0)) for n in names])
    wanted = wanted / wanted.sum() if wanted.sum() else np.full(len(names), 1 / len(names))
    _, reached, gap = solve(points, wanted)
    return docs.sparkSession.createDataFrame([(n, float(w), float(r), gap) for n, w, r in zip(names, wanted, reached)], schema)


def mix(docs: DataFrame, weights: dict[str, np.ndarray], targets: dict[str, float]) -> DataFrame:
    """``docs`` with each row as often as its rate says: the whole part, and one more by a hash of its text."""
    rated = rates(docs, weights, targets)
    coin = F.pmod(F.xxhash64("text", F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)
    copies = F.floor("_mix_rate") + (coin < F.col("_mix_rate") - F.floor("_mix_rate")).cast("long")
    return rated.withColumn("_mix_copy", F.explode(F.sequence(F.lit(0).cast("long"), copies))).where("_mix_copy > 0").select(docs.columns)
