"""Toxicity by FTRL-proximal logistic regression on hashed words.

Features are the distinct words, word pairs and pairs with one word between
(skip-grams) of a whole text, hashed to ``1 << BITS`` places. The learner
keeps two sums per place; each place has its own learning rate, and the L1
term leaves most weights at exactly zero, so what is sent to the tasks is the
short list of the others. It also draws all scores to the middle, and the rows
a model was fitted on score higher than others; so the weights and the bias
are stretched as it fits scores of rows that a model fitted on the other half
has not seen.

Fitting uses at most ``FIT_ROWS`` labelled rows, those of the smallest
doc_id hash, each whole and whatever its length; of these, in that order, all
that fit into ``FIT_PLACES`` distinct places together. One that does not fit
is passed over and the rest goes on. It runs on the driver, and its memory is
bounded by the two limits. Scoring covers every row and whole
texts.

Cases: null and empty texts have no features and score the bias. Labels that
are null are left out; a doc_id labelled more than once counts as toxic if at
least half its labels say so. With no usable label the score is 0.5. Rows
with the same or a null doc_id are scored like others. Columns other than
doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.text import Words, batches, mix
from millrace.session import stored

BITS = 20
FIT_ROWS = 6_000
FIT_PLACES = 1 << 24
EPOCHS = 8
LEAST_OF_CLASS = 20  # rows of either class from which scores are calibrated
_PAIR, _SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """``(text, place)`` of every word, pair and skip-gram."""
    h = words.hashes()
    out = [(words.text, h)]
    for gap, factor in ((1, _PAIR), (2, _SKIP)):
        if len(h) > gap:
            inside = words.text[:-gap] == words.text[gap:]
            out.append((words.text[:-gap][inside], mix(h[:-gap][inside] * factor + h[gap:][inside])))
    return np.concatenate([t for t, _ in out]), np.concatenate([p for _, p in out]) >> np.uint64(64 - BITS)


@dataclass
class Model:
    places: np.ndarray  # with a weight other than zero
    weights: np.ndarray
    bias: float

    def scores(self, texts: Sequence[bytes | None]) -> np.ndarray:
        table = np.zeros(1 << BITS, np.float32)
        table[self.places] = self.weights
        out = np.full(len(texts), self.bias)
        for first, run in batches(texts):
            text, place = features(Words(run))
            used = table[place] != 0
            once = np.unique(text[used].astype(np.int64) << BITS | place[used].astype(np.int64))
            sums = np.bincount(once >> BITS, table[once & (1 << BITS) - 1], len(run))
            out[first : first + len(run)] += sums
        return 1 / (1 + np.exp(-np.clip(out, -35, 35)))


def fit(rows: Sequence[np.ndarray], labels: Sequence[int], epochs: int = EPOCHS, alpha: float = 2.0, beta: float = 1.0, l1: float = 12.0, l2: float = 0.1) -> Model:
    """FTRL-proximal over the rows in the given order; ``rows`` hold the
    distinct places of a text."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias = bias_n = 0.0

    def weights(at: np.ndarray) -> np.ndarray:
        over = np.abs(z[at]) - l1
        return np.where(over > 0, -np.sign(z[at]) * over / ((beta + np.sqrt(n[at])) / alpha + l2), 0.0)

    for _ in range(epochs):
        for at, label in zip(rows, labels):
            w = weights(at)
            error = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - label
            if abs(error) < 1e-4:
                continue
            step = (np.sqrt(n[at] + error * error) - np.sqrt(n[at])) / alpha
            z[at] += error - step * w
            n[at] += error * error
            bias_n += error * error
            bias -= alpha / (beta + np.sqrt(bias_n)) * error
    every = weights(np.arange(1 << BITS))
    kept = np.flatnonzero(every)
    return Model(kept, every[kept].astype(np.float32), float(bias))


def calibrate(model: Model, rows: Sequence[np.ndarray], labels: Sequence[int]) -> Model:
    """The model with its log-odds as ``slope * x + shift``, by logistic
    regression on the rows of each half as the other half's model scores them."""
    y = np.array(labels, float)
    if min(y.sum(), len(y) - y.sum()) < LEAST_OF_CLASS:
        return model
    x, half = np.zeros(len(y)), np.arange(len(y)) % 2
    for side in (0, 1):
        other = fit([r for r, h in zip(rows, half) if h != side], y[half != side].astype(int).tolist())
        table = np.zeros(1 << BITS)
        table[other.places] = other.weights
        x[half == side] = [other.bias + table[r].sum() for r, h in zip(rows, half) if h == side]
    slope, shift = 1.0, 0.0
    for _ in range(50):  # Newton's steps; a little weight on the start keeps them bounded
        p = 1 / (1 + np.exp(-np.clip(slope * x + shift, -35, 35)))
        w = p * (1 - p)
        slopes = np.array([(p - y) @ x + 0.1 * (slope - 1), (p - y).sum() + 0.1 * shift])
        step = np.linalg.solve([[w @ (x * x) + 0.1, w @ x], [w @ x, w.sum() + 0.1]], slopes)
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-9:
            break
    if not (np.isfinite(slope) and np.isfinite(shift) and slope > 0):
        return model
    return Model(model.places, (model.weights * slope).astype(np.float32), float(model.bias * slope + shift))


def labelled(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """``text, label`` of at most ``limit`` labelled documents, chosen by a
    hash of doc_id; ``labels`` are the rows that may be learned from."""
    one = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    )
    order = F.xxhash64("doc_id")
    few = one.orderBy(order, "doc_id").limit(limit)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    # at most ``limit`` rows of two numbers
    return rows.join(F.broadcast(few), "doc_id").select("doc_id", "text", "label")


def whole_rows(rows: DataFrame, numbers: str, size: str, most: int, limit: int) -> pd.DataFrame:
    """Of the ``limit`` first rows by doc_id hash those whose ``size`` fits
    into ``most`` together, in that order, one at least; a repeated row counts
    once."""
    key = ["order", "doc_id", "tie"]
    rows = stored(rows.withColumns({"order": F.xxhash64("doc_id"), "tie": F.xxhash64(numbers)})).dropDuplicates(key)
    sizes = rows.select(*key, size).orderBy(*key).limit(limit).toPandas()
    taken, held = [], 0
    for i, n in enumerate(sizes[size].tolist()):
        if held + n <= most:
            taken.append(i)
            held += n
    taken = taken or [*range(len(sizes))][:1]
    chosen = rows.sparkSession.createDataFrame(sizes.iloc[taken][key], "order bigint, doc_id bigint, tie bigint")
    # at most ``limit`` rows of three numbers
    return rows.join(F.broadcast(chosen), key).toPandas().sort_values(key)


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", limit: int = FIT_ROWS) -> Model:
    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for doc_id, text, y in zip(frame["doc_id"], frame["text"], frame["label"]):
                places = np.unique(features(Words([text or b""]))[1]).astype(np.int32)
                yield pd.DataFrame({"doc_id": [doc_id], "label": [y], "n": [len(places)], "places": [places.tobytes()]})

    found = labelled(docs, labels, label, limit).mapInPandas(extract, "doc_id bigint, label int, n bigint, places binary")
    rows = whole_rows(found, "places", "n", FIT_PLACES, limit)
    places, marks = [np.frombuffer(p, np.int32) for p in rows["places"]], rows["label"].tolist()
    return calibrate(fit(places, marks), places, marks)


def score(model: Model, text: Column) -> Column:
    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts.tolist()))

    return of(text.cast("binary"))
