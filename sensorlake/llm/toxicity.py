"""Toxicity of texts: a linear classifier on character n-grams, scaled by naive Bayes log-count ratios.

A text is the set of the hashed character 4- to 8-grams that begin at its words,
lower-cased; where scripts write without blanks every character begins one. Each
feature has the value of its log-count ratio between toxic and other texts, so
what is equally frequent in both weighs nothing; logistic regression on these
values, with a quadratic penalty, is the classifier, found by accelerated
gradient steps. Sizes, limits and penalty were chosen by a part of the fitting
rows; few labels then suffice, because inner pieces of words add only noise.

It is fitted on a sample of labelled texts, at most about ``MAX_TRAIN`` (a
documented bound), taken by a hash of the id; every text is scored, as a whole.
Fitting runs in Spark over the stored sample: features are counted by a shuffle,
and each step adds up the gradients that ``TRAIN_TASKS`` tasks give. The driver
gets the counts of features that are not too rare, and sends weights of those used.

Defined cases: NULL text counts as empty and is scored; a NULL id has no label
and is not held out; several labels of one id count as toxic if one is;
labels without text or of another value than 0 and 1 are left out. Without
labels of both kinds every score is the share of toxic labels, smoothed. An
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import no_null, small_batches, stored, table

MAX_TRAIN = 12_000
TRAIN_TASKS = 8
THRESHOLD = 0.3
_BITS = 20
_SIZES = (4, 5, 6, 7, 8)
_UNSPACED = 0x2E80  # from here on characters are words of their own
_PENALTY = 1e-3
_STEPS = 40
_POWER_STEPS = 5
_SLICE = 200  # texts handled together
_COUNTED = 1 << 16  # counts handed over together
_LEAST_DOCS = 6
_LEAST_RATIO = 1.5
_SMOOTH = 0.5


def features(text: str) -> np.ndarray:
    """The distinct hashed character n-grams at the beginnings of words; the result may list them in any order."""
    line = f" {' '.join(text.lower().split())} "
    code = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    at = np.flatnonzero((code[1:] != 32) & ((code[:-1] == 32) | (code[1:] >= _UNSPACED))) + 1
    found, gram = [], code[at]
    for size in range(2, max(_SIZES) + 1):
        whole = at + size <= len(code)
        at, gram = at[whole], gram[whole]
        gram = gram * np.uint64(0x100000001B3) + code[at + size - 1]
        if size in _SIZES:
            # the length is part of the gram
            found.append(((gram ^ np.uint64(size << 56)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _BITS)).astype(np.int32))
    grams = np.concatenate(found) if found else np.empty(0, np.int32)
    # of equal ones the last writer of a slot stays
    place = np.arange(len(grams), dtype=np.int32)
    _slots[grams] = place
    return grams[_slots[grams] == place]


_slots = np.empty(1 << _BITS, np.int32)


def held_out(doc_id: Column) -> Column:
    """The fixed fold whose labels are never used for fitting."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """At most about ``max_train`` labelled texts outside the held-out fold, stored in a few parts."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(
        "doc_id").agg(F.max("toxic").cast("int").alias("label"))
    share = min(1.0, max_train / max(known.count(), 1))
    chosen = known.where(F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    # bounded by max_train rows of 12 bytes
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("label", "text")
    return stored(texts.where("text IS NOT NULL").repartition(TRAIN_TASKS), "labelled")


class Model:
    """Weights by feature; ``score`` is a probability."""

    def __init__(self, weights: np.ndarray, bias: float) -> None:
        self.weights, self.bias = weights, bias

    def __getstate__(self) -> tuple[np.ndarray, np.ndarray, float]:
        used = np.flatnonzero(self.weights).astype(np.int32)  # few of all places
        return used, self.weights[used], self.bias

    def __setstate__(self, state: tuple[np.ndarray, np.ndarray, float]) -> None:
        used, weights, self.bias = state
        self.weights = np.zeros(1 << _BITS)
        self.weights[used] = weights

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[features(text)].sum() + self.bias, -30, 30))))


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, 1 << _BITS), np.int32)
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            counts[label, features(text.as_py())] += 1
    found = np.flatnonzero(counts.any(axis=0)).astype(np.int32)
    for part in (found[at:at + _COUNTED] for at in range(0, len(found), _COUNTED)):
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (part, *counts[:, part])], names=["feature", "other", "toxic"])


def class_counts(sample: DataFrame) -> DataFrame:
    """In how many other and toxic texts of ``sample`` each feature is that is not too rare."""
    return sample.mapInArrow(_class_counts, "feature int, other int, toxic int").groupBy("feature").agg(
        F.sum("other").cast("int").alias("other"), F.sum("toxic").cast("int").alias("toxic")).where(
        F.col("other") + F.col("toxic") >= _LEAST_DOCS)


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    small_batches(docs.sparkSession)
    sample = training_sample(docs, labels, max_train)
    sizes = np.zeros(2, np.int64)
    for row in sample.groupBy("label").count().collect():
        sizes[row["label"]] = row["count"]
    bias = float(np.log((sizes[1] + 0.5) / (sizes[0] + 2.0)))
    if not sizes.all():
        return Model(np.zeros(1 << _BITS), bias)
    # three numbers for each feature that is not too rare, at most 12 MB
    feature, other, toxic = (c.to_numpy() for c in class_counts(sample).toArrow().sort_by("feature").columns)
    ratio = np.log((toxic + _SMOOTH) / (sizes[1] + 2 * _SMOOTH)) - np.log((other + _SMOOTH) / (sizes[0] + 2 * _SMOOTH))
    # features too even to tell anything are left out, like those too rare
    used = np.abs(ratio) >= _LEAST_RATIO
    chosen, values = feature[used], ratio[used]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.full(1 << _BITS, -1, np.int32)
        number[chosen] = np.arange(len(chosen), dtype=np.int32)
        for batch in (b.slice(at, _SLICE) for b in batches for at in range(0, b.num_rows, _SLICE)):
            own = [number[features(t.as_py())] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int32()), pa.array([f[f >= 0] for f in own], pa.list_(pa.int32()))],
                names=["label", "features"])

    encoded = stored(sample.mapInArrow(encode, "label int, features array<int>"), "features")
    # the largest curvature bounds the step; found by power iteration
    direction = np.random.default_rng(0).random(len(values))
    for _ in range(_POWER_STEPS):
        direction, _ = _summed(encoded, direction, values)
        curvature = np.linalg.norm(direction)
        direction /= max(curvature, 1e-12)
    n, weights = int(sizes.sum()), np.zeros(len(values))
    step, ahead = 1 / (curvature / (4 * n) + _PENALTY), weights
    for i in range(_STEPS):
        slope, missed = _summed(encoded, ahead, values, bias)
        stepped = ahead - step * (slope / n + _PENALTY * ahead)
        ahead, weights = stepped + i / (i + 3) * (stepped - weights), stepped
        bias -= 0.5 * missed / n
    whole = np.zeros(1 << _BITS)
    whole[chosen] = weights * values
    return Model(whole, bias)


def _summed(encoded: DataFrame, weights: np.ndarray, values: np.ndarray, bias: float | None = None,
            ) -> tuple[np.ndarray, float]:
    """The rows of ``encoded`` weighted by their errors and added up, and the sum of the errors.

    Without ``bias`` a row is weighted by its product with ``weights`` instead.
    """
    scaled = weights * values  # all that a step sends to the tasks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, missed = np.zeros(len(scaled)), 0.0
        for batch in (b.slice(at, _SLICE) for b in batches for at in range(0, b.num_rows, _SLICE)):
            listed = batch.column("features")
            flat = listed.flatten().to_numpy()
            row = np.repeat(np.arange(len(listed)), listed.value_lengths().to_numpy())
            product = np.bincount(row, scaled[flat], len(listed))
            if bias is not None:
                product = 1 / (1 + np.exp(-np.clip(product + bias, -30, 30))) - batch.column("label").to_numpy()
            total += np.bincount(flat, product[row], len(scaled))
            missed += float(product.sum())
        yield pa.RecordBatch.from_pydict({"total": [total.tobytes()], "missed": [missed]})

    parts = encoded.mapInArrow(run, "total binary, missed double").collect()
    return values * sum((np.frombuffer(p.total) for p in parts), np.zeros(len(values))), sum(p.missed for p in parts)


def toxicity(text: Column, model: Model) -> Column:
    """Score of every whole text, between 0 and 1."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([model.score(t) for t in batch], dtype="float64")

    return score(no_null(text))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model fitted on the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), toxicity(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
