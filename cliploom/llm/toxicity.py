"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the hashed n-grams it holds, counted once. On labelled texts each
feature gets the log ratio of its smoothed shares in the two classes; a logistic model with an
L2 penalty is then fitted on the features times these ratios. Scoring adds up, for each text,
one weight for each n-gram it holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cliploom.llm.labelled import fold, labelled_sample, row_sums, sigmoid
from cliploom.llm.ngrams import held_ngrams
from cliploom.llm.words import make_room, text_chunks

FOLDS, HELD_OUT = 5, 0
#: Bytes of text whose n-grams are held at once.
CHUNK_BYTES = 1 << 20


@dataclass(frozen=True)
class Settings:
    orders: tuple[int, ...] = (3, 4, 5)
    bits: int = 18
    #: Labelled rows of each class that the fit reads at most.
    per_class: int = 1000
    #: n-grams in fewer of these texts weigh nothing.
    least_texts: int = 3
    smoothing: float = 1.0
    penalty: float = 1e-5
    steps: int = 120


@dataclass(frozen=True)
class Model:
    """Weight of each hashed n-gram and the constant; a fixed size of ``2 ** bits`` numbers."""

    weights: np.ndarray
    constant: float


def fit(features: np.ndarray, bounds: np.ndarray, label: np.ndarray, settings: Settings) -> Model:
    """The model of texts whose n-grams lie between the bounds; without two classes a constant one."""
    width = 1 << settings.bits
    if not 0 < label.sum() < len(label):
        return Model(np.zeros(width, np.float32), float(np.sign(2 * label.mean() - 1) * 4) if len(label) else 0.0)
    parts = [(a, min(a + 100, len(label))) for a in range(0, len(label), 100)]  # texts that are worked on at once
    counts = np.zeros((2, width))
    for a, b in parts:
        marked = np.repeat(label[a:b], np.diff(bounds[a : b + 1]))
        for value in (0, 1):
            counts[value] += np.bincount(features[bounds[a] : bounds[b]][marked == value], minlength=width)
    texts = np.array([[len(label) - label.sum()], [label.sum()]])
    shares = np.log((settings.smoothing + counts) / (texts + 2 * settings.smoothing))
    ratio = shares[1] - shares[0]
    often = counts.sum(axis=0) >= settings.least_texts
    keep = often[features]
    bounds = np.concatenate((np.zeros(1, np.int32), np.cumsum(keep, dtype=np.int32)))[bounds]
    features = features[keep]
    used = np.flatnonzero(often)
    place = np.zeros(width, np.int32)
    place[used] = np.arange(len(used))
    at, values = place[features], ratio.astype(np.float32)[features]
    del features, keep
    step = 4.0 / max(float(values @ values) / len(label), 1e-9)
    w, look, constant, look_c, theta = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0, 1.0
    balance = np.where(label == 1, 0.5 / label.sum(), 0.5 / (len(label) - label.sum()))
    for _ in range(settings.steps):  # accelerated gradient steps
        slope, total = settings.penalty * look, 0.0
        for a, b in parts:
            own = slice(bounds[a], bounds[b])
            error = (sigmoid(row_sums(look[at[own]] * values[own], bounds[a : b + 1] - bounds[a]) + look_c) - label[a:b]) * balance[a:b]
            slope += np.bincount(at[own], np.repeat(error, np.diff(bounds[a : b + 1])) * values[own], len(used))
            total += error.sum()
        new, new_c = look - step * slope, look_c - 0.5 * total
        theta, old = (1 + np.sqrt(1 + 4 * theta**2)) / 2, theta
        look, look_c = new + (old - 1) / theta * (new - w), new_c + (old - 1) / theta * (new_c - constant)
        w, constant = new, new_c
    weights = np.zeros(width, np.float32)
    weights[used] = w * ratio[used]
    return Model(weights, float(constant))


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on labelled rows outside the held-out fold; at most ``2 * per_class`` texts, in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        features, counts, label = [], [], []
        for chunk in text_chunks(batches, "text", CHUNK_BYTES):
            held, bounds = held_ngrams(chunk.column("text"), settings.orders, settings.bits)
            features.append(held.astype(np.int32))
            counts.append(np.diff(bounds))
            label.append(chunk.column("label").to_numpy(zero_copy_only=False))
        counts = np.concatenate([np.zeros(1, np.int64), *counts])
        model = fit(np.concatenate([np.empty(0, np.int32), *features]), np.cumsum(counts), np.concatenate([np.empty(0, np.int32), *label]), settings)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.constant])], names=["weights", "constant"])

    learn = fold(F.col("doc_id"), FOLDS) != HELD_OUT
    sample = labelled_sample(docs, labels, "toxic", learn, settings.per_class)
    models = sample.mapInArrow(run, "weights binary, constant double").collect()
    if not models:
        return Model(np.zeros(1 << settings.bits, np.float32), 0.0)
    return Model(np.frombuffer(models[0]["weights"], np.float32), models[0]["constant"])


def score(docs: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with ``score`` from 0 to 1; null text scores as empty text, by the constant alone."""
    schema = docs.schema
    names = [f.name for f in schema if f.name != "score"]
    kept = docs.select(*names)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.constant))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        weights, constant = shared.value
        for chunk in text_chunks(batches, "text", CHUNK_BYTES):
            held, bounds = held_ngrams(chunk.column("text"), settings.orders, settings.bits)
            scores = sigmoid(row_sums(weights[held], bounds) + constant)
            yield pa.RecordBatch.from_arrays([*chunk.columns, pa.array(scores)], names=[*chunk.schema.names, "score"])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())]))


def toxic_scores(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs(doc_id, text)``; every row is kept, repeated ones too.

    A score of exactly one half is predicted toxic; null and empty texts score by the constant;
    texts of any length are read whole. Without labels of both classes the score is a constant.
    Other columns are ignored; an empty table gives no rows.
    """
    model = train(docs, labels, settings)
    return score(docs.select("doc_id", F.col("text").cast("string").alias("text")), model, settings).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that score below one half, with their columns as they were, whatever their names.

    Null, empty and very long texts, ties and repeated rows go as in ``toxic_scores``.
    """
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns))  # a caller's own score stays as it is
    scored = score(docs.select(own.alias("own"), F.col("text").cast("string").alias("text")), train(docs, labels, settings), settings)
    return scored.where("score < 0.5").select(*(F.col(f"own.`{c}`").alias(c) for c in docs.columns))
