"""Quality: Bradley-Terry ranking learned from preference pairs.

Texts are described by dense features of their make-up. Each pair sets a text marked good
against one marked bad; logistic loss on the difference of their features gives one score for
any text. The threshold is the quantile of the scores at which the marked texts' share of bad
ones lies, and the reported score is the logistic function of the distance to it.
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
from cliploom.llm.words import span_hashes, text_chunks, utf8_bytes, window_hashes, word_spans

FOLDS, HELD_OUT = 3, 1


@dataclass(frozen=True)
class Settings:
    #: Labelled rows of each class that the fit reads at most.
    per_class: int = 1500
    #: Opponents of each text of the larger class.
    opponents: int = 8
    penalty: float = 1e-3
    steps: int = 300


@dataclass(frozen=True)
class Model:
    """Score = weights . (features - mean) / spread, less the threshold."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float


def byte_kinds() -> np.ndarray:
    kinds = np.full(256, 6)  # other marks
    kinds[ord("a") : ord("z") + 1] = 0
    kinds[ord("A") : ord("Z") + 1] = 1
    kinds[ord("0") : ord("9") + 1] = 2
    kinds[[9, 11, 12, 13, 32]] = 3
    kinds[10] = 4
    kinds[[ord(c) for c in ".,;:'\"?-()"]] = 5
    kinds[128:] = 7
    return kinds


_KINDS = byte_kinds()
N_FEATURES = 8**3 + 6


def fresh_share(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each stretch the share of its keys that are distinct; 1 for empty ones."""
    n = np.diff(bounds)
    of = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((keys, of))
    k, o = keys[order], of[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
    return np.where(n > 0, row_sums(new, bounds) / np.maximum(n, 1), 1.0)


def text_features(texts: pa.Array) -> np.ndarray:
    """One row for each text: square roots of the shares of byte-kind triples, then lengths and repetition."""
    data, bounds = utf8_bytes(texts)
    size = np.diff(bounds)
    kinds = _KINDS[data]
    triple = np.empty(len(data), np.int64)
    if len(data):
        ahead = np.concatenate((kinds[1:], [3, 3]))
        triple = kinds * 64 + ahead[: len(data)] * 8 + ahead[1 : len(data) + 1]
        for back, keep in ((1, 0), (2, 8)):  # a text's last bytes are followed by space
            last = bounds[1:] - back
            last = last[last >= bounds[:-1]]
            triple[last] = kinds[last] * 64 + (kinds[np.minimum(last + 1, len(kinds) - 1)] * keep if keep else 24) + 3
    owner = np.repeat(np.arange(len(size)), size)
    shares = np.sqrt(np.bincount(owner * 512 + triple, minlength=512 * len(size)).reshape(len(size), 512) / np.maximum(size, 1)[:, None])
    starts, ends, first = word_spans(data, bounds)
    words = span_hashes(data, starts, ends)
    n_words = np.diff(first)
    runs = np.concatenate((window_hashes(words, 3), np.zeros(min(2, len(words)), np.uint64)))
    inside = np.arange(len(words)) + 2 < np.repeat(first[1:], n_words)
    run_bounds = np.concatenate(([0], np.cumsum(inside)))[first]
    lines_at = np.flatnonzero(data == 10)
    line_starts = np.unique(np.concatenate((bounds[:-1][size > 0], lines_at + 1)))
    line_starts = line_starts[line_starts < len(data)]
    line_ends = np.minimum(np.concatenate((line_starts[1:], [len(data)])), bounds[1:][np.searchsorted(bounds[1:], line_starts, "right")] if len(line_starts) else 0)
    lines = span_hashes(data, line_starts, line_ends) if len(line_starts) else np.empty(0, np.uint64)
    line_bounds = np.searchsorted(line_starts, bounds)
    more = np.stack((
        np.log1p(n_words), row_sums(ends - starts, first) / np.maximum(n_words, 1) / 10, fresh_share(words, first),
        fresh_share(runs[inside], run_bounds), fresh_share(lines, line_bounds), np.log1p(np.diff(line_bounds)),
    ), axis=1)
    return np.concatenate((shares, more), axis=1)


def fit(features: np.ndarray, good: np.ndarray, bad_share: float, settings: Settings) -> Model:
    """The model of the texts; without both classes every text scores alike, for the class there is."""
    n, width = features.shape
    if not 0 < good.sum() < n:
        return Model(np.zeros(width), np.ones(width), np.zeros(width), float(2 - 4 * good.mean()) if n else 0.0)
    mean, spread = features.mean(axis=0), features.std(axis=0)
    spread[spread < 1e-6] = np.inf
    x = (features - mean) / spread
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    most = max(len(better), len(worse))
    a = np.tile(better[np.arange(most) % len(better)], settings.opponents)
    b = np.concatenate([np.roll(worse, k * 7919)[np.arange(most) % len(worse)] for k in range(settings.opponents)])
    difference = x[a] - x[b]
    step = 1 / (0.25 * np.linalg.norm(difference, 2) ** 2 / len(a) + settings.penalty)
    w, look, theta = np.zeros(width), np.zeros(width), 1.0
    for _ in range(settings.steps):  # accelerated gradient steps
        slope = -difference.T @ sigmoid(-difference @ look) / len(a) + settings.penalty * look
        new = look - step * slope
        theta, old = (1 + np.sqrt(1 + 4 * theta**2)) / 2, theta
        look, w = new + (old - 1) / theta * (new - w), new
    scores = x @ w
    weight = np.where(good, (1 - bad_share) / good.sum(), bad_share / (~good).sum())
    order = np.argsort(scores, kind="stable")
    reached = np.cumsum(weight[order])
    at = min(int(np.searchsorted(reached, bad_share - 1e-9)), n - 2)
    return Model(mean, spread, w, float(scores[order[at : at + 2]].mean()))


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on labelled rows outside the held-out fold; at most ``2 * per_class`` texts, in one task."""
    learn = fold(F.col("doc_id"), FOLDS) != HELD_OUT
    marked = labels.where(learn & F.col("quality").isin(0, 1))
    bad_share = marked.agg(F.avg(1.0 - F.col("quality"))).first()[0]
    bad_share = 0.5 if bad_share is None else float(bad_share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, good = [np.empty((0, N_FEATURES))], [np.empty(0, bool)]
        for chunk in text_chunks(batches, "text"):
            features.append(text_features(chunk.column("text")))
            good.append(chunk.column("label").to_numpy(zero_copy_only=False) == 1)
        m = fit(np.concatenate(features), np.concatenate(good), bad_share, settings)
        columns = [pa.array([v.tolist()], pa.list_(pa.float64())) for v in (m.mean, m.spread, m.weights)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([m.threshold])], names=["mean", "spread", "weights", "threshold"])

    sample = labelled_sample(docs, labels, "quality", learn, settings.per_class)
    models = sample.mapInArrow(run, "mean array<double>, spread array<double>, weights array<double>, threshold double").collect()
    if not models:
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), 0.0)
    m = models[0]
    return Model(np.array(m["mean"]), np.array(m["spread"]), np.array(m["weights"]), m["threshold"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` from 0 to 1, above one half beyond the threshold; null text scores as empty text."""
    kept = docs.select(*(c for c in docs.columns if c != "score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "text"):
            raw = (text_features(chunk.column("text")) - model.mean) / model.spread @ model.weights
            scores = sigmoid(raw - model.threshold)
            yield pa.RecordBatch.from_arrays([*chunk.columns, pa.array(scores)], names=[*chunk.schema.names, "score"])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())]))


def quality_scores(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs(doc_id, text)``; every row is kept, repeated ones too.

    A score of exactly one half is predicted good; null and empty texts have the features of no
    text; texts of any length are read whole. Without labels of both classes all score alike.
    Other columns are ignored; an empty table gives no rows.
    """
    model = train(docs, labels, settings)
    return score(docs.select("doc_id", F.col("text").cast("string").alias("text")), model).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
