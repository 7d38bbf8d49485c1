"""Bounded samples of labelled documents, and logistic fits on them in one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int) -> DataFrame:
    """``text, label`` of at most ``per_class`` rows of each class, in one partition.

    Ids with a 0 or 1 in ``labels`` for which ``learn`` holds are taken in the order of a hash,
    then so are the documents' rows, so repeated ids cannot widen the sample.
    """
    ids = labels.where(learn & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("label"))
    rows = None
    for value in (0, 1):
        some = ids.where(F.col("label") == value).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        # at most per_class ids
        own = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("text", "label", "doc_id")
        own = own.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(per_class)
        rows = own if rows is None else rows.union(own)
    return rows.select("text", "label").coalesce(1)


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values between each two bounds; 0 for empty stretches."""
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))
