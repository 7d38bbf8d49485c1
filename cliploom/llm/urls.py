"""URL filter: rules first, then logistic regression on hashed character n-grams of host and path."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cliploom.llm.labelled import row_sums, sigmoid
from cliploom.llm.ngrams import held_ngrams

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Settings:
    orders: tuple[int, ...] = (1, 2, 3, 4)
    bits: int = 14
    #: Labelled rows of each class that the fit reads at most.
    per_class: int = 3000
    penalty: float = 1e-4
    steps: int = 200


def host_of(url: Column) -> Column:
    """From behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def with_rule(pages: DataFrame, rules: dict[str, str]) -> DataFrame:
    """``pages(url)`` with host, path, the longest fitting rule and its verdict, both null if none fits.

    A rule ``host/path`` fits that host and its subdomains where the path starts with the rule's.
    Rules are settings, tried one by one, longest first.
    """
    found = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule = F.lit(None).cast("string")
    for text in sorted(rules, key=len):
        host, slash, start = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + start)
        rule = F.when(fits, text).otherwise(rule)
    found = found.withColumn("rule", rule)
    ruled = F.lit(None).cast("string")
    for text, verdict in rules.items():
        ruled = F.when(F.col("rule") == text, verdict).otherwise(ruled)
    return found.withColumn("ruled", ruled)


def url_ngrams(host: pa.Array, path: pa.Array, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of the hosts, then of the paths; a row's lie between bounds 2 r and 2 r + 2."""
    a, ab = held_ngrams(host, settings.orders, settings.bits)
    b, bb = held_ngrams(path, settings.orders, settings.bits)
    sizes = np.stack((np.diff(ab), np.diff(bb)), axis=1).ravel()
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    merged = np.empty(len(a) + len(b), np.int64)
    host_part = np.repeat(np.arange(len(sizes)) % 2 == 0, sizes)
    merged[host_part], merged[~host_part] = a, b + (1 << settings.bits)
    return merged, bounds[::2]


def fit(features: np.ndarray, bounds: np.ndarray, label: np.ndarray, settings: Settings) -> tuple[np.ndarray, float]:
    """Weights and constant of the probability to block; without both classes a constant."""
    width, rows = 2 << settings.bits, np.repeat(np.arange(len(label)), np.diff(bounds))
    w, constant = np.zeros(width), 0.0
    if not 0 < label.sum() < len(label):
        return w, float(4 * np.sign(2 * label.mean() - 1)) if len(label) else -4.0
    step = 4.0 / max(1.0, float(np.diff(bounds).mean()))
    look, look_c, theta = w.copy(), 0.0, 1.0
    for _ in range(settings.steps):
        error = (sigmoid(row_sums(look[features], bounds) + look_c) - label) / len(label)
        new = look - step * (np.bincount(features, error[rows], width) + settings.penalty * look)
        new_c = look_c - step * error.sum()
        theta, old = (1 + np.sqrt(1 + 4 * theta**2)) / 2, theta
        look, look_c = new + (old - 1) / theta * (new - w), new_c + (old - 1) / theta * (new_c - constant)
        w, constant = new, new_c
    return w, float(constant)


def train(labelled: DataFrame, settings: Settings = Settings()) -> tuple[np.ndarray, float]:
    """Fit on ``labelled(host, path, verdict)``; at most ``per_class`` distinct addresses of each verdict, in one task."""
    rows = None
    for verdict in ("allow", "block"):
        some = labelled.where(F.col("verdict") == verdict).select("host", "path", F.lit(float(verdict == "block")).alias("label")).distinct()
        some = some.orderBy(F.xxhash64("host", "path"), "host", "path").limit(settings.per_class)
        rows = some if rows is None else rows.union(some)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = list(batches)
        host, path, label = (pa.concat_arrays([x.column(c) for x in rows]) if rows else pa.array([], kind) for c, kind in (("host", pa.string()), ("path", pa.string()), ("label", pa.float64())))
        weights, constant = fit(*url_ngrams(host, path, settings), label.to_numpy(zero_copy_only=False), settings)
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary()), pa.array([constant])], names=["weights", "constant"])

    found = rows.coalesce(1).mapInArrow(run, "weights binary, constant double").collect()
    return (np.frombuffer(found[0]["weights"]), found[0]["constant"]) if found else (np.zeros(2 << settings.bits), -4.0)


def judge(pages: DataFrame, rules: dict[str, str], labelled: DataFrame | None = None, settings: Settings = Settings()) -> DataFrame:
    """``pages(page_id, url)`` with host, path, rule, verdict and the model's ``score`` to block.

    ``labelled(url, verdict)`` is the labelled table; without one, the addresses that a rule
    decides teach the model about those that none does. With nothing to learn from, pages
    outside all rules are allowed. Every row is kept, repeated ones too; a null address has an
    empty host and path; addresses of any length are read whole. A score of exactly one half
    blocks. Other columns are ignored; an empty table gives no rows.
    """
    ruled = with_rule(pages.select("page_id", "url"), rules)
    if labelled is None:
        known = ruled.where("rule is not null").select("host", "path", F.col("ruled").alias("verdict"))
    else:
        known = labelled.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "verdict")
    weights, constant = train(known, settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, bounds = url_ngrams(batch.column("host"), batch.column("path"), settings)
            scores = sigmoid(row_sums(weights[features], bounds) + constant)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, "score"])

    scored = ruled.mapInArrow(run, T.StructType([*ruled.schema.fields, T.StructField("score", T.DoubleType())]))
    own = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "url", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "score")
