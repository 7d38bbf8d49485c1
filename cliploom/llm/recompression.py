"""Substring deduplication by recompression.

Rounds rename a word sequence: adjacent equal symbols become one run symbol, then every pair of
a left-class and a right-class symbol becomes one pair symbol, classes being a bit of the
name. Names are hashes of what they stand for, so all tasks name alike, and equal substrings
get equal symbols except near their ends. For every window the symbols that its own words
determine are known exactly; one of them, chosen by the window's content alone, is its anchor.

Equal windows have equal anchors in equal places. Spark counts anchors (with a few words around
them) over all texts. Where an anchor is shared, stretches of windows around it are compared as
wholes; where the wholes differ, window by window, each by two independent hashes of its words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cliploom.llm.graph import written
from cliploom.llm.words import mix, powers, text_chunks, text_words, window_hashes

WIDTH = 35
#: Words on each side of an anchor that must agree, too, and rounds of renaming.
CONTEXT, ROUNDS = 4, 2
_SECOND = np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Level:
    """Symbols of one round: their first words (and the end), names, texts, and each window's determined ones."""

    start: np.ndarray
    name: np.ndarray
    text: np.ndarray
    low: np.ndarray
    high: np.ndarray


def renamed_runs(x: Level) -> Level:
    """Maximal runs of equal symbols become one; a window's first and last run may go on outside it."""
    head = np.ones(len(x.name), bool)
    head[1:] = (x.name[1:] != x.name[:-1]) | (x.text[1:] != x.text[:-1])
    run = np.cumsum(head) - 1
    at = np.flatnonzero(head)
    length = np.diff(np.append(at, len(head)))
    name = np.where(length > 1, mix(x.name[at] * np.uint64(0xA24BAED4963EE407) + length.astype(np.uint64)), x.name[at])
    last = len(run) - 1
    return Level(np.append(x.start[at], x.start[-1]), name, x.text[at], run[np.minimum(x.low, last)] + 1, run[np.clip(x.high - 1, 0, last)])


def renamed_pairs(x: Level, turn: int) -> Level:
    """Left-class symbols with right-class ones behind them become one; at a window's ends a partner may lie outside it."""
    right = (mix(x.name + np.uint64((turn + 1) * 0x9FB21C651E98DF25 % 2**64)) & np.uint64(1)).astype(bool)
    first = np.zeros(len(right), bool)
    first[:-1] = ~right[:-1] & right[1:] & (x.text[1:] == x.text[:-1])
    head = np.ones(len(right), bool)
    head[1:] = ~first[:-1]
    at = np.flatnonzero(head)
    pair = first[at]
    name = x.name[at].copy()
    name[pair] = mix(name[pair] * np.uint64(0x8CB92BA72F3D8DD7) ^ mix(x.name[at[pair] + 1]))
    new, last = np.cumsum(head) - 1, len(right) - 1
    low = x.low + right[np.minimum(x.low, last)]
    high = x.high - ~right[np.clip(x.high - 1, 0, last)]
    empty = low >= high
    low, high = new[np.minimum(low, last)], new[np.clip(high - 1, 0, last)] + 1
    high[empty] = low[empty]
    return Level(np.append(x.start[at], x.start[-1]), name, x.text[at], low, high)


def least_places(value: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Place of the smallest value, the first of equals, in each non-empty range."""
    best, k = [np.arange(len(value))], 1
    longest = int((high - low).max(initial=1))
    while 2 * k <= longest:
        a = best[-1][: len(value) - 2 * k + 1]
        b = best[-1][k : len(value) - k + 1]
        best.append(np.where(value[a] <= value[b], a, b))
        k *= 2
    size = np.frexp((high - low).astype(np.float64))[1] - 1
    out = np.empty(len(low), np.int64)
    for j in np.unique(size):
        own = np.flatnonzero(size == j)
        a, b = best[j][low[own]], best[j][high[own] - (1 << j)]
        out[own] = np.where(value[a] <= value[b], a, b)
    return out


def stretches(words: np.ndarray, first: np.ndarray, width: int = WIDTH, context: int = CONTEXT, rounds: int = ROUNDS) -> tuple[np.ndarray, ...]:
    """Stretches of successive windows with one anchor: text, first window, windows, anchor's hash, hash of all their words."""
    n_words = np.diff(first)
    text = np.repeat(np.arange(len(n_words)), n_words)
    total = len(words)
    windows = np.flatnonzero(np.arange(total) + width <= first[1:][text]) if total else np.empty(0, np.int64)
    if not len(windows):
        return tuple(np.empty(0, kind) for kind in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    levels = [Level(np.arange(total + 1), words, text, windows, windows + width)]
    for turn in range(rounds):
        levels.append(renamed_pairs(renamed_runs(levels[-1]), turn))
    up, down = powers(total + 1)
    summed = np.zeros(total + 1, np.uint64)
    np.cumsum(words * up[:-1], out=summed[1:])
    spell = lambda a, b, salt: mix((summed[b] - summed[a]) * down[a] + salt)
    anchor_from, anchor_hash = np.empty(len(windows), np.int64), np.empty(len(windows), np.uint64)
    left = np.arange(len(windows))
    for depth in range(rounds, -1, -1):
        x, at = levels[depth], windows[left]
        starts = np.zeros(total + 2, np.int64)
        starts[x.start + 1] = 1
        starts = np.cumsum(starts)  # symbols that begin before each word; the end counts as one
        low = np.maximum(x.low[left], starts[at + context])
        high = np.minimum(x.high[left], starts[at + width - context + 1] - 1)
        some = low < high
        own = left[some]
        if len(own):
            symbol = least_places(mix(x.name ^ np.uint64(depth + 1)), low[some], high[some])
            a, b = x.start[symbol] - context, x.start[symbol + 1] + context
            anchor_from[own] = a * (rounds + 1) + depth
            anchor_hash[own] = spell(a, b, (b - a).astype(np.uint64) * np.uint64(rounds + 1) + np.uint64(depth))
        left = left[~some]
    new = np.ones(len(windows), bool)
    new[1:] = (anchor_from[1:] != anchor_from[:-1]) | (windows[1:] != windows[:-1] + 1)
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(new)))
    begin = windows[at]
    return text[begin], begin - first[text[begin]], count, anchor_hash[at], spell(begin, begin + count + width - 1, count.astype(np.uint64))


def anchors(texts: DataFrame, width: int) -> DataFrame:
    """``name, whole, key, bytes, at, n``: the stretches of every row of ``texts(key, bytes, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "text"):
            text, at, count, name, whole = stretches(*text_words(chunk.column("text")), width=width, context=min(CONTEXT, (width - 1) // 2))
            own = pa.array(text)
            yield pa.RecordBatch.from_arrays([
                pa.array(name.view(np.int64)), pa.array(whole.view(np.int64)), chunk.column("key").take(own), chunk.column("bytes").take(own),
                pa.array(at), pa.array(count.astype(np.int32)),
            ], names=["name", "whole", "key", "bytes", "at", "n"])

    return texts.select("key", "bytes", "text").mapInArrow(run, "name long, whole long, key long, bytes int, at long, n int")


def window_rows(texts: DataFrame, width: int) -> DataFrame:
    """``one, two, key, bytes, at``: two hashes of each window of ``texts(key, bytes, text, ranges)`` that the ranges name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "text"):
            words, first = text_words(chunk.column("text"))
            one, two = window_hashes(words, width), window_hashes(mix(words ^ _SECOND), width)
            ranges = chunk.column("ranges")
            begin = ranges.flatten().field("at").to_numpy(zero_copy_only=False)
            count = ranges.flatten().field("n").to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(chunk.num_rows), ranges.value_lengths().to_numpy(zero_copy_only=False))
            row = np.repeat(owner, count)
            at = np.arange(count.sum()) + np.repeat(begin - np.cumsum(count) + count, count)
            place = first[row] + at
            own = pa.array(row)
            yield pa.RecordBatch.from_arrays([
                pa.array(one[place].view(np.int64)), pa.array(two[place].view(np.int64)), chunk.column("key").take(own), chunk.column("bytes").take(own), pa.array(at),
            ], names=["one", "two", "key", "bytes", "at"])

    return texts.mapInArrow(run, "one long, two long, key long, bytes int, at long")


_BY_TEXT = ["key", "bytes"]


def ranges_of(rows: DataFrame) -> DataFrame:
    """The distinct ranges of each text as one list."""
    return rows.select(*_BY_TEXT, "at", "n").distinct().groupBy(*_BY_TEXT).agg(F.collect_list(F.struct("at", "n")).alias("ranges"))


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with ``n_words, n_removed, kept_sha256`` and the text without its repeated words.

    A word goes if a window of ``width`` words that holds it also starts anywhere else, in the
    same text or another row. Kept words are joined by single spaces; a text that loses nothing
    stays as it is. Null text has no words and stays null. Repeated rows repeat each other; an
    empty table gives no rows; other columns are carried along, whatever their names, but for
    those three, which become the result's.
    """
    if width < 2:
        raise ValueError("width must be 2 at least")
    results = ["n_words", "n_removed", "kept_sha256"]
    carried = [c for c in docs.columns if c not in ("text", *results)]
    own = F.struct(*(F.col(f"`{c}`") for c in carried)) if carried else F.lit(None)
    texts = docs.select(own.alias("own"), "text", F.xxhash64("text").alias("key"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes"))
    found = written(anchors(texts, width), "anchors")
    # counts are written before they meet the rows again, so that joins on frequent names can be split
    shared = written(found.groupBy("name").agg(F.count("*").alias("c")).where("c > 1").select("name"), "shared-names")
    hits = written(found.join(shared, "name", "left_semi"), "shared-anchors")
    wholes = written(hits.groupBy("name", "whole").agg(F.count("*").alias("c"), F.min(F.struct("key", "bytes", "at", "n")).alias("one")), "wholes")
    sure = hits.join(wholes.where("c > 1").select("name", "whole"), ["name", "whole"], "left_semi")
    # anchors whose stretches differ: one of each kind is taken apart into its windows
    mixed = written(wholes.groupBy("name").agg(F.count("*").alias("kinds")).where("kinds > 1").select("name"), "mixed-names")
    apart = ranges_of(wholes.join(mixed, "name", "left_semi").select("one.*"))
    windows = window_rows(texts.join(apart, _BY_TEXT), width)
    place = F.xxhash64(*_BY_TEXT, "at")  # rows of equal text name the same places
    twice = windows.groupBy("one", "two").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low <> high").select("one", "two")
    single = windows.join(twice, ["one", "two"], "left_semi").select(*_BY_TEXT, "at", F.lit(1).alias("n"))
    gone = ranges_of(sure.select(*_BY_TEXT, "at", "n").union(single))
    fields = [*texts.select("own", "text").schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "text"):
            n_words, n_removed, digests, kept_texts = [], [], [], []
            for raw, ranges in zip(chunk.column("text").cast(pa.large_binary()).to_pylist(), chunk.column("ranges"), strict=True):
                words = (raw or b"").split()
                kept = words
                if ranges.is_valid:
                    at = ranges.values.field("at").to_numpy(zero_copy_only=False)
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, at, 1)
                    np.subtract.at(edge, at + ranges.values.field("n").to_numpy(zero_copy_only=False) + width - 1, 1)
                    kept = list(compress(words, (np.cumsum(edge[:-1]) == 0).tolist()))
                joined = b" ".join(kept)
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                digests.append(hashlib.sha256(joined).hexdigest())
                kept_texts.append(raw if len(kept) == len(words) else joined)
            text = pa.array(kept_texts, pa.large_binary()).cast(pa.large_string()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([chunk.column("own"), text, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())], names=["own", "text", *results])

    out = texts.join(gone, _BY_TEXT, "left").mapInArrow(cut, T.StructType(fields))
    return out.select(*("text" if c == "text" else F.col(f"own.`{c}`").alias(c) for c in docs.columns if c not in results), *results)


REPEATS_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), starts AS (
  SELECT doc_id, unnest(range(1, len(w) - 33)) AS i, w FROM words WHERE len(w) >= 35
), keyed AS (
  SELECT doc_id, i, md5_number(array_to_string(w[i : i + 34], ' ')) AS h FROM starts
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS c FROM keyed) WHERE c > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM again
), lost AS (
  SELECT doc_id, list(j) AS js FROM gone GROUP BY doc_id
), kept AS (
  SELECT words.doc_id, len(w) AS n, CASE WHEN js IS NULL THEN w
    ELSE list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(js, x[2])), lambda x: x[1]) END AS k
  FROM words LEFT JOIN lost USING (doc_id)
)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n - len(k) AS BIGINT) AS n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept
"""
