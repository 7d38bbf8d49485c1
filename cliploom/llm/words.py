"""Words and their hashes as numpy arrays over whole Arrow text buffers.

A word is a maximal run of bytes other than space and ``\\t \\n \\v \\f \\r``, so UTF-8 text
needs no decoding. Hashes are functions of the content alone, equal in every task.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; a longer text is one chunk of its own.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 .. n - 1 of the hash base and of its inverse, kept for the next call."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, min(2 * n, 2 * CHUNK_BYTES))
        up, down = np.full(size, _BASE), np.full(size, _BASE_INVERSE)
        up[0] = down[0] = 1
        _powers = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


_tools: dict[Hashable, Any] = {}


def tool(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` builds, kept for the worker's next task; a worker keeps the tool of one operator at a time."""
    if key not in _tools:
        make_room()
        _tools[key] = make()
    return _tools[key]


def make_room() -> None:
    """Drop the tool of another operator that this worker ran before, and give free memory back."""
    _tools.clear()
    release()


def release() -> None:
    """Give memory that a finished task leaves behind back to the system; workers outlive tasks and stages."""
    global _powers
    _powers = np.ones(1, np.uint64), np.ones(1, np.uint64)
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library keeps its own account
        pass


def text_chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of at most ``limit`` bytes of text, one row at least; behind the last one memory is released."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to
    release()


def utf8_bytes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts on end and the n + 1 bounds of the texts; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]] if raw is not None and raw.size else np.empty(0, np.uint8)
    return (_LOWER[data] if lower else data), bounds - bounds[0]


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and past-the-end byte of each word, and for each text the index of its first word (n + 1 values)."""
    inside = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    before = np.concatenate(([False], inside[:-1]))
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.concatenate((inside[1:], [False])) if len(data) else inside
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each position on; positions near the end have none."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = powers(len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[:-1], out=total[1:])
    return mix((total[width:] - total[:n]) * down[:n])


def text_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts on end, and for each text the index of its first word (n + 1 values)."""
    data, bounds = utf8_bytes(texts, lower)
    starts, ends, first = word_spans(data, bounds)
    return span_hashes(data, starts, ends), first
