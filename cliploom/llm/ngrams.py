"""Hashed character n-grams of whole texts as numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from cliploom.llm.words import utf8_bytes


def characters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts on end, A-Z in lower case, and the n + 1 bounds of the texts."""
    data, bounds = utf8_bytes(texts, lower=True)
    try:
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
    except UnicodeDecodeError:  # text by text, so that broken bytes do not shift the others
        each = [data[a:b].tobytes().decode("utf-8", "replace").encode("utf-32-le") for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return np.frombuffer(b"".join(each), "<u4"), np.cumsum([0, *(len(x) // 4 for x in each)])
    lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return points, lead[bounds]


def held_ngrams(texts: pa.Array, orders: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed n-grams of each text, text after text, and the n + 1 bounds of the texts."""
    points, bounds = characters(texts)
    text_of = np.repeat(np.arange(len(bounds) - 1, dtype=np.uint64), np.diff(bounds))
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(points))  # characters to the text's end
    keys = []
    rolled = np.zeros(len(points), np.uint32)
    for k in range(max(orders)):
        n = max(0, len(points) - k)
        rolled = (rolled[:n] ^ points[k : k + n]) * np.uint32(0x9E3779B1)
        rolled ^= rolled >> np.uint32(15)
        if k + 1 in orders:
            inside = left[:n] > k
            hashed = ((rolled * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits)).astype(np.uint64)
            keys.append(((text_of[:n] << np.uint64(bits)) | hashed)[inside])
    keys = np.concatenate(keys)
    if len(bounds) <= 1 << (32 - bits):
        keys = keys.astype(np.uint32)
    keys.sort()
    keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys
    cuts = np.searchsorted(keys, (np.arange(len(bounds), dtype=np.uint64) << np.uint64(bits)).clip(max=np.iinfo(keys.dtype).max).astype(keys.dtype))
    cuts[-1] = len(keys)
    return (keys & keys.dtype.type((1 << bits) - 1)).astype(np.int64), cuts
