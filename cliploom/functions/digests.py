"""SHA-1 of every pair of two lists of strings, as numpy arithmetic on tiles of pairs.

The message schedule of SHA-1 is linear over exclusive or, so it is worked out once for each
string of either list; a pair only joins the two and goes through the eighty rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

TILE = 65536   # pairs in one tile
ACROSS = 2048  # second strings in one tile, at most
_BEGIN = [np.array(x, dtype=np.uint32) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476, 0xC3D2E1F0)]
_ADDED = [np.array(x, dtype=np.uint32) for x in (0x5A827999, 0x6ED9EBA1, 0x8F1BBCDC, 0xCA62C1D6)]
_1, _2, _5, _27, _30, _31 = (np.array(x, dtype=np.uint32) for x in (1, 2, 5, 27, 30, 31))


def _schedule(messages: list[bytes]) -> np.ndarray:
    """Messages of the same whole number of 64-byte blocks as (block, round, message) words."""
    words = np.frombuffer(b"".join(messages), dtype=">u4").reshape(len(messages), -1, 16).transpose(1, 2, 0)
    out = np.empty((len(words), 80, len(messages)), dtype=np.uint32)
    out[:, :16] = words
    for t in range(16, 80):
        x = out[:, t - 3] ^ out[:, t - 8] ^ out[:, t - 14] ^ out[:, t - 16]
        out[:, t] = (x << _1) | (x >> _31)
    return out


def _rounds(state: list[np.ndarray], left: np.ndarray, right: np.ndarray, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """The eighty rounds on a tile, in place; ``left`` and ``right`` are (round, string) words."""
    a, b, c, d, e = state
    for t in range(80):
        np.bitwise_xor(left[t, :, None], right[t], out=x)
        x += _ADDED[t // 20]
        e += x
        if t < 20:
            np.bitwise_xor(c, d, out=x)
            x &= b
            x ^= d
        elif 40 <= t < 60:
            np.bitwise_xor(b, c, out=x)
            x &= d
            np.bitwise_and(b, c, out=y)
            x |= y
        else:
            np.bitwise_xor(b, c, out=x)
            x ^= d
        e += x
        np.left_shift(a, _5, out=x)
        e += x
        np.right_shift(a, _27, out=x)
        e += x
        np.left_shift(b, _30, out=x)
        b >>= _2
        b |= x
        a, b, c, d, e = e, a, b, c, d
    return [a, b, c, d, e]


def sha1_heads(firsts: list[bytes], seconds: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Tiles of ``sha1(first + second)``: the places of either and the first two 32-bit words of each pair's digest."""
    lengths, others = np.array([len(f) for f in firsts]), np.array([len(s) for s in seconds])
    for at in np.unique(lengths):
        mine, blocks = np.flatnonzero(lengths == at), (at + others + 9 + 63) // 64
        for size in np.unique(blocks):
            theirs, end = np.flatnonzero(blocks == size), int(size) * 64
            left = _schedule([firsts[i].ljust(end, b"\0") for i in mine])
            right = _schedule([(b"\0" * int(at) + seconds[j] + b"\x80").ljust(end - 8, b"\0") + int(8 * (at + others[j])).to_bytes(8, "big") for j in theirs])
            across = min(len(theirs), ACROSS)
            down = max(1, TILE // across)
            for j in range(0, len(theirs), across):
                cols = theirs[j : j + across]
                for i in range(0, len(mine), down):
                    rows = mine[i : i + down]
                    x, y, *state = np.empty((7, len(rows), len(cols)), dtype=np.uint32)
                    for part, value in zip(state, _BEGIN):
                        part[...] = value
                    for block in range(int(size)):
                        before = [part.copy() for part in state] if block else _BEGIN
                        state = _rounds(state, left[block, :, i : i + down], right[block, :, j : j + across], x, y)
                        for part, value in zip(state, before):
                            part += value
                    yield rows, cols, state[0], state[1]
