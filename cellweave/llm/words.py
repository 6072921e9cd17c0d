"""Words of a text as 64-bit numbers, computed over whole byte arrays."""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32

U = np.uint64
CHUNK = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """Finishing steps that spread every bit over all others; one to one."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(29))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(32))


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    up = np.full(CHUNK, _BASE, U)
    down = np.full(CHUNK, pow(_BASE, -1, 1 << 64), U)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _long_word(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")


def spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``."""
    edge = np.ones(len(data) + 2, bool)
    edge[1:-1] = SPACE[data]
    at = np.flatnonzero(edge[1:] != edge[:-1])
    return at[::2], at[1::2]


def word_hashes(text: bytes, fold: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word. ``fold`` lower-cases A-Z first.

    Hashes are of the whole word. Long texts are handled in pieces that end between words; a word longer than a piece is
    hashed on its own.
    """
    data = np.frombuffer(text, np.uint8)
    if fold:
        data = FOLD[data]
    starts, ends = spans(data)
    out = np.empty(len(starts), U)
    up, down = _powers()
    first = 0
    while first < len(starts):
        base = starts[first]
        last = int(np.searchsorted(ends, base + CHUNK, "right"))
        if last <= first:
            out[first] = _long_word(data[base : ends[first]].tobytes())
            first += 1
            continue
        piece = data[base : ends[last - 1]]
        total = np.zeros(len(piece) + 1, U)
        np.cumsum((piece.astype(U) + U(1)) * up[: len(piece)], out=total[1:])
        s, e = starts[first:last] - base, ends[first:last] - base
        out[first:last] = mix((total[e] - total[s]) * down[s] + (e - s).astype(U))
        first = last
    return out, starts, ends


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct runs of ``size`` words, sorted; a shorter text is one run, a text without words has none."""
    if not len(words):
        return words
    return np.unique(runs(words, min(size, len(words))))


def runs(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, in order."""
    n = len(words) - size + 1
    if n <= 0:
        return words[:0]
    total = words[:n].copy()
    for i in range(1, size):
        total = total * U(0xD6E8FEB86659FD93) + words[i : i + n]
    return mix(total + U(size))
