"""Word and shingle hashes of many texts at once, from their UTF-8 bytes.

A word is a maximal run of bytes outside [\\x20\\x09-\\x0D] with A-Z lower-cased. Its hash is a
polynomial of its bytes modulo 2**64, read off a running sum over the whole slice, so no Python
loop runs per word. A shingle is ``k`` consecutive words of one text; a text with fewer words has
one shingle of all of them, a text without words has none.
"""

from __future__ import annotations

import numpy as np

from .common import SPACE_BYTES

BASE = 0x9E3779B97F4A7C15                                   # odd, so it has an inverse mod 2**64
_UNBASE = pow(BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_LOWER += np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[list(SPACE_BYTES)] = True
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (kept, grown by doubling)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads every input bit over the word."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans(data: np.ndarray, offs: np.ndarray, gap: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the first word of each text (with the total last).

    ``gap`` marks the bytes between words.
    """
    word = ~gap[data]
    start, end = word.copy(), word.copy()
    start[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    edge = offs[1:-1][(offs[1:-1] > 0) & (offs[1:-1] < len(data))]
    start[edge] = word[edge]                                # words never cross texts
    end[edge - 1] = word[edge - 1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(s, offs)


def running(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums of the lower-cased bytes; see ``span_hash``."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LOWER[data] * powers(BASE, len(data)), out=out[1:])
    return out


def span_hash(sums: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hash of the bytes from s to e, wherever they stand."""
    return mix((sums[e] - sums[s]) * powers(_UNBASE, len(sums))[s])


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s, e, first = spans(data, offs)
    return span_hash(running(data), s, e), first


def shingle_hashes(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts in order, and the offset of each text's first one."""
    w, first = word_hashes(data, offs)
    n = np.diff(first)
    count = np.where(n > 0, np.maximum(n - k + 1, 1), 0)
    at = np.concatenate(([0], np.cumsum(count)))
    doc = np.repeat(np.arange(len(n)), count)
    s = np.arange(at[-1]) - at[doc] + first[doc]
    left = np.minimum(n, k)[doc]
    out = left.astype(np.uint64)
    for j in range(k):
        step = np.uint64(pow(BASE, j + 1, 1 << 64))
        idx = np.minimum(s + j, max(len(w) - 1, 0))
        out = out + np.where(j < left, w[idx] * step, np.uint64(0)) if len(w) else out
    return mix(out), at
