"""Word shingles of whole texts as 64-bit hashes, in vectorised passes over the UTF-8 bytes."""

from __future__ import annotations

import numpy as np

SLICE = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_rng = np.random.Generator(np.random.PCG64(20240601))
BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
GAP = np.zeros(256, dtype=bool)
GAP[[0x20, *range(0x09, 0x0E)]] = True
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """BASE^i and INVERSE^i for i < n, modulo 2^64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, INVERSE)):
            steps = np.full(max(n, 2 * len(_powers[0])), base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _slice_words(raw: bytes) -> np.ndarray:
    data = np.frombuffer(raw, dtype=np.uint8)
    inside = np.empty(len(data) + 2, dtype=bool)
    inside[0] = inside[-1] = False
    np.logical_not(GAP[data], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE[data] * up[:len(data)], out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: bytes | None) -> np.ndarray:
    """A hash of each word ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased."""
    low = (text or b"").lower()
    if len(low) <= SLICE:
        return _slice_words(low)
    out, at = [], 0
    while at < len(low):
        end = min(at + SLICE, len(low))
        while end < len(low) and not GAP[low[end]]:  # slices end at a gap
            end += 1
        out.append(_slice_words(low[at:end]))
        at = end
    return np.concatenate(out)


def shingles(text: bytes | None, n: int) -> np.ndarray:
    """The sorted distinct hashes of the text's n-word shingles; fewer words count as one shingle."""
    words = word_hashes(text)
    if not len(words):
        return words
    size = min(n, len(words))
    out = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        out = out * BASE + words[k:len(words) - size + 1 + k]
    return np.unique(mixed(out))


def share(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(size of the intersection, size of the union) of two shingle sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both, len(a) + len(b) - both
