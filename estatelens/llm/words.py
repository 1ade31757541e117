"""Vectorised words of byte buffers: bounds and 64-bit hashes, no loop per word."""

from __future__ import annotations

import numpy as np

#: Bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` after A-Z is lower-cased: digits, letters, all of a non-ASCII character.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Bytes of `[^\x20\x09-\x0D]`.
SOLID = np.ones(256, bool)
SOLID[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)
_CHUNK = 1 << 20
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i <= n."""
    if len(_powers.get("up", ())) <= n:
        size = max(n, _CHUNK) + 1
        for name, base in (("up", _BASE), ("down", _BACK)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit sums."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end), ascending and not nested, a bounded piece at a time."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = int(np.searchsorted(ends, starts[i] + _CHUNK, "right"))
        j = max(j, i + 1)
        lo, hi = int(starts[i]), int(ends[j - 1])
        up, down = powers(hi - lo)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((buf[lo:hi].astype(np.uint64) + np.uint64(1)) * up[:hi - lo], out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mixed((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def word_bounds(buf: np.ndarray, off: np.ndarray, kind: np.ndarray):
    """(starts, ends, first word of each document plus the total) of the words of each document."""
    if not len(buf):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(off), np.int64)
    inside = kind[buf]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    cuts = off[1:-1]
    cuts = cuts[cuts < len(buf)]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[cuts[cuts > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


def gram_hashes(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the k-word runs that lie inside one document."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = total * np.uint64(_BASE) + h[j:j + n]
    left = np.repeat(first[1:], np.diff(first))[:n] - np.arange(n)  # words to the document's end
    at = np.flatnonzero(left >= k)
    return at, mixed(total[at])
