"""XXH64 of many byte spans at once, with numpy.

The published algorithm (64-bit, any seed), run over all spans side by side:
each step reads the next bytes of every span that still has them.
"""

from __future__ import annotations

import numpy as np

# Fixed values of the XXH64 specification.
P1 = np.uint64(11400714785074694791)
P2 = np.uint64(14029467366897019727)
P3 = np.uint64(1609587929392839161)
P4 = np.uint64(9650029242287828579)
P5 = np.uint64(2870177450012600261)

SEED = 42


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * P2, 31) * P1


def xxh64_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = SEED) -> np.ndarray:
    """The hash of ``buf[start[i]:end[i]]`` for every i (``buf`` is uint8)."""
    with np.errstate(over="ignore"):
        return _hash(buf, start.astype(np.int64), end.astype(np.int64), np.uint64(seed))


def _hash(buf, start, end, seed):
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    n = len(padded) - 7
    lanes8 = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (n,), (1,))
    lanes4 = np.lib.stride_tricks.as_strided(padded[:4].view("<u4"), (n,), (1,))
    # as_strided keeps no reference by itself to a temporary: hold the buffer
    size = end - start
    at = start.copy()
    h = np.full(len(start), seed + P5, np.uint64)

    long = np.flatnonzero(size >= 32)
    if len(long):
        v = [np.full(len(long), seed + P1 + P2, np.uint64), np.full(len(long), seed + P2, np.uint64),
             np.full(len(long), seed, np.uint64), np.full(len(long), seed - P1, np.uint64)]
        left = size[long] // 32
        order = np.argsort(-left, kind="stable")
        long, left = long[order], left[order]
        done = 0
        while True:
            m = int(np.searchsorted(-left, -done, "left"))  # those with more than `done` stripes
            if not m:
                break
            p = at[long[:m]] + 32 * done
            for k in range(4):
                v[k][:m] = _round(v[k][:m], lanes8[p + 8 * k])
            done += 1
        x = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
        for k in range(4):
            x = (x ^ _round(np.zeros_like(v[k]), v[k])) * P1 + P4
        h[long] = x
        at[long] += 32 * left
    h += size.astype(np.uint64)

    for _ in range(3):
        i = np.flatnonzero(end - at >= 8)
        if not len(i):
            break
        lane = lanes8[at[i]]
        h[i] = _rotl(h[i] ^ _round(np.zeros_like(lane), lane), 27) * P1 + P4
        at[i] += 8
    i = np.flatnonzero(end - at >= 4)
    h[i] = _rotl(h[i] ^ (lanes4[at[i]].astype(np.uint64) * P1), 23) * P2 + P3
    at[i] += 4
    for _ in range(3):
        i = np.flatnonzero(end - at >= 1)
        if not len(i):
            break
        h[i] = _rotl(h[i] ^ (padded[at[i]].astype(np.uint64) * P5), 11) * P1
        at[i] += 1
    h ^= h >> np.uint64(33)
    h *= P2
    h ^= h >> np.uint64(29)
    h *= P3
    h ^= h >> np.uint64(32)
    return h
