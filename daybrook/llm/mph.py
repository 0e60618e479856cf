"""Minimal perfect hash of distinct 128-bit keys (two 64-bit words), in numpy.

Keys go to buckets of about two. Buckets, largest first, each take the smallest displacement that sends their keys to
free slots; all buckets of one size try a displacement at the same time. A bucket with a single key stores its slot
itself, marked by the top bit. ``n`` keys fill exactly the slots 0..n-1.
"""

from __future__ import annotations

import numpy as np

from daybrook.llm.common import mix64

PER_BUCKET = 2
_STEP = np.uint64(0x9E3779B97F4A7C15)
_DIRECT = np.uint32(1 << 31)


def n_buckets(n: int) -> int:
    return max(1, -(-n // PER_BUCKET))


def _bucket(h1, h2, n):
    return (mix64(h1 ^ (h2 >> np.uint64(7))) % np.uint64(n_buckets(n))).astype(np.int64)


def _slot(h1, h2, seed, n):
    with np.errstate(over="ignore"):
        return (mix64(h2 + mix64(h1 + seed * _STEP)) % np.uint64(n)).astype(np.int64)


def fingerprint(h1, h2) -> np.ndarray:
    return (mix64(h2 ^ (h1 << np.uint64(1))) >> np.uint64(32)).astype(np.uint32)


def slots(seeds: np.ndarray, h1: np.ndarray, h2: np.ndarray, n: int) -> np.ndarray:
    """Slot of each key; of a key that was not in the set, any slot."""
    if not len(h1):
        return np.empty(0, np.int64)
    seed = seeds[_bucket(h1, h2, n)]
    stored = (seed & ~_DIRECT).astype(np.int64)
    return np.where(seed >= _DIRECT, stored, _slot(h1, h2, seed.astype(np.uint64), n))


def build(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Displacement of each bucket (uint32) for distinct keys."""
    n = len(h1)
    seeds = np.zeros(n_buckets(n), np.uint32)
    if not n:
        return seeds
    bucket = _bucket(h1, h2, n)
    order = np.argsort(bucket, kind="stable")
    starts = np.searchsorted(bucket[order], np.arange(len(seeds)))
    sizes = np.diff(np.append(starts, n))
    taken = np.zeros(n, bool)
    for size in range(int(sizes.max()), 1, -1):
        todo = np.flatnonzero(sizes == size)
        keys = order[starts[todo][:, None] + np.arange(size)]  # buckets x size
        seed = 0
        while len(todo):
            at = _slot(h1[keys], h2[keys], np.uint64(seed), n)
            inner = np.sort(at, axis=1)
            fit = np.flatnonzero(~taken[at].any(axis=1) & (inner[:, 1:] != inner[:, :-1]).all(axis=1))
            if len(fit):
                # of the buckets that want the same slot the first wins
                flat = at[fit].ravel()
                _, first, back = np.unique(flat, return_index=True, return_inverse=True)
                won = (first[back] // size == np.arange(len(flat)) // size).reshape(-1, size).all(axis=1)
                fit = fit[won]
                taken[at[fit].ravel()] = True
                seeds[todo[fit]] = seed
                rest = np.ones(len(todo), bool)
                rest[fit] = False
                todo, keys = todo[rest], keys[rest]
            seed += 1
    single = np.flatnonzero(sizes == 1)
    seeds[single] = np.flatnonzero(~taken).astype(np.uint32) | _DIRECT
    return seeds
