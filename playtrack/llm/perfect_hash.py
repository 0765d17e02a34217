"""Minimal perfect hashes of byte strings, with the keys stored for verification.

Hash and displace: the 64-bit hashes of ``n`` keys fall into about ``n / 4``
buckets; from the largest bucket on, a displacement is searched that sends all
keys of the bucket to free slots of ``0 .. n - 1``.  Single keys take the slots
that are left.  Keys that share their 64-bit hash cannot be told apart by any
displacement, so the hash's seed is changed until none do.
"""

from __future__ import annotations

from itertools import count

import numpy as np

FIRST_SEED = 42
_PER_BUCKET = 4
_TRIES = 1 << 14
_AT_ONCE = 64
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def hashes(keys: list[bytes], seed: int = FIRST_SEED) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.fromiter((xxh64_intdigest(k, seed) for k in keys), np.uint64, len(keys))


def _buckets(n: int) -> int:
    return -(-n // _PER_BUCKET)


def _bucket_of(h: np.ndarray, n) -> np.ndarray:
    return (h >> np.uint64(20)) % np.maximum(-(-n // _PER_BUCKET), 1).astype(np.uint64)


def _slot(h: np.ndarray, displacement: np.ndarray, n) -> np.ndarray:
    x = (h ^ (displacement.astype(np.uint64) * _MULTIPLIER)) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(29))) % np.maximum(n, 1).astype(np.uint64)


def build(keys: list[bytes]) -> tuple[int, np.ndarray, list[bytes]]:
    """``(seed, displacements, keys in the order of their slots)`` of distinct keys.

    A displacement of ``-1 - s`` sends its bucket's only key to slot ``s``.
    """
    for seed in count(FIRST_SEED):
        h = hashes(keys, seed)
        if len(np.unique(h)) == len(h) and (found := _displaced(h)) is not None:
            displacements, slots = found
            placed: list[bytes] = [b""] * len(keys)
            for key, slot in zip(keys, slots.tolist(), strict=True):
                placed[slot] = key
            return seed, displacements, placed
    raise AssertionError("unreachable")


def _displaced(h: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    n = len(h)
    total = np.int64(n)
    bucket = _bucket_of(h, total).astype(np.int64) if n else np.zeros(0, np.int64)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=_buckets(n))
    starts = np.cumsum(sizes) - sizes
    free = np.ones(n, bool)
    displacements, slots = np.zeros(_buckets(n), np.int32), np.zeros(n, np.int64)
    by_size = np.argsort(-sizes, kind="stable")
    for b in by_size[:int((sizes > 1).sum())].tolist():
        own = order[starts[b]:starts[b] + sizes[b]]
        for low in range(0, _TRIES, _AT_ONCE):
            tried = np.arange(low, low + _AT_ONCE)
            at = _slot(h[own][None, :], tried[:, None], total).astype(np.int64)
            inside = np.sort(at, axis=1)
            good = free[at].all(axis=1) & (inside[:, 1:] != inside[:, :-1]).all(axis=1)
            if good.any():
                i = int(good.argmax())
                displacements[b], slots[own], free[at[i]] = low + i, at[i], False
                break
        else:
            return None
    left = np.flatnonzero(free)
    single = np.flatnonzero(sizes == 1)
    displacements[single] = -1 - left
    slots[order[starts[single]]] = left
    return displacements, slots


class ShardedHash:
    """Many perfect hashes side by side: shard ``i`` has ``sizes[i]`` slots from ``bases[i]`` on."""

    def __init__(self, shards: list[tuple[int, np.ndarray, list[bytes]]]):
        """Shards in order; a key's shard is ``shard_of`` its hash."""
        self.sizes = np.array([len(keys) for _, _, keys in shards], np.int64)
        self.bases = np.cumsum(self.sizes) - self.sizes
        self.seeds = [seed for seed, _, _ in shards]
        counts = np.array([len(d) for _, d, _ in shards], np.int64)
        self.first = np.cumsum(counts) - counts
        self.displacements = np.concatenate([np.zeros(0, np.int32), *(d for _, d, _ in shards)])
        self.keys = [k for _, _, keys in shards for k in keys]

    def slots(self, keys: list[bytes]) -> np.ndarray:
        """Slot of every key over all shards; -1 for a key that is not the one stored in its slot."""
        if not len(self.sizes) or not keys:
            return np.full(len(keys), -1, np.int64)
        h = hashes(keys)
        shard = shard_of(h, len(self.sizes))
        for i in sorted(set(shard.tolist())):
            if self.seeds[i] != FIRST_SEED:
                own = np.flatnonzero(shard == i)
                h[own] = hashes([keys[j] for j in own.tolist()], self.seeds[i])
        n = self.sizes[shard]
        some = np.flatnonzero(n > 0)
        d = np.zeros(len(keys), np.int64)
        d[some] = self.displacements[self.first[shard[some]] + _bucket_of(h[some], n[some]).astype(np.int64)]
        slot = np.where(d < 0, -1 - d, _slot(h, np.maximum(d, 0), n).astype(np.int64)) + self.bases[shard]
        stored = self.keys
        same = np.fromiter((stored[s] == k for s, k in zip(np.minimum(slot, len(stored) - 1).tolist(), keys, strict=True)), bool, len(keys))
        return np.where(same & (n > 0), slot, -1)


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> np.uint64(32)) % np.uint64(max(shards, 1))).astype(np.int64)
