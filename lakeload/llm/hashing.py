"""Minimal perfect hashing of integer keys, in buckets, with the keys kept for verification.

Keys below 2 to the 31st power are dealt by a multiplicative hash into buckets of some thousand. In a bucket each
level hashes the keys that are left to a bitmap of twice their number; keys alone on their place set its bit, the
others go to the next level. A key's index is the number of bits set before its own. A key that was never hashed
may get an index too, so a lookup compares the key kept there.
"""

from __future__ import annotations

import numpy as np

#: Factor of the multiplicative hash; with keys below 2**31 products stay below 2**63, in Spark as here.
FACTOR, SHIFT = 2654435761, 16
#: Keys in a bucket on average.
KEYS = 1 << 14


def buckets_for(keys: int) -> int:
    """A power of two, at most 65,536."""
    return min(1 << 16, 1 << max(0, -(-keys // KEYS) - 1).bit_length())


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (keys * FACTOR >> SHIFT) & (buckets - 1)


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """64 well-mixed bits of each key at a level."""
    x = keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def build(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each level, bitmaps of all levels as 64-bit words, keys in the order of their indexes)."""
    sizes, words, left = [], [], np.unique(keys.astype(np.int64))
    while len(left):
        size = max(1, -(-2 * len(left) // 64))
        at = _mixed(left, len(sizes)) % np.uint64(64 * size)
        alone = np.bincount(at.astype(np.int64), minlength=64 * size) == 1
        placed = alone[at.astype(np.int64)]
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        sizes.append(size)
        left = left[~placed]
    every = np.unique(keys.astype(np.int64))
    ordered = np.empty(len(every), np.int64)
    ordered[Table([(sizes, words)]).places(every)] = every
    return np.array(sizes, np.int32), np.concatenate(words) if words else np.zeros(0, "<u8"), ordered


class Table:
    """Buckets beside each other: a key's place counts the keys of earlier buckets too."""

    def __init__(self, buckets: list[tuple[list[int], list[np.ndarray]]], keys: np.ndarray | None = None):
        """``buckets``: words of each level, and their bitmaps, of each bucket in order."""
        levels = max((len(sizes) for sizes, _ in buckets), default=0)
        self.buckets, self.keys = len(buckets), keys
        self.sizes = np.zeros((len(buckets), levels), np.int64)
        for i, (sizes, _) in enumerate(buckets):
            self.sizes[i, : len(sizes)] = sizes
        ends = np.cumsum(self.sizes.ravel()).reshape(self.sizes.shape)
        self.starts = ends - self.sizes
        every = [w for _, words in buckets for w in words]
        self.words = np.concatenate(every) if every else np.zeros(0, "<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key that was hashed; any place, or -1, for others."""
        out = np.full(len(keys), -1, np.int64)
        left, bucket = np.arange(len(keys)), bucket_of(keys, self.buckets) if self.buckets else None
        for level in range(self.sizes.shape[1]):
            size = self.sizes[bucket[left], level]
            left, size = left[size > 0], size[size > 0]
            if not len(left):
                break
            at = (_mixed(keys[left], level) % (64 * size).astype(np.uint64)).astype(np.int64)
            word = self.starts[bucket[left], level] + (at >> 6)
            bit = np.uint64(1) << (at & 63).astype(np.uint64)
            hit = (self.words[word] & bit) != 0
            before = np.bitwise_count(self.words[word[hit]] & (bit[hit] - np.uint64(1)))
            out[left[hit]] = self.before[word[hit]] + before
            left = left[~hit]
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key whose kept key is the same, -1 for all others."""
        out = self.places(keys)
        inside = out >= 0
        out[inside] = np.where(self.keys[out[inside]] == keys[inside], out[inside], -1)
        return out
