"""Minimal perfect hashing of distinct 64-bit keys, with verified look-up."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Keys of a bucket on average; a bucket is hashed in one task.
BUCKET_KEYS = 8192
_WORD = np.uint64(64)
_BUCKET_SEED = 255


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of 64-bit keys, another one for each seed: no two keys ever share their hash."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(keys, _BUCKET_SEED) % np.uint64(buckets)).astype(np.int64)


def hashed_bucket(keys: np.ndarray) -> tuple[list[int], bytes, bytes]:
    """Level sizes, bits and the keys in slot order of one bucket's distinct keys.

    On every level a key hashes to a place; it stays if it is alone there, its bit is set
    and it leaves. A key's slot is the number of bits before its own.
    """
    sizes: list[int] = []
    bits: list[np.ndarray] = []
    placed: list[np.ndarray] = []
    rest = keys.astype(np.uint64)
    while len(rest):
        size = max(64, len(rest))
        at = (mixed(rest, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size)[at] == 1
        level = np.zeros(size, bool)
        level[at[alone]] = True
        stay = rest[alone]
        placed.append(stay[np.argsort(at[alone])])
        sizes.append(size)
        bits.append(level)
        rest = rest[~alone]
    every = np.concatenate(bits) if bits else np.zeros(0, bool)
    padded = np.concatenate([every, np.zeros(-len(every) % 64, bool)])
    order = np.concatenate(placed) if placed else np.zeros(0, np.uint64)
    return sizes, np.packbits(padded, bitorder="little").tobytes(), order.astype("<u8").tobytes()


class PairIndex:
    """Buckets ``first`` … of ``buckets`` in one array of bits; slots count from zero."""

    def __init__(self, first: int, buckets: int, rows: Sequence[tuple[list[int], bytes, bytes]]) -> None:
        self.first, self.buckets, self.held = first, buckets, len(rows)
        self.levels = max((len(sizes) for sizes, _, _ in rows), default=0)
        self.sizes = np.zeros((max(len(rows), 1), max(self.levels, 1)), np.uint64)
        for k, (sizes, _, _) in enumerate(rows):
            self.sizes[k, : len(sizes)] = sizes
        words = [np.frombuffer(bits, "<u8") for _, bits, _ in rows]
        self.words = np.concatenate([*words, np.zeros(1, "<u8")])
        begin = np.cumsum([0, *map(len, words)])[: max(len(rows), 1)].astype(np.uint64) * _WORD
        self.starts = begin[:, None] + np.cumsum(self.sizes, axis=1) - self.sizes
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts
        self.keys = np.concatenate([np.frombuffer(keys, "<u8") for _, _, keys in rows] or [np.zeros(0, "<u8")])

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for keys that the index does not hold."""
        out = np.full(len(keys), -1, np.int64)
        own = bucket_of(keys, self.buckets) - self.first
        left = np.flatnonzero((own >= 0) & (own < self.held))
        for level in range(self.levels):
            size = self.sizes[own[left], level]
            left, size = left[size > 0], size[size > 0]
            if not len(left):
                break
            at = self.starts[own[left], level] + mixed(keys[left], level) % size
            word, bit = (at // _WORD).astype(np.int64), at % _WORD
            hit = (self.words[word] >> bit) & np.uint64(1) > 0
            below = self.words[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[left[hit]] = self.before[word[hit]] + np.bitwise_count(below)
            left = left[~hit]
        held = np.flatnonzero(out >= 0)
        out[held[self.keys[out[held]] != keys[held]]] = -1
        return out
