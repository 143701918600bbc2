"""Token ids of words that a worker has seen, as arrays."""

from __future__ import annotations

import numpy as np

from ampledger.llm.arrays import gather, word_keys


class WordCache:
    """Ids by word: an open-addressing table of word hashes, and all ids in one array.

    A word is known by its 64-bit hash and its first eight bytes.
    """

    def __init__(self, bits: int = 21):
        self.bits = bits
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.tags = np.zeros(1 << self.bits, np.uint64)
        self.index = np.zeros(1 << self.bits, np.int32)
        self.starts, self.flat = np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.int32)
        self.count = self.used = 0

    def _slots(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, h: np.ndarray, tags: np.ndarray) -> np.ndarray:
        """Place of each word, -1 where it isn't known."""
        slot = self._slots(h)
        out = np.where((self.keys[slot] == h) & (self.tags[slot] == tags), self.index[slot], -1)
        left = np.flatnonzero((out < 0) & (self.keys[slot] != 0))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            seen = self.keys[slot]
            hit = (seen == h[left]) & (self.tags[slot] == tags[left])
            out[left[hit]] = self.index[slot[hit]]
            on = ~hit & (seen != 0)
            left, slot = left[on], slot[on]
        return out

    def add(self, h: np.ndarray, tags: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> None:
        """Add distinct words that aren't known."""
        total, n = len(flat), len(h)
        if (self.count + n) * 2 > len(self.keys):
            old = self.keys != 0
            kept = self.keys[old], self.tags[old], self.index[old]
            self.bits = int(self.count + n).bit_length() + 2
            self.keys, self.tags, self.index = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.int32)
            self._place(*kept)
        while self.count + n + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + total] = flat
        self.starts[self.count + 1 : self.count + n + 1] = self.used + np.cumsum(sizes)
        self._place(h, tags, np.arange(self.count, self.count + n, dtype=np.int32))
        self.count, self.used = self.count + n, self.used + total

    def _place(self, h: np.ndarray, tags: np.ndarray, index: np.ndarray) -> None:
        slot, left = self._slots(h), np.arange(len(h))
        while len(left):
            free = np.flatnonzero(self.keys[slot] == 0)
            slots, one = np.unique(slot[free], return_index=True)
            put = left[free[one]]
            self.keys[slots], self.tags[slots], self.index[slots] = h[put], tags[put], index[put]
            rest = np.ones(len(left), bool)
            rest[free[one]] = False
            left, slot = left[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)


def coded_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, cache: WordCache, encode, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after the other, and how many each word has; new words go to ``encode``."""
    if cache.count > limit:
        cache.clear()
    h, tags = word_keys(raw, starts, ends)
    at = cache.find(h, tags)
    new = np.flatnonzero(at < 0)
    if len(new):
        order = new[np.lexsort((tags[new], h[new]))]
        first = np.ones(len(order), bool)
        first[1:] = (h[order[1:]] != h[order[:-1]]) | (tags[order[1:]] != tags[order[:-1]])
        fresh = order[first]
        data = memoryview(np.ascontiguousarray(raw))
        strings = [str(data[a:b], "utf-8") for a, b in zip(starts[fresh].tolist(), ends[fresh].tolist())]
        cache.add(h[fresh], tags[fresh], *encode(strings))
        at[new] = cache.find(h[new], tags[new])
    sizes = cache.starts[at + 1] - cache.starts[at]
    return cache.flat[gather(cache.starts[at], sizes)], sizes
