"""A cuckoo filter over 64-bit keys with bulk operations: membership without misses, and deletion."""

from __future__ import annotations

import numpy as np

U = np.uint64
SLOTS = 4


class CuckooFilter:
    """Buckets of four 16-bit fingerprints (0: free); a key may lie in its bucket or in that bucket's partner.

    Only keys that were inserted may be deleted.  ``insert`` answers False when it could not place all keys; the filter
    is then void and has to be built anew, larger, from the keys themselves.
    """

    def __init__(self, table: np.ndarray):
        self.table = table  # buckets (a power of two) x SLOTS

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        """A filter of ``keys`` with room for as many again."""
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, len(keys)) * 2 / SLOTS))))
        while True:
            out = cls(np.zeros((buckets, SLOTS), np.uint16))
            if out.insert(keys):
                return out
            buckets *= 2

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.tobytes()

    def __len__(self) -> int:
        return int(np.count_nonzero(self.table))

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = np.asarray(keys).astype(np.int64, copy=False).view(U)
        print_ = (keys >> U(48)).astype(np.uint16)
        return np.where(print_ == 0, np.uint16(1), print_), (keys & U(len(self.table) - 1)).astype(np.int64)

    def _partner(self, print_: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            step = (print_.astype(U) * U(0x9E3779B97F4A7C15)) >> U(32)
        return bucket ^ (step & U(len(self.table) - 1)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        print_, bucket = self._places(keys)
        other = self._partner(print_, bucket)
        return ((self.table[bucket] == print_[:, None]) | (self.table[other] == print_[:, None])).any(axis=1)

    def _fill(self, print_: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Puts fingerprints into free slots of their buckets; which ones found none."""
        order = np.argsort(bucket, kind="stable")
        b = bucket[order]
        rank = np.arange(len(b)) - np.searchsorted(b, b)  # place among those that want the same bucket
        free = self.table[b] == 0
        fits = rank < free.sum(axis=1)
        nth = free.cumsum(axis=1) == (rank + 1)[:, None]
        slot = (free & nth).argmax(axis=1)
        self.table[b[fits], slot[fits]] = print_[order[fits]]
        return order[~fits]

    def insert(self, keys: np.ndarray, rounds: int = 500) -> bool:
        rng = np.random.default_rng(5)
        print_, bucket = self._places(keys)
        for _ in range(rounds):
            rest = self._fill(print_, bucket)
            print_, bucket = print_[rest], self._partner(print_[rest], bucket[rest])
            rest = self._fill(print_, bucket)
            if not len(rest):
                return True
            print_, bucket = print_[rest], bucket[rest]
            # one key a bucket takes the place of a random fingerprint there, which moves to its partner bucket
            _, first = np.unique(bucket, return_index=True)
            slot = rng.integers(0, SLOTS, len(first))
            pushed = self.table[bucket[first], slot]
            self.table[bucket[first], slot] = print_[first]
            print_[first] = pushed
            bucket[first] = self._partner(pushed, bucket[first])
        return False

    def delete(self, keys: np.ndarray) -> None:
        print_, bucket = self._places(keys)
        other = self._partner(print_, bucket)
        while len(print_):
            at = np.concatenate([self.table[bucket], self.table[other]], axis=1) == print_[:, None]
            if not at.any(axis=1).all():
                raise ValueError("deleted a key that was never inserted")
            slot = at.argmax(axis=1)
            cell = np.where(slot < SLOTS, bucket, other) * SLOTS + slot % SLOTS
            cell, first = np.unique(cell, return_index=True)  # keys that found the same slot go one after the other
            self.table.ravel()[cell] = 0
            later = np.ones(len(print_), bool)
            later[first] = False
            print_, bucket, other = print_[later], bucket[later], other[later]
