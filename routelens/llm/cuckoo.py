"""A cuckoo filter over 128-bit keys in numpy: four places a bucket, 16-bit fingerprints, deletions."""

from __future__ import annotations

import numpy as np

PLACES = 4
_KICKS = 500


def _hashes(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint (never 0) and both buckets of every key. ``keys`` is (n, 2) of uint64."""
    mark = (keys[:, 0] & np.uint64(0xFFFF)).astype(np.uint16)
    mark[mark == 0] = 1
    first = (keys[:, 1] & np.uint64(buckets - 1)).astype(np.int64)
    return mark, first, _other(first, mark, buckets)


def _other(bucket, mark, buckets: int):
    return bucket ^ ((np.asarray(mark).astype(np.int64) * 0x5BD1E995) & (buckets - 1))


class CuckooFilter:
    """``contains`` is never false for a key that is in, and true for about 1 of 8,000 others."""

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        """A filter with the given distinct keys, as large as they need."""
        buckets = 1 << max(2, int(np.ceil(np.log2(max(len(keys), 1) / (PLACES * 0.85) + 1))))
        while True:
            made = cls(np.zeros((buckets, PLACES), np.uint16))
            if made.insert(keys):
                return made
            buckets *= 2

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, "<u2").reshape(-1, PLACES).copy())

    def to_bytes(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mark, a, b = _hashes(keys, len(self.table))
        return (self.table[a] == mark[:, None]).any(axis=1) | (self.table[b] == mark[:, None]).any(axis=1)

    def insert(self, keys: np.ndarray) -> bool:
        """False if there was no room; the filter must then be made anew from the exact table."""
        for mark, a, b in zip(*[x.tolist() for x in _hashes(keys, len(self.table))], strict=True):
            if not self._put(mark, a, b):
                return False
        return True

    def _put(self, mark: int, a: int, b: int) -> bool:
        for bucket in (a, b):
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = mark
                return True
        bucket = b
        for kick in range(_KICKS):
            place = (mark + kick) % PLACES
            mark, self.table[bucket, place] = int(self.table[bucket, place]), mark
            bucket = int(_other(bucket, mark, len(self.table)))
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = mark
                return True
        return False

    def delete(self, keys: np.ndarray) -> None:
        """Takes out keys that are in; others must not be given."""
        for mark, a, b in zip(*[x.tolist() for x in _hashes(keys, len(self.table))], strict=True):
            for bucket in (a, b):
                found = np.flatnonzero(self.table[bucket] == mark)
                if len(found):
                    self.table[bucket, found[0]] = 0
                    break
