"""Cuckoo filters over live keys: what one shard of the exact-dedup index holds.

A key has a 16-bit fingerprint and two buckets of four slots; either bucket follows from the other and the
fingerprint. A key that finds both full moves a fingerprint on to its other bucket. If that chain does not end, the
filter doubles its buckets and fills them from the stored keys. A hit is only a candidate: the stored keys of its
bucket tell whether the key itself is live.
"""

from __future__ import annotations

import xxhash

SLOTS = 4
KICKS = 200
FINGERPRINTS = (1 << 16) - 1  # zero marks an empty slot
SPREAD = 0x5BD1E995  # odd: the other bucket of a fingerprint


class Filter:
    """The fingerprints alone."""

    def __init__(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.slots = [0] * (buckets * SLOTS)

    def places(self, key: bytes) -> tuple[int, int, int]:
        """Fingerprint and both buckets."""
        mixed = xxhash.xxh3_128_intdigest(key)
        fingerprint = 1 + (mixed >> 64) % FINGERPRINTS
        bucket = mixed & self.mask
        return fingerprint, bucket, bucket ^ (fingerprint * SPREAD & self.mask)

    def holds(self, fingerprint: int, first: int, second: int) -> bool:
        slots, a, b = self.slots, first * SLOTS, second * SLOTS
        return fingerprint in slots[a : a + SLOTS] or fingerprint in slots[b : b + SLOTS]

    def _put(self, fingerprint: int, bucket: int) -> bool:
        at = bucket * SLOTS
        for slot in range(at, at + SLOTS):
            if not self.slots[slot]:
                self.slots[slot] = fingerprint
                return True
        return False

    def add(self, fingerprint: int, first: int, second: int) -> bool:
        """False if no place was found; one fingerprint is then left over, so the filter must be filled anew."""
        if self._put(fingerprint, first) or self._put(fingerprint, second):
            return True
        bucket = first
        for turn in range(KICKS):
            slot = bucket * SLOTS + turn % SLOTS
            fingerprint, self.slots[slot] = self.slots[slot], fingerprint
            bucket ^= fingerprint * SPREAD & self.mask
            if self._put(fingerprint, bucket):
                return True
        return False

    def remove(self, fingerprint: int, first: int, second: int) -> None:
        """Of a key that is in; equal fingerprints of one bucket pair are interchangeable."""
        for bucket in (first, second):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.slots[slot] == fingerprint:
                    self.slots[slot] = 0
                    return


class LiveKeys:
    """A filter with the keys behind it, stored by fingerprint and lesser bucket."""

    def __init__(self, buckets: int = 16) -> None:
        self.filter = Filter(buckets)
        self.stored: dict[tuple[int, int], list[bytes]] = {}
        self.size = self.resizes = self.false_hits = 0

    def _look(self, key: bytes) -> tuple[tuple[int, int, int], list[bytes] | None]:
        """The key's places, and the stored keys of its bucket if the filter has a hit."""
        spot = self.filter.places(key)
        if not self.filter.holds(*spot):
            return spot, None
        return spot, self.stored.get((spot[0], min(spot[1:])))

    def __contains__(self, key: bytes) -> bool:
        _, bucket = self._look(key)
        return bucket is not None and key in bucket

    def insert(self, key: bytes) -> bool:
        """False if the key was live already."""
        spot, bucket = self._look(key)
        if bucket is not None:
            if key in bucket:
                return False
            self.false_hits += 1
        self.stored.setdefault((spot[0], min(spot[1:])), []).append(key)
        self.size += 1
        if not self.filter.add(*spot):
            self._resize()
        return True

    def delete(self, key: bytes) -> bool:
        """False if the key was not live."""
        spot, bucket = self._look(key)
        if bucket is None or key not in bucket:
            return False
        bucket.remove(key)
        if not bucket:
            del self.stored[spot[0], min(spot[1:])]
        self.filter.remove(*spot)
        self.size -= 1
        return True

    def _resize(self) -> None:
        keys = [key for bucket in self.stored.values() for key in bucket]
        buckets = self.filter.mask + 1
        while True:
            buckets *= 2
            self.resizes += 1
            self.filter, self.stored = Filter(buckets), {}
            for key in keys:
                spot = self.filter.places(key)
                self.stored.setdefault((spot[0], min(spot[1:])), []).append(key)
                if not self.filter.add(*spot):
                    break
            else:
                return
