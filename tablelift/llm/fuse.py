"""Static binary-fuse filters in numpy: about nine bits a key, one false positive in 256, no false negatives."""

from __future__ import annotations

import math

import numpy as np

from tablelift.llm.common import mix64


class FuseFilter:
    """A filter over distinct unsigned 64-bit keys that never changes once built."""

    def __init__(self, seed: int, segment: int, segments: int, prints: np.ndarray) -> None:
        self.seed, self.segment, self.segments, self.prints = seed, segment, segments, prints

    @staticmethod
    def _hashes(keys: np.ndarray, seed: int) -> np.ndarray:
        return mix64(keys.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1))

    @staticmethod
    def _places(h: np.ndarray, segment: int, segments: int) -> np.ndarray:
        """Three slots per key, in consecutive segments."""
        first = ((h >> np.uint64(32)) * np.uint64(segments * segment)) >> np.uint64(32)
        mask = np.uint64(segment - 1)
        second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
        third = (first + np.uint64(2 * segment)) ^ (h & mask)
        return np.stack([first, second, third]).astype(np.int64)

    @staticmethod
    def _prints(h: np.ndarray) -> np.ndarray:
        return (h ^ (h >> np.uint64(32))).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        """Keys must be distinct. Tries seed after seed until every key can be peeled off."""
        n = len(keys)
        segment = 1 << max(2, math.floor(math.log(max(n, 2)) / math.log(3.33) + 2.25))
        factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
        segments = max(1, math.ceil(n * factor / segment) - 2)
        for seed in range(1, 200):
            slots = (segments + 2) * segment
            h = cls._hashes(keys, seed)
            at = cls._places(h, segment, segments)
            count = np.bincount(at.ravel(), minlength=slots)
            which = np.zeros(slots, np.int64)  # exclusive or of the keys that use the slot
            for row in at:
                np.bitwise_xor.at(which, row, np.arange(n))
            rounds, left = [], n
            free = np.flatnonzero(count == 1)
            while len(free):
                key, first = np.unique(which[free], return_index=True)
                rounds.append((key, free[first]))
                left -= len(key)
                for row in at[:, key]:
                    np.subtract.at(count, row, 1)
                    np.bitwise_xor.at(which, row, key)
                touched = np.unique(at[:, key].ravel())
                free = touched[count[touched] == 1]
            if left == 0:
                prints = np.zeros(slots, np.uint8)
                own = cls._prints(h)
                for key, slot in reversed(rounds):
                    prints[slot] = 0
                    a, b, c = at[:, key]
                    prints[slot] = own[key] ^ prints[a] ^ prints[b] ^ prints[c]
                return cls(seed, segment, segments, prints)
            if seed % 20 == 0:
                segments += 1 + segments // 8
        raise ValueError("keys are not distinct")

    def contains(self, keys: np.ndarray) -> np.ndarray:
        """True for every key of the filter, and for one other key in 256."""
        h = self._hashes(keys, self.seed)
        a, b, c = self._places(h, self.segment, self.segments)
        return self._prints(h) == self.prints[a] ^ self.prints[b] ^ self.prints[c]
