"""Three-wise binary-fuse filters with 8-bit fingerprints, over numpy.

A filter is immutable: it is built once from distinct 64-bit keys and answers
"maybe" for each of them and for about 1 in 256 other keys.
"""

from __future__ import annotations

import numpy as np

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3 over key + seed."""
    with np.errstate(over="ignore"):
        h = keys + np.uint64(seed)
        h = (h ^ (h >> np.uint64(33))) * _M1
        h = (h ^ (h >> np.uint64(33))) * _M2
        return h ^ (h >> np.uint64(33))


class BinaryFuse8:
    """Slots are cut into short segments; a key owns one slot in each of three
    neighbouring segments, whose xor is the key's fingerprint."""

    def __init__(self, seed: int, segment: int, segments: int, slots: np.ndarray):
        self.seed, self.segment, self.segments, self.slots = seed, segment, segments, slots

    @staticmethod
    def _places(h: np.ndarray, segment: int, segments: int) -> np.ndarray:
        """The three slots of every hash, one column each."""
        first = ((h >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
        base = first.astype(np.int64) * segment
        within, g = np.uint64(segment - 1), _mix(h, 1)
        cols = [base + i * segment + ((g >> np.uint64(s)) & within).astype(np.int64)
                for i, s in enumerate((0, 21, 42))]
        return np.stack(cols, axis=1)

    @staticmethod
    def _print(h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint64(29))) & np.uint64(0xFF)).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> "BinaryFuse8":
        """Peel in rounds: all slots with one remaining key give that key up
        together; slots are then filled in the reverse order."""
        keys = np.unique(keys.astype(np.uint64))
        n = len(keys)
        segment = 1 << int(np.clip(np.log(max(n, 2)) / np.log(3.33) + 2.25, 2, 18))
        room = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2))) * n + 32
        segments = max(1, int(np.ceil(room / segment)) - 2)
        for seed in range(1, 1000):
            if seed % 20 == 0:
                segments += max(1, segments // 10)
            h = _mix(keys, seed)
            at = cls._places(h, segment, segments)
            size = (segments + 2) * segment
            rounds, left = [], np.arange(n)
            while len(left):
                count = np.bincount(at[left].ravel(), minlength=size)
                alone = count[at[left]] == 1
                ready = alone.any(axis=1)
                if not ready.any():
                    break
                who = left[ready]
                rounds.append((who, at[who, alone[ready].argmax(axis=1)]))
                left = left[~ready]
            if len(left) == 0:
                slots, mark = np.zeros(size, dtype=np.uint8), cls._print(h)
                for who, own in reversed(rounds):
                    a = at[who]
                    slots[own] = 0
                    slots[own] = mark[who] ^ slots[a[:, 0]] ^ slots[a[:, 1]] ^ slots[a[:, 2]]
                return cls(seed, segment, segments, slots)
        raise ValueError("no seed gives a peelable filter")

    def maybe(self, keys: np.ndarray) -> np.ndarray:
        h = _mix(keys.astype(np.uint64), self.seed)
        a = self._places(h, self.segment, self.segments)
        s = self.slots
        return (s[a[:, 0]] ^ s[a[:, 1]] ^ s[a[:, 2]]) == self._print(h)

    def to_bytes(self) -> bytes:
        return np.array([self.seed, self.segment, self.segments], dtype="<u4").tobytes() + self.slots.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> "BinaryFuse8":
        seed, segment, segments = (int(x) for x in np.frombuffer(data[:12], dtype="<u4"))
        return cls(seed, segment, segments, np.frombuffer(data, dtype=np.uint8, offset=12))
