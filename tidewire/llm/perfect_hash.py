"""A minimal perfect hash of 16-byte keys by levels of bit arrays, with the ranks of set bits as the values."""

from __future__ import annotations

import numpy as np

#: Bits of a level for each key that is left.
GAMMA = 2
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words(keys: bytes) -> np.ndarray:
    """n x 2 unsigned words of n packed 16-byte keys."""
    return np.frombuffer(keys, "<u8").reshape(-1, 2)


def _places(keys: np.ndarray, level: int, m: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = keys[:, 0] * _MIX + keys[:, 1] * np.uint64(2 * level + 3)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return (h % np.uint64(m)).astype(np.int64)


class PerfectHash:
    """Maps n distinct keys to 0..n-1; any other key maps somewhere or to -1."""

    def __init__(self, keys: np.ndarray):
        self.n, self.levels = len(keys), []
        base, level = 0, 0
        while len(keys):
            m = GAMMA * len(keys) + 1
            at = _places(keys, level, m)
            alone = np.bincount(at, minlength=m) == 1
            ranks = np.cumsum(alone) - 1 + base
            self.levels.append((m, alone, ranks))
            base += int(alone.sum())
            keys = keys[~alone[at]]
            level += 1

    def packed(self) -> bytes:
        """The bit arrays alone, about four bits a key: sizes first, then the bits of each level."""
        head = np.array([self.n, len(self.levels), *(m for m, _, _ in self.levels)], "<i8").tobytes()
        return head + b"".join(np.packbits(alone).tobytes() for _, alone, _ in self.levels)

    @classmethod
    def unpacked(cls, raw: bytes) -> PerfectHash:
        out = cls(np.zeros((0, 2), np.uint64))
        out.n, count = np.frombuffer(raw, "<i8", 2).tolist()
        at, base = 8 * (2 + count), 0
        for m in np.frombuffer(raw, "<i8", count, 16).tolist():
            alone = np.unpackbits(np.frombuffer(raw, np.uint8, -(-m // 8), at), count=m).astype(bool)
            out.levels.append((m, alone, np.cumsum(alone) - 1 + base))
            at, base = at + -(-m // 8), base + int(alone.sum())
        return out

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (m, alone, ranks) in enumerate(self.levels):
            at = _places(keys[left], level, m)
            hit = alone[at]
            out[left[hit]] = ranks[at[hit]]
            left = left[~hit]
            if not len(left):
                break
        return out
