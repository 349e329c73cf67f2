"""Elias-Fano code of a sequence that never falls, with select.

Of ``n`` values below ``u`` the low ``l = log2(u / n)`` bits are packed side by side; the
rest is unary in a bit vector of at most ``3 n`` bits, where the bit of value ``i``
stands at ``(value >> l) + i``. Positions of every ``STRIDE``-th set bit, 32 bits each
against the one before, lead ``select`` close to any value.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

STRIDE = 256


@dataclass
class EliasFano:
    n: int
    low_bits: int
    low: np.ndarray
    high: np.ndarray
    steps: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        lows = values & np.uint64((1 << bits) - 1)
        place = (np.arange(bits, dtype=np.uint64))[None, :]
        low = np.packbits(((lows[:, None] >> place) & np.uint64(1)).astype(np.uint8).reshape(-1), bitorder="little")
        at = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(at[-1]) + 1 if n else 0, dtype=np.uint8)
        high[at] = 1
        steps = np.diff(at[::STRIDE], prepend=0).astype(np.uint32)
        return cls(n, bits, low, np.packbits(high, bitorder="little"), steps)

    def _lows(self, first: int, count: int) -> np.ndarray:
        a, b = first * self.low_bits, (first + count) * self.low_bits
        bits = np.unpackbits(self.low[a // 8 : (b + 7) // 8], bitorder="little")[a % 8 : a % 8 + b - a]
        weight = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        return (bits.reshape(count, self.low_bits).astype(np.uint64) * weight).sum(axis=1, dtype=np.uint64)

    def select(self, i: int) -> int:
        """Value ``i``: the place of the i-th set bit, found from the nearest step."""
        place = int(self.steps[: i // STRIDE + 1].sum(dtype=np.int64))
        left, byte = i % STRIDE, place // 8
        skip = int(np.bitwise_count(self.high[byte] & np.uint8((1 << (place % 8)) - 1)))
        left += skip
        while True:
            chunk = self.high[byte : byte + 64]
            ones = np.cumsum(np.bitwise_count(chunk))
            if left < ones[-1]:
                break
            left -= int(ones[-1])
            byte += 64
        k = int(np.searchsorted(ones, left, side="right"))
        left -= int(ones[k - 1]) if k else 0
        bit = np.flatnonzero(np.unpackbits(chunk[k : k + 1], bitorder="little"))[left]
        high = (byte + k) * 8 + int(bit) - i
        return high << self.low_bits | int(self._lows(i, 1)[0])

    def all(self) -> np.ndarray:
        at = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        high = (at - np.arange(self.n)).astype(np.uint64)
        return high << np.uint64(self.low_bits) | self._lows(0, self.n)

    def dump(self) -> bytes:
        head = np.array([self.n, self.low_bits, len(self.low), len(self.high), len(self.steps)], dtype="<u8")
        return head.tobytes() + self.low.tobytes() + self.high.tobytes() + self.steps.astype("<u4").tobytes()

    @classmethod
    def load(cls, raw: bytes) -> EliasFano:
        n, bits, a, b, c = (int(x) for x in np.frombuffer(raw, dtype="<u8", count=5))
        at = 40
        low = np.frombuffer(raw, dtype=np.uint8, count=a, offset=at)
        high = np.frombuffer(raw, dtype=np.uint8, count=b, offset=at + a)
        steps = np.frombuffer(raw, dtype="<u4", count=c, offset=at + a + b)
        return cls(n, bits, low, high, steps)
