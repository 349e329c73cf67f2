"""Words of many texts at once, on the bytes of an Arrow string column.

A batch is cut into blocks of rows whose bytes stay below a limit, so the arrays
made from them are small; only a text that is longer than that is alone in its block.
Nothing is cut inside a text. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Inverse of the base modulo 2**64, so that hashes do not depend on where a word stands.
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Table over the 256 byte values that is true inside the given inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Everything between words of the kind ``[^\x20\x09-\x0D]+``.
BLANK = byte_class((0x20, 0x20), (0x09, 0x0D))
#: Everything but ASCII letters, digits and the bytes of other characters.
PUNCTUATION = ~byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread 64-bit values (the finaliser of SplitMix64)."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Block:
    """Rows ``first`` to ``first + len(offsets) - 1`` of a batch and their bytes."""

    first: int
    offsets: np.ndarray
    data: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + n + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield Block(
            first,
            offsets[first : last + 1] - offsets[first],
            data[offsets[first] : offsets[last]],
        )
        first = last


@dataclass
class Words:
    """Words in order: the row of each, and where its bytes begin and end."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray


def words(block: Block, between: np.ndarray = BLANK) -> Words:
    """Maximal runs of bytes outside ``between``; none reaches over two rows."""
    inside = np.concatenate(([False], ~between[block.data], [False]))
    edges = block.offsets
    start = inside[1:-1] & ~inside[:-2]
    end = inside[1:-1] & ~inside[2:]
    heads = edges[:-1][edges[:-1] < edges[1:]]
    start[heads] = inside[1:-1][heads]
    tails = edges[1:][edges[:-1] < edges[1:]] - 1
    end[tails] = inside[1:-1][tails]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    row = np.searchsorted(edges, start, side="right") - 1
    return Words(row, start, end)


_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if n < 2 * BLOCK_BYTES:
        if len(_powers) < n:
            size = 1 << int(n).bit_length()
            _powers, _inverses = _series(_BASE, size), _series(_INVERSE, size)
        return _powers, _inverses
    return _series(_BASE, n), _series(_INVERSE, n)


def _series(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


def span_hashes(symbols: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of symbols: a polynomial by prefix sums, then mixed."""
    total, inverses = _sums(symbols)
    return mix((total[end] - total[start]) * inverses[start])


def rolling_hashes(symbols: np.ndarray, size: int) -> np.ndarray:
    """``span_hashes`` of every span of ``size`` symbols, in order of its start."""
    total, inverses = _sums(symbols)
    n = max(len(symbols) - size + 1, 0)
    return mix((total[size : size + n] - total[:n]) * inverses[:n])


def _sums(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of the polynomial, and what takes a sum to where its span starts."""
    powers, inverses = _tables(len(symbols) + 1)
    total = np.zeros(len(symbols) + 1, dtype=np.uint64)
    terms = symbols.astype(np.uint64)
    terms += np.uint64(1)
    terms *= powers[: len(symbols)]
    np.cumsum(terms, out=total[1:])
    return total, inverses


def word_hashes(block: Block, found: Words, lower: bool = False) -> np.ndarray:
    data = _LOWER[block.data] if lower else block.data
    return span_hashes(data, found.start, found.end)


def code_points(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """The block's characters and the offsets of its rows counted in them."""
    lead = (block.data & 0xC0) != 0x80
    count = np.concatenate(([0], np.cumsum(lead)))
    text = block.data.tobytes().decode("utf-8")
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    return points, count[block.offsets]
