"""Pieces that a byte-level BPE tokenizer splits a text into before it merges."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np

from llm.text import Block, code_points, span_hashes

#: The code points with Unicode's White_Space property.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
OTHER, LETTER, NUMBER, SPACE = range(4)
#: Pieces longer than this are never looked up by their hash.
LONGEST = 64


@cache
def classes() -> np.ndarray:
    table = np.zeros(0x110000, dtype=np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    for c in range(0x110000):
        if kind := kinds.get(unicodedata.category(chr(c))[0]):
            table[c] = kind
    table[list(WHITE_SPACE)] = SPACE
    return table


@dataclass
class Pieces:
    """Pieces in order: row, hash, and the span of each in ``points``."""

    row: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    special: np.ndarray
    points: np.ndarray

    def texts(self, at: np.ndarray) -> list[str]:
        raw = self.points.tobytes()
        spans = zip(self.start[at] * 4, self.end[at] * 4, strict=True)
        return [raw[a:b].decode("utf-32-le") for a, b in spans]


def pieces(block: Block, specials: tuple[str, ...] = ()) -> Pieces:
    """Pieces by the usual pattern: contractions; a space at most and then letters,
    numbers or other characters; white space, less its last character before a word.

    ``specials`` are split off first, as one piece each.
    """
    points, rows = code_points(block)
    n = len(points)
    cuts, marked = rows, np.zeros(0, dtype=np.int64)
    if specials:
        spans = _special_spans(block, specials)
        marked = spans[:, 0]
        cuts = np.unique(np.concatenate([rows, spans.reshape(-1)]))
    kind = classes()[points]
    head = np.zeros(n + 1, dtype=bool)
    head[cuts] = True
    start = head[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(start)
    after = np.append(run[1:], n)
    white = (kind[run] == SPACE) & ~head[after]
    stop = after[white]
    start[stop - 1] = True
    start[stop[points[stop - 1] == 32]] = False
    _contractions(points, kind, head, start)
    if len(marked):
        for a, b in spans:
            start[a:b] = False
            start[a] = True
    begin = np.flatnonzero(start)
    end = np.append(begin[1:], n)
    row = np.searchsorted(rows, begin, side="right") - 1
    special = np.isin(begin, marked) if len(marked) else np.zeros(len(begin), dtype=bool)
    return Pieces(row, span_hashes(points, begin, end), begin, end, special, points)


def _contractions(points, kind, head, start) -> None:
    n = len(points)
    at = np.flatnonzero((points == 39) & start)
    at = at[at + 1 < n]
    at = at[~head[at + 1]]
    one = points[at + 1]
    short = np.isin(one, [ord(c) for c in "stmd"])
    two = points[np.minimum(at + 2, n - 1)]
    long = (at + 2 < n) & ~head[np.minimum(at + 2, n)]
    pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))
    pair |= (one == ord("l")) & (two == ord("l"))
    long &= pair
    for chosen, size in ((at[short], 1), (at[long], 2)):
        start[chosen + 1] = False
        rest = chosen + 1 + size
        rest = rest[rest < n]
        start[rest] = True


def _special_spans(block: Block, specials: tuple[str, ...]) -> np.ndarray:
    data = block.data.tobytes()
    pattern = re.compile(b"|".join(re.escape(s.encode()) for s in specials))
    if not any(s.encode() in data for s in specials):
        return np.zeros((0, 2), dtype=np.int64)
    count = np.concatenate(([0], np.cumsum((block.data & 0xC0) != 0x80)))
    out = []
    for r in range(block.rows):
        a, b = int(block.offsets[r]), int(block.offsets[r + 1])
        out += [(count[m.start()], count[m.end()]) for m in pattern.finditer(data, a, b)]
    return np.array(out, dtype=np.int64).reshape(-1, 2)
