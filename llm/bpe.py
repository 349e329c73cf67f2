"""Byte-pair merging by a heap and a linked list, and values of pieces by their hash."""

from __future__ import annotations

import heapq
import json
import os
from collections.abc import Callable
from functools import cache

import numpy as np
import pyarrow as pa

from llm.pretokens import LONGEST, Pieces, pieces
from llm.text import blocks


#: Bytes of text whose pieces are found and encoded at a time; their arrays take some 60 times that.
ENCODED_BYTES = 1 << 18


@cache
def byte_symbols() -> dict[str, int]:
    """The printable character that a byte-level vocabulary writes for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {chr(b): b for b in shown}
    return table | {chr(256 + i): b for i, b in enumerate(hidden)}


def description(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


@cache
def specials(path: str) -> tuple[str, ...]:
    return tuple(x["content"] for x in description(path)["added_tokens"])


@cache
def ranks(path: str) -> dict[int, int]:
    """Rank of each mergeable pair of symbols; bytes are 0 to 255, the symbol that the
    merge of rank r makes is 256 + r, a pair is ``left << 32 | right``."""
    symbols = dict(byte_symbols())
    out: dict[int, int] = {}
    for rank, pair in enumerate(description(path)["model"]["merges"]):
        left, right = pair if isinstance(pair, list) else pair.split(" ")
        symbols.setdefault(left + right, 256 + rank)
        out[symbols[left] << 32 | symbols[right]] = rank
    return out


def count_tokens(data: bytes, rank_of: dict[int, int]) -> int:
    """Symbols left of ``data`` when no pair can be merged: bytes less merges.

    The heap holds ``rank << 32 | position`` of pairs, so the lowest rank comes first and
    the leftmost of equal ones. A popped pair counts only if its symbols still stand
    there; the list of neighbours skips merged symbols.
    """
    n = len(data)
    symbol = list(data)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = rank_of.get(symbol[i] << 32 | symbol[i + 1])
        if rank is not None:
            heap.append(rank << 32 | i)
    heapq.heapify(heap)
    merges = 0
    while heap:
        top = heapq.heappop(heap)
        rank, i = top >> 32, top & 0xFFFFFFFF
        j = after[i]
        if symbol[i] < 0 or j >= n or rank_of.get(symbol[i] << 32 | symbol[j]) != rank:
            continue
        merges += 1
        made = 256 + rank
        symbol[i], symbol[j] = made, -1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            rank = rank_of.get(made << 32 | symbol[k])
            if rank is not None:
                heapq.heappush(heap, rank << 32 | i)
        h = before[i]
        if h >= 0:
            rank = rank_of.get(symbol[h] << 32 | made)
            if rank is not None:
                heapq.heappush(heap, rank << 32 | h)
    return n - merges


class Known:
    """Values of the pieces met so far by hash, all forgotten beyond ``limit`` pieces."""

    def __init__(self, limit: int = 1_500_000):
        self.limit = limit
        self.keys = np.zeros(0, dtype=np.uint64)
        self.values = np.zeros(0, dtype=np.int64)

    def of(self, found: Pieces, at: np.ndarray, make: Callable[[list[str]], np.ndarray]) -> np.ndarray:
        keys, first, back = np.unique(found.hash[at], return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, keys)
        old = np.zeros(len(keys), dtype=bool)
        inside = place < len(self.keys)
        old[inside] = self.keys[place[inside]] == keys[inside]
        values = np.empty(len(keys), dtype=np.int64)
        values[old] = self.values[place[old]]
        new = ~old
        if new.any():
            values[new] = make(found.texts(at[first[new]]))
            self.keys = np.insert(self.keys, place[new], keys[new])
            self.values = np.insert(self.values, place[new], values[new])
        return values[back]

    def full(self) -> bool:
        return len(self.keys) > self.limit


_counts: dict[str, Known] = {}


def token_counts(column: pa.Array, path: str) -> np.ndarray:
    """Tokens of every text of a string column; null and empty texts have none."""
    table, marks = ranks(path), specials(path)
    out = np.zeros(len(column), dtype=np.int64)

    def make(texts: list[str]) -> np.ndarray:
        return np.array([count_tokens(t.encode(), table) for t in texts], dtype=np.int64)

    for block in blocks(column):
        known = _counts.setdefault(path, Known())
        if known.full():
            known = _counts[path] = Known()
        found = pieces(block, marks)
        size = np.ones(len(found.row), dtype=np.int64)
        plain = ~found.special
        short = np.flatnonzero(plain & (found.end - found.start <= LONGEST))
        size[short] = known.of(found, short, make)
        long = np.flatnonzero(plain & (found.end - found.start > LONGEST))
        if len(long):
            size[long] = make(found.texts(long))
        np.add.at(out, block.first + found.row, size)
    return out


class Encoder:
    """Token ids of texts by the ``tokenizers`` library, which encodes each distinct
    piece once; pieces are split as the library splits them, so the ids are its own."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.marks = specials(path)
        self._forget()

    def _forget(self) -> None:
        self.known = Known()
        self.pool = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0

    def _make(self, texts: list[str]) -> np.ndarray:
        made = self.library.encode_batch_fast(texts, add_special_tokens=False)
        ids = [x.ids for x in made]
        size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        total = int(size.sum())
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + total] = [t for x in ids for t in x]
        start = self.used + np.cumsum(size) - size
        self.used += total
        return start << 24 | size

    def encode(self, column: pa.Array):
        """Per block of rows: the first row, ids one after the other, their number by row."""
        for block in blocks(column, ENCODED_BYTES):
            if self.known.full():
                self._forget()
            found = pieces(block, self.marks)
            value = np.zeros(len(found.row), dtype=np.int64)
            short = np.flatnonzero(found.end - found.start <= LONGEST)
            value[short] = self.known.of(found, short, self._make)
            long = np.flatnonzero(found.end - found.start > LONGEST)
            if len(long):
                value[long] = self._make(found.texts(long))
            start, size = value >> 24, value & 0xFFFFFF
            ahead = np.cumsum(size) - size
            at = np.repeat(start - ahead, size) + np.arange(int(size.sum()))
            per_row = np.bincount(found.row, weights=size, minlength=block.rows)
            yield block.first, self.pool[at], per_row.astype(np.int64)


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)
