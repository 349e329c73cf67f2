"""Language identification by Bloom filters whose cells are bitmasks of languages.

A text is lower-cased, everything but letters becomes one blank, and its n-grams of
``ORDERS`` characters are looked up: a cell of the filter holds one bit per language, so
the conjunction of ``HASHES`` cells is the mask of all languages that contain the n-gram.
Counted per language, less the false positives expected from how full its bits are, the
masks decide.

An n-gram belongs to a language if it makes up 1 / ``GRAMS`` of the language's n-grams of
its order or more, and no language has it more than ``RARER`` times as often; so a
language has at most ``GRAMS`` of each order, and the filter is bounded by the number of
languages. It is fitted on about ``DOCS_PER_LANGUAGE`` texts of each language, chosen by
a hash of the id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.pretokens import LETTER, classes
from llm.storage import drop, land
from llm.text import Block, blocks, code_points, mix

ORDERS = (1, 2, 3, 4)
GRAMS = 20_000
RARER = 4
HASHES = 3
#: Bits of a cell's address.
CELLS = 20
DOCS_PER_LANGUAGE = 4000
UNDECIDED = "und"


@cache
def _folded() -> np.ndarray:
    """Lower-case letter of every code point, a blank for all that is no letter."""
    table = np.arange(0x110000, dtype=np.uint32)
    for c in np.flatnonzero(classes()[:0x20000] == LETTER):
        low = chr(c).lower()
        if len(low) == 1:
            table[c] = ord(low)
    table[classes() != LETTER] = 32
    return table


def grams(block: Block) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per order: the row and the key of every n-gram; the key's low bits are the order.
    A text is enclosed in blanks; n-grams of blanks alone are none."""
    points, rows = code_points(block)
    letters = _folded()[points]
    n = block.rows
    at = np.repeat(rows[:-1], 1)
    symbols = np.insert(letters, at, 32)
    row = np.insert(np.repeat(np.arange(n), np.diff(rows)), at, np.arange(n))
    tail = np.cumsum(np.diff(rows) + 1)
    symbols, row = np.insert(symbols, tail, 32), np.insert(row, tail, np.arange(n))
    blank = symbols == 32
    keep = np.ones(len(symbols), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1] & (row[1:] == row[:-1]))
    symbols, row = symbols[keep].astype(np.uint64), row[keep]
    key = symbols
    for order in range(1, max(ORDERS) + 1):
        if order > 1:
            key = key[:-1] * np.uint64(0x9E3779B97F4A7C15) + symbols[order - 1 :]
        if order in ORDERS:
            end = len(row) - order + 1
            inside = row[: max(end, 0)] == row[order - 1 :]
            if order == 1:
                inside = inside & (symbols != 32)
            spread = mix(key[inside], order)
            yield order, row[: max(end, 0)][inside], (spread & ~np.uint64(7)) | np.uint64(order)


@dataclass
class Filters:
    languages: list[str]
    cells: np.ndarray
    false_rate: np.ndarray

    def count(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Corrected counts by row and language, and n-grams by row."""
        hits = np.zeros((len(column), len(self.languages)))
        total = np.zeros(len(column))
        for block in blocks(column):
            here = slice(block.first, block.first + block.rows)
            for _, row, key in grams(block):
                for w in range(len(self.cells)):
                    mask = self._mask(w, key)
                    for bit in range(min(64, len(self.languages) - 64 * w)):
                        one = ((mask >> mask.dtype.type(bit)) & mask.dtype.type(1)).astype(np.float64)
                        hits[here, 64 * w + bit] += np.bincount(row, weights=one, minlength=block.rows)
                total[here] += np.bincount(row, minlength=block.rows)
        true = (hits - self.false_rate * total[:, None]) / (1 - self.false_rate)
        return np.maximum(true, 0), total

    def _mask(self, word: int, key: np.ndarray) -> np.ndarray:
        table, low = self.cells[word], np.uint64((1 << CELLS) - 1)
        mask = table[(key >> np.uint64(3)) & low]
        for i in range(1, HASHES):
            mask = mask & table[(key >> np.uint64(3 + 20 * i)) & low]
        return mask


def build(languages: list[str], keys: np.ndarray, language: np.ndarray) -> Filters:
    """Filters that contain every key for its language (a place in ``languages``)."""
    width = max(1, (len(languages) + 63) // 64)
    kind = np.uint8 if len(languages) <= 8 else np.uint64
    cells = np.zeros((width, 1 << CELLS), dtype=kind)
    low = np.uint64((1 << CELLS) - 1)
    for i in range(HASHES):
        place = (keys >> np.uint64(3 + 20 * i)) & low
        for lang in range(len(languages)):
            cells[lang // 64, place[language == lang]] |= kind(1 << (lang % 64))
    filled = [np.mean((cells[x // 64] >> kind(x % 64)) & kind(1)) for x in range(len(languages))]
    return Filters(languages, cells, np.array(filled, dtype=float).reshape(-1) ** HASHES)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        lang = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for block in blocks(batch.column(1)):
            for _, row, key in grams(block):
                held.append((lang[block.first + row], key))
                size += len(key)
            if size >= 4_000_000:
                yield _unique(held)
                held, size = [], 0
    if size:
        yield _unique(held)


def _unique(held) -> pa.RecordBatch:
    lang, key = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((lang, key))
    lang, key = lang[order], key[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (lang[1:] != lang[:-1])
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(key)))
    return pa.RecordBatch.from_arrays([pa.array(lang[at]), pa.array(key[at].view(np.int64)), pa.array(n)], names=["lang", "key", "n"])


def fit(texts: DataFrame) -> Filters:
    """Filters from ``doc_id, text, lang``; rows with a null language teach nothing."""
    known = texts.where("lang is not null")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes, key=lambda x: (-sizes[x], x))
    if not languages:
        return build([], np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))
    number = F.create_map(*(F.lit(x) for i, lang in enumerate(languages) for x in (lang, i)))
    share = F.create_map(*(F.lit(x) for lang in languages for x in (lang, int(1e6 * min(1.0, DOCS_PER_LANGUAGE / sizes[lang])))))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share[F.col("lang")])
    counts = chosen.select(number[F.col("lang")].alias("lang"), "text").mapInArrow(_counted, "lang long, key long, n long")
    counts = land(counts.groupBy("lang", "key").agg(F.sum("n").alias("n")), "grams")
    order = F.col("key").bitwiseAND(7)
    totals = counts.groupBy("lang", order.alias("o")).agg(F.sum("n").alias("total")).collect()
    total = F.create_map(*(F.lit(x) for r in totals for x in (r["lang"] * 8 + r["o"], r["total"]))) if totals else F.create_map()
    rate = counts.withColumn("rate", F.col("n") / total[F.col("lang") * 8 + order])
    often = rate.groupBy("key").agg(F.collect_list(F.struct("lang", "n", "rate")).alias("by"), F.max("rate").alias("most"))
    members = often.select("key", "most", F.explode("by").alias("x")).where(
        (F.col("x.n") >= 3) & (F.col("x.rate") >= 1 / GRAMS) & (F.col("x.rate") * RARER >= F.col("most"))
    )
    found = members.select("key", "x.lang").toPandas()
    drop(counts)
    return build(languages, found["key"].to_numpy(dtype=np.int64).view(np.uint64), found["lang"].to_numpy(dtype=np.int64))


def identify(docs: DataFrame, texts: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs``, learned from ``texts``.

    ``score`` is the winner's part of all languages' corrected counts. Texts that are null
    or have no letter are ``und`` with score 0, and so is every text if nothing was
    learned. If no n-gram is known, or at a tie, the language with more rows to learn from
    wins, then the first by name; without any known n-gram its score is 0. Repeated rows
    get equal rows; null ids are passed through; no rows give no rows; other columns do
    not matter.
    """
    taught = texts.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    shared = docs.sparkSession.sparkContext.broadcast(fit(taught))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = shared.value
        names = np.array([*filters.languages, UNDECIDED], dtype=object)
        for batch in batches:
            true, total = filters.count(batch.column(1))
            best = true.argmax(axis=1) if len(filters.languages) else np.zeros(len(true), dtype=int)
            known = true.sum(axis=1)
            top = true.max(axis=1, initial=0)
            score = np.divide(top, known, out=np.zeros_like(known), where=known > 0)
            best = np.where((total > 0) & bool(filters.languages), best, len(filters.languages))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[best], pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"]
            )

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(run, "doc_id long, lang_pred string, score double")
