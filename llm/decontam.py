"""Benchmark decontamination by latent semantic retrieval and checks of what it finds.

*Terms.* A benchmark word counts as a term if at most ``TERM_SHARE`` of all documents
have it, or if it is among the ``RAREST`` rarest of an item, so every item has terms.

*Passages.* A text's words (letters and digits, lower-cased) are cut into runs of
``RUN``; a passage is two neighbouring runs of 1, 2, 4 ... such. Items are sorted by
length: one of up to ``RUN * 2**c`` words is compared with the passages of class c, some of
which hold the whole of any copy. Texts are taken whole.

*Index.* Passages are TF-IDF vectors over the terms of the benchmark, as no other term
can add to a product with an item; document frequencies are those of all documents. A
randomised SVD, its products with the passage matrix summed from partitions, gives
``RANK`` latent dimensions. It is fitted on the items and on the runs of every document:
what it needs of them is how much any two terms weigh together in a run, which one pass
adds up. Every passage of every document is indexed.

*Search and checks.* Items are the stated query set, taken ``ITEMS`` at a time. Passages
whose latent cosine with an item is at least ``COSINE`` are candidates. A candidate is
confirmed if ``COPIED`` words of the item in a row stand in it, if the longest common
subsequence holds ``COPY`` of the item's words, or ``PARAPHRASE`` of them while the item's
answer stands in the passage word for word. Where no answer is given, ``PARAPHRASE`` of them
within ``SPAN`` times the item's length are enough.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.storage import drop, land, small_if
from llm.text import PUNCTUATION, blocks, mix, word_hashes, words

RUN = 16
RANK = 128
OVERSAMPLE = 16
#: Tasks that multiply the weights of pairs of terms; each returns a matrix of ``RANK``.
PARTS = 4
ITEMS = 256
TERM_SHARE = 0.01
RAREST = 8
COSINE = 0.3
COPY = 0.8
PARAPHRASE = 0.5
#: Words in a row that are a copy, whatever part of the item they are.
COPIED = 13
#: Length of text, by that of the item, in which a paraphrase stands.
SPAN = 1.25
#: Words of an item's end that count as its answer where none is given.
ANSWER = 5
PAIRS = "doc_id long, item_id long, cosine double, common_words long, item_words long, answer_found boolean"


@dataclass
class Item:
    item_id: int
    terms: np.ndarray
    answer: np.ndarray
    answer_given: bool
    grams: np.ndarray
    masks: dict[int, int]


@dataclass
class Index:
    """Terms, their weights times the latent basis, the items by class, and all their runs."""

    terms: np.ndarray
    basis: np.ndarray
    classes: dict[int, tuple[list[Item], np.ndarray]]
    grams: np.ndarray


def _terms(text: str | None) -> np.ndarray:
    block = next(blocks(pa.array([text or ""])))
    return word_hashes(block, words(block, PUNCTUATION), lower=True)


def _class(n: int) -> int:
    return max(0, int(np.ceil(np.log2(max(n, 1) / RUN))))


def _places(terms: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Rows of the terms; their number stands for any other word."""
    at = np.minimum(np.searchsorted(terms, found), len(terms) - 1)
    return np.where(terms[at] == found, at, len(terms))


def _runs(row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and row of every run of ``RUN`` words; the last of a row may be short."""
    n = np.bincount(row, minlength=rows)
    first = np.cumsum(n) - n
    lead = np.flatnonzero((np.arange(len(row)) - first[row]) % RUN == 0)
    return lead, row[lead]


def _passages(total: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums over ``2 * size`` runs from every ``size``-th run of a row, and where each begins;
    ``total`` has the sums of all runs before each."""
    n = np.bincount(owner) if len(owner) else np.zeros(0, dtype=int)
    first = np.cumsum(n) - n
    place = np.arange(len(owner)) - first[owner]
    start = np.flatnonzero((place % size == 0) & ((place == 0) | (place + size < n[owner])))
    end = np.minimum(start + 2 * size, (first + n)[owner[start]])
    return start, total[end] - total[start]


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, size, out=np.zeros_like(x), where=size > 1e-9)


def _masks(terms: np.ndarray) -> dict[int, int]:
    """Each word's places, as bits."""
    masks: dict[int, int] = {}
    for i, w in enumerate(terms.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    return masks


def common_subsequence(left: np.ndarray, right: np.ndarray) -> int:
    """Length of the longest common subsequence, a row of bits for ``left`` at a time."""
    return _common(_masks(left), len(left), right.tolist())


def _common(masks: dict[int, int], n: int, right: list[int]) -> int:
    full = (1 << n) - 1
    row = full
    for w in right:
        if hit := row & masks.get(w, 0):
            row = ((row + hit) | (row - hit)) & full
    return n - row.bit_count()


def _may_share(masks: dict[int, int], words: set[int], least: float) -> bool:
    """Whether ``least`` places of an item have a word of the text; no common subsequence
    is longer than that."""
    return sum(masks[w].bit_count() for w in masks.keys() & words) >= least


def _contains(text: np.ndarray, part: np.ndarray) -> bool:
    n = len(part)
    if not n or n > len(text):
        return False
    return any(np.array_equal(text[i : i + n], part) for i in np.flatnonzero(text[: len(text) - n + 1] == part[0]))


def _grams(one: np.ndarray) -> np.ndarray:
    """Hashes of all runs of ``COPIED`` words."""
    n = max(len(one) - COPIED + 1, 0)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(COPIED):
        out = out * np.uint64(0x9E3779B97F4A7C15) + one[k : k + n]
    return mix(out)


def _within_span(item: Item, text: list[int]) -> bool:
    """``PARAPHRASE`` of the item's words, in order, in ``SPAN`` times its length."""
    n = len(item.terms)
    wide, step = int(np.ceil(SPAN * n)), max(1, n // 8)
    starts = range(0, max(len(text) - wide, 0) + step, step)
    return any(_common(item.masks, n, text[i : i + wide]) >= PARAPHRASE * n for i in starts)


def _document_frequencies(docs: DataFrame, terms: np.ndarray) -> tuple[np.ndarray, int]:
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        count, seen = np.zeros(len(known), dtype=np.int64), 0
        for batch in batches:
            seen += batch.num_rows
            for block in blocks(batch.column(1)):
                found = words(block, PUNCTUATION)
                at = _places(known, word_hashes(block, found, lower=True))
                keep = at < len(known)
                pair = np.unique(found.row[keep].astype(np.int64) * len(known) + at[keep])
                count += np.bincount(pair % len(known), minlength=len(known))
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(count[at], seen))], names=["term", "n"])

    counts = docs.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(len(terms) + 1)
    out[counts["term"].to_numpy()] = counts["n"].to_numpy()
    return out[:-1], int(out[-1])


def _together(docs: DataFrame, terms: np.ndarray, weight: np.ndarray) -> DataFrame:
    """The upper triangle of A^T A for the unit vectors A of the runs of all documents:
    one row for any two terms that some run has."""
    shared = docs.sparkSession.sparkContext.broadcast((terms, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, idf = shared.value
        n = len(known)
        for batch in batches:
            for block in blocks(batch.column(1)):
                found = words(block, PUNCTUATION)
                at = _places(known, word_hashes(block, found, lower=True))
                lead, _ = _runs(found.row, block.rows)
                kept = np.flatnonzero(at < n)
                if not len(kept):
                    continue
                run_of = np.searchsorted(lead, kept, side="right") - 1
                cell, count = np.unique(run_of * n + at[kept], return_counts=True)
                r, t = cell // n, cell % n
                value = count * idf[t]
                value = value / np.sqrt(np.bincount(r, weights=value**2))[r]
                cells, values = [], []
                for step in range(RUN):  # cells are sorted by run and term
                    low = np.flatnonzero(r[: len(r) - step] == r[step:])
                    cells.append(t[low] * n + t[low + step])
                    values.append(value[low] * value[low + step])
                    if not len(low):
                        break
                pair, place = np.unique(np.concatenate(cells), return_inverse=True)
                total = np.bincount(place, weights=np.concatenate(values))
                yield pa.RecordBatch.from_arrays([pa.array(pair // n), pa.array(pair % n), pa.array(total)], names=["low", "high", "value"])

    return docs.mapInArrow(run, "low long, high long, value double").groupBy("low", "high").agg(F.sum("value").alias("value"))


def _products(together: DataFrame, right: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """A^T (A right) for the vectors A of the runs and of ``rows``."""
    shared = together.sparkSession.sparkContext.broadcast(right)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = shared.value
        total = np.zeros_like(wide)
        for batch in batches:
            low, high, value = (c.to_numpy() for c in batch.columns)
            for row, column, share in ((low, high, value), (high, low, np.where(low == high, 0.0, value))):
                order = np.argsort(row, kind="stable")
                head = np.flatnonzero(np.diff(row[order], prepend=-1))
                if len(head):
                    total[row[order[head]]] += np.add.reduceat(share[order, None] * wide[column[order]], head, axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    parts = together.coalesce(PARTS).mapInArrow(run, "part binary").collect()  # PARTS matrices at most
    total = rows.T @ (rows @ right)
    for x in parts:
        total += np.frombuffer(x["part"], dtype=np.float64).reshape(total.shape)
    return total


def _basis(docs: DataFrame, terms: np.ndarray, weight: np.ndarray, items: list[Item]) -> np.ndarray:
    """Right singular vectors by a randomised range and one power step."""
    together = land(_together(docs, terms, weight), "together")
    rows = np.zeros((len(items), len(terms)))
    for i, item in enumerate(items):
        at = _places(terms, item.terms)
        np.add.at(rows[i], at[at < len(terms)], 1)
    rows = _unit(rows * weight)
    width = min(RANK + OVERSAMPLE, len(terms))
    q = np.random.default_rng(0).standard_normal((len(terms), width))
    for _ in range(2):
        q, _ = np.linalg.qr(_products(together, q, rows))
    values, vectors = np.linalg.eigh(q.T @ _products(together, q, rows))
    drop(together)
    return q @ vectors[:, ::-1][:, :RANK]


def build_index(docs: DataFrame, items: list[Item]) -> Index:
    terms = np.unique(np.concatenate([x.terms for x in items]))
    frequency, n_docs = _document_frequencies(docs, terms)
    chosen = frequency <= TERM_SHARE * n_docs
    for x in items:
        own = np.unique(_places(terms, x.terms))
        chosen[own[np.argsort(frequency[own], kind="stable")[:RAREST]]] = True
    terms, frequency = terms[chosen], frequency[chosen]
    weight = np.log((n_docs + 1) / (frequency + 0.5)).clip(min=0.05) ** 2
    basis = weight[:, None] * _basis(docs, terms, weight, items)
    basis = basis.astype(np.float32)
    classes: dict[int, tuple[list[Item], np.ndarray]] = {}
    for c in sorted({_class(len(x.terms)) for x in items}):
        own = [x for x in items if _class(len(x.terms)) == c]
        places = [_places(terms, x.terms) for x in own]
        vectors = np.array([basis[at[at < len(terms)]].sum(axis=0) for at in places])
        classes[c] = (own, _unit(vectors).astype(np.float32))
    return Index(terms, basis, classes, np.unique(np.concatenate([x.grams for x in items])))


def _matches(index: Index, block) -> Iterator[tuple[int, Item, float, int, bool]]:
    found = words(block, PUNCTUATION)
    if not len(found.row):
        return
    one = word_hashes(block, found, lower=True)
    lead, owner = _runs(found.row, block.rows)
    grams = _grams(one)
    copies = np.flatnonzero(np.isin(grams, index.grams))
    at = _places(index.terms, one)
    runs = np.zeros((len(lead), index.basis.shape[1]), dtype=np.float32)
    known = np.flatnonzero(at < len(index.terms))
    run_of = np.searchsorted(lead, known, side="right") - 1
    head = np.flatnonzero(np.diff(run_of, prepend=-1))
    if not len(head):
        return
    runs[run_of[head]] = np.add.reduceat(index.basis[at[known]], head, axis=0)
    total = np.concatenate([np.zeros((1, runs.shape[1])), np.cumsum(runs, axis=0, dtype=np.float64)])
    stop = np.append(lead[1:], len(at))
    ends = np.searchsorted(owner, owner, side="right") - 1  # the last run of the same row
    for c, (items, latent) in index.classes.items():
        start, sums = _passages(total, owner, 1 << c)
        cosine = _unit(sums).astype(np.float32) @ latent.T
        last = np.minimum(start + 2 * (1 << c) - 1, ends[start])
        first_copy = np.searchsorted(copies, lead[start])
        after_copies = np.searchsorted(copies, stop[last] - COPIED + 1)
        before = -1
        for p, k in zip(*(x.tolist() for x in np.nonzero(cosine >= COSINE)), strict=True):
            if p != before:  # candidates come passage by passage
                before = p
                text = one[lead[start[p]] : stop[last[p]]]
                listed = text.tolist()
                had = set(listed)
                low, high = first_copy[p], after_copies[p]
            item = items[k]
            least = PARAPHRASE * len(item.terms)
            copied = low < high and bool(np.isin(grams[copies[low:high]], item.grams).any())
            if not copied and not _may_share(item.masks, had, least):
                continue
            common = _common(item.masks, len(item.terms), listed)
            if common < least and not copied:
                continue
            answered = _contains(text, item.answer)
            alike = copied or common >= COPY * len(item.terms) or answered
            if alike or (not item.answer_given and _within_span(item, listed)):
                yield int(owner[start[p]]), item, float(cosine[p, k]), common, answered


def _search(docs: DataFrame, index: Index) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            best: dict[tuple, tuple] = {}
            for block in blocks(batch.column(1)):
                for row, item, cosine, common, answered in _matches(shared.value, block):
                    key = (block.first + row, item.item_id)
                    best[key] = max(best.get(key, (-1, 0, 0, False)), (common, len(item.terms), cosine, answered))
            rows = [(ids[r], i, c, n, size, a) for (r, i), (n, size, c, a) in best.items()]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.bool_()]
            names = [x.split()[0] for x in PAIRS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return docs.mapInArrow(run, PAIRS)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", answer_col: str | None = None) -> DataFrame:
    """``doc_id, item_id, cosine, common_words, item_words, answer_found``: every document
    with every item it contains, once, by its best passage.

    The answer is that of ``answer_col``, or the item's last ``ANSWER`` words. Null or
    wordless texts and items match nothing; equal items are found each by its own id, rows
    that repeat an item or a document are found once. A null document id is returned as
    null, once per item. No rows of either side give no rows. Other columns do not matter.
    """
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    asked = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"), (F.col(answer_col) if answer_col else F.lit(None)).cast("string").alias("answer"))
    found = None
    held: list[Item] = []
    for row in asked.dropDuplicates().sort("item_id", "text", "answer").toLocalIterator():  # the query set, one block at a time
        terms = _terms(row["text"])
        if len(terms):
            answer = _terms(row["answer"]) if row["answer"] else terms[-ANSWER:]
            held.append(Item(row["item_id"], terms, answer, bool(row["answer"]), np.unique(_grams(terms)), _masks(terms)))
        if len(held) == ITEMS:
            found, held = _more(found, given, held), []
    if held:
        found = _more(found, given, held)
    if found is None:
        return docs.sparkSession.createDataFrame([], PAIRS)
    best = F.max(F.struct("common_words", "item_words", "cosine", "answer_found")).alias("x")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "x.cosine", "x.common_words", "x.item_words", "x.answer_found")


def _more(found: DataFrame | None, docs: DataFrame, items: list[Item]) -> DataFrame:
    pairs = land(_search(docs, build_index(docs, items)), "leaks")
    return pairs if found is None else found.union(pairs)


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item, with their own columns.

    What is found is found in an id and a text together: rows without an id are judged by
    their text, and of rows that share an id each goes or stays for itself.
    """
    row = F.xxhash64(docs[id_col].cast("long"), docs[text_col].cast("string"))
    given = docs.select(row.alias("doc_id"), docs[text_col].alias("text"))
    leaks = land(find_leaks(given, benchmark).select(F.col("doc_id").alias("key")).distinct(), "leaked")
    return docs.join(small_if(leaks), row == leaks["key"], "left_anti")
