"""Spelling variants: words one edit apart, found by walking a trie as a table.

The trie is an edge table over path-compressed prefixes: an edge leads from a node, a
prefix at which words part, by a label to the next such prefix or to the end of a word.
A state is a word, the part of it that is still to be read, a node, and the edits made.
All states are joined with the edges of their nodes, level by level: a label that agrees
is read, or one edit is spent on its first character, which differs. States that read
their word to its end at the end of another word are neighbours.

Two words one edit apart agree in at least half of the longer one, before the edit or
behind it. So the trie is built of words and of reversed words, and edits are tried only
from the middle on, where few words share a node.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.storage import drop, land
from llm.text import BLOCK_BYTES, Block, Words, blocks, code_points, mix, span_hashes, words

MIN_LENGTH, MIN_COUNT = 5, 3
#: A form has at least this many times the occurrences of its variant.
DOMINANCE = 2
#: Different words that a task counts before it hands them on.
HELD_WORDS = 400_000
_NOT_LETTER = np.array([True, False])


# --- words and their counts ----------------------------------------------------


def letter_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_every: int | None = None, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of the words of at least ``min_length`` code points met ``min_count`` times.

    Words are maximal runs of ``A-Z``, ``a-z`` and U+00C0 to U+00FF; only ``A-Z`` are
    lower-cased. With ``drop_every``, a word of a document whose crc32 of ``<id>:<word>``
    it divides loses the code point at that crc32 modulo its length; a null id loses none.
    Null and empty texts have no words; repeated rows count again. Words are counted in
    each task before they leave it, so a frequent word is not a hot key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            ids, texts = batch.columns
            for block in blocks(texts, 2 * BLOCK_BYTES - 2):
                counts.update(_count_block(block, ids.slice(block.first, block.rows).to_pylist(), drop_every, min_length))
                # a block of text adds at most its own size
                if len(counts) > HELD_WORDS or block.rows == 1:
                    yield from _counted(counts, min_length)
                    counts = Counter()
        yield from _counted(counts, min_length)

    given = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    counted = given.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_count)


def _counted(counts: Counter, min_length: int) -> Iterator[pa.RecordBatch]:
    kept = {w: n for w, n in counts.items() if len(w) >= min_length}
    if kept:
        yield pa.RecordBatch.from_arrays([pa.array(list(kept)), pa.array(list(kept.values()), type=pa.int64())], names=["word", "n"])


def _count_block(block: Block, ids: list, drop_every: int | None, min_length: int = 1) -> Counter:
    points, offsets = code_points(block)
    upper = (points >= 0x41) & (points <= 0x5A)
    letter = upper | ((points >= 0x61) & (points <= 0x7A)) | ((points >= 0xC0) & (points <= 0xFF))
    points = np.where(upper, points + 32, points).astype("<u4")
    found = words(Block(block.first, offsets, letter.astype(np.uint8)), _NOT_LETTER)
    enough = found.end - found.start >= min_length
    found = Words(found.row[enough], found.start[enough], found.end[enough])
    _, first, which = np.unique(span_hashes(points, found.start, found.end), return_index=True, return_inverse=True)
    text = points.tobytes().decode("utf-32-le")
    vocabulary = [text[a:b] for a, b in zip(found.start[first].tolist(), found.end[first].tolist())]
    counts = np.bincount(which, minlength=len(vocabulary))
    changed: Counter = Counter()
    if drop_every and len(vocabulary):
        code = _crc_of_words(vocabulary, which, found.row, ids)
        for i in np.flatnonzero(code % np.uint64(drop_every) == 0):
            word = vocabulary[which[i]]
            if ids[found.row[i]] is not None:
                k = int(code[i]) % len(word)
                changed[word[:k] + word[k + 1 :]] += 1
                counts[which[i]] -= 1
    changed.update({w: int(n) for w, n in zip(vocabulary, counts) if n})
    return changed


def _crc_of_words(vocabulary: list[str], which: np.ndarray, row: np.ndarray, ids: list) -> np.ndarray:
    """crc32 of ``<id>:<word>`` for every occurrence, from one crc32 per word and one per
    id and length: the crc32 of two strings in a row is linear in that of the first."""
    encoded = [w.encode() for w in vocabulary]
    own = np.array([zlib.crc32(w) for w in encoded], dtype=np.uint64)
    size = np.array([len(w) for w in encoded], dtype=np.int64)[which]
    pair, where = np.unique((row << 32) | size, return_inverse=True)
    zeros = {int(n): bytes(int(n)) for n in np.unique(size)}
    plain = {n: zlib.crc32(z) for n, z in zeros.items()}
    heads = [zlib.crc32(f"{i}:".encode()) for i in ids]
    moved = [zlib.crc32(zeros[p & 0xFFFFFFFF], heads[p >> 32]) ^ plain[p & 0xFFFFFFFF] for p in pair.tolist()]
    return np.array(moved, dtype=np.uint64)[where] ^ own[which]


# --- the trie --------------------------------------------------------------------


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every prefix of a word, and of the reversed word, from its middle on, as a hash,
    with the character behind it (0 at the end of the word)."""
    for batch in batches:
        found = batch.column(0).to_pylist()
        for backwards in (0, 1):
            read = [w[::-1] for w in found] if backwards else found
            size = np.array([len(w) for w in read], dtype=np.int64)
            start = np.concatenate(([0], np.cumsum(size)))
            points = np.frombuffer("".join(read).encode("utf-32-le"), dtype=np.uint32)
            middle = size // 2 if backwards else (size + 1) // 2
            many = size - middle + 1
            word = np.repeat(np.arange(len(read)), many)
            depth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + middle[word]
            node = mix(span_hashes(points, start[word], start[word] + depth), backwards)
            behind = np.append(points, np.uint32(0))[start[word] + depth]
            behind = np.where(depth == size[word], 0, behind)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(word)),
                    batch.column(1).take(pa.array(word)),
                    pa.array(np.full(len(word), bool(backwards))),
                    pa.array(depth.astype(np.int32)),
                    pa.array(node.view(np.int64)),
                    pa.array(behind.astype(np.int32)),
                ],
                names=["word", "n", "backwards", "depth", "node", "behind"],
            )


def trie(vocabulary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edge table, and where every word stands at its first node.

    Edges are ``node, label, child, near, near_n, ahead``: the child is null where the label
    ends the word ``near``; ``ahead`` has the first characters of the child's edges, and
    ``END`` if a word ends there. Start states are ``word, n, rest, node, edits``.
    """
    prefixes = land(vocabulary.select("word", "n").mapInArrow(_prefixes, "word string, n long, backwards boolean, depth int, node long, behind int"), "prefixes")
    parting = prefixes.groupBy("node").agg(F.min("behind").alias("low"), F.max("behind").alias("high")).where("low <> high")
    steps = prefixes.join(parting.select("node"), "node")
    paths = steps.groupBy("word", "n", "backwards").agg(F.array_sort(F.collect_list(F.struct("depth", "node"))).alias("nodes"))
    read = F.when(F.col("backwards"), F.reverse("word")).otherwise(F.col("word"))
    paths = land(paths.withColumn("read", read).drop("backwards"), "paths")
    drop(prefixes)
    place = paths.select("word", "n", "read", "nodes", F.posexplode("nodes").alias("at", "here"))
    follows = F.get("nodes", F.col("at") + 1)
    until = F.coalesce(follows["depth"], F.char_length("read"))
    label = F.substring(F.col("read"), F.col("here.depth") + 1, until - F.col("here.depth"))
    leaf = follows.isNull()
    edges = place.select(
        F.col("here.node").alias("node"),
        label.alias("label"),
        follows["node"].alias("child"),
        F.when(leaf, F.col("word")).alias("near"),
        F.when(leaf, F.col("n")).alias("near_n"),
    ).distinct()
    edges = land(edges, "edges")
    # what may be read behind an edge, so that states without a way on are not made
    behind = edges.groupBy("node").agg(F.array_join(F.collect_set(_first("label")), "").alias("ahead"))
    inner = edges.where("child IS NOT NULL").join(behind.withColumnRenamed("node", "child"), "child")
    edges = inner.unionByName(edges.where("child IS NULL"), allowMissingColumns=True)
    start = F.get("nodes", F.lit(0))
    states = paths.select("word", "n", F.substring(F.col("read"), start["depth"] + 1, F.char_length("read")).alias("rest"), start["node"].alias("node"), F.lit(0).alias("edits"))
    return land(edges, "edges"), states


REPLACED, DELETED = 1, 2
#: Stands for the end of a word among the characters of words.
END = "."


def _first(text, at=1):
    """The character at a place, or ``END`` behind the last."""
    return F.when(F.char_length(text) >= at, F.substring(text, at, 1)).otherwise(F.lit(END))


def _step(states: DataFrame, edges: DataFrame) -> DataFrame:
    """All states after one more edge: ``word, n, rest, node, edits``, the node being null
    at the end of ``near``. Nodes have one edge for a first character, so an unedited word
    goes along its own edge, and differs from every other in the first character."""
    rest, label, leaf = F.col("rest"), F.col("label"), F.col("child").isNull()
    tail, size = F.substring(rest, F.lit(2), F.char_length(rest)), F.char_length(label)
    own = F.substring(rest, 1, 1) == F.substring(label, 1, 1)

    def reads(text, path, path_size):
        goes_on = F.startswith(text, path) & F.contains("ahead", _first(text, path_size + 1))
        return F.when(leaf, text == path).otherwise(goes_on)

    def after(text, skipped, edits):
        left = F.substring(text, skipped + 1, F.char_length(text))
        return F.struct(left.alias("rest"), edits.alias("edits"))

    fresh, some = F.col("edits") == 0, F.char_length(rest) > 0
    goes = fresh & own & some & ~leaf
    replaced = fresh & ~own & some & (size > 0) & reads(tail, F.substring(label, F.lit(2), size), size - 1)
    deleted = fresh & ~own & some & reads(tail, label, size)
    follows = ~fresh & reads(rest, label, size)
    outcomes = F.array(
        F.when(goes, after(rest, size, F.lit(0))),
        F.when(replaced, after(tail, size - 1, F.lit(REPLACED))),
        F.when(deleted, after(tail, size, F.lit(DELETED))),
        F.when(follows, after(rest, size, F.col("edits"))),
    )
    met = states.join(edges, "node").where(goes | replaced | deleted | follows)
    met = met.withColumn("_next", F.explode(F.array_compact(outcomes)))
    return met.select("word", "n", "_next.rest", F.col("child").alias("node"), "_next.edits", "near", "near_n")


def near_words(vocabulary: DataFrame) -> DataFrame:
    """``word, n, near, near_n``: every ordered pair of words exactly one inserted, deleted
    or replaced code point apart. ``vocabulary`` has distinct words with ``n``."""
    edges, states = trie(vocabulary)
    pairs, level = None, states
    while True:
        level = land(_step(level, edges), "level")
        done = level.where("node IS NULL").select("word", "n", "near", "near_n", "edits")
        pairs = done if pairs is None else pairs.unionByName(done)
        level = level.where("node IS NOT NULL").select("word", "n", "rest", "node", "edits")
        if level.isEmpty():
            break
    shorter = pairs.where(F.col("edits") == DELETED)
    mirrored = shorter.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return land(pairs.drop("edits").unionByName(mirrored).distinct(), "near")


# --- groups ------------------------------------------------------------------------


def variants(vocabulary: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of ``vocabulary``.

    ``form`` is the near word of largest ``n`` (ties: the smallest in code-point order) if
    it has at least ``dominance`` times the word's own; ``root`` is where the forms lead.
    Words without near words have 0 of them and are their own root. The vocabulary's other
    columns do not matter; an empty one gives no rows.
    """
    vocabulary = land(vocabulary.select("word", "n"), "vocabulary")
    near = near_words(vocabulary)
    best = F.min(F.struct((-F.col("near_n")).alias("by"), F.col("near").alias("form")))
    known = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("_best"))
    found = vocabulary.join(known, "word", "left")
    strong = -F.col("_best.by") >= dominance * F.col("n")
    found = found.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("_best.form")).alias("form"),
        F.when(strong, -F.col("_best.by")).alias("form_n"),
    )
    found = land(found, "forms")
    roots = _roots(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame:
    """``word, root``: links followed to their ends by doubling. They lead to larger counts,
    at least double each time, so there is no circle and the rounds are few."""
    now = land(links, "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("_on"))
        after = land(now.join(onward, "root", "left").select("word", F.coalesce("_on", "root").alias("root"), F.col("_on").isNotNull().alias("moved")), "roots")
        if after.where("moved").isEmpty():
            return after.drop("moved")
        now = after.drop("moved")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_every: int | None = None) -> DataFrame:
    """The spelling variants among the words of ``docs``: see ``letter_words``, ``variants``.

    All texts and words count, whole. The rounds are as many as words part from others on
    one path of the trie, not as words are long, so a very long word costs no more of them.
    """
    return variants(letter_words(docs, id_col, text_col, drop_every))
