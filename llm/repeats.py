"""Repeated strings of bytes, found by suffix sorting in buckets.

A string of ``WIDTH`` bytes that is met again shares its anchor: the place in it whose
next ``WIDTH - REACH + 1`` bytes have the smallest hash. Places of one anchor are one
bucket, and a place's context is what the strings around that anchor cover. Equal
contexts are one class before any sorting; a class met twice is repeated as a whole. The
classes of a bucket are sorted by suffixes in two stages: only suffixes smaller than their
successors are sorted directly, the others are induced by scanning the buckets of first
characters in order. Neighbours in the order with ``WIDTH`` bytes in common are repeated.

A bucket of many classes is cut before it is sorted: strings of fewer positions around the
anchor share more bytes, so each such part has a bucket of its own by those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.storage import drop, land, small_if
from llm.text import blocks, mix, rolling_hashes, span_hashes

WIDTH = 400
#: Positions that a string may have around its anchor.
REACH = 100
#: Classes of a bucket that one task sorts together; larger buckets are cut.
BUCKET_CLASSES = 1024
#: Bytes of contexts that are sorted at a time.
CHUNK_BYTES = 1 << 20
#: Rows of a table that every task holds for a join.
SMALL_ROWS = 1 << 14
#: Pairs of strings whose bytes are compared at a time.
COMPARED = 1 << 11

_ANCHORS = "text_key binary, anchors array<struct<bucket:long,context:long,at:int,before:int,size:int>>"


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, bucket_classes: int = BUCKET_CLASSES) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` for every row of ``docs``.

    ``spans`` lists the maximal runs (``first, beyond``, in bytes) that are covered by
    strings of ``width`` bytes that start anywhere else too, in the same text or another;
    ``kept`` is the rest of the bytes. All strings are judged on the texts as given. Null
    and empty texts have no bytes; equal texts, repeated rows included, repeat each other
    wholly if they have ``width`` bytes; ids are passed through, null or not; other columns
    do not matter. Nothing of a text is skipped. Strings and texts are told apart by hashes
    of 64 and 128 bits; strings in different contexts are compared byte by byte.
    """
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    keyed = given.withColumn("text_key", F.unhex(F.md5(F.col("text"))))
    spans = repeated_spans(keyed.select("text_key", "text"), width, bucket_classes)
    by_text = spans.groupBy("text_key").agg(F.collect_set(F.struct("first", "beyond")).alias("spans"))
    by_text = land(by_text.mapInArrow(_maximal, by_text.schema), "spans")
    joined = keyed.join(_small(by_text, by_text.select(F.explode("spans"))), "text_key", "left")
    kind = given.select("doc_id").schema.simpleString()[len("struct<") : -1].replace(":", " ", 1)
    shape = f"{kind}, n_bytes long, spans array<struct<first:long,beyond:long>>, kept binary"
    return joined.select("doc_id", "text", "spans").mapInArrow(_cut, shape)


def _small(by_text: DataFrame, listed: DataFrame) -> DataFrame:
    """Mark a table of lists for broadcast if all lists together have few entries."""
    return small_if(by_text, SMALL_ROWS if listed.count() <= SMALL_ROWS else -1)


def repeated_spans(texts: DataFrame, width: int = WIDTH, bucket_classes: int = BUCKET_CLASSES) -> DataFrame:
    """``text_key, first, beyond``: bytes that repeated strings cover, in parts.

    ``texts`` has ``text_key`` and ``text``; a text may be given many times.
    """
    reach = min(REACH, width // 4 + 1)
    found = land(texts.where(F.octet_length("text") >= width).mapInArrow(_anchors(width, reach), _ANCHORS), "anchors")
    each = found.select("text_key", F.explode("anchors").alias("a")).select("text_key", "a.*")
    again = land(each.groupBy("bucket").agg(F.count(F.lit(1)).alias("met")).where("met > 1").select("bucket"), "buckets")
    places = land(each.join(small_if(again, SMALL_ROWS), "bucket"), "places")
    drop(found, again)
    one = F.min(F.struct("text_key", "at", "before", "size")).alias("one")
    classes = land(places.groupBy("bucket", "context").agg(F.count(F.lit(1)).alias("met"), one), "classes")
    several = classes.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    ones = land(classes.join(small_if(land(several, "buckets"), SMALL_ROWS), "bucket").select("bucket", "context", "met", "one.*"), "ones")
    contexts = land(_contexts(texts, ones), "contexts")
    drop(ones)
    whole = _whole(classes.select("bucket", "context", "met", "one.before", "one.size"), width)
    marks = land(_per_class(whole.unionByName(class_marks(contexts, width, reach, bucket_classes))), "marks")
    drop(contexts, classes)
    return _covered(places, marks, width)


def _per_class(marks: DataFrame) -> DataFrame:
    """One range a class. The strings of a context all hold its anchor, so the bytes that
    they cover are one stretch, from the first string's first to the last one's last."""
    return marks.groupBy("bucket", "context").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def _whole(classes: DataFrame, width: int) -> DataFrame:
    """Marks of classes that are met twice: all strings of their contexts."""
    twice = classes.where("met > 1")
    high = F.col("size") - F.col("before") - width
    return twice.select("bucket", "context", (-F.col("before")).cast("long").alias("low"), high.cast("long").alias("high"))


def class_marks(contexts: DataFrame, width: int, reach: int, bucket_classes: int) -> DataFrame:
    """``bucket, context, low, high``: first bytes, counted from the anchor, of the first and
    last of strings that stand in two classes of a bucket.

    ``contexts`` is landed and has ``bucket, context, met, before, bytes``, one row a class.
    A bucket of more than ``bucket_classes`` is cut into parts of the reach; what is found
    in a part holds for the classes that the part's contexts come from.
    """
    buckets = land(contexts.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_classes")).where("n_classes > 1"), "buckets")
    sortable = contexts.join(small_if(buckets.where(F.col("n_classes") <= bucket_classes), SMALL_ROWS), "bucket")
    sortable = sortable.select("bucket", "context", "before", "bytes").repartition("bucket").sortWithinPartitions("bucket")
    marks = sortable.mapInArrow(_sorter(width, reach), "bucket long, context long, low long, high long")
    large = buckets.where(F.col("n_classes") > bucket_classes).select("bucket")
    if reach == 1 or large.isEmpty():
        return marks
    finer = -(-reach // 5)
    given = contexts.join(small_if(large, SMALL_ROWS), "bucket").select("bucket", "context", "met", "before", "bytes")
    parts = given.mapInArrow(_splitter(width, reach, finer), _PARTS)
    merged = parts.groupBy("bucket", "context").agg(F.sum("met").alias("met"), F.first("before").alias("before"), F.first("bytes").alias("bytes"))
    merged = land(merged, "contexts")
    whole = _whole(merged.withColumn("size", F.length("bytes")), width)
    found = land(_per_class(whole.unionByName(class_marks(merged, width, finer, bucket_classes))), "marks")
    drop(merged)
    # the parts are cut again, without their bytes being kept
    back = parts.select("bucket", "context", "old", "old_class", "moved").join(small_if(found, SMALL_ROWS), ["bucket", "context"])
    back = back.select(
        F.col("old").alias("bucket"),
        F.col("old_class").alias("context"),
        (F.col("low") + F.col("moved")).alias("low"),
        (F.col("high") + F.col("moved")).alias("high"),
    )
    return marks.unionByName(back)


def _covered(places: DataFrame, marks: DataFrame, width: int) -> DataFrame:
    """The bytes of the marked strings at all places of a class."""
    met = places.join(small_if(marks, SMALL_ROWS), ["bucket", "context"])
    first, beyond = F.col("at") + F.col("low"), F.col("at") + F.col("high") + width
    return met.select("text_key", first.alias("first"), beyond.alias("beyond"))


# --- anchors and contexts --------------------------------------------------------


def _anchors(width: int, reach: int):
    """Per text its anchors: bucket, class, place, and the context's extent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                at, row = anchors(block.data, block.offsets, width, reach)
                if len(at):
                    begin, end = _extent(at, block.offsets[row], block.offsets[row + 1], width, reach)
                    bucket = span_hashes(block.data, at, at + width - reach + 1)
                    # the anchor's place in its context belongs to the class
                    context = mix(span_hashes(block.data, begin, end) + (at - begin).astype(np.uint64))
                    fields = [
                        pa.array(bucket.view(np.int64)),
                        pa.array(context.view(np.int64)),
                        *(pa.array(x.astype(np.int32)) for x in (at - block.offsets[row], at - begin, end - begin)),
                    ]
                    listed = pa.StructArray.from_arrays(fields, names=["bucket", "context", "at", "before", "size"])
                    rows, head = np.unique(row, return_index=True)
                    lists = pa.ListArray.from_arrays(pa.array(np.append(head, len(row)).astype(np.int32)), listed)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows + block.first)), lists], names=["text_key", "anchors"])

    return run


def _extent(at, low, high, width, reach):
    """Where the contexts of anchors begin and end inside the texts' bytes."""
    return np.maximum(at - reach + 1, low), np.minimum(at + width, high)


def anchors(data: np.ndarray, offsets: np.ndarray, width: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Places, and their rows, that are the anchor of some string of ``width`` bytes: those
    of the smallest among the ``reach`` hashes that lie in the string."""
    n = len(data) - width + 1
    own = np.zeros(max(n, 0), dtype=bool)
    for low, high in zip(offsets[:-1], offsets[1:]):
        own[low : max(high - width + 1, low)] = True
    if not own.any():
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    hashes = rolling_hashes(data, width - reach + 1)
    # the string at i takes the minimum of the hashes i to i + reach - 1
    least = _sliding(hashes, reach, np.minimum, np.uint64(2**64 - 1))[:n]
    # a hash is an anchor if it is the minimum of one of the strings that it lies in
    asked = np.zeros(len(hashes) + reach - 1, dtype=np.uint64)
    asked[reach - 1 : reach - 1 + n] = np.where(own, least, np.uint64(0))
    most = _sliding(asked, reach, np.maximum, np.uint64(0))[: len(hashes)]
    at = np.flatnonzero(most == hashes)
    return at, np.searchsorted(offsets, at, side="right") - 1


def _sliding(values: np.ndarray, size: int, op: np.ufunc, neutral) -> np.ndarray:
    """``op`` over every stretch of ``size`` values, from running ones of blocks."""
    padded = np.full((len(values) // size + 2) * size, neutral)
    padded[: len(values)] = values
    blocks_ = padded.reshape(-1, size)
    ahead, behind = np.empty_like(blocks_), np.empty_like(blocks_)
    op.accumulate(blocks_, axis=1, out=ahead)
    op.accumulate(blocks_[:, ::-1], axis=1, out=behind[:, ::-1])
    return op(behind.reshape(-1)[: len(values)], ahead.reshape(-1)[size - 1 : size - 1 + len(values)])


def _contexts(texts: DataFrame, ones: DataFrame) -> DataFrame:
    """``bucket, context, met, before, bytes``: one context of every class, read from a text."""
    by_text = ones.groupBy("text_key").agg(F.collect_list(F.struct("bucket", "context", "met", "at", "before", "size")).alias("ones"))
    by_text = land(by_text, "ones")
    met = texts.join(_small(by_text, ones), "text_key").select("text_key", "text", "ones")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = set()  # of the copies of a text, a task reads one
        for batch in batches:
            for key, text, listed in zip(*batch.columns):
                if key.as_py() in read:
                    continue
                read.add(key.as_py())
                data, flat = text.as_buffer(), listed.values
                columns = [flat.field(name) for name in ("bucket", "context", "met", "before")]
                place = [flat.field(name).to_numpy() for name in ("at", "before", "size")]
                view = memoryview(data)
                cut = [bytes(view[a - b : a - b + s]) for a, b, s in zip(*(p.tolist() for p in place))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(cut, type=pa.binary())], names=["bucket", "context", "met", "before", "bytes"])

    cut_out = met.mapInArrow(run, "bucket long, context long, met long, before int, bytes binary")
    return cut_out.dropDuplicates(["bucket", "context"])


# --- sorting ---------------------------------------------------------------------


def _sorter(width: int, reach: int):
    """Strings met twice in different contexts of a bucket: their first bytes, from the
    anchor, as maximal ranges. A partition is sorted by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size > CHUNK_BYTES and held and held[-1][0] != row[0]:
                    yield from _ranges(held, width, reach)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield from _ranges(held, width, reach)

    return run


def _ranges(held: list, width: int, reach: int) -> Iterator[pa.RecordBatch]:
    bucket, context, before = (np.array([r[k] for r in held], dtype=np.int64) for k in range(3))
    of, starts = repeated_starts([r[3] for r in held], bucket, before, width)
    if len(of):
        edge = np.flatnonzero((np.diff(starts) != 1) | (np.diff(of) != 0))
        first, last = np.append(0, edge + 1), np.append(edge, len(of) - 1)
        of = of[first]
        columns = bucket[of], context[of], starts[first] - before[of], starts[last] - before[of]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bucket", "context", "low", "high"])


def repeated_starts(contexts: list[bytes], buckets: np.ndarray, before: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The starts, up to the anchors, of strings that another start has too: the context of
    each, in order, and where in it."""
    size = np.array([len(c) for c in contexts])
    begin = np.concatenate(([0], np.cumsum(size + 1)))[:-1]
    wanted = np.minimum(before + 1, size - width + 1)
    # UTF-8 has no byte 255: every byte is raised by one, and 0 ends a context
    data = np.zeros(int(begin[-1] + size[-1] + 1), dtype=np.uint8)
    for a, c in zip(begin, contexts):
        data[a : a + len(c)] = np.frombuffer(c, dtype=np.uint8) + np.uint8(1)
    order = two_stage_order(data, begin, begin + wanted - 1, width)
    owner = np.repeat(np.arange(len(contexts)), size + 1)[order]
    full = order - begin[owner] < wanted[owner]
    order, owner = order[full], owner[full]
    equal = equal_strings(data, order[:-1], order[1:], width)
    # neighbouring anchors show the same string twice: it must stand at the same distance
    # from the same anchor in another class
    same = np.cumsum(np.append(0, ~equal))
    bucket = np.unique(buckets, return_inverse=True)[1][owner]
    ahead = before[owner] - (order - begin[owner])
    place = (same * (bucket.max(initial=0) + 1) + bucket) * (int(before.max()) + 1) + ahead
    _, which, met = np.unique(place, return_inverse=True, return_counts=True)
    repeated = met[which] > 1
    at, of = order[repeated], owner[repeated]
    by_place = np.argsort(at)
    at, of = at[by_place], of[by_place]
    return of, at - begin[of]


def smaller_than_next(data: np.ndarray) -> np.ndarray:
    """Whether a suffix is smaller than its successor, both read up to the next end (0)."""
    differs = data[1:] != data[:-1]
    change = np.flatnonzero(differs)
    run = np.append(0, np.cumsum(differs))  # changes before each place
    rises = np.append(data[change + 1] > data[change], False)
    return rises[run]


def two_stage_order(data: np.ndarray, first: np.ndarray, last: np.ndarray, width: int) -> np.ndarray:
    """Suffixes that begin at ``first`` to ``last`` of each context, ordered by ``width``
    bytes and more.

    Each range is carried on to a suffix smaller than its successor, or to the end of the
    context, so whatever is not sorted directly has its successor in the order.
    """
    rising = smaller_than_next(data)
    seeds = np.flatnonzero(rising | (data == 0))
    last = seeds[np.searchsorted(seeds, last)]
    inside = np.zeros(len(data) + 1, dtype=np.int32)
    np.add.at(inside, first, 1)
    np.add.at(inside, last + 1, -1)
    inside = np.cumsum(inside[:-1]) > 0
    text = data.tobytes()
    direct = np.flatnonzero(inside & (rising | (data == 0))).tolist()
    keys = {i: text[i : i + width] for i in direct}
    direct = np.array(sorted(direct, key=keys.__getitem__), dtype=np.int64)
    del keys
    head = data[direct]
    bounds = np.searchsorted(head, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    order = []
    for c in range(256):
        induced = waiting[c]
        if induced:
            newest = np.concatenate(induced)
            induced = [newest]
            while len(newest):
                # runs of one character: each is larger than the same with one less
                newest = newest[newest > 0] - 1
                newest = newest[(data[newest] == c) & inside[newest]]
                induced.append(newest)
        here = np.concatenate([*induced, direct[bounds[c] : bounds[c + 1]]])
        if not len(here):
            continue
        order.append(here)
        previous = here[here > 0] - 1
        previous = previous[(data[previous] > c) & inside[previous]]
        if len(previous):
            previous = previous[np.argsort(data[previous], kind="stable")]
            cut = np.flatnonzero(np.diff(data[previous])) + 1
            for part in np.split(previous, cut):
                waiting[data[part[0]]].append(part)
        waiting[c] = []
    order = np.concatenate(order) if order else direct
    return order[data[order] > 0]


def equal_strings(data: np.ndarray, a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    """Whether the ``width`` bytes at ``a`` and ``b`` are the same."""
    padded = np.concatenate((data, np.zeros(width, dtype=np.uint8)))
    strings = np.lib.stride_tricks.as_strided(padded[:width].view(f"V{width}"), shape=(len(data) + 1,), strides=(1,))
    out = np.ones(len(a), dtype=bool)
    for k in range(0, width, max(width // 8, 1)):  # most that differ do so at one of these
        out &= data[np.minimum(a + k, len(data) - 1)] == data[np.minimum(b + k, len(data) - 1)]
    still = np.flatnonzero(out)
    for k in range(0, len(still), COMPARED):
        part = still[k : k + COMPARED]
        left, right = (strings[x[part]].view(np.uint8).reshape(-1, width) for x in (a, b))
        out[part] = (left == right).all(axis=1)
    return out


# --- cutting large buckets ----------------------------------------------------------


_PARTS = "old long, old_class long, bucket long, context long, met long, moved int, before int, bytes binary"


def _splitter(width: int, reach: int, finer: int):
    """Contexts of large buckets by parts of the reach.

    The ``finer`` strings of a part share more bytes than the anchor, and the part has the
    bucket of those; its contexts are shorter, so more of them are equal.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for old, old_class, met, before, data in zip(*(c.to_pylist() for c in batch.columns)):
                symbols, salt = np.frombuffer(data, dtype=np.uint8), np.array([old & (2**64 - 1)], dtype=np.uint64)
                for part in range(-(-reach // finer)):
                    # the part's strings begin part * finer and up to finer - 1 more before the anchor
                    at, size = before - part * finer, width - finer + 1
                    if at < 0 or len(data) < at + size:
                        continue  # no string of this part is in the text
                    begin, end = max(at - finer + 1, 0), min(at + width, len(data))
                    shared = span_hashes(symbols, np.array([at]), np.array([at + size])) ^ mix(salt, part)
                    own = mix(span_hashes(symbols, np.array([begin]), np.array([end])) + np.uint64(at - begin))
                    codes = (int(x.view(np.int64)[0]) for x in (shared, own))
                    out.append((old, old_class, *codes, met, at - before, at - begin, data[begin:end]))
            if out:
                kinds = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.binary()]
                names = ["old", "old_class", "bucket", "context", "met", "moved", "before", "bytes"]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*out), kinds)], names=names)

    return run


# --- results ------------------------------------------------------------------------


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("beyond", pa.int64())]))


def _maximal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of each text put together where they overlap or touch, in order."""
    for batch in batches:
        out = []
        for listed in batch.column(1):
            first, beyond = (listed.values.field(name).to_numpy() for name in ("first", "beyond"))
            order = np.argsort(first, kind="stable")
            first, reach = first[order], np.maximum.accumulate(beyond[order])
            head = np.flatnonzero(np.append(True, first[1:] > reach[:-1]))
            ends = reach[np.append(head[1:], len(reach)) - 1]
            out.append([{"first": a, "beyond": b} for a, b in zip(first[head].tolist(), ends.tolist())])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, type=_SPANS)], names=["text_key", "spans"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, spans, kept = [], [], []
        for text, listed in zip(batch.column(1), batch.column(2)):
            data, whole = (text.as_py() or "").encode(), listed.as_py() or []
            edges = [0, *(x for s in whole for x in (s["first"], s["beyond"])), len(data)]
            sizes.append(len(data))
            spans.append(whole)
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, type=pa.int64()), pa.array(spans, type=_SPANS), pa.array(kept, type=pa.binary())],
            names=["doc_id", "n_bytes", "spans", "kept"],
        )


def repeats_digest(found: DataFrame) -> DataFrame:
    """Sizes, and the digest of the kept bytes."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["beyond"] - s["first"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
