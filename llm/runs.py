"""Periodic runs of words, found in tiles whose size follows the period.

A run is a maximal stretch of words with smallest period ``q`` that is at least
``max(MIN_LENGTH, MIN_POWER * q)`` long. Words ``i`` and ``i + q`` agree over an interval
of ``2q`` or more places ``i``. The periods of an octave, ``P`` to ``2P - 1``, are looked
for at boundaries ``P`` apart: such an interval holds two boundaries or more, and at each
of them the block of ``P`` words before or behind equals the one ``q`` further on. A tile
is a boundary with ``P`` words before and ``3P`` behind. Two Z-functions per tile, one
read forwards and one backwards, tell how far every period reaches from the boundary;
what a tile sees of an interval is a fragment. Fragments of one document and period that
overlap or touch are one interval.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.storage import BROADCAST_ROWS, land, small_if
from llm.text import blocks, mix, span_hashes, word_hashes, words

MIN_LENGTH, MIN_POWER = 24, 3
#: Half of the least number of agreeing places of a short period (24 - 7 and more).
FIRST_OCTAVE = 8
#: Texts of this many bytes have their tiles dealt over the cluster.
LONG_BYTES = 1 << 18
#: Words a dealt group of tiles advances by, if its octave is not larger.
GROUP_WORDS = 1 << 15

_FRAGMENT = "text_key binary, period long, first long, beyond long"
_TILES = "text_key binary, octave long, base long, end long, n_words long, symbols binary"


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", long_bytes: int = LONG_BYTES, group_words: int = GROUP_WORDS
) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row.

    ``runs`` lists ``start, period, length`` in words, ordered so. ``collapsed`` has the
    words, joined by one space, without those that lie in a run behind its first period.
    Words are ``[^\\x20\\x09-\\x0D]+``; null and empty texts have none, an empty list and an
    empty text. Ids are passed through, null or not; repeated rows and equal texts have
    equal results; other columns do not matter. A text of ``long_bytes`` or more is cut
    into its tiles, which are solved anywhere; a shorter one is solved where it is read.
    Fragments of all are shuffled by text and period and stitched. A tile of the largest
    octave holds the whole text, so memory is linear in the longest text.
    """
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    keyed = given.withColumn("text_key", _key("text"))
    texts = keyed.select("text_key", "text").where(F.length("text") >= MIN_LENGTH)
    size = F.octet_length("text")
    near = texts.where(size < long_bytes).mapInArrow(_solve_texts, _FRAGMENT)
    tiles = texts.where(size >= long_bytes).mapInArrow(_cutter(group_words), _TILES)
    far = tiles.repartition("text_key", "octave", "base").mapInArrow(_solve_tiles, _FRAGMENT)
    runs = land(stitch(near.unionByName(far)), "runs")
    by_text = runs.groupBy("text_key").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    by_text = land(by_text, "runs")
    joined = keyed.join(small_if(by_text, _rows_for(runs)), "text_key", "left")
    schema = given.select("doc_id").schema.simpleString()[len("struct<") : -1].replace(":", " ", 1)
    shape = f"{schema}, n_words long, runs array<struct<start:long,period:long,length:long>>, collapsed string"
    return joined.select("doc_id", "text", "runs").mapInArrow(_collapse, shape)


def _key(text: str):
    return F.unhex(F.md5(F.col(text)))


def _rows_for(runs: DataFrame) -> int:
    """Texts that may be broadcast: none if their runs are more than a broadcast may hold."""
    return BROADCAST_ROWS if runs.count() <= BROADCAST_ROWS else -1


def stitch(fragments: DataFrame) -> DataFrame:
    """``text_key, start, period, length`` of the runs whose fragments are given.

    Copies of a text give the same fragments, which are dropped before the shuffle.
    """
    by_period = Window.partitionBy("text_key", "period").orderBy("first", "beyond")
    before = by_period.rowsBetween(Window.unboundedPreceding, -1)
    seen = fragments.distinct().withColumn("_reach", F.max("beyond").over(before))
    opens = (F.col("_reach").isNull() | (F.col("_reach") < F.col("first"))).cast("int")
    islands = seen.withColumn("_island", F.sum(opens).over(by_period))
    whole = islands.groupBy("text_key", "period", "_island").agg(F.min("first").alias("start"), F.max("beyond").alias("beyond"))
    whole = whole.withColumn("length", F.col("beyond") - F.col("start") + F.col("period"))
    enough = F.col("length") >= F.greatest(F.lit(MIN_LENGTH), MIN_POWER * F.col("period"))
    return whole.where(enough).select("text_key", "start", "period", "length")


def _solve_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, texts = batch.columns
        for block in blocks(texts):
            found = words(block)
            # the row goes into the symbol, so nothing agrees across two texts
            symbols = mix(word_hashes(block, found) ^ mix(found.row.astype(np.uint64)))
            head = np.searchsorted(found.row, np.arange(block.rows + 1))
            longest = int(np.diff(head).max(initial=0))
            out, octave = [], FIRST_OCTAVE
            while MIN_POWER * _least(octave) <= longest:
                out += merged(solve(symbols, octave, 0, len(symbols)), -1, len(symbols))
                octave *= 2
            if out:
                period, first, beyond = np.array(out, dtype=np.int64).T
                row = found.row[first]
                yield _fragments(keys.take(pa.array(row + block.first)), period, first - head[row], beyond - head[row])


def _fragments(keys, period, first, beyond) -> pa.RecordBatch:
    names = ["text_key", "period", "first", "beyond"]
    return pa.RecordBatch.from_arrays([keys, pa.array(period), pa.array(first), pa.array(beyond)], names=names)


def _cutter(group_words: int):
    """Groups of neighbouring tiles of every octave, with the words that they look at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.columns
            for block in blocks(texts):
                found = words(block)
                hashes = word_hashes(block, found)
                head = np.searchsorted(found.row, np.arange(block.rows + 1))
                for row in range(block.rows):
                    symbols, octave = hashes[head[row] : head[row + 1]], FIRST_OCTAVE
                    n = len(symbols)
                    while MIN_POWER * _least(octave) <= n:
                        step = max(octave, group_words // octave * octave)
                        for base in range(0, n, step):
                            part = symbols[max(base - octave, 0) : base + step + 3 * octave]
                            values = octave, base, min(base + step, n), n, part.tobytes()
                            yield pa.RecordBatch.from_arrays(
                                [keys.slice(block.first + row, 1), *(pa.array([x]) for x in values)],
                                names=["text_key", "octave", "base", "end", "n_words", "symbols"],
                            )
                        octave *= 2

    return run


def _solve_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, (octave, base, end, n, data) in enumerate(zip(*(c.to_pylist() for c in batch.columns[1:]))):
            symbols = np.frombuffer(data, dtype=np.uint64)
            left = max(base - octave, 0)
            found = solve(symbols, octave, base - left, end - left)
            kept = merged(found, -1 if left == 0 else 0, n if end == n else end - left)
            if kept:
                period, first, beyond = np.array(kept, dtype=np.int64).T
                yield _fragments(batch.column(0).take(pa.array([i] * len(kept))), period, first + left, beyond + left)


def _least(octave: int) -> int:
    return 1 if octave == FIRST_OCTAVE else octave


def solve(symbols: np.ndarray, octave: int, start: int, end: int) -> list[tuple[int, int, int]]:
    """``(period, first, beyond)``: what tiles with boundaries in ``start`` to ``end`` see
    of the intervals of places ``i`` where ``i`` and ``i + period`` agree, for the smallest
    periods of the octave. ``start`` is a multiple of the octave away from place 0.
    """
    n = len(symbols)
    places = np.arange(n - octave + 1)
    if not len(places):
        return []
    hashes = span_hashes(symbols, places, places + octave)
    heads = np.arange(start - octave if start >= octave else start, min(end, len(hashes)), octave)
    periods = np.arange(_least(octave), 2 * octave)
    asked: dict[int, set[int]] = defaultdict(set)
    rows = max(1, (1 << 20) // len(periods))
    for k in range(0, len(heads), rows):
        some = heads[k : k + rows]
        there = some[:, None] + periods
        same = hashes[np.minimum(there, len(hashes) - 1)] == hashes[some][:, None]
        for x, y in zip(*np.nonzero(same & (there < len(hashes)))):
            at, period = int(some[x]), int(periods[y])
            for boundary in (at, at + octave):
                if start <= boundary < end or boundary == end == n:
                    asked[boundary].add(period)
    out = []
    for boundary, wanted in asked.items():
        out += _tile(symbols, octave, boundary, wanted)
    return out


def _tile(symbols: np.ndarray, octave: int, m: int, wanted: set[int]) -> list[tuple[int, int, int]]:
    ahead = symbols[m : m + 3 * octave].tolist()
    forwards = z_function(ahead)
    low, high = max(m - octave, 0), min(m + 2 * octave, len(symbols))
    back = symbols[low:m].tolist()[::-1]
    backwards = z_function([*back, None, *symbols[low:high].tolist()[::-1]])
    out = []
    for q in wanted:
        if any(d < len(forwards) and forwards[d] >= q - d for d in _divisors(q)):
            continue
        right = min(forwards[q], octave) if q < len(forwards) else 0
        place = high - (m + q)
        left = min(backwards[len(back) + 1 + place], len(back)) if back and place >= 0 else 0
        if left or right:
            out.append((q, m - left, m + right))
    return out


def z_function(s: list) -> list[int]:
    """For every place, how much of what stands there equals the beginning of ``s``."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def _divisors(q: int) -> list[int]:
    """The largest proper divisors: ``q`` over each of its primes."""
    out, rest, p = [], q, 2
    while p * p <= rest:
        if rest % p == 0:
            out.append(q // p)
            while rest % p == 0:
                rest //= p
        p += 1
    if rest > 1:
        out.append(q // rest)
    return out


def merged(fragments: list[tuple[int, int, int]], low: int, high: int) -> list[tuple[int, int, int]]:
    """Fragments put together where they touch. Those that are too short stay only if they
    reach ``low`` or ``high``, where another group of tiles may go on."""
    out: list[list[int]] = []
    for q, first, beyond in sorted(fragments):
        if out and out[-1][0] == q and first <= out[-1][2]:
            out[-1][2] = max(out[-1][2], beyond)
        else:
            out.append([q, first, beyond])
    return [
        (q, first, beyond)
        for q, first, beyond in out
        if beyond - first + q >= max(MIN_LENGTH, MIN_POWER * q) or first <= low or beyond >= high
    ]


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts, runs = batch.columns
        counts, collapsed = [], []
        for text, found in zip(texts, runs):
            # the ASCII white space of bytes.split is the class between words
            parts = (text.as_py() or "").encode().split()
            counts.append(len(parts))
            if found.is_valid:
                gone = np.zeros(len(parts), dtype=bool)
                for run in found.as_py():
                    gone[run["start"] + run["period"] : run["start"] + run["length"]] = True
                parts = [part for part, drop in zip(parts, gone) if not drop]
            collapsed.append(b" ".join(parts))
        kind = pa.struct([("start", pa.int64()), ("period", pa.int64()), ("length", pa.int64())])
        lists = pa.array([r.as_py() or [] for r in runs], type=pa.list_(kind))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(counts, type=pa.int64()), lists, pa.array([c.decode() for c in collapsed], type=pa.string())],
            names=["doc_id", "n_words", "runs", "collapsed"],
        )


def runs_digest(found: DataFrame) -> DataFrame:
    """The number of runs, the one of greatest length by period (ties: smallest start, then
    period), and digests of all runs and of the collapsed text."""
    # lengths by periods are compared as products, which are exact
    best = F.expr(
        "aggregate(runs, CAST(NULL AS STRUCT<start: BIGINT, period: BIGINT, length: BIGINT>),"
        " (b, r) -> CASE WHEN b IS NULL OR r.length * b.period > b.length * r.period THEN r ELSE b END)"
    )
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.alias("_best"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        *(F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * _best.length DIV _best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
