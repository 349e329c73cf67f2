"""Quality rules: counted statistics, fixed rules, and robust multivariate outliers.

Every text has a vector of transformed statistics, shrunk so that a short text does not
stand out by chance. For each language and source, the centre and covariance of the
vectors are those of the minimum covariance determinant: starting from medians and
median deviations, the share ``SUBSET`` of rows nearest to the centre gives the next
centre and covariance (a concentration step, which never raises the determinant), over
all rows of the group, ``STEPS`` times. A row whose squared Mahalanobis distance is above
the ``CUTOFF`` quantile of its chi-square distribution is rejected.

Sums of a group are aggregates with map-side combine; a group's model is one row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.storage import land, small_if
from llm.text import blocks, byte_class, mix, span_hashes, word_hashes, words

WINDOW = 5
#: The characters counted as symbols.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SUBSET = 0.75
STEPS = 3
CUTOFF = 0.9999
#: Groups with fewer rows are pooled by language, then over all.
MIN_GROUP = 100
#: Deviations below these do not count, in the units of the vector.
VECTOR = {"word_length": 0.05, "symbols": 0.03, "dup_lines": 0.1, "repeats": 0.1, "upper": 0.05, "exclaims": 0.03}
_SYMBOL = np.isin(np.arange(256), [ord(c) for c in SYMBOLS])
_UPPER = byte_class((0x41, 0x5A))
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
COUNTED = f"doc_id long, lang string, source string, {BASE}, n_lines long, n_upper long, n_exclaims long"


def _repeated(key: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether an equal key of the same row comes before, and whether there is another."""
    both = mix(key ^ mix(row.astype(np.uint64)))
    order = np.argsort(both, kind="stable")
    same = np.zeros(len(both) + 1, dtype=bool)
    same[1:-1] = both[order][1:] == both[order][:-1]
    later, any_ = np.zeros(len(both), dtype=bool), np.zeros(len(both), dtype=bool)
    later[order] = same[:-1]
    any_[order] = same[:-1] | same[1:]
    return later, any_


def block_counts(block) -> np.ndarray:
    """The eight counts of every row of a block."""
    rows, data = block.rows, block.data
    found = words(block)
    row = found.row
    per_row = lambda at, weight=None: np.bincount(at, weights=weight, minlength=rows)
    n = per_row(row)
    lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    chars = per_row(row, lead[found.end] - lead[found.start])
    bytes_of = lambda table: np.diff(np.concatenate(([0], np.cumsum(table[data])))[block.offsets])
    exclaim = byte_class((0x21, 0x21))
    breaks = np.flatnonzero(data == 0x0A)
    begin = np.unique(np.concatenate([block.offsets[:-1], breaks + 1]))
    begin = begin[begin < len(data)]
    line_row = np.searchsorted(block.offsets, begin, side="right") - 1
    end = np.append(breaks, len(data))[np.searchsorted(breaks, begin)]
    end = np.minimum(end, block.offsets[line_row + 1])
    worded = np.searchsorted(found.start, end) > np.searchsorted(found.start, begin)
    begin, end, line_row = begin[worded], end[worded], line_row[worded]
    later, _ = _repeated(span_hashes(data, begin, end), line_row)
    first = np.cumsum(n) - n
    at = np.flatnonzero(np.arange(len(row)) - first[row] + WINDOW <= n[row])
    one = word_hashes(block, found)
    window = np.zeros(len(at), dtype=np.uint64)
    for k in range(WINDOW):
        window = mix(window ^ one[at + k], k)
    _, twice = _repeated(window, row[at])
    cover = np.zeros(len(row) + 1, dtype=np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + WINDOW, -1)
    covered = np.cumsum(cover)[:-1] > 0
    out = [n, chars, bytes_of(_SYMBOL), per_row(line_row[later]), per_row(row[covered]), per_row(line_row), bytes_of(_UPPER), bytes_of(exclaim)]
    return np.array(out).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in COUNTED.split(", ")]
    for batch in batches:
        counts = [block_counts(b) for b in blocks(batch.column(3))]
        if counts:
            counted = [pa.array(x) for x in np.concatenate(counts, axis=1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *counted], names=names)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The counts of every text; null texts have none of anything."""
    given = docs.select(F.col(id_col).cast("long"), *(F.col(c).cast("string") for c in (lang_col, source_col, text_col)))
    return given.mapInArrow(_count, COUNTED)


def vector() -> dict[str, F.Column]:
    """The statistics as numbers of about normal spread."""
    chars, n = F.col("word_chars"), F.col("n_words")
    return {
        "word_length": F.log((chars + 500) / (n + 100)),
        "symbols": F.sqrt(F.col("n_symbols") / (chars + 200)),
        "dup_lines": F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + 10)),
        "repeats": F.sqrt(F.col("n_repeat_words") / (n + 100)),
        "upper": F.sqrt((F.col("n_upper") + 6) / (chars + 200)),
        "exclaims": F.sqrt(F.col("n_exclaims") / (chars + 200)),
    }


def chi_square(x: float, k: float) -> float:
    """Share of the chi-square distribution with ``k`` degrees of freedom below ``x``."""
    a, half = k / 2, x / 2
    if half <= 0:
        return 0.0
    term = total = 1 / a
    for i in range(1, 500):
        term *= half / (a + i)
        total += term
    return min(1.0, total * math.exp(a * math.log(half) - half - math.lgamma(a)))


def chi_square_quantile(p: float, k: float) -> float:
    low, high = 0.0, 200.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, k) < p else (low, mid)
    return high


def _distance(names: list[str]) -> F.Column:
    """Squared distance by the model's centre ``m`` and whitening rows ``w`` (a triangle)."""
    p, total = len(names), F.lit(0.0)
    off = [F.col(n) - F.col("m")[i] for i, n in enumerate(names)]
    for i in range(p):
        part = F.lit(0.0)
        for j in range(i + 1):
            part = part + F.col("w")[i * (i + 1) // 2 + j] * off[j]
        total = total + part * part
    return total


def _models(moments: DataFrame, factor: float) -> DataFrame:
    """Centre and whitening triangle of every group's row of sums."""
    floor = np.array(list(VECTOR.values()))
    p = len(floor)
    at = [(i, j) for i in range(p) for j in range(i + 1)]

    def run(batches):
        for df in batches:
            centres, whites = [], []
            for n, sums, cross in zip(df["n"], df["s"], df["c"], strict=True):
                mean = np.array(sums, dtype=float) / n
                cov = np.zeros((p, p))
                for (i, j), x in zip(at, cross, strict=True):
                    cov[i, j] = cov[j, i] = x / n - mean[i] * mean[j]
                cov = cov * factor + np.diag(floor**2)
                white = np.linalg.inv(np.linalg.cholesky(cov))
                centres.append(mean.tolist())
                whites.append([float(white[i, j]) for i, j in at])
            yield df[["g_lang", "g_source"]].assign(m=centres, w=whites)

    return moments.mapInPandas(run, "g_lang string, g_source string, m array<double>, w array<double>")


def outliers(counted: DataFrame) -> DataFrame:
    """``counted`` with ``distance`` and ``outlier``.

    Null languages and sources are groups of their own. Groups of fewer than
    ``MIN_GROUP`` rows are pooled by language, pools that stay smaller over all; if that
    is still smaller, its rows are nobody's outliers (distance null).
    """
    names = list(VECTOR)
    rows = counted.withColumns(vector())
    sizes = land(counted.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")), "sizes")
    own = F.col("n") >= MIN_GROUP
    pools = sizes.where(~own).groupBy(F.col("lang").alias("p_lang")).agg(F.sum("n").alias("pool"))
    name = lambda c: F.concat(F.lit("="), F.coalesce(c, F.lit("")), F.col(c).isNull().cast("string"))
    groups = sizes.join(pools, F.col("lang").eqNullSafe(F.col("p_lang")), "left").select(
        F.col("lang").alias("k_lang"),
        F.col("source").alias("k_source"),
        F.when(own | (F.col("pool") >= MIN_GROUP), name("lang")).otherwise("*").alias("g_lang"),
        F.when(own, name("source")).otherwise("*").alias("g_source"),
    )
    groups = small_if(land(groups, "groups"))
    same = rows["lang"].eqNullSafe(groups["k_lang"]) & rows["source"].eqNullSafe(groups["k_source"])
    rows = land(rows.join(groups, same).drop("k_lang", "k_source"), "vectors")
    by = ["g_lang", "g_source"]
    middle = [F.percentile_approx(n, 0.5, 1000) for n in names]
    medians = land(rows.groupBy(*by).agg(F.array(*middle).alias("med"), F.count(F.lit(1)).alias("size")).where(F.col("size") >= MIN_GROUP), "medians")
    away = [F.abs(F.col(n) - F.col("med")[i]) for i, n in enumerate(names)]
    spreads = rows.join(small_if(medians), by).groupBy(*by).agg(
        F.array(*(F.percentile_approx(a, 0.5, 1000) for a in away)).alias("mad"), F.first("med").alias("m")
    )
    floor = list(VECTOR.values())
    zero = F.lit(0.0)
    white = [1 / (1.4826 * F.col("mad")[i] + floor[i]) if i == j else zero for i in range(len(names)) for j in range(i + 1)]
    model = land(spreads.select(*by, "m", F.array(*white).alias("w")), "model")
    p, q = len(names), chi_square_quantile(SUBSET, len(names))
    factor = SUBSET / chi_square(q, p + 2)
    for _ in range(STEPS):
        near = rows.join(small_if(model), by).select(*by, *names, _distance(names).alias("d"))
        edge = land(near.groupBy(*by).agg(F.percentile_approx("d", SUBSET, 10_000).alias("edge")), "edge")
        inside = near.join(small_if(edge), by).where("d <= edge")
        cross = [F.sum(F.col(names[i]) * F.col(names[j])) for i in range(p) for j in range(i + 1)]
        moments = inside.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.array(*(F.sum(n) for n in names)).alias("s"), F.array(*cross).alias("c"))
        model = land(_models(moments, factor), "model")
    out = rows.join(small_if(model), by, "left").withColumn("distance", _distance(names))
    far = F.coalesce(F.col("distance") > chi_square_quantile(CUTOFF, p), F.lit(False))
    return out.withColumn("outlier", far).drop(*by, *names, "m", "w")


def quality(docs: DataFrame, **columns: str) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``distance`` and ``kept`` for every row.

    ``base_failed``: fewer than ``MIN_WORDS`` words, or more than ``MAX_REPEAT_PERCENT``
    percent of them in repeated windows. ``kept``: neither that nor an outlier. Null and
    empty texts fail. Repeated rows get the same verdict, each its own row; null ids are
    passed through; no rows give no rows; other columns do not matter.
    """
    found = outliers(land(statistics(docs, **columns), "counted"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    base = [x.split()[0] for x in BASE.split(", ")]
    return found.select("doc_id", *base, failed.alias("base_failed"), "distance", (~failed & ~F.col("outlier")).alias("kept"))
