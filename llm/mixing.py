"""Temperature mixing of sources, realised as budgeted permutations of blocks.

The share ``p`` of a source in all tokens becomes the weight ``p**a / sum(p**a)``. The
budget is the least at which every source is used once in full, so the source that is
largest for its weight is read once and a source i is repeated ``(t_max / t_i)**(1 - a)``
times. The exponent is found by bisection in [0, 1]: the least at which no source is
repeated more than ``max_epochs`` times, or the one whose weights have a given entropy.

A source's documents are hashed into ``BLOCKS`` blocks. Every epoch has a seeded
permutation of them; whole epochs are followed by the blocks of the next permutation that
fit the rest of the source's budget, whole, so a source falls short of its budget by less
than a block. Block sizes are summed with map-side combine, and a source has
``BLOCKS`` of them however large it is; nothing is sorted beyond these.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.storage import land, small_if

BLOCKS = 1024
MAX_EPOCHS = 2.0


def word_tokens(text_col: str = "text") -> F.Column:
    """Words between white space, and one for the end of the text."""
    spaced = F.regexp_count(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]++"))
    return (spaced + 1).cast("long")


def weights(tokens: list[float], exponent: float) -> list[float]:
    top = max(tokens)
    raw = [(t / top) ** exponent for t in tokens]
    total = sum(raw)
    return [x / total for x in raw]


def entropy(parts: list[float]) -> float:
    return -sum(p * math.log(p) for p in parts if p > 0)


def bisect(good, low: float = 0.0, high: float = 1.0) -> float:
    """The least exponent for which ``good`` holds, if it holds from there on."""
    if good(low):
        return low
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if good(mid) else (mid, high)
    return high


def exponent_of(tokens: list[float], max_epochs: float | None = MAX_EPOCHS, target_entropy: float | None = None) -> float:
    """Exponent for a repetition limit, or for a target entropy (the nearest there is)."""
    if target_entropy is not None:
        return bisect(lambda a: entropy(weights(tokens, a)) <= target_entropy)
    ratio = math.log(max(tokens) / min(tokens))
    return bisect(lambda a: (1 - a) * ratio <= math.log(max_epochs))


def mix(docs: DataFrame, tokens: F.Column | None = None, max_epochs: float = MAX_EPOCHS, target_entropy: float | None = None, seed: int = 0, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """A row ``doc_id, source, n_tokens, weight, epoch, position`` per use of a document.

    ``position`` in [0, 1) is the place of the document's block in its source's whole
    reading; read in its order, all sources stay at their weights throughout. Every
    document is used at least once. Null sources are one source; documents with a null id
    are used like others; rows that repeat are rows of their own; a document without
    words has the one token of its end. No rows give no rows; other columns do not matter.
    """
    planned, blocks = _plan(docs, tokens, max_epochs, target_entropy, seed, id_col, source_col)
    if blocks is None:
        return planned
    used = planned.join(small_if(blocks), ["_source", "_block"]).select("doc_id", "source", "n_tokens", "weight", F.explode("uses").alias("use"))
    return used.select("doc_id", "source", "n_tokens", "weight", F.col("use.epoch").alias("epoch"), F.col("use.position").alias("position"))


RESULT = "doc_id long, source string, n_tokens long, weight double, epoch int, position double"


def _key(source_col: str) -> F.Column:
    return F.concat(F.col(source_col).isNull().cast("string"), F.coalesce(F.col(source_col).cast("string"), F.lit("")))


def _block(id_col: str, seed: int) -> F.Column:
    return F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(BLOCKS)).cast("int")


def _plan(docs, tokens, max_epochs, target_entropy, seed, id_col, source_col):
    """Documents with their block, and every block's uses."""
    n_tokens = tokens if tokens is not None else word_tokens()
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), n_tokens.cast("long").alias("n_tokens"),
        _key(source_col).alias("_source"), _block(id_col, seed).alias("_block"),
    )
    rows = land(rows, "counted")
    sums = land(rows.groupBy("_source", "_block").agg(F.sum("n_tokens").alias("t")), "blocks")
    totals = land(sums.groupBy("_source").agg(F.sum("t").alias("total")), "sources")
    top, least = totals.agg(F.max("total"), F.min(F.when(F.col("total") > 0, F.col("total")))).first()
    if not top:
        return docs.sparkSession.createDataFrame([], RESULT), None
    if target_entropy is None:
        a = exponent_of([float(top), float(least)], max_epochs)
    else:
        a = exponent_of([float(r["total"]) for r in totals.collect() if r["total"]], None, target_entropy)  # one number per source
    raw = totals.withColumn("raw", F.pow(F.col("total") / F.lit(float(top)), F.lit(a)))
    whole = raw.agg(F.sum("raw")).first()[0]
    sources = raw.select("_source", "total", (F.col("raw") / whole).alias("weight"), F.pow(F.lit(float(top)) / F.col("total"), F.lit(1 - a)).alias("epochs"))
    epoch = F.explode(F.sequence(F.lit(0), F.ceil("epochs").cast("int") - 1))
    turns = sums.join(small_if(land(sources, "weights")), "_source").select("*", epoch.alias("epoch"))
    order = Window.partitionBy("_source", "epoch").orderBy(F.xxhash64("_block", "epoch", F.lit(seed)), "_block")
    ahead = F.sum("t").over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = turns.withColumn("at", F.col("epoch") * F.col("total") + ahead)
    chosen = placed.where((F.col("epoch") == 0) | (F.col("at") <= F.col("epochs") * F.col("total") + 0.5))
    position = (F.col("at") - F.col("t")) / F.greatest(F.col("epochs") * F.col("total") + 0.5, F.col("total") + 0.5)
    uses = chosen.groupBy("_source", "_block").agg(F.first("weight").alias("weight"), F.sort_array(F.collect_list(F.struct("epoch", position.alias("position")))).alias("uses"))
    return rows, land(uses, "uses")


def mixed_documents(docs: DataFrame, max_epochs: float = MAX_EPOCHS, seed: int = 0) -> DataFrame:
    """The rows of ``docs`` with their own columns, each as often as the mixture uses it."""
    planned, blocks = _plan(docs, None, max_epochs, None, seed, "doc_id", "source")
    if blocks is None:
        return docs
    times = blocks.select("_source", "_block", F.size("uses").alias("_times"))
    given = docs.withColumns({"_source": _key("source"), "_block": _block("doc_id", seed)})
    used = given.join(small_if(times), ["_source", "_block"])
    again = F.explode(F.sequence(F.lit(1), F.col("_times")))
    return used.select(*docs.columns, again.alias("_use")).drop("_use")
