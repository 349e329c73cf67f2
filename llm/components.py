"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.storage import drop, land


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a``, ``b``); ``root`` is the
    smallest node reachable.

    Each round hangs every node's larger neighbours (large star), then its smaller ones
    (small star), under the smallest node it sees. Minima are aggregates with map-side
    combine and the joins take landed tables, so a node with most of the edges is split.
    Edges never grow in number. The rounds are logarithmic in the longest path. An edge
    with a null end, or from a node to itself, is no edge. No edges give no rows.
    """
    now = land(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "stars",
    )
    state = _state(now)
    while state[0]:
        both = now.union(now.select("b", "a"))
        stars = land(_star(now, both), "stars")
        after = land(_star(stars, stars), "stars")
        drop(now, stars)
        now, before, state = after, state, _state(after)
        if state == before:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return land(now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots), "roots")


def _star(now: DataFrame, seen: DataFrame) -> DataFrame:
    """One star: what ``seen`` lists for a node is hung under the smallest of it.

    With both directions in ``seen`` these are the larger neighbours, with edges that
    lead from a larger to a smaller node the smaller ones and the node itself.
    """
    least = seen.groupBy("a").agg(F.min("b").alias("m")).select(
        "a", F.least("a", "m").alias("m")
    )
    if seen is now:
        hung = now.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        hung = hung.union(least.select("a", F.col("m").alias("b")))
    else:
        larger = now.select(F.col("b").alias("a"), F.col("a").alias("v"))
        hung = larger.join(least, "a").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return hung.where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    """Count and order-free digest of the edges."""
    return tuple(
        edges.agg(
            F.count(F.lit(1)),
            F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0)),
        ).first()
    )
