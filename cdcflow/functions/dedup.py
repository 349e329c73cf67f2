"""One row per key, chosen by a declared order.

Both directions aggregate a struct that starts with the order columns and goes
on with the rest of the row. The aggregate combines before the shuffle, so a key
holding a large share of the rows reaches its reducer as one row per map task,
and ties can only happen between identical rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row per key that sorts first, ascending with NULLs last."""
    ranked = []
    for i, name in enumerate(order):
        ranked.append(F.col(name).isNull().alias(f"_null{i}"))
        ranked.append(F.col(name).alias(f"_order{i}"))
    return _choose(df, keys, order, ranked, F.min)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row per key that sorts last; a NULL order loses to any value."""
    ranked = [F.col(name).alias(f"_order{i}") for i, name in enumerate(order)]
    return _choose(df, keys, order, ranked, F.max)


def _choose(df, keys, order, ranked, best):
    held = {name: f"_order{i}" for i, name in enumerate(order)}
    rest = [c for c in df.columns if c not in keys and c not in held]
    chosen = best(F.struct(*ranked, *rest)).alias("_chosen")
    kept = df.groupBy(*keys).agg(chosen)
    return kept.select(
        *[
            F.col(c)
            if c in keys
            else F.col("_chosen").getField(held.get(c, c)).alias(c)
            for c in df.columns
        ]
    )
