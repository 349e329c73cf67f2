"""Join inputs that keep hot keys splittable."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def splittable(df: DataFrame, key: str) -> DataFrame:
    """The side of few rows per key in a join against hot keys.

    Adaptive execution splits a hot key only where both inputs of the join come
    straight from shuffles the join asked for. A side that is already grouped by
    the key needs none, and an explicit ``repartition`` counts as the user's, so
    either makes one task join all rows of a hot key. Behind a generator Spark
    does not know the grouping and plans its own shuffle of this smaller side.
    """
    rest = [c for c in df.columns if c != key]
    return df.select(F.explode(F.array(key)).alias(key), *rest)
