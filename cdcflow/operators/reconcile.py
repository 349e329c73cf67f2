"""Compare what was written with what was meant to be written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def reconcile_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Row counts of both sides, their gap and a verdict, in one row."""
    sides = source.select(F.lit(1).alias("side")).unionAll(
        target.select(F.lit(0).alias("side"))
    )
    counted = sides.agg(
        F.count_if(F.col("side") == 1).alias("source_count"),
        F.count_if(F.col("side") == 0).alias("target_count"),
    )
    gap = F.abs(F.col("source_count") - F.col("target_count"))
    return counted.select(
        "source_count",
        "target_count",
        gap.alias("gap"),
        F.when(gap == 0, "equal").otherwise("different").alias("verdict"),
    )


def missing_rows(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source rows the target lacks, as often as it lacks them (multiset).

    Copies of a row travel as one row with a count. Rows with few are multiplied out
    where they are, those with many in portions that are spread over the tasks: a row
    with very many copies is not written out by the one task that counted it.
    """
    columns = source.columns
    counted = _row_counts(source, target).withColumn("_copies", F.col("_s") - F.col("_t"))
    few = counted.filter(f"_copies BETWEEN 1 AND {_PORTION}")
    many = counted.filter(f"_copies > {_PORTION}")
    portions = F.sequence(F.lit(0), F.expr(f"(_copies - 1) div {_PORTION}"))
    # a given number of tasks is kept, where a size-based one would see few bytes
    tasks = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = many.select(
        *columns, "_copies", F.explode(portions).alias("_portion")
    ).repartition(tasks, *columns, "_portion")
    left = F.least(F.col("_copies") - F.col("_portion") * _PORTION, F.lit(_PORTION))

    def multiplied(df, copies):
        each = F.explode(F.sequence(F.lit(1), copies.cast("int"))).alias("_copy")
        return df.select(*columns, each).drop("_copy")

    return multiplied(few, F.col("_copies")).unionByName(multiplied(spread, left))


_PORTION = 1024  # copies of one row a task multiplies out


def unexpected_rows(source: DataFrame, target: DataFrame) -> DataFrame:
    """Target rows the source lacks, as often as it lacks them."""
    return missing_rows(target.select(*source.columns), source)


def _row_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Distinct rows of both sides with their copies in each (``_s``, ``_t``)."""
    columns = source.columns
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    sides = source.select(*columns, one.alias("_s"), none.alias("_t")).unionByName(
        target.select(*columns, none.alias("_s"), one.alias("_t"))
    )
    return sides.groupBy(*columns).agg(F.sum("_s").alias("_s"), F.sum("_t").alias("_t"))


def reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """Counts and content in one pass: equal counts alone prove nothing.

    Both sides are grouped by whole row; the surplus of either side per distinct
    row is what ``missing_rows`` and ``unexpected_rows`` list.
    """
    per_row = _row_counts(source, target)
    none = F.lit(0).cast("bigint")

    def total(value):
        return F.coalesce(F.sum(value), none)

    totals = per_row.agg(
        total(F.col("_s")).alias("source_count"),
        total(F.col("_t")).alias("target_count"),
        total(F.greatest(F.col("_s") - F.col("_t"), none)).alias("missing"),
        total(F.greatest(F.col("_t") - F.col("_s"), none)).alias("unexpected"),
    )
    agreed = (F.col("missing") == 0) & (F.col("unexpected") == 0)
    return totals.select(
        "source_count",
        "target_count",
        F.abs(F.col("source_count") - F.col("target_count")).alias("gap"),
        "missing",
        "unexpected",
        F.when(agreed, "equal").otherwise("different").alias("verdict"),
    )


# --- digests -----------------------------------------------------------------

#: Bits of a row's hash that choose its leaf, and that a level of the tree adds.
LEAF_BITS, LEVEL_BITS = 12, 4


def _row_hash(df: DataFrame, salt: int) -> Column:
    """Hash of a row; what is NULL counts, also inside of nested values, as a hash alone
    skips NULLs."""
    return F.xxhash64(F.lit(salt), *[x for f in df.schema for x in _hashed(F.col(f.name), f.dataType)])


def _hashed(value: Column, kind: T.DataType) -> list[Column]:
    """What a hash takes of a value: whether it is NULL and the value, or its fields'."""
    if isinstance(kind, T.StructType):
        return [value.isNull(), *[x for f in kind for x in _hashed(value.getField(f.name), f.dataType)]]
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return [value.isNull(), F.to_json(value, {"ignoreNullFields": "false"})]
    return [value.isNull(), value]


def _leaf(df: DataFrame, bits: int) -> Column:
    return F.shiftrightunsigned(_row_hash(df, 0), 64 - bits)


def row_digests(df: DataFrame) -> list[Column]:
    """Aggregates over rows in any order: ``row_count``, ``digest_a``, ``digest_b``."""
    sums = [
        F.coalesce(F.sum(_row_hash(df, salt).cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)")).alias(name)
        for salt, name in ((1, "digest_a"), (2, "digest_b"))
    ]
    return [F.count(F.lit(1)).alias("row_count"), *sums]


def digest_tree(df: DataFrame, bits: int = LEAF_BITS) -> DataFrame:
    """``bits, prefix, row_count, digest_a, digest_b`` of the rows below every prefix of
    their hash, for 0 bits (the root) up to the leaves.

    Digests are sums of hashes, so neither the order of rows nor their partitions matter,
    copies count, and a branch has the sums of its leaves. Rows are added up where they are
    read: a task sends one row per leaf at most. Trees of two copies of a table, wherever
    they are, are compared without the rows.
    """
    leaves = df.groupBy(_leaf(df, bits).alias("_leaf")).agg(*row_digests(df))
    levels = sorted({0, bits, *range(0, bits, LEVEL_BITS)})
    above = F.explode(F.array(*[F.struct(F.lit(n).alias("bits"), F.shiftright("_leaf", bits - n).alias("prefix")) for n in levels]))
    nodes = leaves.select(above.alias("_node"), "row_count", "digest_a", "digest_b").select("_node.*", "row_count", "digest_a", "digest_b")
    return nodes.groupBy("bits", "prefix").agg(*[F.sum(c).alias(c) for c in ("row_count", "digest_a", "digest_b")])


def differing_branches(source_tree: DataFrame, target_tree: DataFrame) -> DataFrame:
    """``bits, prefix`` of the branches whose rows differ; none if the tables are equal."""
    held = F.struct("row_count", "digest_a", "digest_b")
    left = source_tree.select("bits", "prefix", held.alias("_left"))
    right = target_tree.select("bits", "prefix", held.alias("_right"))
    both = left.join(right, ["bits", "prefix"], "full_outer")
    return both.filter(~F.col("_left").eqNullSafe(F.col("_right"))).select("bits", "prefix")


def reconcile_tree(source: DataFrame, target: DataFrame, bits: int = LEAF_BITS) -> DataFrame:
    """Rows that either side lacks, as often as it does, with ``side``: ``missing`` in the
    target or ``unexpected`` there.

    The leaves of both sides' digests are compared first (2 ** ``bits`` rows at most); only
    rows of leaves that differ are shuffled and compared as rows.
    """
    target = target.select(*[F.col(c).cast(source.schema[c].dataType).alias(c) for c in source.columns])
    differ = differing_branches(digest_tree(source, bits), digest_tree(target, bits))
    leaves = F.broadcast(differ.filter(F.col("bits") == bits).select(F.col("prefix").alias("_differs")))

    def suspected(df):
        return df.join(leaves, _leaf(df, bits) == F.col("_differs"), "left_semi")

    left, right = suspected(source), suspected(target)
    lacks = missing_rows(left, right).withColumn("side", F.lit("missing"))
    return lacks.unionByName(unexpected_rows(left, right).withColumn("side", F.lit("unexpected")))
