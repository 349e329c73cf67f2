"""Change capture from two snapshots of a keyed table.

Row triggers need a database that runs them; two snapshots give the same change
log on any storage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"
# a key with several rows in a snapshot: which of them changed cannot be told
CONFLICT = "CONFLICT"


def snapshot_diff(
    before: DataFrame, after: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Keys whose rows differ: keys, ``status``, ``before`` and ``after`` images.

    The snapshots are tagged and grouped rather than full-outer joined: rows of a
    key meet in one aggregate, so a key that breaks uniqueness costs linear work
    instead of all pairs. Such a key has the status CONFLICT and no images, and no
    change log takes it; ``snapshot_conflicts`` counts its rows. Whole rows are shuffled once: ``snapshot_changes`` is for few changes.
    """
    columns = _same_columns(before, after)
    image = before.select(F.struct(*columns).alias("i")).schema["i"].dataType
    was = before.select(
        *keys,
        F.struct(*columns).alias("before"),
        F.lit(None).cast(image).alias("after"),
    )
    now = after.select(
        *[F.col(k).cast(before.schema[k].dataType).alias(k) for k in keys],
        F.lit(None).cast(image).alias("before"),
        F.struct(
            *[F.col(c).cast(before.schema[c].dataType).alias(c) for c in columns]
        ).alias("after"),
    )
    status = (
        F.when(F.col("before").isNull(), INSERT)
        .when(F.col("after").isNull(), DELETE)
        .otherwise(UPDATE)
    )
    return (
        was.unionByName(now)
        .groupBy(*keys)
        .agg(
            F.max("before").alias("before"),
            F.max("after").alias("after"),
            F.greatest(F.count("before"), F.count("after")).alias("_copies"),
        )
        .filter((F.col("_copies") > 1) | ~F.col("before").eqNullSafe(F.col("after")))
        .select(
            *keys,
            F.when(F.col("_copies") > 1, CONFLICT).otherwise(status).alias("status"),
            *[F.when(F.col("_copies") == 1, F.col(side)).alias(side) for side in ("before", "after")],
        )
    )


def _same_columns(before: DataFrame, after: DataFrame) -> list[str]:
    if set(before.columns) != set(after.columns):
        raise ValueError("snapshots must have the same columns")
    return before.columns


def _compared(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key how many rows either snapshot has, and 128-bit digests of one of each.

    NULLs leave a hash as it is, so what is NULL is hashed beside the values.
    """
    columns = _same_columns(before, after)

    def digested(df, side):
        typed = [F.col(c).cast(before.schema[c].dataType).alias(c) for c in columns]
        nulls = [F.col(c).isNull() for c in columns]
        halves = [F.xxhash64(F.lit(salt), *nulls, *columns).alias(f"_{salt}") for salt in (1, 2)]
        return df.select(*typed).select(*keys, F.lit(side).alias("_side"), F.struct(*halves).alias("_digest"))

    both = digested(before, 0).unionByName(digested(after, 1))

    def of(side):
        return F.when(F.col("_side") == side, F.col("_digest"))

    return both.groupBy(*keys).agg(
        F.count(of(0)).alias("n_before"),
        F.count(of(1)).alias("n_after"),
        F.max(of(0)).alias("_was"),
        F.max(of(1)).alias("_is"),
    )


def snapshot_changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """As ``snapshot_diff``, for snapshots that differ in few rows.

    First keys and digests alone are shuffled; then the images of the keys that differ are
    fetched, by joins that Spark turns into broadcasts while those keys are few. A snapshot
    is scanned twice, the second time without being shuffled.
    """
    columns = _same_columns(before, after)
    compared = _compared(before, after, keys)
    repeated = F.greatest("n_before", "n_after") > 1
    status = F.when(repeated, CONFLICT).when(F.col("n_before") == 0, INSERT).when(F.col("n_after") == 0, DELETE)
    differ = compared.filter(repeated | ~F.col("_was").eqNullSafe(F.col("_is")))
    differ = differ.select(*keys, status.otherwise(UPDATE).alias("status"))

    def image(df, side):
        typed = [F.col(c).cast(before.schema[c].dataType).alias(c) for c in columns]
        return df.select(F.struct(*typed).alias(side), *[F.col(k).cast(before.schema[k].dataType).alias(f"_{side}_{k}") for k in keys])

    def fetched(df, side):
        same = [F.col(k).eqNullSafe(F.col(f"_{side}_{k}")) for k in keys]
        wanted = differ.filter(F.col("status").isin(UPDATE, DELETE if side == "before" else INSERT))
        met = image(df, side).join(wanted, same)
        other = F.lit(None).cast(met.schema[side].dataType)
        both = {"before": other, "after": other} | {side: F.col(side)}
        return met.select(*keys, "status", *[both[name].alias(name) for name in ("before", "after")])

    # an update has one row of either side, so the images meet in one small aggregate
    images = fetched(before, "before").unionByName(fetched(after, "after"))
    images = images.groupBy(*keys, "status").agg(F.max("before").alias("before"), F.max("after").alias("after"))
    conflicts = differ.filter(F.col("status") == CONFLICT)
    return images.unionByName(conflicts, allowMissingColumns=True)


def snapshot_conflicts(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that have several rows in a snapshot, which no diff can tell apart: keys,
    ``n_before``, ``n_after``. Keys and counts alone are shuffled."""
    counted = _compared(before, after, keys).filter((F.col("n_before") > 1) | (F.col("n_after") > 1))
    return counted.select(*keys, "n_before", "n_after")


def change_images(
    changes: DataFrame, side: str, at: Column, log_id: Column
) -> DataFrame:
    """Change-log rows: one row image per change, its status, time and number.

    The after log holds the new row and, for a delete, the old one; the before
    log holds the old row and, for an insert, the new one. ``at`` and ``log_id``
    are expressions over the change, so that replays number alike.
    """
    other = {"after": "before", "before": "after"}[side]
    refused = F.raise_error(F.lit("a snapshot has several rows of one key, see snapshot_conflicts"))
    return changes.select(
        log_id.cast("bigint").alias("log_id"),
        F.coalesce(side, other).alias("_image"),
        F.when(F.col("status") == CONFLICT, refused).otherwise(F.col("status")).alias("status"),
        at.cast("timestamp").alias("log_timestamp"),
    ).select("log_id", "_image.*", "status", "log_timestamp")


def after_image_log(changes: DataFrame, at: Column, log_id: Column) -> DataFrame:
    return change_images(changes, "after", at, log_id)


def before_image_log(changes: DataFrame, at: Column, log_id: Column) -> DataFrame:
    return change_images(changes, "before", at, log_id)
