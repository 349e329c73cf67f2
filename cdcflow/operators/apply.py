"""Fold change sets into keyed targets.

Per key the latest change wins, whatever the order or the batches changes arrive
in: targets remember the log position (``_version``) of what they hold. Folding
is idempotent, so replayed batches do no harm.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.functions.dedup import keep_last
from cdcflow.operators.capture import DELETE

VERSION = "_version"
LOG_POSITION = ("log_timestamp", "log_id")


def apply_changes(
    target: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str] = ("_id",),
    order: Sequence[str] = LOG_POSITION,
    deletes: str = "tombstone",
    merge: str = "replace",
    derived: bool = False,
) -> DataFrame:
    """Target after the changes: one row per key, with ``status`` and ``_version``.

    ``deletes``: ``tombstone`` keeps deleted keys with status DELETE, which is the
    form to store, since a late older change must still lose against the delete.
    ``remove`` is the view without them.
    ``merge``: ``replace`` takes the whole document of the latest change;
    ``patch`` keeps old values where changes hold NULL (for changes that arrive
    in order: values a key lacked are not filled from late older changes).

    Changes with a NULL key part belong to no row and are left out (``keyless`` lists
    them), so folding stays idempotent.

    ``derived``: the target is itself the result of folds or joins. It then enters the
    plan once, through one full outer join on the keys, so plans of repeated folds grow
    by one join each. Otherwise it is taken for a stored table that is cheap to scan:
    a target that is large against the changes is not shuffled: it meets only
    the changed keys, which Spark broadcasts while they are below its threshold.
    """
    keys, order = list(keys), list(order)
    changes = changes.dropna(how="any", subset=keys)
    if merge == "replace":
        fold = _replace_once if derived and target is not None else _replace
        result = fold(target, changes, keys, order)
    elif merge == "patch":
        result = _patch(target, _patches(changes, keys, order), keys)
    else:
        raise ValueError(f"unknown merge: {merge}")
    if deletes == "remove":
        return live_documents(result)
    if deletes != "tombstone":
        raise ValueError(f"unknown deletes: {deletes}")
    return result


def live_documents(target: DataFrame) -> DataFrame:
    return target.filter(~F.col("status").eqNullSafe(F.lit(DELETE)))


def keyless(changes: DataFrame, keys: Sequence[str] = ("_id",)) -> DataFrame:
    """Changes that no target can hold: those with a NULL key part."""
    return changes.filter(F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False)))


def _latest(changes, keys, order):
    latest = keep_last(changes, keys, order)
    return latest.withColumn(VERSION, F.struct(*order)).drop(*order)


def _replace(target, changes, keys, order):
    latest = _latest(changes, keys, order)
    if target is None:
        return latest
    if VERSION in target.columns:
        # keys and positions alone: whole documents are folded once, below
        newest = changes.groupBy(*keys).agg(F.max(F.struct(*order)).alias(VERSION))
        held = target.select(*keys, F.col(VERSION).alias("_held"))
        outdated = newest.join(held, keys).filter(F.col("_held") > F.col(VERSION))
        latest = latest.join(outdated.select(*keys), keys, "left_anti")
    kept = target.join(latest.select(*keys), keys, "left_anti")
    return kept.unionByName(latest, allowMissingColumns=True)


def _replace_once(target, changes, keys, order):
    """As ``_replace``, with the target and the changes in the plan once each."""
    latest = _latest(changes, keys, order)
    columns = [c for c in target.columns if c not in keys]
    columns += [c for c in latest.columns if c not in (*keys, *columns)]

    def packed(df, name):
        own = [c for c in columns if c in df.columns]
        return df.select(*keys, F.struct(*own).alias(name))

    both = packed(target, "_old").join(packed(latest, "_new"), keys, "full_outer")
    taken = F.col("_new").isNotNull()
    if VERSION in target.columns:
        outdated = F.col(f"_old.{VERSION}") > F.col(f"_new.{VERSION}")
        taken &= ~F.coalesce(outdated, F.lit(False))

    def side(c):
        new = F.col(f"_new.{c}") if c in latest.columns else F.lit(None)
        old = F.col(f"_old.{c}") if c in target.columns else F.lit(None)
        return F.when(taken, new).otherwise(old).alias(c)

    return both.select(*keys, *map(side, columns))


def _patches(changes, keys, order):
    """Latest change per key, and per column the latest value since a delete."""
    position = F.struct(*order)
    deleted = F.col("status").eqNullSafe(F.lit(DELETE))
    columns = [c for c in changes.columns if c not in (*keys, *order, "status")]
    folded = changes.groupBy(*keys).agg(
        F.max(F.struct(*order, "status", *columns)).alias("_last"),
        F.max(deleted).alias("_reset"),
        *[
            F.max(
                F.when(
                    deleted | F.col(c).isNotNull(),
                    F.struct(
                        position.alias("at"), deleted.alias("gone"), F.col(c).alias("v")
                    ),
                )
            ).alias(f"_v_{c}")
            for c in columns
        ],
    )
    ended = F.col("_last.status").eqNullSafe(F.lit(DELETE))
    return folded.select(
        *keys,
        F.col("_last.status").alias("status"),
        *[
            F.when(ended, F.col(f"_last.{c}"))
            .when(~F.col(f"_v_{c}.gone"), F.col(f"_v_{c}.v"))
            .alias(c)
            for c in columns
        ],
        F.struct(*[F.col(f"_last.{c}").alias(c) for c in order]).alias(VERSION),
        "_reset",
    )


def _patch(target, patches, keys):
    if target is None:
        return patches.drop("_reset")
    columns = [c for c in patches.columns if c not in (*keys, "_reset")]
    extra = [c for c in target.columns if c not in (*keys, *columns)]
    held = [c if c in target.columns else None for c in columns]
    old = target.select(
        *keys,
        F.struct(
            *[(F.col(h) if h else F.lit(None)).alias(c) for c, h in zip(columns, held)]
        ).alias("_old"),
        *extra,
    )
    new = patches.select(*keys, F.struct(*columns).alias("_new"), "_reset")
    stale = F.col(f"_old.{VERSION}") > F.col(f"_new.{VERSION}")
    unchanged = F.col("_new").isNull() | F.coalesce(stale, F.lit(False))
    fresh = F.col("_reset") | F.col("_old.status").eqNullSafe(F.lit(DELETE))

    def merged(c):
        before, after = F.col(f"_old.{c}"), F.col(f"_new.{c}")
        taken = F.when(fresh, after).otherwise(F.coalesce(after, before))
        return F.when(unchanged, before).otherwise(taken).alias(c)

    updated = old.join(new, keys, "left").select(*keys, *map(merged, columns), *extra)
    added = patches.drop("_reset").join(target.select(*keys), keys, "left_anti")
    return updated.unionByName(added, allowMissingColumns=True)
