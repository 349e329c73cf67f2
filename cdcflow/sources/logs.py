"""Incremental reads of change logs behind per-table cursors.

A cursor table has one row per log: ``table_name``, ``cursor_ts``, ``cursor_id``.
Cursors enter a read as scalar subqueries, so the time bound reaches the scan of
the log without collecting anything.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CURSOR_SCHEMA = "table_name string, cursor_ts timestamp, cursor_id bigint"

# Below any log time and number: where a log without a cursor starts.
_START_TS = "0001-01-01 00:00:00"
_START_ID = -(2**63)


def empty_cursors(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CURSOR_SCHEMA)


def incremental_log_read(
    log: DataFrame,
    cursors: DataFrame | None = None,
    table_name: str | None = None,
    ts: str = "log_timestamp",
    tie: str | None = "log_id",
) -> tuple[DataFrame, DataFrame]:
    """Rows newer than the cursor, oldest first, and the next cursor.

    Rows are compared by (``ts``, ``tie``), so none is lost that shares its
    millisecond with the last one read. ``tie=None`` compares the time alone.
    Without new rows the cursor stays. Without a cursor everything is new, rows without
    a time included; with one, such rows have no place after it (``untimed`` lists them).
    """
    fresh, following = _read_after(log, cursors, table_name, ts, tie)
    # a second sort column lets the sort spread rows that share one time
    second = F.col(tie) if tie else F.xxhash64(*log.columns)
    return fresh.orderBy(F.col(ts), second), following


def _read_after(log, cursors, table_name, ts, tie) -> tuple[DataFrame, DataFrame]:
    cursors_unset = cursors is None
    if cursors_unset:
        cursors = empty_cursors(log.sparkSession)
    mine = cursors.filter(F.col("table_name").eqNullSafe(F.lit(table_name)))
    if cursors_unset:
        fresh = log
    else:
        fresh = log.filter(_after(mine, ts, tie)).unionByName(_without_cursor(log, mine, ts, tie))
    position = F.max(
        F.struct(
            F.col(ts).cast("timestamp").alias("cursor_ts"),
            (F.col(tie) if tie else F.lit(None)).cast("bigint").alias("cursor_id"),
        )
    )
    reached = fresh.agg(position.alias("at")).select("at.cursor_ts", "at.cursor_id")
    # of the old and the reached position the later one stays
    following = (
        reached.unionByName(mine.select("cursor_ts", "cursor_id"))
        .agg(F.max(F.struct("cursor_ts", "cursor_id")).alias("at"))
        .filter(F.col("at.cursor_ts").isNotNull())
        .select(
            F.lit(table_name).cast("string").alias("table_name"),
            "at.cursor_ts",
            "at.cursor_id",
        )
    )
    return fresh, following


def untimed(log: DataFrame, ts: str = "log_timestamp") -> DataFrame:
    """Rows without a time, which no cursor can be compared with."""
    return log.filter(F.col(ts).isNull())


def _start(mine: DataFrame):
    """The latest position of the cursor rows, taken as a whole."""
    return mine.agg(F.max(F.struct("cursor_ts", "cursor_id")).alias("at"))


def _without_cursor(log: DataFrame, mine: DataFrame, ts: str, tie: str | None) -> DataFrame:
    """What the comparison with a cursor leaves out where there is no cursor at all."""
    none = _start(mine).select(F.col("at").isNull()).scalar()
    lost = F.col(ts).isNull() if tie is None else F.col(ts).isNull() | F.col(tie).isNull()
    return log.filter(lost & none)


def _after(mine: DataFrame, ts: str, tie: str | None):
    start_ts = _start(mine).select(
        F.coalesce("at.cursor_ts", F.lit(_START_TS).cast("timestamp"))
    ).scalar()
    if tie is None:
        return F.col(ts) > start_ts
    start_id = _start(mine).select(
        F.coalesce("at.cursor_id", F.lit(_START_ID).cast("bigint"))
    ).scalar()
    # the first conjunct is implied; it is what a scan can prune by
    later = (F.col(ts) > start_ts) | (F.col(tie) > start_id)
    return (F.col(ts) >= start_ts) & later & (F.col(tie).isNotNull() | _start(mine).select(F.col("at").isNotNull()).scalar())


def collect_change_logs(
    logs: dict[str, DataFrame],
    cursors: DataFrame | None = None,
    tie: str | None = "log_id",
) -> tuple[DataFrame, DataFrame]:
    """One incremental pass over all logs: a wide change set and the next cursors.

    The set has no order: what folds it looks at log positions, so sorting each
    log would be a shuffle for nothing.
    """
    reads = {
        name: _read_after(log, cursors, name, "log_timestamp", tie)
        for name, log in logs.items()
    }
    changes = reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True),
        [
            rows.withColumn("table_name", F.lit(name))
            for name, (rows, _) in reads.items()
        ],
    )
    following = reduce(DataFrame.unionByName, [after for _, after in reads.values()])
    return changes, following


def bootstrap_cutover(
    logs: dict[str, DataFrame], ts: str = "log_timestamp", tie: str = "log_id"
) -> DataFrame:
    """Cursors past everything logged so far.

    After an initial load they keep the loaded rows from being replayed as
    changes, without emptying the logs.
    """
    ends = [
        log.agg(F.max(F.struct(ts, tie)).alias("at")).select(
            F.lit(name).alias("table_name"),
            F.col("at").getField(ts).cast("timestamp").alias("cursor_ts"),
            F.col("at").getField(tie).cast("bigint").alias("cursor_id"),
        )
        for name, log in logs.items()
    ]
    return reduce(DataFrame.unionByName, ends).filter(F.col("cursor_ts").isNotNull())


def save_cursors(cursors: DataFrame, root: str, generation: int) -> None:
    """Persist cursors; a rerun of the same generation replaces its own rows."""
    cursors.write.mode("overwrite").parquet(f"{root}/generation={generation}")


def load_cursors(spark: SparkSession, root: str, generation: int) -> DataFrame:
    return spark.read.schema(CURSOR_SCHEMA).parquet(f"{root}/generation={generation}")
