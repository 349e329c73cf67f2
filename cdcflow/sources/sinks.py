"""Writers: relational tables, document collections, ordered loads."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.operators.apply import LOG_POSITION, apply_changes
from cdcflow.operators.reconcile import reconcile, reconcile_counts, row_digests
from cdcflow.sources.jdbc import jdbc_options, jdbc_scan
from cdcflow.specs import TableSpec, load_order


def jdbc_append(
    df: DataFrame, url: str, table: str, props: dict[str, str] | None = None
) -> DataFrame:
    """Append to a relational table; returns the reconciliation of the two."""
    options = jdbc_options(url, table, props)
    df.write.format("jdbc").options(**options).mode("append").save()
    return reconcile_counts(df, jdbc_scan(df.sparkSession, url, table, props))


def document_sink(
    df: DataFrame,
    collection: str,
    uri: str,
    database: str,
    fmt: str = "mongodb",
    options: dict[str, str] | None = None,
) -> None:
    """Append documents to a collection of a document store."""
    writer = df.write.format(fmt).option("connection.uri", uri)
    writer = writer.option("database", database).option("collection", collection)
    writer.options(**(options or {})).mode("append").save()


# --- document collections on files -------------------------------------------


def write_documents(
    df: DataFrame, root: str, collection: str, batch_id: int, stream: str = "direct"
) -> None:
    """Store one batch of document changes.

    A batch owns its folder and replaces it, so a batch that is replayed after a
    failure leaves the same files. ``stream`` tells apart streams that number their
    batches alike, such as one that was started again with a new checkpoint.
    """
    folder = f"{root}/{collection}/stream={stream}/batch_id={batch_id}"
    df.write.mode("overwrite").parquet(folder)


def document_changes(
    spark: SparkSession, root: str, collection: str, schema: T.StructType | None = None
) -> DataFrame:
    reader = spark.read.option("basePath", f"{root}/{collection}")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(f"{root}/{collection}").drop("batch_id", "stream")


def read_documents(
    spark: SparkSession,
    root: str,
    collection: str,
    keys=("_id",),
    order=LOG_POSITION,
    deletes: str = "remove",
    base: DataFrame | None = None,
) -> DataFrame:
    """Collection as of its last batch: all batches folded into ``base``.

    Writing the result (with ``deletes='tombstone'``) elsewhere as the next
    ``base`` compacts a collection.
    """
    changes = document_changes(spark, root, collection)
    return apply_changes(base, changes, keys=keys, order=order, deletes=deletes)


# --- relational tables on files ----------------------------------------------


def bootstrap_tables(
    spark: SparkSession, specs: Iterable[TableSpec], root: str
) -> DataFrame:
    """Recreate empty tables and list the columns they are stored with."""
    stored = []
    for spec in specs:
        empty = spark.createDataFrame([], spec.struct)
        empty.write.mode("overwrite").parquet(f"{root}/{spec.name}")
        found = spark.read.parquet(f"{root}/{spec.name}").schema
        if found != spec.struct:
            raise ValueError(f"{spec.name} was stored as {found.simpleString()}")
        stored += [(spec.name, f.name, f.dataType.simpleString()) for f in found]
    return spark.createDataFrame(
        stored, "table_name string, column_name string, data_type string"
    )


def table_sink(root: str) -> Callable[[str, DataFrame], None]:
    def append(name: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(f"{root}/{name}")

    return append


def ordered_load(
    tables: dict[str, DataFrame],
    specs: Iterable[TableSpec],
    sink: Callable[[str, DataFrame], None],
) -> list[str]:
    """Load tables through ``sink``, parents before children; returns the order."""
    order = [s.name for s in load_order(specs) if s.name in tables]
    for name in order:
        sink(name, tables[name])
    return order


def load_report(
    written: dict[str, tuple[DataFrame, DataFrame]],
    compare: Callable[[DataFrame, DataFrame], DataFrame] = reconcile_counts,
) -> DataFrame:
    """Reconciliation row per (source, target) pair, tagged with its name."""
    report = None
    for name, (source, target) in written.items():
        line = compare(source, target).select(F.lit(name).alias("table_name"), "*")
        report = line if report is None else report.unionByName(line)
    return report


def observing(sink: Callable[[str, DataFrame], None], seen: dict[str, Observation]) -> Callable[[str, DataFrame], None]:
    """A sink whose rows are counted and digested on their way: what was written is known
    without computing it a second time."""

    def store(name: str, df: DataFrame) -> None:
        seen[name] = Observation(name)
        sink(name, df.observe(seen[name], *row_digests(df)))

    return store


def observed_report(
    written: dict[str, tuple[Observation, DataFrame, DataFrame]],
) -> DataFrame:
    """As ``load_report`` with ``reconcile``, from what was observed of each output.

    One scan of each target gives its digests. Where they are those of the rows that were
    written nothing is missing or unexpected; elsewhere source and target are compared by
    row, for which the source is computed again.
    """
    held = None
    for name, (_, _, target) in written.items():
        line = target.agg(*row_digests(target)).select(F.lit(name).alias("table_name"), "*")
        held = line if held is None else held.unionByName(line)
    # a row per output
    stored = {r.table_name: r for r in held.collect()}
    spark, report = held.sparkSession, None
    for name, (observation, source, target) in written.items():
        sent, found = observation.get, stored[name]
        if all(sent[c] == found[c] for c in ("row_count", "digest_a", "digest_b")):
            n = found.row_count
            line = spark.sql(
                "SELECT CAST({n} AS BIGINT) AS source_count, CAST({n} AS BIGINT) AS target_count, CAST(0 AS BIGINT) AS gap,"
                " CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS unexpected, 'equal' AS verdict",
                n=n,
            )
        else:
            line = reconcile(source, target)
        line = line.select(F.lit(name).alias("table_name"), "*")
        report = line if report is None else report.unionByName(line)
    return report
