"""Initial load: feed files to tables and collections, reconciled and cut over."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.operators.documents import (
    event_docs,
    latest_documents,
    orgs_docs,
    repo_docs,
    users_docs,
)
from cdcflow.operators.entities import feed_tables, feed_times
from cdcflow.sources.files import land_parquet, scan_nested_json
from cdcflow.sources.logs import bootstrap_cutover
from cdcflow.sources.sinks import (
    bootstrap_tables,
    observed_report,
    observing,
    ordered_load,
    table_sink,
)
from cdcflow.specs import FEED_TABLES


def batch_load(
    spark: SparkSession,
    feed_path: str,
    root: str,
    fork_type: str = "ForkEvent",
    logs: dict[str, DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Load a feed into tables, then collections; report what was written.

    The feed is landed as Parquet once, event times parsed: the outputs and their checks
    then read only the nested columns they need. Users and organisations are folded once, for their
    tables; their collections come from what was stored. Of several events that give
    one document the last one counts. Every output is digested while it is written, so its
    check is one scan of what was stored. Returns the report, one row per output, and the
    cursors past ``logs``.
    """
    raw = land_parquet(feed_times(scan_nested_json(spark, feed_path)), f"{root}/raw")
    specs = list(FEED_TABLES.values())
    tables = feed_tables(raw, fork_type)
    bootstrap_tables(spark, specs, f"{root}/tables")
    seen, seen_documents = {}, {}
    order = ordered_load(tables, specs, observing(table_sink(f"{root}/tables"), seen))
    loaded = {name: spark.read.parquet(f"{root}/tables/{name}") for name in order}

    documents = {
        "users": users_docs(loaded["users"]),
        "orgs": orgs_docs(loaded["orgs"]),
        "repos": repo_docs(raw, latest=True),
        "events": latest_documents(event_docs(raw, position=True)),
    }
    store = observing(table_sink(f"{root}/collections"), seen_documents)
    for name, docs in documents.items():
        store(name, docs)

    written = {f"tables/{name}": (seen[name], tables[name], loaded[name]) for name in order}
    for name, docs in documents.items():
        stored = spark.read.schema(docs.schema).parquet(f"{root}/collections/{name}")
        written[f"collections/{name}"] = (seen_documents[name], docs, stored)
    report = observed_report(written)
    return report, bootstrap_cutover(logs) if logs else None


def failed_loads(report: DataFrame) -> DataFrame:
    return report.filter(F.col("verdict") != "equal")
