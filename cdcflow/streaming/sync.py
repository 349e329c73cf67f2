"""The change stream: verify, divert, parse, route, shape and store each batch."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from cdcflow.functions.dedup import keep_last
from cdcflow.operators.apply import LOG_POSITION
from cdcflow.operators.envelope import CANONICAL, dead_letters, verify_records
from cdcflow.operators.routing import cdc_docs, route_by_table, unrouted
from cdcflow.plans.cdc_sync import from_wire
from cdcflow.sources.sinks import document_sink, write_documents
from cdcflow.sources.store import N_BUCKETS, StoredTable
from cdcflow.specs import EXCLUDED_FROM_DOCUMENTS, FEED_TABLES, TableSpec, wide_schema

DEAD_LETTERS, UNROUTED = "dead_letters", "unrouted"
# reason of verified messages whose key or time cannot be read
UNREADABLE = "Unreadable key or log_timestamp"

Sink = Callable[[str, DataFrame, int], None]


def file_sink(root: str) -> Sink:
    """Collections as batch folders of Parquet (see ``sinks.read_documents``).

    The folders are those of the stream's own id, which lives in its checkpoint.
    """

    def store(collection: str, docs: DataFrame, batch_id: int) -> None:
        context = docs.sparkSession.sparkContext
        stream = context.getLocalProperty("sql.streaming.queryId") or "direct"
        write_documents(docs, root, collection, batch_id, stream)

    return store


def stored_table(spark, root: str, spec: TableSpec, n_buckets: int = N_BUCKETS) -> StoredTable:
    """The table that ``table_store_sink`` keeps for ``spec``: documents by ``_id`` where
    they are declared, else rows by the table's key."""
    key = spec.key if spec.stream_document is None else "_id"
    return StoredTable(spark, f"{root}/{spec.name}", [key], n_buckets)


def table_store_sink(root: str, specs: dict[str, TableSpec], n_buckets: int = N_BUCKETS) -> Sink:
    """Declared tables as stored tables, each batch once: their documents, or where none
    are declared their rows in the columns' own types.

    A table's manifest remembers the stream and batch it holds, so of a repeated batch only
    the tables that failed take it. Other outputs become batch folders, if they have rows.
    """

    def store(collection: str, docs: DataFrame, batch_id: int) -> None:
        context = docs.sparkSession.sparkContext
        stream = context.getLocalProperty("sql.streaming.queryId") or "direct"
        spec = specs.get(collection)
        if spec is None:
            if not docs.isEmpty():
                write_documents(docs, root, collection, batch_id, stream)
            return
        rows = docs
        if spec.stream_document is None:
            rows = from_wire(docs, spec, ("status", *LOG_POSITION))
        rows = rows.withColumn("log_timestamp", F.col("log_timestamp").try_cast("timestamp"))
        stored_table(docs.sparkSession, root, spec, n_buckets).upsert(rows, (stream, batch_id))

    return store


def once_per_message(
    messages: DataFrame, wait: str = "10 minutes", at: Column | None = None, style: str = CANONICAL
) -> DataFrame:
    """A stream of messages without redelivered ones.

    A valid message is known by its id and log number, which a producer that seals it again
    leaves as they are; any other by its text, so that a damaged copy does not stand for the
    message. What was seen is kept in Spark's state until the latest time is ``wait`` past
    it, and messages that come later than that are dropped; ``late_messages`` counts them.
    ``at`` is the time of a message, such as the broker's; by default its log time, and
    messages without one pass as they are, by a second reading of the source.
    """
    value = F.col("value").cast("string")
    verified = verify_records(messages, style)
    number = F.get_json_object(value, "$.log_id")
    timed_by = F.get_json_object(value, "$.log_timestamp").try_cast("timestamp") if at is None else at
    known = verified.select(
        *messages.columns,
        timed_by.alias("_at"),
        F.when(F.col("is_valid"), F.col("message_id")).otherwise(F.sha2(value, 256)).alias("_message"),
        F.when(F.col("is_valid"), F.coalesce(number, F.lit(""))).otherwise("").alias("_number"),
    )
    once = known.where("_at IS NOT NULL").withWatermark("_at", wait)
    once = once.dropDuplicatesWithinWatermark(["_message", "_number"]).select(*messages.columns)
    if at is not None:
        return once
    return once.unionByName(known.where("_at IS NULL").select(*messages.columns))


def late_messages(query: StreamingQuery) -> int:
    """Messages that came too late for ``once_per_message`` in the batches of a query."""
    states = [state for batch in query.recentProgress for state in batch["stateOperators"]]
    return sum(state["numRowsDroppedByWatermark"] for state in states)


def store_sink(
    uri: str, database: str, fmt: str = "mongodb", options: dict | None = None
) -> Sink:
    """Collections of a document store that replaces documents by ``_id``."""

    def store(collection: str, docs: DataFrame, batch_id: int) -> None:
        document_sink(docs, collection, uri, database, fmt, options)

    return replacing_sink(store)


def replacing_sink(store: Sink) -> Sink:
    """A sink for a store that keeps what it is given last, whatever the order of rows.

    A batch hands it one document per ``_id``, the latest, without the log position.
    Dead letters, unrouted rows and tables without ``_id`` replace nothing and are handed
    on as they are. The order between batches is the topic's: where a change may come in
    a later batch than a newer one of its key, the store has to compare positions itself,
    or the collection is kept by ``file_sink``.
    """

    def fold(collection: str, docs: DataFrame, batch_id: int) -> None:
        if collection not in (DEAD_LETTERS, UNROUTED) and "_id" in docs.columns:
            docs = keep_last(docs, ["_id"], LOG_POSITION).drop(*LOG_POSITION)
        store(collection, docs, batch_id)

    return fold


def batch_outputs(
    messages: DataFrame,
    specs: dict[str, TableSpec] = FEED_TABLES,
    exclude: Iterable[str] = EXCLUDED_FROM_DOCUMENTS,
    style: str = CANONICAL,
    hold: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> dict[str, DataFrame]:
    """Collections one set of messages gives, dead letters and unrouted included.

    No step shuffles. ``hold`` marks the checked messages, which all outputs
    read, for reuse: each message is verified and parsed once.
    """
    verified = verify_records(messages, style)
    schema = wide_schema(specs.values())
    record = F.from_json(F.col("value").cast("string"), schema)
    parsed = verified.withColumn("_record", F.when(F.col("is_valid"), record))
    unread = _unreadable(specs, exclude, schema.names)
    parsed = parsed.withColumns(
        {
            "error_reason": F.coalesce("error_reason", F.when(F.col("is_valid"), unread)),
            "is_valid": F.col("is_valid") & unread.isNull(),
        }
    )
    # flat, so that each output reads only its columns of what is held
    fields = [F.col("_record")[n].alias(f"_record_{n}") for n in schema.names]
    checked = hold(parsed.select(*verified.columns, *fields))
    parsed = checked.filter("is_valid").select(
        *[F.col(f"_record_{n}").alias(n) for n in schema.names]
    )
    routed = route_by_table(parsed, specs, tuple(exclude))
    outputs = {
        table: cdc_docs(table, rows, LOG_POSITION, specs)
        for table, rows in routed.items()
    }
    outputs[UNROUTED] = unrouted(parsed, specs, tuple(exclude), unnamed=True)
    outputs[DEAD_LETTERS] = dead_letters(checked)
    return outputs


def _unreadable(specs: dict[str, TableSpec], exclude: Iterable[str], names) -> Column:
    """Why a verified message of a declared table cannot be stored, or NULL.

    A row without its key or its time would be in a collection that nobody finds it in.
    """
    reason = F.lit(None).cast("string")
    left_out = {name.lower() for name in exclude}
    for name, spec in specs.items():
        if name.lower() in left_out:
            continue
        lost = F.lit(False)
        for column in (spec.key, "log_timestamp"):
            if column in names:
                lost |= F.col(f"_record.{column}").isNull()
        mine = F.lower(F.col("_record.table_name")) == name.lower()
        reason = F.when(mine & lost, UNREADABLE).otherwise(reason)
    return reason


def process_batch(
    batch: DataFrame,
    batch_id: int,
    sink: Sink,
    specs: dict[str, TableSpec] = FEED_TABLES,
    exclude: Iterable[str] = EXCLUDED_FROM_DOCUMENTS,
    style: str = CANONICAL,
) -> None:
    """Store every output of a batch; fail afterwards if one could not be stored.

    A failing table neither stops the others nor passes silently: the raised
    error makes the stream repeat the batch, which the sinks bear.
    """
    held: list[DataFrame] = []

    def hold(df: DataFrame) -> DataFrame:
        held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return held[-1]

    try:
        outputs = batch_outputs(batch, specs, exclude, style, hold)
        if held[0].isEmpty():
            return
        failures = []
        for collection, docs in outputs.items():
            try:
                sink(collection, docs, batch_id)
            except Exception as error:  # noqa: BLE001 - raised below, all together
                failures.append((collection, error))
        if failures:
            named = "; ".join(f"{name}: {error}" for name, error in failures)
            raise RuntimeError(f"batch {batch_id} not stored: {named}")
    finally:
        for df in held:
            df.unpersist()


def run_stream(
    source: DataFrame,
    sink: Sink,
    checkpoint: str,
    specs: dict[str, TableSpec] = FEED_TABLES,
    exclude: Iterable[str] = EXCLUDED_FROM_DOCUMENTS,
    style: str = CANONICAL,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the stream; offsets live in ``checkpoint``.

    By default it takes what is there and stops; give a ``processingTime``
    trigger to keep it running.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, batch_id, sink, specs, exclude, style)

    return (
        source.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
