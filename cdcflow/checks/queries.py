"""One query per operator over the given tables; ``oracle.py`` has their SQL.

Times are returned as text and nested values flat, so results compare by value.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.checks import views
from cdcflow.checks.views import CUSTOMER, FORK_TYPE, ORDERS, PRODUCED_AT, SHOP
from cdcflow.functions.times import FEED_PATTERN, MICRO_PATTERN
from cdcflow.operators import apply, capture, documents, entities, envelope
from cdcflow.operators import integrity, reconcile, routing
from cdcflow.plans.batch_load import batch_load
from cdcflow.plans.cdc_sync import cdc_sync, from_wire
from cdcflow.session import new_dir, use_utc
from cdcflow.sources import files, gaps, logs, sinks, store, topics
from cdcflow.specs import CASCADE, DOCUMENT_RULES, FEED_TABLES, SET_NULL, USERS
from cdcflow.specs import ForeignKey, TableSpec, wide_schema
from cdcflow.specs import Column as Field
from cdcflow.streaming import sync

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

SHOP_WIDE = wide_schema(SHOP.values())


def query(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(use_utc(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def as_text(df: DataFrame) -> DataFrame:
    """Timestamps and decimals as text."""
    return df.select(
        *[
            F.date_format(c, MICRO_PATTERN).alias(c)
            if kind.startswith("timestamp")
            else F.col(c).cast("string").alias(c)
            if kind.startswith("decimal")
            else F.col(c)
            for c, kind in df.dtypes
        ]
    )


# --- sources -----------------------------------------------------------------


@query
def scan_nested_json(spark, sf_dir):
    raw = views.raw_events(spark, sf_dir)
    line = F.to_json(F.struct(*raw.columns))
    broken = F.when(F.col("id").cast("bigint") % 83 == 0, F.substr(line, F.lit(1), F.lit(20)))
    path = new_dir(spark, "feed")
    raw.select(F.coalesce(broken, line).alias("value")).write.text(path)
    scanned = files.scan_nested_json(spark, path)
    return scanned.select(
        "id",
        "type",
        "public",
        "created_at",
        F.col("actor.id").alias("actor_id"),
        F.col("actor.login").alias("actor_login"),
        F.col("repo.id").alias("repo_id"),
        F.col("org.id").alias("org_id"),
        F.col("payload.forkee.id").alias("fork_id"),
        F.col("payload.forkee.owner.login").alias("owner_login"),
        F.col("payload.forkee.size").alias("fork_size"),
    )


@query
def stream_change_topic(spark, sf_dir):
    root = new_dir(spark, "topic")
    messages = views.shop_messages(spark, sf_dir, "orders")
    topics.publish_topic(messages, "changes", "text", path=root)
    stream = topics.stream_change_topic(
        spark, "text", max_per_trigger=4, path=f"{root}/changes"
    )
    read = stream.select(
        F.get_json_object("value", "$.message_id").alias("message_id"),
        F.get_json_object("value", "$.status").alias("status"),
        F.sha2("value", 256).alias("value_sha"),
    )
    started = (
        read.writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{root}/read")
    )
    started.awaitTermination()
    return spark.read.schema(read.schema).parquet(f"{root}/read")


def _half_way(spark) -> DataFrame:
    """Cursor in the middle of a millisecond that several changes share."""
    return spark.sql(
        "SELECT 'orders' AS table_name, TIMESTAMP '2024-01-01 00:00:00.500' AS cursor_ts,"
        " CAST(4500 AS BIGINT) AS cursor_id"
    )


@query
def incremental_log_read(spark, sf_dir):
    log = views.shop_log(spark, sf_dir, "orders")
    rows, _ = logs.incremental_log_read(log, _half_way(spark), "orders")
    return as_text(rows)


@query
def incremental_log_cursor(spark, sf_dir):
    log = views.shop_log(spark, sf_dir, "orders")
    _, following = logs.incremental_log_read(log, _half_way(spark), "orders")
    return as_text(following)


@query
def collect_change_logs(spark, sf_dir):
    changes = {name: views.shop_log(spark, sf_dir, name) for name in SHOP}
    rows, _ = logs.collect_change_logs(changes, _half_way(spark))
    return as_text(rows)


def _commits(log: DataFrame) -> DataFrame:
    """The log with the pass before which each row was committed: numbers up to 1,000
    before the first, all others before the second, but for some that stay open longer."""
    number = F.col("log_id")
    late = F.when(number % 15 == 0, 3).when(number % 5 == 0, 2).otherwise(1)
    return log.withColumn("committed", F.greatest(late, F.when(number > 1000, 2).otherwise(1)))


def _gap_passes(spark, sf_dir, passes):
    log = _commits(views.shop_log(spark, sf_dir, "orders"))
    log = files.land_parquet(log, new_dir(spark, "log"))
    state, read = gaps.unread_from(spark, ["orders"], first=0), []
    for n in range(1, passes + 1):
        rows, state = gaps.read_unread(log.filter(F.col("committed") <= n), state, "orders")
        read.append(rows.withColumn("pass", F.lit(n)))
    return functools.reduce(DataFrame.unionByName, read), state


@query
def log_gaps(spark, sf_dir):
    read, _ = _gap_passes(spark, sf_dir, 3)
    return as_text(read.drop("committed"))


@query
def log_gap_state(spark, sf_dir):
    _, state = _gap_passes(spark, sf_dir, 2)
    return as_text(state)


# --- entities ----------------------------------------------------------------


@query
def users_dim(spark, sf_dir):
    return as_text(entities.users_dim(views.raw_events(spark, sf_dir)))


@query
def orgs_dim(spark, sf_dir):
    return as_text(entities.orgs_dim(views.raw_events(spark, sf_dir)))


@query
def repos_dim(spark, sf_dir):
    return as_text(entities.repos_dim(views.raw_events(spark, sf_dir)))


@query
def events_fact(spark, sf_dir):
    return as_text(entities.events_fact(views.raw_events(spark, sf_dir), FORK_TYPE))


@query
def repo_ownership(spark, sf_dir):
    return entities.repo_ownership(views.raw_events(spark, sf_dir))


@query
def dedup_by_key(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_returnflag"
    )
    kept = entities.dedup_by_key(
        lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"]
    )
    return as_text(kept)


# --- documents ---------------------------------------------------------------


@query
def users_docs(spark, sf_dir):
    users = entities.users_dim(views.raw_events(spark, sf_dir))
    return as_text(documents.users_docs(users))


@query
def orgs_docs(spark, sf_dir):
    orgs = entities.orgs_dim(views.raw_events(spark, sf_dir))
    return as_text(documents.orgs_docs(orgs))


@query
def repo_docs(spark, sf_dir):
    docs = documents.repo_docs(views.raw_events(spark, sf_dir))
    flat = docs.select(
        "_id", "name", "full_name", "url", "html_url", "description", "is_private",
        "is_fork", "language", "default_branch", "stats.*", "dates.*",
        F.col("owner.id").alias("owner_id"),
        F.col("owner.login").alias("owner_login"),
        F.col("owner.type").alias("owner_type"),
    )
    return as_text(flat)


@query
def event_docs(spark, sf_dir):
    docs = documents.event_docs(views.raw_events(spark, sf_dir))
    flat = docs.select(
        "_id", "type", "is_public", "created_at",
        F.col("actor").isNull().alias("no_actor"),
        F.col("actor.id").alias("actor_id"),
        F.col("actor.login").alias("actor_login"),
        F.col("actor.avatar_url").alias("actor_avatar_url"),
        F.col("repo.id").alias("repo_id"),
        F.col("repo.name").alias("repo_name"),
        F.col("repo.url").alias("repo_url"),
        F.col("org").isNull().alias("no_org"),
        F.col("org.id").alias("org_id"),
        F.col("org.login").alias("org_login"),
        F.col("payload.forkee").isNull().alias("no_forkee"),
        F.col("payload.forkee.id").alias("forkee_id"),
        F.col("payload.forkee.name").alias("forkee_name"),
        F.col("payload.forkee.public").alias("forkee_public"),
        F.col("payload.ref").alias("ref"),
        F.col("payload.head").alias("head"),
    )
    return as_text(flat)


# --- capture -----------------------------------------------------------------


@query
def snapshot_diff(spark, sf_dir):
    before, after = views.shop_snapshots(spark, sf_dir, "orders")
    changes = capture.snapshot_diff(before, after, ["o_orderkey"])
    images = [
        F.col(f"{side}.{c}").alias(f"{side}_{c}")
        for side in ("before", "after")
        for c in ORDERS.column_names
    ]
    return as_text(changes.select("o_orderkey", "status", *images))


@query
def snapshot_changes(spark, sf_dir):
    """Digests first, images of the changed rows after."""
    before, after = views.shop_snapshots(spark, sf_dir, "orders")
    changes = capture.snapshot_changes(before, after, ["o_orderkey"])
    images = [
        F.col(f"{side}.{c}").alias(f"{side}_{c}")
        for side in ("before", "after")
        for c in ORDERS.column_names
    ]
    return as_text(changes.select("o_orderkey", "status", *images))


@query
def snapshot_conflicts(spark, sf_dir):
    """Line items by order alone, which repeats; a tenth of the lines is gone after."""
    lines = _lines(spark, sf_dir)
    after = lines.filter((F.col("l_orderkey") + F.col("l_linenumber")) % 10 != 0)
    return capture.snapshot_conflicts(lines, after, ["l_orderkey"])


@query
def after_image_log(spark, sf_dir):
    return as_text(views.shop_log(spark, sf_dir, "orders"))


@query
def before_image_log(spark, sf_dir):
    before, after = views.shop_snapshots(spark, sf_dir, "orders")
    changes = capture.snapshot_diff(before, after, ["o_orderkey"])
    log = capture.before_image_log(
        changes, views.log_time(ORDERS), views.log_number(ORDERS)
    )
    return as_text(log)


@query
def bootstrap_cutover(spark, sf_dir):
    changes = {name: views.shop_log(spark, sf_dir, name) for name in SHOP}
    cursors = logs.bootstrap_cutover(changes)
    # what is left to read behind the cursors: nothing
    left, _ = logs.collect_change_logs(changes, cursors)
    replayed = left.groupBy("table_name").agg(F.count("*").alias("replayed"))
    counted = cursors.join(replayed, "table_name", "left").select(
        "table_name", "cursor_ts", "cursor_id",
        F.coalesce("replayed", F.lit(0)).alias("replayed"),
    )
    return as_text(counted)


# --- seal, verify ------------------------------------------------------------


@query
def seal_records(spark, sf_dir):
    return views.shop_messages(spark, sf_dir, "orders")


@query
def verify_records(spark, sf_dir):
    verified = envelope.verify_records(views.all_damaged(spark, sf_dir))
    return verified.select(
        F.col("offset").alias("key"), "is_valid", "message_id", "error_reason"
    )


@query
def valid_records(spark, sf_dir):
    verified = envelope.verify_records(views.all_damaged(spark, sf_dir))
    valid, _ = envelope.split_records(verified)
    return valid.select(
        F.col("value").cast("string").alias("value"), "topic", "partition", "offset"
    )


@query
def dead_letters(spark, sf_dir):
    verified = envelope.verify_records(views.all_damaged(spark, sf_dir))
    _, dead = envelope.split_records(verified)
    return dead


@query
def publish_topic(spark, sf_dir):
    root = new_dir(spark, "published")
    valid, dead = envelope.split_records(
        envelope.verify_records(views.all_damaged(spark, sf_dir))
    )
    letters = envelope.dead_letter_messages(dead)
    topics.publish_topic(valid, "verified", "text", path=root)
    topics.publish_topic(letters, "rejected", "text", path=root)
    sent = [
        spark.read.text(f"{root}/{topic}").select(F.lit(topic).alias("topic"), "value")
        for topic in ("verified", "rejected")
    ]
    rejected = F.col("topic") == "rejected"
    return sent[0].unionByName(sent[1]).select(
        "topic",
        F.when(~rejected, F.col("value")).alias("message"),
        F.get_json_object("value", "$.error_reason").alias("error_reason"),
        F.get_json_object("value", "$.offset").cast("bigint").alias("offset"),
        # a readable original is nested, so its fields can be reached
        F.get_json_object("value", "$.original_record.producer_timestamp").alias(
            "original_producer_timestamp"
        ),
    )


# --- parse, route, shape -----------------------------------------------------


@query
def parse_envelopes(spark, sf_dir):
    return routing.parse_envelopes(views.all_damaged(spark, sf_dir), SHOP_WIDE)


def _mixed_names(spark, sf_dir) -> DataFrame:
    """Parsed changes whose table names vary in case; some name no known table."""
    parsed = routing.parse_envelopes(
        views.shop_messages(spark, sf_dir, "orders").select("value").unionByName(
            views.shop_messages(spark, sf_dir, "customer").select("value")
        ),
        SHOP_WIDE,
    )
    name, number = F.col("table_name"), F.col("log_id")
    mixed = parsed.withColumn(
        "table_name",
        F.when(number % 41 == 0, F.lit(None))
        .when(number % 43 == 0, F.lit("REPO_OWNERSHIP"))
        .when(number % 47 == 0, F.lit("other"))
        .when(number % 3 == 0, F.upper(name))
        .when(number % 3 == 1, F.initcap(name))
        .otherwise(name),
    )
    # every route reads it: captured, sealed and parsed once
    return files.land_parquet(mixed, new_dir(spark, "mixed"))


@query
def route_by_table(spark, sf_dir):
    parsed = _mixed_names(spark, sf_dir)
    routes = routing.route_by_table(parsed, ["orders", "customer"])
    routes["(unrouted)"] = routing.unrouted(parsed, ["orders", "customer"])
    tagged = [
        rows.select(F.lit(name).alias("route"), "table_name", "log_id", "status")
        for name, rows in routes.items()
    ]
    return functools.reduce(DataFrame.unionByName, tagged)


def _feed_docs(spark, sf_dir, name, keep=()):
    log, spec = views.feed_log(spark, sf_dir, name)
    sealed = envelope.seal_records(log, spec, PRODUCED_AT)
    parsed = routing.parse_envelopes(sealed.select("value"))
    routed = routing.route_by_table(parsed, FEED_TABLES)
    return routing.cdc_docs(name, routed[name], keep)


@query
def cdc_users(spark, sf_dir):
    return _feed_docs(spark, sf_dir, "users")


@query
def cdc_repos(spark, sf_dir):
    return _feed_docs(spark, sf_dir, "repos")


@query
def cdc_orgs(spark, sf_dir):
    return _feed_docs(spark, sf_dir, "orgs", keep=("log_timestamp", "log_id"))


@query
def cdc_events(spark, sf_dir):
    return _feed_docs(spark, sf_dir, "events")


@query
def cdc_fallback(spark, sf_dir):
    messages = views.shop_messages(spark, sf_dir, "orders").select("value")
    parsed = routing.parse_envelopes(messages, SHOP_WIDE)
    routed = routing.route_by_table(parsed, ["orders"])
    return routing.cdc_docs("orders", routed["orders"])


@query
def non_null_columns(spark, sf_dir):
    """Of both routes, from one reading of the messages each."""
    parsed = _mixed_names(spark, sf_dir)
    routed = routing.route_by_table(parsed, SHOP)
    found = [
        routing.non_null_columns(rows).withColumn("route", F.lit(name))
        for name, rows in routed.items()
    ]
    return functools.reduce(DataFrame.unionByName, found)


# --- apply -------------------------------------------------------------------


@query
def run_stream(spark, sf_dir):
    root = new_dir(spark, "stream")
    messages = views.all_damaged(spark, sf_dir)
    topics.publish_topic(messages, "changes", "text", path=root)
    source = topics.stream_change_topic(
        spark, "text", max_per_trigger=4, path=f"{root}/changes"
    )
    started = sync.run_stream(
        source, sync.file_sink(f"{root}/docs"), f"{root}/checkpoint", SHOP, exclude=()
    )
    started.awaitTermination()
    stored = []
    for name, spec in SHOP.items():
        docs = sinks.read_documents(spark, f"{root}/docs", name, keys=[spec.key])
        stored.append(
            docs.select(
                F.lit(name).alias("collection"),
                F.col(spec.key).alias("key"),
                "status",
                F.col(f"{apply.VERSION}.log_id").alias("log_id"),
            )
        )
    dead = sinks.document_changes(spark, f"{root}/docs", sync.DEAD_LETTERS)
    stored.append(
        dead.select(
            F.lit(sync.DEAD_LETTERS).alias("collection"),
            F.lit(None).cast("bigint").alias("key"),
            F.col("error_reason").alias("status"),
            F.lit(None).cast("bigint").alias("log_id"),
        )
    )
    return functools.reduce(DataFrame.unionByName, stored)


def _two_rounds(spark, sf_dir) -> DataFrame:
    """Order changes, and for some keys a later one whose number is lower."""
    log = views.shop_log(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "_id")
    again = log.filter(F.col("_id") % 20 == 1).select(
        (-F.col("log_id")).alias("log_id"),
        "_id", "o_custkey", "o_orderstatus",
        (F.col("o_totalprice") + 5).cast("decimal(18,2)").alias("o_totalprice"),
        "o_orderdate",
        F.lit("again").alias("o_orderpriority"),
        F.when(F.col("_id") % 40 == 1, "DELETE").otherwise("UPDATE").alias("status"),
        (F.col("log_timestamp") + F.expr("INTERVAL 1 HOUR")).alias("log_timestamp"),
    )
    return again.unionByName(log)


def _orders_target(spark, sf_dir) -> DataFrame:
    before, _ = views.shop_snapshots(spark, sf_dir, "orders")
    return before.withColumnRenamed("o_orderkey", "_id")


def _applied(df: DataFrame) -> DataFrame:
    position = F.col(f"{apply.VERSION}.log_id").alias("log_id")
    return as_text(df.select("*", position).drop(apply.VERSION))


@query
def apply_upsert(spark, sf_dir):
    changes = _two_rounds(spark, sf_dir)
    return _applied(apply.apply_changes(_orders_target(spark, sf_dir), changes))


@query
def apply_late_changes(spark, sf_dir):
    """Two batches, the newer one first: the older must not win."""
    changes = _two_rounds(spark, sf_dir)
    newer = changes.filter(F.col("log_id") <= 0)
    older = changes.filter(F.col("log_id") > 0)
    target = apply.apply_changes(_orders_target(spark, sf_dir), newer)
    return _applied(apply.apply_changes(target, older, derived=True))


@query
def apply_deletes(spark, sf_dir):
    changes = _two_rounds(spark, sf_dir)
    target = _orders_target(spark, sf_dir)
    return _applied(apply.apply_changes(target, changes, deletes="remove"))


@query
def apply_patch(spark, sf_dir):
    """Changes that carry the price alone leave the other values in place."""
    changes = _two_rounds(spark, sf_dir)
    bare = [F.lit(None).cast(kind).alias(c) for c, kind in changes.dtypes
            if c in ("o_custkey", "o_orderdate")]
    partial = changes.select(
        *[c for c in changes.columns if c not in ("o_custkey", "o_orderdate")], *bare
    )
    target = _orders_target(spark, sf_dir)
    return _applied(apply.apply_changes(target, partial, merge="patch"))


# --- sinks -------------------------------------------------------------------


@query
def document_sink(spark, sf_dir):
    """Two batches, the first of them written twice, as after a failure."""
    root = new_dir(spark, "documents")
    changes = _two_rounds(spark, sf_dir)
    first = changes.filter(F.col("log_id") > 0)
    second = changes.filter(F.col("log_id") <= 0)
    for number, batch in ((0, first), (1, second), (0, first)):
        sinks.write_documents(batch, root, "orders", number)
    return _applied(sinks.read_documents(spark, root, "orders", deletes="tombstone"))


@query
def bucketed_upsert(spark, sf_dir):
    """A stored table: the newer changes first, then the older, then the newer once more as
    a replay; then in fewer buckets, with what is not needed any more removed."""
    changes = _two_rounds(spark, sf_dir)
    orders = store.StoredTable(spark, f"{new_dir(spark, 'stored')}/orders", ["_id"], 16)
    orders.replace(_orders_target(spark, sf_dir))
    newer, older = changes.filter("log_id <= 0"), changes.filter("log_id > 0")
    for number, batch in ((0, newer), (1, older), (0, newer)):
        orders.upsert(batch, commit=("orders", number))
    orders.rebucket(8)
    orders.vacuum(keep=1)
    return _applied(orders.read("tombstone"))


@query
def stream_round_trip(spark, sf_dir):
    """Both tables brought up to date by a stream into stored tables. The first run fails in
    one table after the other took the batch; the next one starts from the checkpoint."""
    root = new_dir(spark, "round")
    for name, spec in SHOP.items():
        before, _ = views.shop_snapshots(spark, sf_dir, name)
        sync.stored_table(spark, f"{root}/tables", spec, 16).replace(before)
        topics.publish_topic(views.shop_messages(spark, sf_dir, name), "changes", "text", path=root)
    keep = sync.table_store_sink(f"{root}/tables", SHOP, 16)

    def run(sink):
        # all there is at once: the keys of any batch lie in every bucket, so each batch costs a whole table
        source = topics.stream_change_topic(spark, "text", path=f"{root}/changes")
        query = sync.run_stream(source, sink, f"{root}/checkpoint", SHOP, exclude=())
        query.awaitTermination()

    def failing(collection, docs, batch_id):
        if collection == "customer":
            raise OSError("the store is away")
        keep(collection, docs, batch_id)

    try:
        run(failing)
    except StreamingQueryException:
        pass
    run(keep)
    synced = {name: sync.stored_table(spark, f"{root}/tables", spec, 16).read() for name, spec in SHOP.items()}
    return _shop_rows(synced)


@query
def stream_dedup(spark, sf_dir):
    """How often each message passes when a third is delivered again, sealed anew, after a
    restart, and how many came too late: some from the day before."""
    root = new_dir(spark, "once")
    log = views.shop_log(spark, sf_dir, "orders")
    again = log.filter(F.col("log_id") % 3 == 0)
    late = log.filter(F.col("log_id") % 50 == 7).withColumns(
        {"log_id": -F.col("log_id"), "log_timestamp": F.col("log_timestamp") - F.expr("INTERVAL 1 DAY")}
    )
    dropped = 0
    for produced_at, rows in ((PRODUCED_AT, [log]), ("2024-06-02T00:00:00.000000", [again, late])):
        for batch in rows:
            sealed = envelope.seal_records(batch, ORDERS, produced_at)
            topics.publish_topic(sealed, "changes", "text", path=root)
        source = topics.stream_change_topic(spark, "text", max_per_trigger=8, path=f"{root}/changes")
        once = sync.once_per_message(source).select(
            F.get_json_object("value", "$.message_id").alias("message_id"),
            F.get_json_object("value", "$.log_id").cast("bigint").alias("log_id"),
        )
        writer = once.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
        started = writer.trigger(availableNow=True).start(f"{root}/once")
        started.awaitTermination()
        dropped += sync.late_messages(started)
    passed = spark.read.schema("message_id string, log_id bigint").parquet(f"{root}/once")
    counted = passed.groupBy("message_id", "log_id").agg(F.count("*").alias("passed"))
    return counted.unionByName(
        spark.sql(f"SELECT 'late' AS message_id, CAST(NULL AS BIGINT) AS log_id, CAST({dropped} AS BIGINT) AS passed")
    )


@query
def ordered_load(spark, sf_dir):
    root = new_dir(spark, "tables")
    raw = files.land_parquet(views.raw_events(spark, sf_dir), f"{root}/raw")
    tables = entities.feed_tables(raw, FORK_TYPE)
    order = sinks.ordered_load(tables, FEED_TABLES.values(), sinks.table_sink(root))
    written = {n: (tables[n], spark.read.parquet(f"{root}/{n}")) for n in order}
    position = F.array_position(F.array(*[F.lit(n) for n in order]), F.col("table_name"))
    return sinks.load_report(written).withColumn("position", position)


@query
def bootstrap_tables(spark, sf_dir):
    """Recreate the tables, load them, count what each declared column holds."""
    root = new_dir(spark, "bootstrap")
    listed = sinks.bootstrap_tables(spark, FEED_TABLES.values(), root)
    raw = files.land_parquet(views.raw_events(spark, sf_dir), f"{root}/raw")
    tables = entities.feed_tables(raw, FORK_TYPE)
    sinks.ordered_load(tables, FEED_TABLES.values(), sinks.table_sink(root))
    held = [
        routing.non_null_columns(spark.read.schema(s.struct).parquet(f"{root}/{name}"))
        .withColumn("table_name", F.lit(name))
        for name, s in FEED_TABLES.items()
    ]
    found = functools.reduce(DataFrame.unionByName, held)
    return listed.join(found, ["table_name", "column_name"], "left").select(
        "table_name", "column_name", "data_type",
        F.coalesce("non_nulls", F.lit(0)).alias("non_nulls"),
    )


# --- reconciliation and integrity --------------------------------------------


def _order_sides(spark, sf_dir):
    source = views.typed(views.table(spark, sf_dir, "orders"), ORDERS)
    _, target = views.shop_snapshots(spark, sf_dir, "orders")
    return source, target


def _line_sides(spark, sf_dir):
    """Line items, and the same with some of them doubled."""
    lines = views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate"
    )
    twice = F.when(F.col("l_orderkey") % 10 == 0, F.array(F.lit(1), F.lit(2)))
    doubled = lines.withColumn(
        "copy", F.explode(F.coalesce(twice, F.array(F.lit(1))))
    ).drop("copy")
    return lines, doubled


@query
def reconcile_counts(spark, sf_dir):
    orders = reconcile.reconcile_counts(*_order_sides(spark, sf_dir))
    lines = reconcile.reconcile_counts(*_line_sides(spark, sf_dir))
    return orders.withColumn("table_name", F.lit("orders")).unionByName(
        lines.withColumn("table_name", F.lit("lineitem"))
    )


@query
def reconcile_content(spark, sf_dir):
    orders = reconcile.reconcile(*_order_sides(spark, sf_dir))
    lines = reconcile.reconcile(*_line_sides(spark, sf_dir))
    return orders.withColumn("table_name", F.lit("orders")).unionByName(
        lines.withColumn("table_name", F.lit("lineitem"))
    )


@query
def missing_rows(spark, sf_dir):
    lines, doubled = _line_sides(spark, sf_dir)
    return as_text(reconcile.missing_rows(doubled, lines))


@query
def unexpected_rows(spark, sf_dir):
    source, target = _order_sides(spark, sf_dir)
    return as_text(reconcile.unexpected_rows(source, target))


@query
def reconcile_tree(spark, sf_dir):
    source, target = _order_sides(spark, sf_dir)
    return as_text(reconcile.reconcile_tree(source, target))


@query
def missing_tables(spark, sf_dir):
    """Which required kinds of event never occur in the feed."""
    present = views.table(spark, sf_dir, "events").select("event_type").distinct()
    required = ["VIEW", "click", "purchase", "signup", "fork", "star"]
    return integrity.missing_tables(spark, required, present)


@query
def probe_row(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders")
    found = integrity.probe_row(orders, "o_orderkey", 1).select(
        F.lit(1).alias("probe"), "found"
    )
    lacking = integrity.probe_row(orders, "o_orderkey", -1).select(
        F.lit(-1).alias("probe"), "found"
    )
    return found.unionByName(lacking)


def _broken_documents(spark, sf_dir) -> DataFrame:
    """Event documents as JSON; by key, fields missing or of a wrong type."""
    key = F.col("event_id")
    number = key.cast("string")

    def by_key(every, broken, sound):
        return F.when(key % every == 0, broken).otherwise(sound)

    text = F.concat(
        F.lit('{"_id":'),
        by_key(11, number, F.concat(F.lit('"'), number, F.lit('"'))),
        by_key(7, F.lit(""), by_key(13, F.lit(',"type":null'),
               F.concat(F.lit(',"type":"'), "event_type", F.lit('"')))),
        F.lit(',"is_public":'),
        by_key(5, F.lit("1"), F.lit("true")),
        F.lit(',"actor":'),
        by_key(17, F.lit("[1]"), F.concat(
            F.lit('{"id":'), by_key(19, F.lit("1.5"), F.col("user_id").cast("string")),
            F.lit(',"login":null}'))),
        F.lit(',"payload":{"forkee":{"id":'),
        by_key(23, F.lit('"x"'), F.lit("null")),
        F.lit(',"public":false},"ref":'),
        by_key(29, F.lit('{"a":1}'), F.lit('"r"')),
        F.lit("}}"),
    )
    cut = F.when(key % 31 == 0, F.substr(text, F.lit(1), F.lit(12)))
    odd = F.when(key % 37 == 0, F.lit("[1]"))
    return views.table(spark, sf_dir, "events").select(
        F.coalesce(cut, odd, text).alias("json")
    )


@query
def schema_violations(spark, sf_dir):
    docs = _broken_documents(spark, sf_dir)
    return integrity.schema_violations(docs, DOCUMENT_RULES["events"])


@query
def null_violations(spark, sf_dir):
    events = entities.events_fact(views.raw_events(spark, sf_dir), FORK_TYPE)
    return integrity.null_violations(events, FEED_TABLES["events"])


@query
def unique_violations(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem")
    return integrity.unique_violations(lines, ["l_orderkey", "l_linenumber"])


def _kept_orders(spark, sf_dir):
    return views.table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 10 != 0)


def _deleted_orders(spark, sf_dir):
    return views.table(spark, sf_dir, "orders").filter(
        F.col("o_orderkey") % 10 == 0
    ).select("o_orderkey")


def _lines(spark, sf_dir):
    return views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )


@query
def orphans(spark, sf_dir):
    parents = _kept_orders(spark, sf_dir)
    return integrity.orphans(_lines(spark, sf_dir), "l_orderkey", parents, "o_orderkey")


@query
def cascade_delete(spark, sf_dir):
    deleted = _deleted_orders(spark, sf_dir)
    return integrity.cascade_delete(_lines(spark, sf_dir), "l_orderkey", deleted)


@query
def cascade_set_null(spark, sf_dir):
    customers = views.table(spark, sf_dir, "customer").filter(
        F.col("c_custkey") % 10 == 0
    )
    orders = views.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus"
    )
    return integrity.cascade_set_null(orders, "o_custkey", customers.select("c_custkey"))


@query
def cascade_graph(spark, sf_dir):
    """Users deleted from the feed tables take their events along."""
    raw = files.land_parquet(views.raw_events(spark, sf_dir), new_dir(spark, "raw"))
    tables = entities.feed_tables(raw, FORK_TYPE)
    users = tables["users"].filter(F.col("user_id") % 10 == 0).select("user_id")
    orgs = tables["orgs"].filter(F.col("org_id") % 5 == 0).select("org_id")
    left, _ = integrity.cascade(
        tables, FEED_TABLES.values(), {"users": users, "orgs": orgs}
    )
    counted = [
        rows.agg(
            F.count("*").alias("row_count"),
            (F.count(F.col(fk)) if fk else F.count("*")).alias("fk_count"),
        ).withColumn("table_name", F.lit(name))
        for name, rows, fk in [
            ("users", left["users"], None),
            ("orgs", left["orgs"], None),
            ("events", left["events"], "org_id"),
            ("repo_ownership", left["repo_ownership"], "owner_user_id"),
        ]
    ]
    return functools.reduce(DataFrame.unionByName, counted)


CIRCLE = (
    TableSpec(
        name="customer",
        key="c_custkey",
        columns=(Field("c_custkey", views.LONG), Field("c_referrer", views.LONG), Field("c_order", views.LONG)),
        foreign_keys=(ForeignKey("c_referrer", "customer", CASCADE), ForeignKey("c_order", "orders", CASCADE)),
    ),
    TableSpec(
        name="orders",
        key="o_orderkey",
        columns=(Field("o_orderkey", views.LONG), Field("o_custkey", views.LONG)),
        foreign_keys=(ForeignKey("o_custkey", "customer", CASCADE),),
    ),
    TableSpec(
        name="lineitem",
        key="l_key",
        columns=(Field("l_key", views.LONG), Field("l_orderkey", views.LONG)),
        foreign_keys=(ForeignKey("l_orderkey", "orders", SET_NULL),),
    ),
)


@query
def cascade_closure(spark, sf_dir):
    """Customers referred by customers and kept by an order, orders kept by customers: what
    some customers take along, through chains and circles, and lines without their order."""
    key = F.col("c_custkey").cast("bigint")
    customer = views.table(spark, sf_dir, "customer").select(
        key.alias("c_custkey"),
        F.when(key > 6, F.expr("c_custkey DIV 7").cast("bigint")).alias("c_referrer"),
        F.when(key % 9 == 0, key * 2).alias("c_order"),
    )
    orders = views.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.col("o_custkey").cast("bigint").alias("o_custkey")
    )
    lines = views.table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("l_key"),
        F.col("l_orderkey").cast("bigint").alias("l_orderkey"),
    )
    tables = {"customer": customer, "orders": orders, "lineitem": lines}
    deleted = {"customer": customer.filter(F.col("c_custkey") % 97 == 5).select("c_custkey")}
    left, gone = integrity.cascade_closure(tables, CIRCLE, deleted)
    rows = [
        left[name].select(F.lit(name).alias("table_name"), F.col(k).alias("key"), F.col(fk).alias("parent"))
        for name, k, fk in (("customer", "c_custkey", "c_referrer"), ("orders", "o_orderkey", "o_custkey"), ("lineitem", "l_key", "l_orderkey"))
    ]
    rows += [
        gone[name].select(F.lit(f"gone from {name}").alias("table_name"), "key", F.lit(None).cast("bigint").alias("parent"))
        for name in ("customer", "orders")
    ]
    return functools.reduce(DataFrame.unionByName, rows)


@query
def fill_defaults(spark, sf_dir):
    repos = entities.repos_dim(views.raw_events(spark, sf_dir))
    partial = repos.select(
        "repo_id", "name",
        F.when(F.col("repo_id") % 2 == 0, F.col("watchers_count")).alias("watchers_count"),
    )
    filled = integrity.fill_defaults(partial, FEED_TABLES["repos"], "2024-06-01 00:00:00")
    return filled.select(
        "repo_id", "name", "full_name", "size", "forks_count", "stargazers_count",
        "watchers_count",
    )


@query
def length_violations(spark, sf_dir):
    spec = TableSpec(
        name="documents",
        key="doc_id",
        columns=(
            Field("doc_id", views.LONG),
            Field("text", views.STRING, length=512),
            Field("source", views.STRING, length=4),
        ),
    )
    return integrity.length_violations(views.table(spark, sf_dir, "documents"), spec)


# --- compositions ------------------------------------------------------------


@query
def batch_load_report(spark, sf_dir):
    root = new_dir(spark, "load")
    raw = views.raw_events(spark, sf_dir)
    raw.write.json(f"{root}/feed")
    report, _ = batch_load(spark, f"{root}/feed", f"{root}/out", FORK_TYPE)
    return report


@query
def cdc_round_trip(spark, sf_dir):
    snaps = {name: views.shop_snapshots(spark, sf_dir, name) for name in SHOP}
    synced = cdc_sync(
        {name: pair[0] for name, pair in snaps.items()},
        {name: pair[1] for name, pair in snaps.items()},
        SHOP,
        views.log_time,
        views.log_number,
        PRODUCED_AT,
    )
    return _shop_rows(synced)


def _shop_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of all shop tables under each other, tagged, their values as text."""
    columns = [c for spec in SHOP.values() for c in spec.column_names]
    tagged = [
        as_text(rows.select(*SHOP[name].column_names)).select(
            F.lit(name).alias("table_name"),
            *[(F.col(c) if c in rows.columns else F.lit(None)).cast("string").alias(c) for c in columns],
        )
        for name, rows in tables.items()
    ]
    return functools.reduce(DataFrame.unionByName, tagged)
