"""Streams over text topics: restart, failing sinks, replays, sinks and loads."""

import json

import pytest
from cdcflow.checks import queries, views
from cdcflow.operators.entities import feed_tables
from cdcflow.operators.envelope import seal_records
from cdcflow.plans.batch_load import batch_load, failed_loads
from cdcflow.plans.cdc_sync import cdc_sync
from cdcflow.session import new_dir
from cdcflow.sources import jdbc, sinks, topics
from cdcflow.specs import FEED_TABLES, USERS
from cdcflow.streaming import sync
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"


def users_log(spark, *rows):
    """(number, key, login, status, second) rows as a change log of users."""
    df = spark.createDataFrame(
        list(rows), "log_id bigint, user_id bigint, login string, status string, s int"
    )
    return df.select(
        "log_id", "user_id", "login",
        *[F.lit(None).cast("string").alias(c) for c in ("avatar_url", "url", "type")],
        F.lit(True).alias("site_admin"), F.lit(None).cast("timestamp").alias("created_at"),
        "status", F.timestamp_seconds(F.col("s")).alias("log_timestamp"),
    )


def publish(spark, root, *rows):
    sealed = seal_records(users_log(spark, *rows), USERS, "now")
    topics.publish_topic(sealed.coalesce(1), "t", "text", path=root)


def start(spark, root, sink=None):
    source = topics.stream_change_topic(spark, "text", max_per_trigger=1, path=f"{root}/t")
    query = sync.run_stream(source, sink or sync.file_sink(f"{root}/docs"), f"{root}/cp")
    query.awaitTermination()
    return query


def users(spark, root, deletes="remove"):
    docs = sinks.read_documents(spark, f"{root}/docs", "users", deletes=deletes)
    return {r["_id"]: r.login for r in docs.collect()}


def test_a_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, root, (1, 1, "a", "INSERT", 1), (2, 2, "b", "INSERT", 1))
    start(spark, root)
    assert users(spark, root) == {1: "a", 2: "b"}
    publish(spark, root, (3, 1, "a2", "UPDATE", 2), (4, 2, "b", "DELETE", 2))
    again = start(spark, root)
    assert sum(p["numInputRows"] for p in again.recentProgress) == 2
    assert users(spark, root) == {1: "a2"}
    assert users(spark, root, "tombstone") == {1: "a2", 2: "b"}


def test_a_failing_table_loses_nothing(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, root, (1, 1, "a", "INSERT", 1))
    (tmp_path / "t" / "extra.txt").write_text("broken\n")
    store, seen = sync.file_sink(f"{root}/docs"), []

    def failing(collection, docs, batch_id):
        seen.append(collection)
        if collection == "users":
            raise OSError("store is away")
        store(collection, docs, batch_id)

    with pytest.raises(StreamingQueryException, match="store is away"):
        start(spark, root, failing)
    # the other collections of the batch were still tried
    assert {"repos", "orgs", "events", sync.DEAD_LETTERS} <= set(seen)
    start(spark, root)
    assert users(spark, root) == {1: "a"}
    dead = sinks.document_changes(spark, f"{root}/docs", sync.DEAD_LETTERS).collect()
    assert [(d.original_record, d.error_reason) for d in dead] == [("broken", "Malformed JSON")]


def test_replayed_batches_change_nothing(spark, tmp_path):
    root = str(tmp_path)
    sealed = seal_records(
        users_log(spark, (1, 1, "a", "INSERT", 1), (2, 1, "b", "UPDATE", 2)), USERS, "now"
    )
    for _ in range(2):
        sync.process_batch(sealed.select("value"), 0, sync.file_sink(f"{root}/docs"))
    assert sinks.document_changes(spark, f"{root}/docs", "users").count() == 2
    assert users(spark, root) == {1: "b"}


def test_an_older_batch_does_not_win_and_a_base_compacts(spark, tmp_path):
    root = str(tmp_path)
    rows = [(2, 1, "new", "UPDATE", 2)], [(1, 1, "old", "INSERT", 1), (3, 2, "x", "INSERT", 1)]
    for number, batch in enumerate(rows):
        sealed = seal_records(users_log(spark, *batch), USERS, "now").select("value")
        sync.process_batch(sealed, number, sync.file_sink(f"{root}/docs"))
    stored = sinks.read_documents(spark, f"{root}/docs", "users", deletes="tombstone")
    stored.write.parquet(f"{root}/base")
    base = spark.read.parquet(f"{root}/base")
    late = seal_records(users_log(spark, (0, 1, "older", "UPDATE", 0)), USERS, "now")
    sync.process_batch(late.select("value"), 0, sync.file_sink(f"{root}/next"))
    folded = sinks.read_documents(spark, f"{root}/next", "users", base=base)
    assert {r["_id"]: r.login for r in folded.collect()} == {1: "new", 2: "x"}


def test_a_replacing_store_gets_the_latest_change_of_a_batch(spark):
    rows = [(k * 10 + n, k, f"v{n}", "UPDATE", n) for k in (1, 2) for n in range(4)]
    sealed = seal_records(users_log(spark, *rows), USERS, "now").select("value")
    broken = spark.createDataFrame([("broken",)], "value string")
    store, handed = {}, {}

    def replace(collection, docs, batch_id):
        handed[collection] = docs.columns
        for row in reversed(docs.collect()):
            store[collection, row.asDict().get("_id")] = row

    sync.process_batch(sealed.union(broken), 0, sync.replacing_sink(replace))
    assert {k: r.login for (c, k), r in store.items() if c == "users"} == {1: "v3", 2: "v3"}
    assert "log_id" not in handed["users"] and "error_reason" in handed[sync.DEAD_LETTERS]


def test_text_topics_refuse_line_breaks(spark, tmp_path):
    split = spark.createDataFrame([('{"a":1,\n"b":2}',)], "value string")
    with pytest.raises(Exception, match="line break"):
        topics.publish_topic(split, "t", "text", path=str(tmp_path))
    topics.publish_topic(split, "t", "parquet", path=str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/t").first().value == '{"a":1,\n"b":2}'


def test_unknown_tables_are_kept_aside(spark, tmp_path):
    root = str(tmp_path)
    orders = views.shop_messages(spark, SF_DIR, "orders").limit(3).select("value")
    sync.process_batch(orders, 0, sync.file_sink(root))
    aside = sinks.document_changes(spark, root, sync.UNROUTED).collect()
    assert {r.table_name for r in aside} == {"orders"} and len(aside) == 3


def test_stream_publishing(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, root, (1, 1, "a", "INSERT", 1))
    stream = topics.stream_change_topic(spark, "text", max_per_trigger=1, path=f"{root}/t")
    query = topics.publish_topic(
        stream, "copy", "text", {"checkpointLocation": f"{root}/cp2"}, path=root
    )
    query.processAllAvailable()
    query.stop()
    copied = spark.read.text(f"{root}/copy").first().value
    assert json.loads(copied)["message_id"].startswith("users_1_")


def test_snapshots_round_trip_for_every_feed_table(spark):
    raw = views.raw_events(spark, SF_DIR)
    tables = feed_tables(raw, views.FORK_TYPE)
    changed = {"users": "login", "repos": "name", "orgs": "login", "events": "event_type"}
    before, after = {}, {}
    for name, column in changed.items():
        new = F.concat(F.col(column), F.lit("é\"'"))
        before[name], after[name] = views.snapshots(
            tables[name], FEED_TABLES[name].key, column, new
        )
    specs = {n: FEED_TABLES[n] for n in changed}
    synced = cdc_sync(before, after, specs, views.log_time, views.log_number, "now")
    for name in changed:
        assert synced[name].exceptAll(after[name]).count() == 0, name
        assert after[name].exceptAll(synced[name]).count() == 0, name


def test_batch_load_reports_equal_and_cuts_over(spark):
    root = new_dir(spark, "load")
    views.raw_events(spark, SF_DIR).write.json(f"{root}/feed")
    logs = {"users": users_log(spark, (5, 1, "a", "INSERT", 1))}
    report, cursors = batch_load(spark, f"{root}/feed", root, views.FORK_TYPE, logs)
    assert report.count() == 9 and failed_loads(report).count() == 0
    assert [r.cursor_id for r in cursors.collect()] == [5]


def test_bootstrap_recreates(spark, tmp_path):
    root = str(tmp_path)
    listed = sinks.bootstrap_tables(spark, FEED_TABLES.values(), root)
    assert listed.count() == sum(len(s.columns) for s in FEED_TABLES.values())
    spark.range(3).selectExpr("id AS user_id").write.mode("append").parquet(f"{root}/users")
    sinks.bootstrap_tables(spark, [USERS], root)
    assert spark.read.parquet(f"{root}/users").count() == 0


def test_a_scan_needs_its_nested_columns_only(spark):
    root = new_dir(spark, "landed")
    views.raw_events(spark, SF_DIR).write.parquet(root)
    landed = spark.read.parquet(root)
    plan = feed_tables(landed)["orgs"]._jdf.queryExecution().executedPlan()
    scan = plan.toString()
    scan = scan[scan.index("FileScan") :].replace("\n", "")
    assert "IsNotNull(org.id)" in scan and "payload" not in scan and "actor" not in scan


def test_jdbc_options():
    # no database is reachable from here: the options are all that is checked
    part = jdbc.JdbcPartition("user_id", 0, 1000, 16)
    assert jdbc.jdbc_options("jdbc:x", "USERS", {"user": "u"}, part) == {
        "url": "jdbc:x", "dbtable": "USERS", "user": "u", "partitionColumn": "user_id",
        "lowerBound": "0", "upperBound": "1000", "numPartitions": "16",
    }


def test_messages_are_sealed_in_as_many_tasks_as_they_were_captured(spark, monkeypatch):
    plans, publish = [], queries.topics.publish_topic
    def seen(df, *args, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return publish(df, *args, **options)
    monkeypatch.setattr(queries.topics, "publish_topic", seen)
    queries.QUERIES["stream_dedup"](spark, SF_DIR)
    assert len(plans) == 3 and not any("Coalesce " in p for p in plans)


def test_the_round_trip_writes_a_table_once_however_many_files_a_topic_has(spark, monkeypatch):
    roots, publish = set(), queries.topics.publish_topic
    def dealt(df, *args, path, **options):
        roots.add(path)
        return publish(df.repartition(12), *args, path=path, **options)
    monkeypatch.setattr(queries.topics, "publish_topic", dealt)
    queries.QUERIES["stream_round_trip"](spark, SF_DIR)
    for name, spec in queries.SHOP.items():
        assert sync.stored_table(spark, f"{next(iter(roots))}/tables", spec, 16).manifest().version == 2
