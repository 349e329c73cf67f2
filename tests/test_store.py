"""Stored tables: crashes, readers, writers and replays; streams into them."""

import os

import pytest
from cdcflow.checks import views
from cdcflow.operators import capture
from cdcflow.operators.envelope import seal_records
from cdcflow.sources import store, topics
from cdcflow.specs import USERS
from cdcflow.streaming import sync
from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"


def changes(spark, *rows):
    """(key, value, status, number) rows; the number is the log time as well."""
    df = spark.createDataFrame(list(rows), "k bigint, v string, status string, log_id bigint")
    return df.withColumn("log_timestamp", F.timestamp_seconds("log_id"))


@pytest.fixture
def table(spark, tmp_path):
    return store.StoredTable(spark, str(tmp_path / "t"), ["k"], 8)


def held(table, deletes="remove", version=None):
    return {r.k: r.v for r in table.read(deletes, version).collect()}


def many(spark, n, status="INSERT", number=1):
    return changes(spark, *((k, f"v{k}", status, number) for k in range(n)))


def test_the_latest_change_wins_in_any_order_of_sets(spark, table):
    assert table.upsert(changes(spark, (1, "new", "UPDATE", 5), (2, "b", "INSERT", 2), (None, "no key", "INSERT", 9)))
    assert table.upsert(changes(spark, (1, "old", "INSERT", 1), (2, None, "DELETE", 3), (3, "c", "INSERT", 3)))
    assert held(table) == {1: "new", 3: "c"}
    assert table.upsert(changes(spark, (2, "late", "UPDATE", 2)))
    assert held(table) == {1: "new", 3: "c"} and set(held(table, "tombstone")) == {1, 2, 3}


def test_a_commit_is_taken_once_and_kept_with_its_cursors(spark, table):
    assert table.upsert(many(spark, 20), ("s", 0), {"log": ("2024-01-01 00:00:00", 7)})
    version = table.manifest().version
    assert not table.upsert(many(spark, 20, "DELETE", 2), ("s", 0))
    assert table.manifest().version == version and len(held(table)) == 20
    assert table.upsert(many(spark, 5, "DELETE", 2), ("s", 1)) and len(held(table)) == 15
    assert table.upsert(many(spark, 1), ("another", 0))
    assert table.manifest().commits == {"s": 1, "another": 0}
    assert table.manifest().cursors == {"log": ["2024-01-01 00:00:00", 7]}


def test_a_crash_before_the_switch_changes_nothing(spark, table, monkeypatch):
    table.upsert(many(spark, 50))

    def crash(self, manifest):
        raise OSError("gone")

    with monkeypatch.context() as broken:
        broken.setattr(store.StoredTable, "_publish", crash)
        with pytest.raises(OSError):
            table.upsert(many(spark, 50, "DELETE", 2), ("s", 0))
    assert len(held(table)) == 50 and table.manifest().commits == {}
    orphans = len(os.listdir(f"{table.root}/data"))
    assert len(table.vacuum()) == 1 and len(os.listdir(f"{table.root}/data")) == orphans - 1
    assert table.upsert(many(spark, 50, "DELETE", 2), ("s", 0)) and held(table) == {}


def test_a_reader_keeps_what_it_began_with(spark, table):
    table.upsert(many(spark, 50))
    reading = table.read()
    table.upsert(many(spark, 50, "DELETE", 2))
    assert reading.count() == 50 and table.read().count() == 0
    assert len(held(table, version=1)) == 50


def test_the_slower_of_two_writers_fails(spark, table, monkeypatch):
    table.upsert(many(spark, 10))
    stale = table.manifest()
    table.upsert(changes(spark, (1, "first", "UPDATE", 5)))
    with monkeypatch.context() as late:
        late.setattr(store.StoredTable, "manifest", lambda self, version=None: stale)
        with pytest.raises(store.ConcurrentChange):
            table.upsert(changes(spark, (1, "second", "UPDATE", 6)))
    assert held(table)[1] == "first"


def test_only_touched_buckets_are_written_and_reads_do_not_grow(spark, table):
    table.upsert(many(spark, 400))
    before = table.manifest().folders
    for number in range(2, 12):
        table.upsert(changes(spark, (7, f"x{number}", "UPDATE", number)))
    after = table.manifest().folders
    assert set(after) == set(before) and sum(after[b] != before[b] for b in after) == 1
    files = table.read().inputFiles()
    assert len(files) == len(after) == 8
    assert held(table)[7] == "x11" and len(held(table)) == 400
    table.vacuum(keep=1)
    assert len(held(table)) == 400 and len(os.listdir(f"{table.root}/data")) == 2


def test_rebucket_keeps_rows_commits_and_tombstones(spark, table):
    table.upsert(many(spark, 100), ("s", 3))
    table.upsert(many(spark, 10, "DELETE", 2), ("s", 4))
    rows = held(table, "tombstone")
    table.rebucket(3)
    assert held(table, "tombstone") == rows and len(held(table)) == 90
    manifest = table.manifest()
    assert manifest.n_buckets == 3 and len(manifest.folders) <= 3 and manifest.commits == {"s": 4}
    table.upsert(many(spark, 10, "INSERT", 3))
    assert len(held(table)) == 100


def test_new_columns_and_patches(spark, table):
    table.upsert(many(spark, 40))
    table.upsert(changes(spark, (1, None, "UPDATE", 2)).withColumn("w", F.lit("w")), merge="patch")
    found = {r.k: (r.v, r.w) for r in table.read().collect()}
    assert found[1] == ("v1", "w") and found[2] == ("v2", None) and len(found) == 40


def test_empty_tables_and_changes(spark, table):
    assert table.read().count() == 0 and table.vacuum() == []
    assert table.upsert(changes(spark).limit(0)) and table.manifest().version == 0
    with pytest.raises(ValueError, match="keys"):
        table.upsert(many(spark, 1))
        store.StoredTable(spark, table.root, ["v"]).read()


# --- streams ---------------------------------------------------------------------


def users_log(spark, *rows):
    df = spark.createDataFrame(list(rows), "log_id bigint, user_id bigint, login string, status string")
    empty = [F.lit(None).cast("string").alias(c) for c in ("avatar_url", "url", "type")]
    return df.select(
        "log_id", "user_id", "login", *empty, F.lit(True).alias("site_admin"),
        F.lit(None).cast("timestamp").alias("created_at"), "status", F.timestamp_seconds(F.col("log_id")).alias("log_timestamp"),
    )


def publish(spark, root, *rows, at="now"):
    topics.publish_topic(seal_records(users_log(spark, *rows), USERS, at).coalesce(1), "t", "text", path=root)


def test_a_failing_switch_repeats_the_batch_once(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    publish(spark, root, (1, 1, "a", "INSERT"), (2, 2, "b", "INSERT"))
    sink = sync.table_store_sink(f"{root}/tables", {"users": USERS}, 4)

    def run():
        source = topics.stream_change_topic(spark, "text", max_per_trigger=1, path=f"{root}/t")
        sync.run_stream(source, sink, f"{root}/cp", {"users": USERS}).awaitTermination()

    taken = []
    real = store.StoredTable._publish

    def after_the_switch(self, manifest):
        real(self, manifest)
        taken.append(manifest.version)
        raise OSError("the driver is gone")

    with monkeypatch.context() as broken:
        broken.setattr(store.StoredTable, "_publish", after_the_switch)
        with pytest.raises(StreamingQueryException):
            run()
    users = sync.stored_table(spark, f"{root}/tables", USERS, 4)
    assert taken == [1] and users.read().count() == 2
    publish(spark, root, (3, 1, "a2", "UPDATE"), (4, 2, "b", "DELETE"))
    run()
    # the first batch was known by its number and stored nothing again
    assert users.manifest().version == 2
    assert [(r._id, r.login) for r in users.read().collect()] == [(1, "a2")]
    assert not os.path.exists(f"{root}/tables/{sync.DEAD_LETTERS}")


def test_a_damaged_copy_does_not_stand_for_its_message(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, root, (1, 1, "a", "INSERT"))
    good = spark.read.text(f"{root}/t").first()[0]
    broken = good.replace('"login":"a"', '"login":"x"')
    lines = [broken, broken, good, good, "{not json", "{not json", good]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{root}/again")
    source = topics.stream_change_topic(spark, "text", path=f"{root}/again")
    once = sync.once_per_message(source)
    writer = once.writeStream.format("parquet").option("checkpointLocation", f"{root}/cp")
    writer.trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    # texts without a time are not held in the state and pass
    assert sorted(r.value for r in spark.read.parquet(f"{root}/out").collect()) == sorted([broken, good, "{not json", "{not json"])


# --- capture ---------------------------------------------------------------------


def shuffled(df):
    """Bytes that the exchanges of an executed query took."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.finalPhysicalPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "ShuffleExchangeExec":
            total += node.metrics().apply("dataSize").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_few_changes_shuffle_few_bytes(spark):
    # long rows, of which one in a hundred changes
    before = spark.range(0, 20_000, 1, 4).select("id", *[F.sha2(F.concat("id", F.lit(i)).cast("string"), 512).alias(f"c{i}") for i in range(8)])
    after = before.withColumn("c0", F.when(F.col("id") % 100 == 0, "new").otherwise(F.col("c0")))
    whole, digests = capture.snapshot_diff(before, after, ["id"]), capture.snapshot_changes(before, after, ["id"])
    assert digests.count() == 200
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, digests.select(whole.columns).collect()))
    assert shuffled(digests) < shuffled(whole) / 10


def test_nulls_that_trade_places_are_a_change(spark):
    schema = "k bigint, a string, b string"
    before = spark.createDataFrame([(1, "x", None), (2, None, None), (None, "n", None)], schema)
    after = spark.createDataFrame([(1, None, "x"), (2, None, None), (None, "m", None)], schema)
    for diff in (capture.snapshot_diff, capture.snapshot_changes):
        assert sorted((r.k or 0, r.status, r.after.a, r.after.b) for r in diff(before, after, ["k"]).collect()) == [
            (0, "UPDATE", "m", None),
            (1, "UPDATE", None, "x"),
        ]


def test_keys_with_several_rows_are_told_apart(spark):
    schema = "k bigint, a string"
    before = spark.createDataFrame([(1, "a"), (1, "z"), (3, "c")], schema)
    after = spark.createDataFrame([(1, "z"), (2, "n"), (2, "m"), (3, "c")], schema)
    for diff in (capture.snapshot_diff, capture.snapshot_changes):
        changes = diff(before, after, ["k"])
        assert sorted(tuple(r) for r in changes.collect()) == [(1, "CONFLICT", None, None), (2, "CONFLICT", None, None)]
        with pytest.raises(PySparkException, match="several rows of one key"):
            capture.after_image_log(changes, F.lit(0).cast("timestamp"), F.lit(1)).collect()
    found = capture.snapshot_conflicts(before, after, ["k"]).collect()
    assert sorted(tuple(r) for r in found) == [(1, 2, 1), (2, 0, 2)]


def test_log_and_snapshots_of_the_shop_agree(spark):
    before, after = views.shop_snapshots(spark, SF_DIR, "customer")
    assert capture.snapshot_conflicts(before, after, ["c_custkey"]).count() == 0


# --- loads observed while they are written ------------------------------------------


def test_a_changed_target_is_found_by_its_digest(spark, tmp_path):
    from cdcflow.sources import sinks

    source = spark.range(500).selectExpr("id", "named_struct('a', IF(id % 2 = 0, NULL, id), 'b', IF(id % 2 = 0, id, NULL)) AS s")
    seen = {}
    sink = sinks.observing(sinks.table_sink(str(tmp_path)), seen)
    for name in ("same", "swapped", "short", "empty"):
        sink(name, source.limit(0) if name == "empty" else source)
    stored = {name: spark.read.schema(source.schema).parquet(f"{tmp_path}/{name}") for name in seen}
    stored["swapped"] = stored["swapped"].selectExpr("id", "IF(id = 3, named_struct('a', CAST(NULL AS BIGINT), 'b', 3L), s) AS s")
    stored["short"] = stored["short"].filter("id < 499")
    written = {name: (seen[name], source.limit(0) if name == "empty" else source, stored[name]) for name in seen}
    found = {r.table_name: tuple(r)[1:] for r in sinks.observed_report(written).collect()}
    assert found == {
        "same": (500, 500, 0, 0, 0, "equal"),
        "swapped": (500, 500, 0, 1, 1, "different"),
        "short": (500, 499, 1, 1, 0, "different"),
        "empty": (0, 0, 0, 0, 0, "equal"),
    }
