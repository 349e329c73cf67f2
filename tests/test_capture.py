from cdcflow.operators import capture
from cdcflow.operators.apply import apply_changes
from pyspark.sql import functions as F

SCHEMA = "k bigint, a string, b int"


def diff(spark, before, after, keys=("k",)):
    changes = capture.snapshot_diff(
        spark.createDataFrame(before, SCHEMA), spark.createDataFrame(after, SCHEMA), list(keys)
    )
    return {r.k: r for r in changes.collect()}, changes


BEFORE = [(1, "x", 1), (2, "x", None), (3, "x", 3), (4, None, 4), (5, "same", None)]
AFTER = [(2, "x", 2), (3, "x", None), (4, None, 4), (5, "same", None), (6, "new", 6)]


def test_statuses_and_images(spark):
    rows, _ = diff(spark, BEFORE, AFTER)
    assert {k: r.status for k, r in rows.items()} == {
        1: "DELETE", 2: "UPDATE", 3: "UPDATE", 6: "INSERT",
    }
    assert rows[1].after is None and rows[1].before.a == "x"
    assert (rows[2].before.b, rows[2].after.b) == (None, 2)
    assert (rows[3].before.b, rows[3].after.b) == (3, None)
    assert rows[6].before is None


def test_column_order_and_types_are_aligned(spark):
    before = spark.createDataFrame([(1, "x", 1)], SCHEMA)
    after = spark.createDataFrame([(1, "x", 1)], "b bigint, a string, k int")
    assert capture.snapshot_diff(before, after, ["k"]).count() == 0


def test_logs_hold_the_image_of_their_side(spark):
    _, changes = diff(spark, BEFORE, AFTER)
    at = F.lit("2024-01-01").cast("timestamp")

    def images(log):
        return {r.k: (r.status, r.b) for r in log.collect()}

    after = images(capture.after_image_log(changes, at, F.col("k")))
    before = images(capture.before_image_log(changes, at, F.col("k")))
    assert after == {1: ("DELETE", 1), 2: ("UPDATE", 2), 3: ("UPDATE", None), 6: ("INSERT", 6)}
    assert before == {1: ("DELETE", 1), 2: ("UPDATE", None), 3: ("UPDATE", 3), 6: ("INSERT", 6)}


def test_a_repeated_key_costs_no_pairs(spark):
    before = spark.range(30000).select(
        F.lit(1).cast("bigint").alias("k"), F.col("id").cast("string").alias("a"),
        F.lit(0).alias("b"),
    )
    after = before.withColumn("a", F.concat("a", F.lit("!")))
    changes = capture.snapshot_diff(before, after, ["k"])
    assert changes.count() == 1
    assert "Join" not in changes._jdf.queryExecution().executedPlan().toString()


def test_applying_a_diff_gives_the_later_snapshot(spark):
    _, changes = diff(spark, BEFORE, AFTER)
    at = F.lit("2024-01-01").cast("timestamp")
    log = capture.after_image_log(changes, at, F.col("k"))
    target = spark.createDataFrame(BEFORE, SCHEMA)
    synced = apply_changes(target, log, keys=["k"], deletes="remove").select("k", "a", "b")
    assert sorted(map(tuple, synced.collect())) == sorted(AFTER)
