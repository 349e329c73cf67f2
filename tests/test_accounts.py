"""Every message of a batch is in exactly one output, whatever is wrong with it."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from cdcflow.operators.apply import apply_changes, keyless
from cdcflow.operators.envelope import verify_records
from cdcflow.operators.integrity import constraint_violations, length_violations
from cdcflow.sources import sinks
from cdcflow.sources.logs import incremental_log_read, untimed
from cdcflow.specs import FEED_TABLES
from cdcflow.streaming import sync


def sealed(record, **other):
    text = json.dumps(record, sort_keys=True, separators=(",", ":"))
    digest = hashlib.sha256(text.encode()).hexdigest()
    return text[:-1] + f',"hash":"{digest}"}}'


def record(**fields):
    base = {"table_name": "users", "message_id": "m", "status": "INSERT",
            "log_timestamp": "2024-01-01 00:00:00.000000", "user_id": 1, "login": "a"}
    return base | fields


GOOD = sealed(record())
ESCAPED = "{},\"record\":" + GOOD
DOUBLED = '{"a":1,"a":2,' + GOOD[1:]
WRONG_ORDER_TEXT = '{"table_name":"users","message_id":"m"}'
UNSORTED = WRONG_ORDER_TEXT[:-1] + f',"hash":"{hashlib.sha256(WRONG_ORDER_TEXT.encode()).hexdigest()}"}}'


@pytest.mark.parametrize(
    "text, reason",
    [
        (GOOD, None),
        (ESCAPED, "Malformed JSON"),
        ('{"a":1},"end":0}', "Malformed JSON"),
        (GOOD + GOOD, "Malformed JSON"),
        ("[1]", "Malformed JSON"),
        ("null", "Malformed JSON"),
        (DOUBLED, "Hash mismatch"),
        (UNSORTED, "Hash mismatch"),
    ],
)
def test_what_is_no_single_record_is_refused(spark, text, reason):
    row = verify_records(spark.createDataFrame([(text,)], "value string")).first()
    assert row.is_valid == (reason is None)
    assert (row.error_reason or "").startswith(reason or "")


def test_input_is_tables_unrouted_excluded_and_dead(spark):
    texts = [
        GOOD, ESCAPED, DOUBLED, UNSORTED, "junk", "",
        sealed(record(user_id="abc")), sealed(record(user_id=None)),
        sealed(record(log_timestamp=None)), sealed(record(table_name="elsewhere")),
        sealed(record(table_name="repo_ownership", repo_id=4)),
    ]
    outputs = sync.batch_outputs(spark.createDataFrame([(t,) for t in texts], "value string"))
    counts = {name: df.count() for name, df in outputs.items()}
    excluded = 1
    assert sum(counts.values()) + excluded == len(texts)
    assert counts["users"] == 1 and counts[sync.UNROUTED] == 1
    reasons = [r.error_reason for r in outputs[sync.DEAD_LETTERS].collect()]
    assert reasons.count(sync.UNREADABLE) == 3


def test_a_row_without_a_table_name_is_unrouted(spark):
    from cdcflow.operators.routing import unrouted

    rows = spark.createDataFrame([(None,), ("users",), ("x",)], "table_name string")
    assert [r[0] for r in unrouted(rows, ["users"], unnamed=True).collect()] == [None, "x"]


def test_streams_of_one_root_keep_their_batches(spark, tmp_path):
    root = str(tmp_path)
    for number in (1, 2):
        source = f"{root}/in{number}"
        spark.createDataFrame([(sealed(record(user_id=number)),)], "value string").write.text(source)
        stream = spark.readStream.format("text").load(source)
        sync.run_stream(stream, sync.file_sink(f"{root}/docs"), f"{root}/check{number}").awaitTermination()
    found = sinks.read_documents(spark, f"{root}/docs", "users")
    assert sorted(r["_id"] for r in found.collect()) == [1, 2]


CHANGES = "_id long, status string, v string, log_timestamp int, log_id long"


def test_plans_of_repeated_folds_grow_by_one_scan(spark, tmp_path):
    paths = []
    for n in range(4):
        paths.append(f"{tmp_path}/{n}")
        spark.createDataFrame([(k, "UPDATE", f"{n}", n, n) for k in range(n, n + 3)], CHANGES).write.parquet(paths[-1])
    target = None
    for n, path in enumerate(paths):
        target = apply_changes(target, spark.read.parquet(path), derived=True)
        assert target._jdf.queryExecution().executedPlan().toString().count("FileScan") == n + 1
    assert {r["_id"]: r["v"] for r in target.collect()} == {0: "0", 1: "1", 2: "2", 3: "3", 4: "3", 5: "3"}
    late = apply_changes(target, spark.read.parquet(paths[0]), derived=True)
    assert sorted(map(str, late.collect())) == sorted(map(str, target.select(late.columns).collect()))


@pytest.mark.parametrize("derived", [True, False])
def test_changes_without_a_key_are_left_out_and_listed(spark, derived):
    rows = spark.createDataFrame([(None, "INSERT", "a", 1, 1), (1, "INSERT", "b", 1, 2)], CHANGES)
    once = apply_changes(None, rows)
    twice = apply_changes(once, rows, derived=derived)
    assert [r["_id"] for r in once.collect()] == [r["_id"] for r in twice.collect()] == [1]
    assert [r["v"] for r in keyless(rows).collect()] == ["a"]


def test_log_rows_without_a_time(spark):
    log = spark.createDataFrame([(None, 1), ("2024-01-01 00:00:00", None), ("2024-01-02 00:00:00", 3)], "t string, log_id long")
    log = log.select(F.to_timestamp("t").alias("log_timestamp"), "log_id")
    assert incremental_log_read(log)[0].count() == 3
    cursors = spark.createDataFrame([("x", "2024-01-01 12:00:00", 9)], "table_name string, t string, cursor_id long")
    cursors = cursors.select("table_name", F.to_timestamp("t").alias("cursor_ts"), "cursor_id")
    assert incremental_log_read(log, cursors, "other")[0].count() == 3
    assert incremental_log_read(log, cursors, "x")[0].count() == 1
    assert untimed(log).count() == 1


@pytest.mark.parametrize("name", FEED_TABLES)
def test_constraints_of_every_feed_table(spark, name):
    spec = FEED_TABLES[name]
    rows = spark.createDataFrame([tuple(None for _ in spec.columns)] * 2, spec.struct)
    assert length_violations(rows, spec).count() == 0
    found = constraint_violations(rows, spec).collect()
    assert len(found) == 2 * sum(c.required for c in spec.columns)
