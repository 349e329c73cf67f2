import random
from datetime import datetime, timedelta

import pytest
from cdcflow.operators.apply import apply_changes, live_documents

CHANGES = "_id bigint, status string, a string, b int, log_timestamp timestamp, log_id bigint"
TARGET = "_id bigint, a string, b int"


def at(second):
    return datetime(2024, 1, 1) + timedelta(seconds=second)


def change(key, status, a, b, second, number):
    return (key, status, a, b, at(second), number)


def frame(spark, rows):
    return spark.createDataFrame(rows, CHANGES)


def state(df):
    return {r["_id"]: (r.status, r.a, r.b) for r in df.collect()}


def fold(spark, target, *batches, **options):
    for batch in batches:
        target = apply_changes(target, frame(spark, batch), **options)
    return target


FIRST = [
    change(1, "UPDATE", "late", 2, 5, 2),
    change(1, "UPDATE", "early", 1, 1, 1),
    change(2, "DELETE", "x", 1, 9, 9),
]
SECOND = [
    change(1, "UPDATE", "middle", 3, 3, 3),
    change(2, "UPDATE", "resurrected?", 1, 8, 8),
    change(3, "INSERT", "new", 1, 1, 1),
]
EXPECTED = {1: ("UPDATE", "late", 2), 2: ("DELETE", "x", 1), 3: ("INSERT", "new", 1)}


def test_latest_change_wins_across_batches(spark):
    assert state(fold(spark, None, FIRST, SECOND)) == EXPECTED
    assert state(fold(spark, None, SECOND, FIRST)) == EXPECTED
    assert state(fold(spark, None, FIRST, SECOND, FIRST, SECOND)) == EXPECTED


def test_number_breaks_ties_of_time(spark):
    rows = [change(1, "UPDATE", "b", 1, 1, 11), change(1, "UPDATE", "a", 1, 1, 9)]
    assert state(fold(spark, None, rows))[1] == ("UPDATE", "b", 1)


def test_replaces_the_whole_document_and_keeps_other_keys(spark):
    target = spark.createDataFrame([(1, "old", 1), (7, "kept", 7)], TARGET)
    result = fold(spark, target, [change(1, "UPDATE", None, 5, 1, 1)])
    assert state(result) == {1: ("UPDATE", None, 5), 7: (None, "kept", 7)}


def test_removed_view_hides_deletes_only(spark):
    target = spark.createDataFrame([(2, "old", 1), (7, "kept", 7)], TARGET)
    stored = fold(spark, target, FIRST)
    assert set(state(live_documents(stored))) == {1, 7}
    removed = apply_changes(target, frame(spark, FIRST), deletes="remove")
    assert state(removed) == state(live_documents(stored))


def test_patch_keeps_what_changes_leave_out(spark):
    target = spark.createDataFrame([(1, "old", 1), (7, "kept", 7)], TARGET)
    result = fold(spark, target, [
        change(1, "UPDATE", None, 5, 1, 1),
        change(8, "INSERT", "n", None, 1, 2),
        change(8, "UPDATE", None, 4, 2, 3),
    ], merge="patch")
    assert state(result) == {
        1: ("UPDATE", "old", 5), 7: (None, "kept", 7), 8: ("UPDATE", "n", 4),
    }


def test_patch_does_not_inherit_across_a_delete(spark):
    target = spark.createDataFrame([(1, "old", 1)], TARGET)
    gone = [change(1, "DELETE", "old", 1, 1, 1)]
    back = [change(1, "INSERT", None, 9, 2, 2)]
    expected = {1: ("INSERT", None, 9)}
    assert state(fold(spark, target, gone + back, merge="patch")) == expected
    assert state(fold(spark, target, gone, back, merge="patch")) == expected


@pytest.mark.parametrize("merge", ["replace", "patch"])
def test_any_split_into_batches_gives_the_same(spark, merge):
    dice = random.Random(7)
    rows = [
        change(dice.randrange(6), dice.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"]),
               dice.choice([None, "a", "b"]), dice.choice([None, 1, 2]), n // 3, n)
        for n in range(60)
    ]
    target = spark.createDataFrame([(0, "t", 0), (99, "t", 9)], TARGET)
    whole = state(fold(spark, target, rows, merge=merge))
    assert state(fold(spark, target, rows[:17], rows[17:40], rows[40:], merge=merge)) == whole
    if merge == "replace":
        dice.shuffle(rows)
        assert state(fold(spark, target, rows[:31], rows[31:], merge=merge)) == whole


def test_the_target_meets_only_the_changed_keys(spark, tmp_path):
    target, changes = str(tmp_path / "target"), str(tmp_path / "changes")
    apply_changes(None, frame(spark, SECOND)).write.parquet(target)
    frame(spark, FIRST).write.parquet(changes)
    result = apply_changes(spark.read.parquet(target), spark.read.parquet(changes))
    assert state(result) == EXPECTED
    plan = result._jdf.queryExecution().executedPlan().toString()
    kept = plan[: plan.index("FileScan")]  # the join the old target goes through
    assert "BroadcastHashJoin [_id" in kept and "Exchange hashpartitioning" not in kept


def test_unknown_modes_are_refused(spark):
    for options in ({"deletes": "x"}, {"merge": "x"}):
        with pytest.raises(ValueError):
            fold(spark, None, FIRST, **options)
