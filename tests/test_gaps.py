"""Log reading that waits for numbers committed late."""

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from cdcflow.sources import gaps

T = "2024-01-01 00:00:00.{:03d}"


def log(spark, numbers, at=0):
    rows = [(n, f"v{n}", T.format(at)) for n in numbers]
    df = spark.createDataFrame(rows, "log_id bigint, v string, t string")
    return df.select("log_id", "v", F.col("t").cast("timestamp").alias("log_timestamp"))


def ranges(state):
    return sorted((r.gap_from, r.gap_to) for r in state.collect())


def expected(seen, first=1):
    """Ranges of unread numbers, by looking at every number."""
    end = max([first - 1, *seen])
    out, start = [], None
    for n in range(first, end + 2):
        if n in seen or n > end:
            if start is not None:
                out.append((start, n - 1))
            start = None
        elif start is None:
            start = n
    return sorted([*out, (end + 1, None)])


def test_every_row_is_read_once_in_any_order_of_commits(spark):
    rng = random.Random(4)
    numbers = rng.sample(range(1, 400), 150)
    state, seen, got = gaps.unread_from(spark, ["t", "other"]), [], []
    for part in (numbers[:60], numbers[60:61], [], numbers[61:]):
        seen += part
        rows, mine = gaps.read_unread(log(spark, seen), state, "t")
        read = [r.log_id for r in rows.collect()]
        assert sorted(read) == sorted(part)
        got += read
        assert ranges(mine) == expected(set(seen))
        state = mine
    assert sorted(got) == sorted(numbers)


def test_ranges_across_cells_and_far_numbers(spark):
    far = [1, 65_535, 65_536, 131_073, 1 << 33, (1 << 33) + 2, 1 << 50, (1 << 62) + 5]
    _, state = gaps.read_unread(log(spark, far), gaps.unread_from(spark, ["t"]), "t")
    want = [(a + 1, b - 1) for a, b in zip(far, far[1:], strict=False) if b > a + 1]
    assert ranges(state) == sorted([*want, (far[-1] + 1, None)])
    # so much is missing that cells are wide; late rows are still found, once
    late = [*far, 7, 70_000, 1 << 40, (1 << 62) + 4, (1 << 62) + 6]
    rows, after = gaps.read_unread(log(spark, late), state, "t")
    assert sorted(r.log_id for r in rows.collect()) == sorted(set(late) - set(far))
    assert (65_537, 69_999) in ranges(after) and (70_001, 131_072) in ranges(after)


def test_numbers_below_zero(spark):
    state = gaps.unread_from(spark, ["t"], first=-10)
    _, state = gaps.read_unread(log(spark, [-7, 3]), state, "t")
    assert ranges(state) == expected({-7, 3}, -10)
    rows, state = gaps.read_unread(log(spark, [-7, 3, -8, 0, 4]), state, "t")
    assert sorted(r.log_id for r in rows.collect()) == [-8, 0, 4]
    assert ranges(state) == expected({-7, 3, -8, 0, 4}, -10)


def test_repeated_numbers_nothing_new_and_an_empty_log(spark):
    start = gaps.unread_from(spark, ["t"])
    rows, state = gaps.read_unread(log(spark, [2, 2, 4]), start, "t")
    assert rows.count() == 3 and ranges(state) == [(1, 1), (3, 3), (5, None)]
    rows, after = gaps.read_unread(log(spark, [2, 2, 4]), state, "t")
    assert rows.count() == 0 and ranges(after) == ranges(state)
    rows, after = gaps.read_unread(log(spark, []), start, "t")
    assert rows.count() == 0 and ranges(after) == [(1, None)]


def test_rows_no_pass_returns_are_listed(spark):
    df = log(spark, [None, 0, 1])
    rows, state = gaps.read_unread(df, gaps.unread_from(spark, ["t"]), "t")
    left = [r.log_id for r in gaps.unnumbered(df).collect()]
    assert [r.log_id for r in rows.collect()] == [1] and sorted(left, key=str) == [0, None]
    with pytest.raises(ValueError, match="no state"):
        gaps.read_unread(df, state, "u")


def test_a_range_keeps_the_time_it_was_found_until_it_is_forgotten(spark):
    start = gaps.unread_from(spark, ["t"])
    _, state = gaps.read_unread(log(spark, [5], at=1), start, "t")
    rows = log(spark, [5], at=1).unionByName(log(spark, [3, 8], at=9))
    _, state = gaps.read_unread(rows, state, "t")
    seen = {(r.gap_from, r.gap_to): r.seen_at and r.seen_at.microsecond for r in state.collect()}
    assert seen == {(1, 2): 1000, (4, 4): 1000, (6, 7): 9000, (9, None): None}
    kept = gaps.forget_gaps(state, F.lit(T.format(5)).cast("timestamp"))
    assert ranges(kept) == [(6, 7), (9, None)]
    more, after = gaps.read_unread(log(spark, [1, 6, 9]), kept, "t")
    assert sorted(r.log_id for r in more.collect()) == [6, 9]
    assert ranges(after) == [(7, 7), (10, None)]


def test_the_missing_numbers_bounds_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "log")
    log(spark, range(1, 50)).write.parquet(path)
    df = spark.read.parquet(path)
    state = spark.createDataFrame([("t", 40, 42, None)], gaps.GAP_SCHEMA)
    known = Row(ahead=50, lowest=40, highest=42, missing=3)
    late = gaps._late(df, state, F.col("log_id"), known)
    assert sorted(r.log_id for r in late.collect()) == [40, 41, 42]
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(log_id,40)" in plan and "NestedLoop" not in plan
