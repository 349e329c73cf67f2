from cdcflow.sources import logs
from pyspark.sql import functions as F

def log(spark, *rows):
    df = spark.createDataFrame(
        [(i, v, t) for i, v, t in rows], "log_id bigint, v string, t string"
    )
    return df.select("log_id", "v", F.col("t").cast("timestamp").alias("log_timestamp"))


# three neighbouring milliseconds
T0, T1, T2 = "2024-01-01 00:00:00.000", "2024-01-01 00:00:00.001", "2024-01-01 00:00:00.002"


def read(df, cursors=None, **options):
    rows, after = logs.incremental_log_read(df, cursors, "t", **options)
    return [r.v for r in rows.collect()], after


def position(cursors):
    return [(r.table_name, str(r.cursor_ts), r.cursor_id) for r in cursors.collect()]


def test_reads_all_oldest_first_without_a_cursor(spark):
    values, after = read(log(spark, (3, "c", T1), (2, "b", T0), (1, "a", T1)))
    assert values == ["b", "a", "c"]
    assert position(after) == [("t", "2024-01-01 00:00:00.001000", 3)]


def test_rows_that_share_the_cursors_time_are_not_lost(spark):
    _, cursors = read(log(spark, (1, "a", T0), (2, "b", T1)))
    later = log(spark, (1, "a", T0), (2, "b", T1), (3, "c", T1), (4, "d", T2))
    assert read(later, cursors)[0] == ["c", "d"]
    assert read(later, cursors, tie=None)[0] == ["d"]


def test_no_news_keep_the_cursor(spark):
    df = log(spark, (1, "a", T0))
    _, cursors = read(df)
    values, after = read(df, cursors)
    assert values == [] and position(after) == position(cursors)
    empty = df.limit(0)
    assert position(read(empty, cursors)[1]) == position(cursors)
    assert position(read(empty)[1]) == []


def test_cursors_of_other_tables_do_not_matter(spark):
    _, cursors = read(log(spark, (9, "z", T2)))
    rows, _ = logs.incremental_log_read(log(spark, (1, "a", T0)), cursors, "u")
    assert rows.count() == 1


def test_logs_are_collected_into_one_wide_set(spark):
    other = log(spark, (5, "x", T2)).withColumnRenamed("v", "w")
    rows, after = logs.collect_change_logs({"a": log(spark, (1, "v", T0)), "b": other})
    assert {(r.table_name, r.v, r.w) for r in rows.collect()} == {("a", "v", None), ("b", None, "x")}
    assert sorted(position(after))[1][2] == 5
    assert "Sort " not in rows._jdf.queryExecution().executedPlan().toString()


def test_cut_over_leaves_nothing_to_replay(spark, tmp_path):
    tables = {"a": log(spark, (1, "x", T0), (2, "y", T1)), "b": log(spark, (1, "x", T0)).limit(0)}
    cursors = logs.bootstrap_cutover(tables)
    logs.save_cursors(cursors, str(tmp_path), 1)
    logs.save_cursors(cursors, str(tmp_path), 1)
    kept = logs.load_cursors(spark, str(tmp_path), 1)
    assert position(kept) == [("a", "2024-01-01 00:00:00.001000", 2)]
    rows, _ = logs.collect_change_logs(tables, kept)
    assert rows.count() == 0


def test_the_time_bound_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "log")
    log(spark, (1, "a", T0), (2, "b", T1)).write.parquet(path)
    _, cursors = read(log(spark, (1, "a", T0)))
    rows, _ = logs.incremental_log_read(spark.read.parquet(path), cursors, "t")
    assert [r.v for r in rows.collect()] == ["b"]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan") :]
    assert "DataFilters: [isnotnull(log_timestamp" in scan and "Subquery" in scan
