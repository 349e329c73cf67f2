"""A key that holds a third of all rows is split between tasks, not cut."""

import pytest
from cdcflow.checks.views import raw_events
from cdcflow.operators import documents, integrity
from pyspark.sql import functions as F

# Thresholds low enough for test data to count as skewed.
TIGHT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
}


@pytest.fixture
def tight(spark):
    before = {k: spark.conf.get(k, None) for k in TIGHT}
    for key, value in TIGHT.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def children(spark):
    return spark.range(0, 300000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000).alias("fk"), "id"
    )


def parents(spark):
    return spark.range(0, 100000, 1, 16).select((F.col("id") % 500).alias("k"))


def split(df):
    rows = df.agg(F.count("*").alias("n"), F.count("fk").alias("filled")).collect()[0]
    df.collect()  # the adapted plan is that of the frame itself
    return rows, "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_set_null_splits_a_hot_parent(tight):
    df = integrity.cascade_set_null(children(tight), "fk", parents(tight))
    rows, was_split = split(df)
    assert rows.n == 300000 and rows.filled == 100000
    assert was_split


@pytest.mark.parametrize("distinct", [False, True])
def test_delete_splits_a_hot_parent(tight, distinct):
    keys = parents(tight).distinct() if distinct else parents(tight)
    rows, was_split = split(integrity.cascade_delete(children(tight), "fk", keys))
    assert rows.n == 100000 and was_split


def test_orphans_split_a_hot_parent(tight):
    df = integrity.orphans(children(tight), "fk", parents(tight).distinct(), "k")
    rows, was_split = split(df)
    assert rows.n == 100000 and was_split


def test_documents_split_a_hot_fork_target(tight):
    raw = raw_events(tight, "/root/testdata/sf0.01").filter("payload.forkee.id IS NOT NULL")
    copies = F.explode(F.sequence(F.lit(1), F.lit(20)))
    # a hot partition is split between the map tasks that wrote it
    many = raw.withColumn("copy", copies).drop("copy").repartition(16)
    hot = F.when(F.col("id").cast("bigint") % 3 == 0, 1).otherwise(F.col("payload.forkee.id"))
    forkee = F.col("payload.forkee").withField("id", hot)
    many = many.withColumn("payload", F.col("payload").withField("forkee", forkee))
    docs = documents.repo_docs(many)
    assert docs.filter("_id = 1").count() > many.count() // 4
    docs.collect()
    assert "skew=true" in docs._jdf.queryExecution().executedPlan().toString()
