"""Tables that an operator writes to shared storage to cut lineage, and joins whose
small side is measured before it is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.session import new_dir

#: Rows of a table of a few numbers per row that may go to every executor.
BROADCAST_ROWS = 1_000_000


def land(df: DataFrame, label: str) -> DataFrame:
    """Write the rows below the session's shared folder and read them again.

    The written table outlives lost executors and is the new start of the lineage.
    """
    spark = df.sparkSession
    path = new_dir(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._landed = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete landed tables that nothing needs any more."""
    for table in tables:
        spark, path = table.sparkSession, getattr(table, "_landed", None)
        if path:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    target.getFileSystem(conf).delete(target, True)


def small_if(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a table of narrow rows for broadcast if it has at most ``limit`` rows.

    The rows are counted first; beyond the limit Spark shuffles both sides of the join
    and splits hot keys, with the same result.
    """
    return F.broadcast(df) if df.count() <= limit else df
