"""File scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cdcflow.specs import RAW_EVENT_SCHEMA


def scan_nested_json(
    spark: SparkSession, path: str, schema=RAW_EVENT_SCHEMA
) -> DataFrame:
    """Line-delimited JSON under a fixed schema; a malformed line is all NULL."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def land_parquet(df: DataFrame, path: str) -> DataFrame:
    """Write once as Parquet and read back.

    JSON scans parse whole objects for every output table; the landed copy is
    read with nested column pruning and pushed-down filters, and survives the
    loss of executors.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
