"""Relational tables over JDBC. The driver jar and credentials are the caller's."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcPartition:
    """Numeric, date or timestamp column to split a table read on."""

    column: str
    lower: object
    upper: object
    count: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.count),
        }


def jdbc_options(
    url: str,
    table: str,
    props: dict[str, str] | None = None,
    partition: JdbcPartition | None = None,
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, **(props or {})}
    if partition is not None:
        options |= partition.options()
    return options


def jdbc_scan(
    spark: SparkSession,
    url: str,
    table: str,
    props: dict[str, str] | None = None,
    partition: JdbcPartition | None = None,
) -> DataFrame:
    """Whole table; without ``partition`` one task reads it all."""
    options = jdbc_options(url, table, props, partition)
    return spark.read.format("jdbc").options(**options).load()
