"""Session settings and the shared folder intermediate tables are written to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times carry a literal ``Z``: they only parse right in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or where that is
    unset a folder below the session's warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        configured = f"{warehouse}/_intermediate"
    return configured.rstrip("/")


def new_dir(spark: SparkSession, label: str) -> str:
    """Unused path below the shared folder."""
    return f"{shared_dir(spark)}/cdcflow/{label}-{uuid.uuid4().hex}"
