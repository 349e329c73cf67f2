"""Parse verified messages, route them by table, shape stream documents."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.specs import EXCLUDED_FROM_DOCUMENTS, FEED_TABLES, TableSpec, wide_schema

_DROPPED_BY_FALLBACK = ("table_name", "hash", "message_id")


def parse_envelopes(
    messages: DataFrame, schema: T.StructType | None = None
) -> DataFrame:
    """Message bytes to the wide row; malformed text is all NULL."""
    schema = schema or wide_schema(FEED_TABLES.values())
    record = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(record.alias("record")).select("record.*")


def route_by_table(
    parsed: DataFrame,
    tables: Iterable[str],
    exclude: Sequence[str] = EXCLUDED_FROM_DOCUMENTS,
) -> dict[str, DataFrame]:
    """Rows per declared table, names compared without case.

    The tables are declared, so routing is a filter each and asks the data
    nothing. Rows without a table name are ``unrouted`` if that is asked for them.
    """
    excluded = {name.lower() for name in exclude}
    name = F.lower("table_name")
    return {
        table: parsed.filter(name == table)
        for table in dict.fromkeys(t.lower() for t in tables)
        if table not in excluded
    }


def unrouted(
    parsed: DataFrame,
    tables: Iterable[str],
    exclude: Sequence[str] = EXCLUDED_FROM_DOCUMENTS,
    unnamed: bool = False,
) -> DataFrame:
    """Rows of tables neither declared nor excluded; with ``unnamed`` also those
    without a table name."""
    known = {t.lower() for t in tables} | {t.lower() for t in exclude}
    name = F.lower("table_name")
    return parsed.filter(F.coalesce(~name.isin(*sorted(known)), F.lit(unnamed)))


def cdc_docs(
    table: str,
    routed: DataFrame,
    keep: Sequence[str] = (),
    specs: dict[str, TableSpec] = FEED_TABLES,
) -> DataFrame:
    """Flat stream documents of one table.

    ``keep`` carries columns the document does not hold, such as the log position
    an ordered fold needs. A table without declared document keeps its wide row.
    """
    spec = specs.get(table)
    if spec is None or spec.stream_document is None:
        dropped = [
            c for c in (*_DROPPED_BY_FALLBACK, "log_timestamp") if c not in keep
        ]
        return routed.drop(*dropped)
    fields = [
        _document_field(spec, source).alias(name)
        for source, name in spec.stream_document
    ]
    return routed.select(F.col(spec.key).alias("_id"), "status", *fields, *keep)


def _document_field(spec: TableSpec, source: str):
    if isinstance(spec.type_of(source), T.BooleanType):
        return F.col(source).cast("boolean")
    return F.col(source)


def non_null_columns(df: DataFrame) -> DataFrame:
    """Columns that hold a value, with how many; one aggregate over the data."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    listed = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("non_nulls"))
            for c in df.columns
        ]
    )
    return counts.select(F.inline(listed)).filter(F.col("non_nulls") > 0)


def prune_null_columns(df: DataFrame) -> DataFrame:
    """Projection to the columns that hold a value (reads column names only)."""
    filled = {r["column_name"] for r in non_null_columns(df).collect()}
    return df.select(*[c for c in df.columns if c in filled])
