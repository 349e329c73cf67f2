"""Seal changes with a hash, verify received ones, divert the bad ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.functions.canonical import (
    HASH,
    canonical_json,
    computed_once,
    covered_sha256,
    field_json,
    field_text,
    in_canonical_order,
    is_sealed_by,
    rewritten_sha256,
    seal_text,
    sha256,
    spaced_json_sha256,
    with_fields,
)
from cdcflow.functions.times import time_text
from cdcflow.specs import TableSpec, wire_type

CANONICAL, SPACED = "canonical", "spaced"

# Reasons of rejected messages and the id of unidentified ones.
MALFORMED = "Malformed JSON"
NO_HASH = "No hash found"
NO_TABLE = "Missing table_name (Routing Label)"
NO_ID = "No message_id found"
UNKNOWN = "unknown"
# id columns in the order older producers look for a non-empty one
LEGACY_IDS = ("user_id", "repo_id", "org_id", "event_id")
# JSON texts of values that count as absent
_EMPTY = ("null", '""', "0", "false", "[]", "{}")


def wire_columns(spec: TableSpec) -> dict[str, Column]:
    """A table's columns in the types they are published with."""
    return {c.name: _wire_value(c.name, c.type, c.digits) for c in spec.columns}


def _wire_value(name: str, declared: T.DataType, digits: int) -> Column:
    if isinstance(declared, (T.TimestampType, T.TimestampNTZType)):
        return time_text(name, digits)
    if isinstance(declared, T.DateType):
        return time_text(name, 0)
    return F.col(name).cast(declared).cast(wire_type(declared))


def message_id(spec: TableSpec, legacy_id: bool = False) -> Column:
    """``<table>_<key>_<log time>``; a NULL key reads ``unknown``.

    ``legacy_id`` takes the first non-empty of the well-known id columns instead
    of the table's own key, as older producers do.
    """
    if legacy_id:
        present = [c for c in LEGACY_IDS if c in spec.column_names]
        keys = [
            F.when(~F.col(c).cast("string").isin("", "0"), F.col(c).cast("string"))
            for c in present
        ]
    else:
        keys = [F.col(spec.key).cast("string")]
    return F.concat_ws(
        "_",
        F.lit(spec.name),
        F.coalesce(*keys, F.lit(UNKNOWN)),
        time_text("log_timestamp"),
    )


def seal_records(
    changes: DataFrame,
    spec: TableSpec,
    produced_at: Column | str | None = None,
    message: Column | None = None,
    legacy_id: bool = False,
    style: str = CANONICAL,
) -> DataFrame:
    """Changes of one table as published records, with ``hash`` and ``value``.

    ``value`` is the JSON message. The hash covers every other field. Give
    ``produced_at`` to make reruns seal alike; it defaults to the current time.
    """
    if produced_at is None:
        produced_at = F.date_format(
            F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
        )
    elif isinstance(produced_at, str):
        produced_at = F.lit(produced_at)
    fields = wire_columns(spec)
    fields["status"] = F.col("status")
    fields["log_timestamp"] = time_text("log_timestamp")
    if "log_id" in changes.columns:
        fields["log_id"] = F.col("log_id").cast("bigint")
    fields["table_name"] = F.lit(spec.name)
    fields["message_id"] = message_id(spec, legacy_id) if message is None else message
    fields["producer_timestamp"] = produced_at

    record = changes.select(*[value.alias(name) for name, value in fields.items()])
    named = {name: F.col(name) for name in fields}
    record = record.withColumn("_text", canonical_json(named))
    text = F.col("_text")
    digest = sha256(text) if style == CANONICAL else spaced_json_sha256(text)
    record = record.withColumn(HASH, digest)
    # the hash joins the text it was taken from; nothing is encoded twice
    opened = text.substr(F.lit(1), F.char_length(text) - 1)
    value = F.concat(opened, seal_text(F.col(HASH)))
    return record.select(*fields, HASH, value.alias("value"))


def verify_records(messages: DataFrame, style: str = CANONICAL) -> DataFrame:
    """Adds ``is_valid``, ``message_id`` and ``error_reason`` to messages.

    The whole text is verified, fields no table knows included, so this goes
    before any projection to a schema.
    """
    text = F.col("value").cast("string")
    parsed = with_fields(messages, text, (HASH, "table_name", "message_id"), "_fields")
    fields = F.col("_fields")
    received, table, identity = fields[HASH], fields["table_name"], fields["message_id"]
    identity = F.coalesce(field_text(identity), F.lit(UNKNOWN))
    early = (
        F.when(fields.isNull(), MALFORMED)
        .when(field_json(received).isin(*_EMPTY), NO_HASH)
        .when(field_json(table).isin(*_EMPTY), NO_TABLE)
        .when(identity == UNKNOWN, NO_ID)
    )
    parsed = parsed.select(
        *messages.columns,
        identity.alias("_identity"),
        early.alias("_early"),
        F.coalesce(field_text(received), field_json(received)).alias("_received"),
        F.when(in_canonical_order(fields["_keys"]), covered_sha256(text)).alias("_covered"),
    )
    # A message as sealed here has its members in order and the hash as the last:
    # hashing its bytes is enough. Any other text, say with members reordered on
    # the way, is brought to canonical form first.
    if style == CANONICAL:
        covered = F.col("_covered")
        digest = (
            F.when(F.col("_early").isNotNull(), F.lit(None))
            .when(is_sealed_by(text, covered), covered)
            .otherwise(rewritten_sha256(text))
        )
    else:
        digest = spaced_json_sha256(text)
    parsed = parsed.withColumn("_computed", digest)
    checked = computed_once(
        parsed.drop("_covered"),
        "_checks",
        F.struct(
            F.col("_identity").alias("message_id"),
            F.col("_early").alias("early"),
            F.col("_received").alias("received"),
            F.col("_computed").alias("computed"),
        ),
    )
    mismatch = F.when(
        ~F.col("_checks.received").eqNullSafe(F.col("_checks.computed")),
        F.concat(
            F.lit("Hash mismatch (received: "),
            "_checks.received",
            F.lit(", computed: "),
            F.coalesce("_checks.computed", F.lit("none")),
            F.lit(")"),
        ),
    )
    reason = F.coalesce(F.col("_checks.early"), mismatch)
    return checked.select(
        *messages.columns,
        reason.isNull().alias("is_valid"),
        F.col("_checks.message_id").alias("message_id"),
        reason.alias("error_reason"),
    )


def valid_records(verified: DataFrame) -> DataFrame:
    """Valid messages as they came, hash included."""
    return verified.filter("is_valid").drop("is_valid", "message_id", "error_reason")


def dead_letters(verified: DataFrame) -> DataFrame:
    """Invalid messages with reason and source coordinates, where the source has any."""
    kinds = dict(verified.dtypes)
    sent = F.lit(None)
    if "timestamp" in kinds:
        sent = F.col("timestamp")
        if kinds["timestamp"] == "timestamp":
            sent = F.unix_millis(sent)

    def coordinate(name, kind):
        value = F.col(name) if name in kinds else F.lit(None)
        return value.cast(kind).alias(name)

    return verified.filter(~F.col("is_valid")).select(
        F.col("value").cast("string").alias("original_record"),
        "error_reason",
        "message_id",
        sent.cast("bigint").alias("timestamp"),
        coordinate("topic", "string"),
        coordinate("partition", "int"),
        coordinate("offset", "bigint"),
    )


def split_records(verified: DataFrame) -> tuple[DataFrame, DataFrame]:
    return valid_records(verified), dead_letters(verified)


def dead_letter_messages(dead: DataFrame) -> DataFrame:
    """Dead letters as JSON messages; a readable record is nested, not quoted."""
    original = F.coalesce(
        F.try_parse_json("original_record"), F.col("original_record").cast("variant")
    )
    rest = [c for c in dead.columns if c != "original_record"]
    letter = F.struct(original.alias("original_record"), *rest)
    return dead.select(F.to_json(letter, {"ignoreNullFields": "false"}).alias("value"))
