"""Snapshots to synchronised targets: capture, seal, verify, route, apply."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.operators.apply import LOG_POSITION, apply_changes
from cdcflow.operators.capture import after_image_log, snapshot_diff
from cdcflow.operators.envelope import seal_records, valid_records, verify_records
from cdcflow.operators.routing import parse_envelopes, route_by_table
from cdcflow.specs import TableSpec, wide_schema


def sealed_changes(
    before: dict[str, DataFrame],
    after: dict[str, DataFrame],
    specs: dict[str, TableSpec],
    at: Callable[[TableSpec], Column],
    log_id: Callable[[TableSpec], Column],
    produced_at: str,
) -> dict[str, DataFrame]:
    """Per table, messages for every row that differs between two snapshots."""
    messages = {}
    for name, spec in specs.items():
        changes = snapshot_diff(before[name], after[name], [spec.key])
        log = after_image_log(changes, at(spec), log_id(spec))
        messages[name] = seal_records(log, spec, produced_at).select("value")
    return messages


def from_wire(rows: DataFrame, spec: TableSpec, keep=()) -> DataFrame:
    """Parsed rows back in the table's own column types."""
    return rows.select(
        *[F.col(c.name).try_cast(c.type).alias(c.name) for c in spec.columns], *keep
    )


def apply_messages(
    targets: dict[str, DataFrame],
    messages: dict[str, DataFrame],
    specs: dict[str, TableSpec],
) -> dict[str, DataFrame]:
    """Targets after the valid changes among their messages.

    Each table has its own messages: one target then costs no verifying and
    parsing of other tables' changes.
    """
    synced = {}
    for name, spec in specs.items():
        valid = valid_records(verify_records(messages[name]))
        parsed = parse_envelopes(valid, wide_schema([spec]))
        routed = route_by_table(parsed, [name], exclude=())[name]
        changes = from_wire(routed, spec, ("status", *LOG_POSITION))
        # changes that are derived here enter the plan once
        applied = apply_changes(
            targets[name], changes, keys=[spec.key], deletes="remove", derived=True
        )
        synced[name] = applied.select(*spec.column_names)
    return synced


def cdc_sync(
    before: dict[str, DataFrame],
    after: dict[str, DataFrame],
    specs: dict[str, TableSpec],
    at: Callable[[TableSpec], Column],
    log_id: Callable[[TableSpec], Column],
    produced_at: str,
) -> dict[str, DataFrame]:
    """Copies of ``before`` brought up to ``after`` by published changes alone."""
    messages = sealed_changes(before, after, specs, at, log_id, produced_at)
    return apply_messages(before, messages, specs)
