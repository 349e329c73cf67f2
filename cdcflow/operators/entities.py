"""Nested feed events to relational tables.

Each table is one pass over the events: where an event can yield several rows,
the candidates are exploded from an array of structs rather than unioned from
several scans. Precedence between duplicates is (source, event time with NULLs
last, event id as a number, event id, row).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.functions.dedup import keep_first
from cdcflow.functions.times import parse_feed_time
from cdcflow.specs import EVENTS, ORGS, REPO_OWNERSHIP, REPOS, USERS, TableSpec

dedup_by_key = keep_first

EVENT_POSITION = ["_event_time", "_event_number", "_event"]
_PRECEDENCE = ["_source", *EVENT_POSITION]


def event_order() -> list[Column]:
    """Where an event stands in the feed, as the columns ``EVENT_POSITION``."""
    return [
        parse_feed_time(F.col("created_at")).alias("_event_time"),
        F.col("id").try_cast("decimal(38,0)").alias("_event_number"),
        F.col("id").alias("_event"),
    ]


def feed_times(raw: DataFrame) -> DataFrame:
    """Events with their time parsed, which ``parse_feed_time`` then leaves as it is: a
    feed that is read for many outputs has it parsed once."""
    return raw.withColumn("created_at", parse_feed_time(F.col("created_at")))


def _candidate(spec: TableSpec, source: int, values: dict[str, Column]) -> Column:
    """Struct with every column of the table; columns not given are typed NULLs."""
    return F.struct(
        F.lit(source).alias("_source"),
        *[
            values.get(c.name, F.lit(None)).cast(c.type).alias(c.name)
            for c in spec.columns
        ],
    )


def _one_per_key(raw: DataFrame, spec: TableSpec, *candidates: Column) -> DataFrame:
    rows = (
        raw.select(*event_order(), F.explode(F.array(*candidates)).alias("_row"))
        .select("_event_time", "_event_number", "_event", "_row.*")
        .filter(F.col(spec.key).isNotNull())
    )
    return keep_first(rows, [spec.key], _PRECEDENCE).select(*spec.column_names)


def users_dim(raw: DataFrame) -> DataFrame:
    """Actors, then owners of fork targets."""
    seen = parse_feed_time(F.col("created_at"))
    actor = _candidate(
        USERS,
        0,
        {
            "user_id": F.col("actor.id"),
            "login": F.col("actor.login"),
            "avatar_url": F.col("actor.avatar_url"),
            "url": F.col("actor.url"),
            "type": F.lit("User"),
            "site_admin": F.lit(False),
            "created_at": seen,
        },
    )
    owner = _candidate(
        USERS,
        1,
        {
            "user_id": F.col("payload.forkee.owner.id"),
            "login": F.col("payload.forkee.owner.login"),
            "type": F.col("payload.forkee.owner.type"),
            "site_admin": F.lit(False),
            "created_at": seen,
        },
    )
    return _one_per_key(raw, USERS, actor, owner)


def orgs_dim(raw: DataFrame) -> DataFrame:
    org = _candidate(
        ORGS,
        0,
        {
            "org_id": F.col("org.id"),
            "login": F.col("org.login"),
            "url": F.col("org.url"),
            "avatar_url": F.col("org.avatar_url"),
            "created_at": parse_feed_time(F.col("created_at")),
        },
    )
    # a single candidate: without the explode the key filter reaches the scan
    rows = raw.select(*event_order(), org.alias("_row")).select(
        "_event_time", "_event_number", "_event", "_row.*"
    )
    rows = rows.filter(F.col("org_id").isNotNull())
    return keep_first(rows, ["org_id"], _PRECEDENCE).select(*ORGS.column_names)


def fork_target() -> dict[str, Column]:
    """Repository columns of an event's fork target."""
    renamed = {"repo_id": "id", "is_private": "private", "is_fork": "fork"}
    values = {}
    for column in REPOS.columns:
        if column.name == "url":  # events give it by the repository, not by its fork
            continue
        value = F.col(f"payload.forkee.{renamed.get(column.name, column.name)}")
        is_time = isinstance(column.type, T.TimestampType)
        values[column.name] = parse_feed_time(value) if is_time else value
    return values


def repos_dim(raw: DataFrame) -> DataFrame:
    """Event repositories (flags false, counters 0), then fork targets."""
    base = {
        "repo_id": F.col("repo.id"),
        "name": F.col("repo.name"),
        "url": F.col("repo.url"),
        "is_private": F.lit(False),
        "is_fork": F.lit(False),
    }
    for counter in ("size", "forks_count", "stargazers_count", "watchers_count"):
        base[counter] = F.lit(0)
    return _one_per_key(
        raw, REPOS, _candidate(REPOS, 0, base), _candidate(REPOS, 1, fork_target())
    )


def events_fact(raw: DataFrame, fork_type: str = "ForkEvent") -> DataFrame:
    """Event keys; the fork target only for the fork type. NULL ids are kept."""
    rows = raw.select(
        *event_order(),
        F.col("id").alias("event_id"),
        F.col("type").alias("event_type"),
        F.col("actor.id").alias("actor_id"),
        F.col("repo.id").alias("repo_id"),
        F.col("org.id").alias("org_id"),
        F.col("public").alias("is_public"),
        parse_feed_time(F.col("created_at")).alias("created_at"),
        F.when(F.col("type") == fork_type, F.col("payload.forkee.id")).alias(
            "forkee_repo_id"
        ),
    ).drop("_event_number", "_event")
    return keep_first(rows, ["event_id"], ["_event_time"]).select(*EVENTS.column_names)


def repo_ownership(raw: DataFrame) -> DataFrame:
    """Owner per repository: the event's organisation, then the fork owner."""
    by_org = F.struct(
        F.lit(0).alias("_source"),
        F.col("repo.id").alias("repo_id"),
        F.lit(None).cast("bigint").alias("owner_user_id"),
        F.col("org.id").alias("owner_org_id"),
    )
    by_user = F.struct(
        F.lit(1).alias("_source"),
        F.col("payload.forkee.id").alias("repo_id"),
        F.col("payload.forkee.owner.id").alias("owner_user_id"),
        F.lit(None).cast("bigint").alias("owner_org_id"),
    )
    rows = (
        raw.select(*event_order(), F.explode(F.array(by_org, by_user)).alias("_row"))
        .select("_event_time", "_event_number", "_event", "_row.*")
        .filter(
            F.col("repo_id").isNotNull()
            & F.coalesce("owner_user_id", "owner_org_id").isNotNull()
        )
    )
    return keep_first(rows, ["repo_id"], _PRECEDENCE).select(
        *REPO_OWNERSHIP.column_names
    )


def feed_tables(raw: DataFrame, fork_type: str = "ForkEvent") -> dict[str, DataFrame]:
    return {
        "users": users_dim(raw),
        "repos": repos_dim(raw),
        "orgs": orgs_dim(raw),
        "events": events_fact(raw, fork_type),
        "repo_ownership": repo_ownership(raw),
    }
