"""Feed events and tables to document collections keyed by ``_id``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.functions.dedup import keep_first, keep_last
from cdcflow.functions.joins import splittable
from cdcflow.functions.times import parse_feed_time
from cdcflow.operators.entities import (
    EVENT_POSITION,
    event_order,
    fork_target,
    orgs_dim,
    users_dim,
)


def users_docs(users: DataFrame) -> DataFrame:
    return users.withColumnRenamed("user_id", "_id")


def orgs_docs(orgs: DataFrame) -> DataFrame:
    return orgs.withColumnRenamed("org_id", "_id")


def repo_docs(raw: DataFrame, position: bool = False, latest: bool = False) -> DataFrame:
    """One document per fork event, with the owner first seen for that target.

    A target in several events gives several documents with one ``_id``; they
    are folded when the collection is loaded. ``position`` adds where the event stands.
    ``latest`` folds them as ``latest_documents`` does, before they meet their owners: a
    target has one owner, so only one row of each is joined.
    """
    target = [value.alias(name) for name, value in fork_target().items()]
    forks = raw.select(*target, *event_order()).filter(F.col("repo_id").isNotNull())
    docs = forks.select(
        F.col("repo_id").alias("_id"),
        "name",
        "full_name",
        F.lit(None).cast("string").alias("url"),
        "html_url",
        "description",
        "is_private",
        "is_fork",
        "language",
        "default_branch",
        F.struct("size", "forks_count", "stargazers_count", "watchers_count").alias(
            "stats"
        ),
        F.struct("created_at", "updated_at", "pushed_at").alias("dates"),
        *EVENT_POSITION,
    )
    if latest:
        docs = keep_last(docs, ["_id"], EVENT_POSITION)
    owners = keep_first(
        raw.filter(F.col("payload.forkee.id").isNotNull()).select(
            F.col("payload.forkee.id").alias("fork_id"),
            *event_order(),
            F.col("payload.forkee.owner.id").alias("id"),
            F.col("payload.forkee.owner.login").alias("login"),
            F.col("payload.forkee.owner.type").alias("type"),
        ),
        ["fork_id"],
        EVENT_POSITION,
    ).select("fork_id", F.struct("id", "login", "type").alias("owner"))
    owners = splittable(owners.filter(F.col("owner.id").isNotNull()), "fork_id")
    joined = docs.join(owners, docs["_id"] == owners.fork_id)
    values = [c for c in docs.columns if c not in EVENT_POSITION]
    return joined.select(*values, "owner", *(EVENT_POSITION if position else []))


def event_docs(raw: DataFrame, position: bool = False) -> DataFrame:
    """Nested event documents; only ``org`` is a NULL object when it has no id."""
    return raw.select(
        F.col("id").alias("_id"),
        "type",
        F.col("public").alias("is_public"),
        parse_feed_time(F.col("created_at")).alias("created_at"),
        F.struct("actor.id", "actor.login", "actor.avatar_url").alias("actor"),
        F.struct("repo.id", "repo.name", "repo.url").alias("repo"),
        F.when(F.col("org.id").isNotNull(), F.struct("org.id", "org.login")).alias(
            "org"
        ),
        F.struct(
            F.struct("payload.forkee.id", "payload.forkee.name", "public").alias(
                "forkee"
            ),
            "payload.ref",
            "payload.head",
        ).alias("payload"),
        *(event_order() if position else []),
    )


def latest_documents(docs: DataFrame) -> DataFrame:
    """Document per ``_id`` of the last event that gave one (``position=True``)."""
    return keep_last(docs, ["_id"], EVENT_POSITION).drop(*EVENT_POSITION)


def feed_documents(raw: DataFrame) -> dict[str, DataFrame]:
    return {
        "users": users_docs(users_dim(raw)),
        "orgs": orgs_docs(orgs_dim(raw)),
        "repos": repo_docs(raw),
        "events": event_docs(raw),
    }
