"""Declared tables: columns, keys, constraints, stream documents, document rules.

Operators take a ``TableSpec`` (or plain column names) instead of hard-coding a
table, so the same code serves the five event-feed tables and any other one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

CASCADE = "cascade"
SET_NULL = "set_null"

LONG = T.LongType()
INT = T.IntegerType()
STRING = T.StringType()
BOOLEAN = T.BooleanType()
TIMESTAMP = T.TimestampType()

NOW = object()  # default marker: the caller's load time


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    required: bool = False
    unique: bool = False
    length: int | None = None
    default: object = None
    # fraction digits of a published time; what the source holds is not cut
    digits: int = 6


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    on_delete: str


@dataclass(frozen=True)
class TableSpec:
    name: str
    key: str
    columns: tuple[Column, ...]
    foreign_keys: tuple[ForeignKey, ...] = ()
    # (source column, document field) pairs after ``_id`` and ``status``;
    # None: the table has no declared stream document
    stream_document: tuple[tuple[str, str], ...] | None = field(default=None)

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)

    def type_of(self, name: str) -> T.DataType:
        return self.column(name).type

    @property
    def struct(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, c.type, True) for c in self.columns]
        )


@dataclass(frozen=True)
class DocumentRule:
    """One field of a document collection: the JSON types it may hold."""

    path: str
    types: tuple[str, ...]
    required: bool = False


# --- fixed values: table, column and constraint names of the event feed -------

USERS = TableSpec(
    name="users",
    key="user_id",
    columns=(
        Column("user_id", LONG, required=True, unique=True),
        Column("login", STRING, required=True, unique=True, length=255),
        Column("avatar_url", STRING, length=512),
        Column("url", STRING, length=512),
        Column("type", STRING, length=50),
        Column("site_admin", BOOLEAN),
        Column("created_at", TIMESTAMP, default=NOW, digits=0),
    ),
    stream_document=(
        ("login", "login"),
        ("avatar_url", "avatar_url"),
        ("url", "url"),
        ("type", "type"),
        ("site_admin", "site_admin"),
        ("created_at", "created_at"),
    ),
)

REPOS = TableSpec(
    name="repos",
    key="repo_id",
    columns=(
        Column("repo_id", LONG, required=True, unique=True),
        Column("name", STRING, required=True, length=255),
        Column("full_name", STRING, unique=True, length=512),
        Column("url", STRING, length=512),
        Column("html_url", STRING, length=512),
        Column("description", STRING),
        Column("is_private", BOOLEAN),
        Column("is_fork", BOOLEAN),
        Column("homepage", STRING, length=512),
        Column("size", INT),
        Column("language", STRING, length=100),
        Column("forks_count", INT, default=0),
        Column("stargazers_count", INT, default=0),
        Column("watchers_count", INT, default=0),
        Column("default_branch", STRING, length=100),
        Column("created_at", TIMESTAMP, digits=0),
        Column("updated_at", TIMESTAMP, digits=0),
        Column("pushed_at", TIMESTAMP, digits=0),
    ),
    stream_document=(
        ("name", "name"),
        ("full_name", "full_name"),
        ("description", "description"),
        ("is_private", "is_private"),
        ("is_fork", "is_fork"),
        ("language", "language"),
        ("size", "size"),
        ("created_at", "created_at"),
    ),
)

ORGS = TableSpec(
    name="orgs",
    key="org_id",
    columns=(
        Column("org_id", LONG, required=True, unique=True),
        Column("login", STRING, required=True, unique=True, length=255),
        Column("url", STRING, length=512),
        Column("avatar_url", STRING, length=512),
        Column("created_at", TIMESTAMP, default=NOW, digits=0),
    ),
    stream_document=(("login", "login"), ("avatar_url", "avatar_url")),
)

EVENTS = TableSpec(
    name="events",
    key="event_id",
    columns=(
        Column("event_id", STRING, required=True, unique=True, length=50),
        Column("event_type", STRING, required=True, length=100),
        Column("actor_id", LONG),
        Column("repo_id", LONG),
        Column("org_id", LONG),
        Column("is_public", BOOLEAN),
        Column("created_at", TIMESTAMP, required=True, digits=0),
        Column("forkee_repo_id", LONG),
    ),
    foreign_keys=(
        ForeignKey("actor_id", "users", CASCADE),
        ForeignKey("repo_id", "repos", CASCADE),
        ForeignKey("org_id", "orgs", SET_NULL),
        ForeignKey("forkee_repo_id", "repos", CASCADE),
    ),
    stream_document=(
        ("event_type", "type"),
        ("actor_id", "actor_id"),
        ("repo_id", "repo_id"),
        ("org_id", "org_id"),
        ("is_public", "is_public"),
        ("created_at", "created_at"),
    ),
)

REPO_OWNERSHIP = TableSpec(
    name="repo_ownership",
    key="repo_id",
    columns=(
        Column("repo_id", LONG, required=True, unique=True),
        Column("owner_user_id", LONG),
        Column("owner_org_id", LONG),
    ),
    foreign_keys=(
        ForeignKey("repo_id", "repos", CASCADE),
        ForeignKey("owner_user_id", "users", SET_NULL),
        ForeignKey("owner_org_id", "orgs", SET_NULL),
    ),
)

FEED_TABLES = {t.name: t for t in (USERS, REPOS, ORGS, EVENTS, REPO_OWNERSHIP)}

# Columns every published change carries besides the table's own.
CONTROL_COLUMNS = {
    "table_name": STRING,
    "status": STRING,
    "log_timestamp": STRING,
    "message_id": STRING,
    "hash": STRING,
    "log_id": LONG,
}

EXCLUDED_FROM_DOCUMENTS = ("repo_ownership",)

# Raw feed record: one nested JSON object per line.
RAW_EVENT_SCHEMA = """
    id string, type string, public boolean, created_at string,
    actor struct<id: bigint, login: string, url: string, avatar_url: string>,
    repo struct<id: bigint, name: string, url: string>,
    org struct<id: bigint, login: string, url: string, avatar_url: string>,
    payload struct<
        forkee: struct<
            id: bigint, name: string, full_name: string,
            owner: struct<id: bigint, login: string, type: string>,
            private: boolean, fork: boolean, html_url: string,
            description: string, homepage: string, size: int,
            language: string, forks_count: int, stargazers_count: int,
            watchers_count: int, default_branch: string,
            created_at: string, updated_at: string, pushed_at: string>,
        ref: string, head: string>
"""

_ID = ("int",)
_TEXT = ("string", "null")
_FLAG = ("bool", "null")
_COUNT = ("int", "null")
_TIME = ("string", "null")  # dates travel as strings in JSON
_OBJECT = ("object", "null")

DOCUMENT_RULES = {
    "users": (
        DocumentRule("_id", _ID, required=True),
        DocumentRule("login", ("string",), required=True),
        DocumentRule("avatar_url", _TEXT),
        DocumentRule("url", _TEXT),
        DocumentRule("type", _TEXT),
        DocumentRule("site_admin", _FLAG),
        DocumentRule("created_at", _TIME),
    ),
    "orgs": (
        DocumentRule("_id", _ID, required=True),
        DocumentRule("login", _TEXT),
        DocumentRule("url", _TEXT),
        DocumentRule("avatar_url", _TEXT),
        DocumentRule("created_at", _TIME),
    ),
    "repos": (
        DocumentRule("_id", _ID, required=True),
        DocumentRule("name", _TEXT),
        DocumentRule("full_name", _TEXT),
        DocumentRule("url", _TEXT),
        DocumentRule("html_url", _TEXT),
        DocumentRule("description", _TEXT),
        DocumentRule("is_private", _FLAG),
        DocumentRule("is_fork", _FLAG),
        DocumentRule("stats", _OBJECT),
        DocumentRule("stats.size", _COUNT),
        DocumentRule("stats.forks_count", _COUNT),
        DocumentRule("stats.stargazers_count", _COUNT),
        DocumentRule("stats.watchers_count", _COUNT),
        DocumentRule("language", _TEXT),
        DocumentRule("default_branch", _TEXT),
        DocumentRule("dates", _OBJECT),
        DocumentRule("dates.created_at", _TIME),
        DocumentRule("dates.updated_at", _TIME),
        DocumentRule("dates.pushed_at", _TIME),
        DocumentRule("owner", _OBJECT),
        DocumentRule("owner.id", _COUNT),
        DocumentRule("owner.login", _TEXT),
        DocumentRule("owner.type", _TEXT),
    ),
    "events": (
        DocumentRule("_id", ("string",), required=True),
        DocumentRule("type", _TEXT, required=True),
        DocumentRule("is_public", _FLAG),
        DocumentRule("created_at", _TIME),
        DocumentRule("actor", _OBJECT),
        DocumentRule("actor.id", _COUNT),
        DocumentRule("actor.login", _TEXT),
        DocumentRule("actor.avatar_url", _TEXT),
        DocumentRule("repo", _OBJECT),
        DocumentRule("repo.id", _COUNT),
        DocumentRule("repo.name", _TEXT),
        DocumentRule("repo.url", _TEXT),
        DocumentRule("org", _OBJECT),
        DocumentRule("org.id", _COUNT),
        DocumentRule("org.login", _TEXT),
        DocumentRule("payload", _OBJECT),
        DocumentRule("payload.forkee", _OBJECT),
        DocumentRule("payload.forkee.id", _COUNT),
        DocumentRule("payload.forkee.name", _TEXT),
        DocumentRule("payload.forkee.public", _FLAG),
        DocumentRule("payload.ref", _TEXT),
        DocumentRule("payload.head", _TEXT),
    ),
}

# --- end of fixed values -----------------------------------------------------


def wire_type(data_type: T.DataType) -> T.DataType:
    """Type a column has inside a published change.

    Booleans travel as 0/1. Times and decimals travel as text: a JSON number
    would lose trailing zeros, and with them the hash.
    """
    if isinstance(data_type, T.BooleanType):
        return T.IntegerType()
    if isinstance(
        data_type,
        (T.TimestampType, T.TimestampNTZType, T.DateType, T.DecimalType),
    ):
        return T.StringType()
    return data_type


def wide_schema(specs) -> T.StructType:
    """Union of all tables' published columns, plus the control columns."""
    fields: dict[str, T.DataType] = dict(CONTROL_COLUMNS)
    for spec in specs:
        for name in spec.column_names:
            published = wire_type(spec.type_of(name))
            if fields.setdefault(name, published) != published:
                raise ValueError(f"column {name} has two published types")
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


def load_order(specs) -> list[TableSpec]:
    """Parents before children, following the declared foreign keys."""
    pending = {s.name: s for s in specs}
    ordered: list[TableSpec] = []
    while pending:
        ready = [
            s
            for s in pending.values()
            if not any(
                fk.parent in pending and fk.parent != s.name for fk in s.foreign_keys
            )
        ]
        if not ready:
            raise ValueError(f"foreign keys form a cycle: {sorted(pending)}")
        for s in ready:
            ordered.append(pending.pop(s.name))
    return ordered
