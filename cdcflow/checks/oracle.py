"""SQL of the queries in ``queries.py``, for an independent engine (DuckDB).

Written from the operators' definitions, not from their plans: windows where the
operators aggregate, joins where they group, text concatenation where they
encode JSON.
"""

from __future__ import annotations


def _text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


# --- derived views -----------------------------------------------------------

RAW = """
src AS (
  SELECT e.*, CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS k,
         c.*, n.*, p.*,
         e.event_type = 'purchase' OR e.event_id % 13 = 0 AS forked
  FROM events e
  JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON CAST(json_extract_string(e.props, '$.k') AS BIGINT) = p.p_partkey
),
once AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS id, event_type AS type,
    event_id % 10 <> 0 AS public,
    CASE WHEN event_id % 97 = 0 THEN 'bad'
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS created_text,
    CASE WHEN event_id % 97 <> 0 THEN date_trunc('second', ts) END AS created,
    CASE WHEN event_id % 50 <> 0 THEN user_id END AS actor_id,
    c_name AS actor_login, 'u/' || user_id AS actor_url, 'a/' || user_id AS actor_avatar,
    k AS repo_id, p_name AS repo_name, 'r/' || k AS repo_url,
    CASE WHEN event_type IN ('view', 'click') THEN CAST(n_nationkey AS BIGINT) END AS org_id,
    n_name AS org_login,
    CASE WHEN event_type IN ('view', 'click') THEN 'o/' || n_nationkey END AS org_url,
    CASE WHEN forked THEN 1000 + k * 10 + user_id % 10 END AS f_id,
    CASE WHEN forked THEN p_name END AS f_name,
    CASE WHEN forked THEN c_name || '/' || p_name END AS f_full,
    CASE WHEN forked AND event_id % 29 <> 0 THEN 10000 + (user_id + 1) % 200 END AS f_owner_id,
    CASE WHEN forked THEN 'w' || (10000 + (user_id + 1) % 200) END AS f_owner_login,
    CASE WHEN forked THEN 'User' END AS f_owner_type,
    CASE WHEN forked THEN p_size END AS f_size,
    CASE WHEN forked THEN p_brand END AS f_lang,
    CASE WHEN forked THEN CAST(k AS INTEGER) END AS f_forks,
    CASE WHEN forked THEN CAST(k + 1 AS INTEGER) END AS f_stars,
    CASE WHEN forked THEN CAST(k + 2 AS INTEGER) END AS f_watch
  FROM src
),
raw AS (
  SELECT * FROM once UNION ALL SELECT * FROM once WHERE event_id % 100 = 7
)"""

USERS = (
    RAW
    + """,
user_rows AS (
  SELECT 0 AS pick, created, event_id, actor_id AS user_id, actor_login AS login,
         actor_avatar AS avatar_url, actor_url AS url, 'User' AS type
  FROM raw WHERE actor_id IS NOT NULL
  UNION ALL
  SELECT 1, created, event_id, f_owner_id, f_owner_login, NULL, NULL, f_owner_type
  FROM raw WHERE f_owner_id IS NOT NULL
),
users AS (
  SELECT user_id, login, avatar_url, url, type, false AS site_admin, created AS created_at
  FROM user_rows
  QUALIFY row_number() OVER (PARTITION BY user_id
    ORDER BY pick, created NULLS LAST, event_id) = 1
)"""
)

ORGS = (
    RAW
    + """,
orgs AS (
  SELECT org_id, org_login AS login, org_url AS url, CAST(NULL AS VARCHAR) AS avatar_url,
         created AS created_at
  FROM raw WHERE org_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY org_id ORDER BY created NULLS LAST, event_id) = 1
)"""
)

REPOS = (
    RAW
    + """,
repo_rows AS (
  SELECT 0 AS pick, created, event_id, repo_id, repo_name AS name,
    CAST(NULL AS VARCHAR) AS full_name, repo_url AS url, false AS is_private,
    false AS is_fork, 0 AS size, CAST(NULL AS VARCHAR) AS language, 0 AS forks_count,
    0 AS stargazers_count, 0 AS watchers_count, CAST(NULL AS TIMESTAMP) AS created_at
  FROM raw WHERE repo_id IS NOT NULL
  UNION ALL
  SELECT 1, created, event_id, f_id, f_name, f_full, NULL, false, true, f_size, f_lang,
    f_forks, f_stars, f_watch, created
  FROM raw WHERE f_id IS NOT NULL
),
repos AS (
  SELECT repo_id, name, full_name, url, CAST(NULL AS VARCHAR) AS html_url,
    CAST(NULL AS VARCHAR) AS description, is_private, is_fork,
    CAST(NULL AS VARCHAR) AS homepage, size, language, forks_count, stargazers_count,
    watchers_count, CAST(NULL AS VARCHAR) AS default_branch,
    created_at, created_at AS updated_at, created_at AS pushed_at
  FROM repo_rows
  QUALIFY row_number() OVER (PARTITION BY repo_id
    ORDER BY pick, created NULLS LAST, event_id) = 1
)"""
)

FACT = (
    RAW
    + """,
fact AS (
  SELECT DISTINCT id AS event_id, type AS event_type, actor_id, repo_id, org_id,
    public AS is_public, created AS created_at,
    CASE WHEN type = 'purchase' THEN f_id END AS forkee_repo_id
  FROM raw
)"""
)

OWNERSHIP = (
    RAW
    + """,
owner_rows AS (
  SELECT 0 AS pick, created, event_id, repo_id, CAST(NULL AS BIGINT) AS owner_user_id,
         org_id AS owner_org_id
  FROM raw WHERE repo_id IS NOT NULL AND org_id IS NOT NULL
  UNION ALL
  SELECT 1, created, event_id, f_id, f_owner_id, NULL
  FROM raw WHERE f_id IS NOT NULL AND f_owner_id IS NOT NULL
),
ownership AS (
  SELECT repo_id, owner_user_id, owner_org_id FROM owner_rows
  QUALIFY row_number() OVER (PARTITION BY repo_id
    ORDER BY pick, created NULLS LAST, event_id) = 1
)"""
)

REPO_DOCS = (
    RAW
    + """,
owners AS (
  SELECT f_id, f_owner_id, f_owner_login, f_owner_type FROM raw WHERE f_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY f_id ORDER BY created NULLS LAST, event_id) = 1
),
repo_docs AS (
  SELECT r.f_id AS _id, f_name AS name, f_full AS full_name, CAST(NULL AS VARCHAR) AS url,
    CAST(NULL AS VARCHAR) AS html_url, CAST(NULL AS VARCHAR) AS description,
    false AS is_private, true AS is_fork, f_lang AS language,
    CAST(NULL AS VARCHAR) AS default_branch, f_size AS size, f_forks AS forks_count,
    f_stars AS stargazers_count, f_watch AS watchers_count, created AS created_at,
    created AS updated_at, created AS pushed_at, o.f_owner_id AS owner_id,
    o.f_owner_login AS owner_login, o.f_owner_type AS owner_type
  FROM raw r LEFT JOIN owners o ON r.f_id = o.f_id
  WHERE r.f_id IS NOT NULL AND o.f_owner_id IS NOT NULL
)"""
)

EVENT_DOCS = """
  SELECT id AS _id, type, public AS is_public, created AS created_at,
    false AS no_actor, actor_id, actor_login, actor_avatar AS actor_avatar_url,
    repo_id, repo_name, repo_url, org_id IS NULL AS no_org, org_id,
    CASE WHEN org_id IS NOT NULL THEN org_login END AS org_login,
    false AS no_forkee, f_id AS forkee_id, f_name AS forkee_name,
    public AS forkee_public, type AS ref, CAST(NULL AS VARCHAR) AS head
  FROM raw"""


def _diff(rows: str, key: str, changed: str, new: str, columns: list[str]) -> str:
    """Change log of a snapshot recipe; ``rows`` names the whole table's CTE."""
    number = f"CAST({key} AS BIGINT)"
    images = ", ".join(
        f"CASE WHEN {number} % 10 = 1 THEN {new} ELSE {c} END AS {c}" if c == changed else c
        for c in columns
    )
    return f"""
    SELECT {number} AS log_id, {images},
      CASE {number} % 10 WHEN 0 THEN 'DELETE' WHEN 1 THEN 'UPDATE' ELSE 'INSERT' END AS status,
      TIMESTAMP '2024-01-01' + to_milliseconds({number} % 1000) AS log_timestamp
    FROM {rows} WHERE {number} % 10 IN (0, 1, 2)"""


ORDER_COLUMNS = [
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
    "o_orderpriority",
]
CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]

ORDERS = """
o AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, o_orderdate, o_orderpriority
  FROM orders
)"""
CUSTOMERS = """
c AS (
  SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal,
         c_mktsegment
  FROM customer
)"""
PLUS_ONE = "CAST({} + 1 AS DECIMAL(18,2))"
ORDER_DIFF = _diff(
    "o", "o_orderkey", "o_totalprice", PLUS_ONE.format("o_totalprice"), ORDER_COLUMNS
)
CUSTOMER_DIFF = _diff(
    "c", "c_custkey", "c_acctbal", PLUS_ONE.format("c_acctbal"), CUSTOMER_COLUMNS
)
ORDER_LOG = f"{ORDERS}, olog AS ({ORDER_DIFF})"
CUSTOMER_LOG = f"{CUSTOMERS}, clog AS ({CUSTOMER_DIFF})"


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in columns.items())


ORDER_TEXTS = {c: c for c in ORDER_COLUMNS} | {
    "o_totalprice": "CAST(o_totalprice AS VARCHAR)",
    "o_orderdate": _text("o_orderdate"),
}
ORDER_LOG_TEXTS = {
    "log_id": "log_id",
    **ORDER_TEXTS,
    "status": "status",
    "log_timestamp": _text("log_timestamp"),
}

# --- messages ----------------------------------------------------------------


def _member(name: str, kind: str) -> str:
    if kind == "text":
        return f"""'"{name}":' || coalesce(CAST(to_json({name}) AS VARCHAR), 'null')"""
    return f"""'"{name}":' || coalesce(CAST({name} AS VARCHAR), 'null')"""


def _object(members: dict[str, str]) -> str:
    return " || ',' || ".join(_member(n, members[n]) for n in sorted(members))


def _wire(name: str, log: str, key: str, columns: dict[str, tuple[str, str]]) -> str:
    """CTEs: the published columns of a log, then its sealed messages.

    ``columns``: published SQL and kind (text or number) per column.
    """
    published = ", ".join(f"{sql} AS {c}" for c, (sql, _) in columns.items())
    kinds = {c: kind for c, (_, kind) in columns.items()} | {
        "status": "text", "log_timestamp": "text", "log_id": "number",
        "table_name": "text", "message_id": "text", "producer_timestamp": "text",
    }
    body = _object(kinds)
    return f"""
{name}_wire AS (
  SELECT {published}, status, {_text("log_timestamp")} AS log_timestamp, log_id,
    '{name}' AS table_name,
    '{name}_' || {key} || '_' || {_text("log_timestamp")} AS message_id,
    '2024-06-01T00:00:00.000000' AS producer_timestamp
  FROM {log}
),
{name}_sealed AS (
  SELECT *, sha256('{{' || {body} || '}}') AS hash,
    '{{' || {body} || ',"hash":"' || sha256('{{' || {body} || '}}') || '"}}' AS value
  FROM {name}_wire
),
{name}_named AS (
  SELECT * REPLACE (CASE WHEN {key} % 29 <> 0 THEN message_id END AS message_id)
  FROM {name}_wire
),
{name}_hashed AS (
  SELECT *, {key} AS k, '{{' || {body} || '}}' AS body FROM {name}_named
),
{name}_damaged AS (
  SELECT *,
    CASE WHEN k % 17 = 0 THEN replace(body, '"status":"', '"status":"X') ELSE body END AS body1,
    CASE WHEN k % 23 = 0 THEN 'null' ELSE '"' || sha256(body) || '"' END AS hash1
  FROM {name}_hashed
),
{name}_messages AS (
  SELECT *, CASE WHEN k % 31 = 0 THEN left(whole, length(whole) - 5) ELSE whole END AS value
  FROM (
    SELECT *,
      CASE WHEN k % 19 = 0 THEN replace(body1, '"table_name":"{name}"', '"table_name":null')
           ELSE body1 END AS body2,
      left(body2, length(body2) - 1) || ',"hash":' || hash1 || '}}' AS whole
    FROM {name}_damaged
  )
),
{name}_verified AS (
  SELECT k, value, body1, message_id AS sent_id, coalesce(
    CASE WHEN k % 31 = 0 THEN 'Malformed JSON'
         WHEN k % 23 = 0 THEN 'No hash found'
         WHEN k % 19 = 0 THEN 'Missing table_name (Routing Label)'
         WHEN k % 29 = 0 THEN 'No message_id found'
         WHEN k % 17 = 0 THEN 'Hash mismatch (received: ' || sha256(body)
                              || ', computed: ' || sha256(body1) || ')' END, '') AS reason,
    CASE WHEN k % 31 = 0 OR message_id IS NULL THEN 'unknown' ELSE message_id END AS known_id,
    epoch_ms(TIMESTAMP '2024-01-01' + to_milliseconds(k)) AS sent
  FROM {name}_messages
)"""


_SECONDS = "strftime({}, '%Y-%m-%d %H:%M:%S')"
ORDER_WIRE = _wire(
    "orders",
    "olog",
    "o_orderkey",
    {
        "o_orderkey": ("o_orderkey", "number"),
        "o_custkey": ("o_custkey", "number"),
        "o_orderstatus": ("o_orderstatus", "text"),
        "o_totalprice": ("CAST(o_totalprice AS VARCHAR)", "text"),
        "o_orderdate": (_SECONDS.format("o_orderdate"), "text"),
        "o_orderpriority": ("o_orderpriority", "text"),
    },
)
CUSTOMER_WIRE = _wire(
    "customer",
    "clog",
    "c_custkey",
    {
        "c_custkey": ("c_custkey", "number"),
        "c_name": ("c_name", "text"),
        "c_nationkey": ("c_nationkey", "number"),
        "c_acctbal": ("CAST(c_acctbal AS VARCHAR)", "text"),
        "c_mktsegment": ("c_mktsegment", "text"),
    },
)
SHOP = f"{ORDER_LOG}, {CUSTOMER_LOG}, {ORDER_WIRE}, {CUSTOMER_WIRE}"
VERIFIED = f"""{SHOP},
verified AS (
  SELECT * FROM orders_verified UNION ALL SELECT * FROM customer_verified
)"""

_NAMED = """
CASE WHEN log_id % 41 = 0 THEN NULL
     WHEN log_id % 43 = 0 THEN 'REPO_OWNERSHIP'
     WHEN log_id % 47 = 0 THEN 'other'
     WHEN log_id % 3 = 0 THEN upper('{0}')
     WHEN log_id % 3 = 1 THEN upper(left('{0}', 1)) || substr('{0}', 2)
     ELSE '{0}' END"""
MIXED = f"""{SHOP},
mixed AS (
  SELECT {_NAMED.format("orders")} AS table_name, log_id, status FROM olog
  UNION ALL
  SELECT {_NAMED.format("customer")}, log_id, status FROM clog
)"""


def _wide(kind: str) -> str:
    """The wide row of one table's messages: own columns, then typed NULLs."""
    columns = {c: "BIGINT" for c in ("o_orderkey", "o_custkey", "c_custkey")}
    columns |= {c: "VARCHAR" for c in ORDER_COLUMNS + CUSTOMER_COLUMNS if c not in columns}
    columns["c_nationkey"] = "INTEGER"
    own = ORDER_COLUMNS if kind == "orders" else CUSTOMER_COLUMNS
    control = ["status", "log_timestamp", "hash", "message_id", "table_name"]
    parts = [
        f"CASE WHEN k % 31 <> 0 THEN {c} END AS {c}"
        if c in own
        else f"CAST(NULL AS {t}) AS {c}"
        for c, t in columns.items()
    ]
    values = {
        "status": "CASE WHEN k % 17 = 0 THEN 'X' || status ELSE status END",
        "log_timestamp": "log_timestamp",
        "hash": "CASE WHEN k % 23 <> 0 THEN sha256(body) END",
        "message_id": "message_id",
        "table_name": "CASE WHEN k % 19 <> 0 THEN table_name END",
    }
    parts += [f"CASE WHEN k % 31 <> 0 THEN {values[c]} END AS {c}" for c in control]
    parts.append("CASE WHEN k % 31 <> 0 THEN log_id END AS log_id")
    return f"SELECT {', '.join(parts)} FROM {kind}_messages"


# --- targets -----------------------------------------------------------------

ROUNDS = f"""{ORDER_LOG},
again AS (
  SELECT -log_id AS log_id, o_orderkey, o_custkey, o_orderstatus,
    CAST(o_totalprice + 5 AS DECIMAL(18,2)) AS o_totalprice, o_orderdate,
    'again' AS o_orderpriority,
    CASE WHEN o_orderkey % 40 = 1 THEN 'DELETE' ELSE 'UPDATE' END AS status,
    log_timestamp + INTERVAL 1 HOUR AS log_timestamp
  FROM olog WHERE o_orderkey % 20 = 1
),
latest AS (
  SELECT * FROM (SELECT * FROM olog UNION ALL SELECT * FROM again)
  QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY log_timestamp DESC, log_id DESC) = 1
),
target AS (SELECT * FROM o WHERE o_orderkey % 10 <> 2),
applied AS (
  SELECT o_orderkey AS _id, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
         o_orderpriority, status, log_id
  FROM latest
  UNION ALL
  SELECT t.o_orderkey, t.o_custkey, t.o_orderstatus, t.o_totalprice, t.o_orderdate,
         t.o_orderpriority, NULL, NULL
  FROM target t WHERE t.o_orderkey NOT IN (SELECT o_orderkey FROM latest)
)"""
_APPLIED = f"""SELECT _id, o_custkey, o_orderstatus,
  CAST(o_totalprice AS VARCHAR) AS o_totalprice, {_text("o_orderdate")} AS o_orderdate,
  o_orderpriority, status, log_id"""

LINES = """
doubled AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_shipdate
  FROM lineitem
  UNION ALL
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_shipdate
  FROM lineitem WHERE l_orderkey % 10 = 0
)"""
ORDER_TARGET = f"""{ORDERS},
target AS (
  SELECT * REPLACE (CASE WHEN o_orderkey % 10 = 1
    THEN CAST(o_totalprice + 1 AS DECIMAL(18,2)) ELSE o_totalprice END AS o_totalprice)
  FROM o WHERE o_orderkey % 10 <> 0
)"""

BOTH_TARGETS = f"""{ORDER_TARGET}, {CUSTOMERS},
customer_target AS (
  SELECT * REPLACE (CASE WHEN c_custkey % 10 = 1
    THEN CAST(c_acctbal + 1 AS DECIMAL(18,2)) ELSE c_acctbal END AS c_acctbal)
  FROM c WHERE c_custkey % 10 <> 0
)"""
_SHOP_ROWS = f"""
SELECT 'orders' AS table_name, CAST(o_orderkey AS VARCHAR) AS o_orderkey,
  CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
  CAST(o_totalprice AS VARCHAR) AS o_totalprice, {_text("o_orderdate")} AS o_orderdate,
  o_orderpriority, NULL AS c_custkey, NULL AS c_name, NULL AS c_nationkey,
  NULL AS c_acctbal, NULL AS c_mktsegment
FROM target
UNION ALL
SELECT 'customer', NULL, NULL, NULL, NULL, NULL, NULL, CAST(c_custkey AS VARCHAR), c_name,
  CAST(c_nationkey AS VARCHAR), CAST(c_acctbal AS VARCHAR), c_mktsegment
FROM customer_target"""

DOCUMENTS = """
docs AS (
  SELECT event_id AS k, CASE
    WHEN event_id % 31 = 0 THEN NULL
    WHEN event_id % 37 = 0 THEN '[1]'
    ELSE '{"_id":' || CASE WHEN event_id % 11 = 0 THEN CAST(event_id AS VARCHAR)
                           ELSE '"' || event_id || '"' END
      || CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 13 = 0 THEN ',"type":null'
              ELSE ',"type":"' || event_type || '"' END
      || ',"is_public":' || CASE WHEN event_id % 5 = 0 THEN '1' ELSE 'true' END
      || ',"actor":' || CASE WHEN event_id % 17 = 0 THEN '[1]'
           ELSE '{"id":' || CASE WHEN event_id % 19 = 0 THEN '1.5'
                                 ELSE CAST(user_id AS VARCHAR) END || ',"login":null}' END
      || ',"payload":{"forkee":{"id":' || CASE WHEN event_id % 23 = 0 THEN '"x"' ELSE 'null' END
      || ',"public":false},"ref":' || CASE WHEN event_id % 29 = 0 THEN '{"a":1}' ELSE '"r"' END
      || '}}' END AS j
  FROM events
),
rules(path, pointer, allowed, required) AS (VALUES
  ('_id', '$._id', ['string'], true),
  ('type', '$.type', ['string', 'null'], true),
  ('is_public', '$.is_public', ['bool', 'null'], false),
  ('created_at', '$.created_at', ['string', 'null'], false),
  ('actor', '$.actor', ['object', 'null'], false),
  ('actor.id', '$.actor.id', ['int', 'null'], false),
  ('actor.login', '$.actor.login', ['string', 'null'], false),
  ('actor.avatar_url', '$.actor.avatar_url', ['string', 'null'], false),
  ('repo', '$.repo', ['object', 'null'], false),
  ('org', '$.org', ['object', 'null'], false),
  ('payload', '$.payload', ['object', 'null'], false),
  ('payload.forkee', '$.payload.forkee', ['object', 'null'], false),
  ('payload.forkee.id', '$.payload.forkee.id', ['int', 'null'], false),
  ('payload.forkee.public', '$.payload.forkee.public', ['bool', 'null'], false),
  ('payload.ref', '$.payload.ref', ['string', 'null'], false),
  ('payload.head', '$.payload.head', ['string', 'null'], false)
),
typed AS (
  SELECT json_extract_string(j, '$._id') AS _id, path, allowed, required,
    CASE json_type(j, pointer)
      WHEN 'UBIGINT' THEN 'int' WHEN 'BIGINT' THEN 'int' WHEN 'VARCHAR' THEN 'string'
      WHEN 'BOOLEAN' THEN 'bool' WHEN 'DOUBLE' THEN 'double' WHEN 'OBJECT' THEN 'object'
      WHEN 'ARRAY' THEN 'array' WHEN 'NULL' THEN 'null' END AS found
  FROM docs, rules WHERE j IS NOT NULL AND j <> '[1]'
)"""


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def _feed_diff(base: str, rows: str, key: str, changed: str, columns: list[str]) -> str:
    log = _diff(rows, key, changed, f"{changed} || '!'", columns)
    return f"{base}, flog AS ({log})"


USER_COLUMNS = ["user_id", "login", "avatar_url", "url", "type", "site_admin", "created_at"]
REPO_COLUMNS = [
    "repo_id", "name", "full_name", "url", "html_url", "description", "is_private", "is_fork",
    "homepage", "size", "language", "forks_count", "stargazers_count", "watchers_count",
    "default_branch", "created_at", "updated_at", "pushed_at",
]
ORG_COLUMNS = ["org_id", "login", "url", "avatar_url", "created_at"]
FACT_COLUMNS = [
    "event_id", "event_type", "actor_id", "repo_id", "org_id", "is_public", "created_at",
    "forkee_repo_id",
]


def _times(columns: list[str]) -> str:
    return _select({c: _text(c) if c.endswith("_at") else c for c in columns})


def _loaded_tables() -> str:
    return f"""{USERS}, {ORGS.removeprefix(RAW).lstrip(",")}, {REPOS.removeprefix(RAW).lstrip(",")},
{FACT.removeprefix(RAW).lstrip(",")}, {OWNERSHIP.removeprefix(RAW).lstrip(",")}"""


LOADED = _loaded_tables()

_COUNTS = """count(*) AS source_count, count(*) AS target_count, CAST(0 AS BIGINT) AS gap"""
_TABLES = (
    ("users", "users", USER_COLUMNS),
    ("orgs", "orgs", ORG_COLUMNS),
    ("repos", "repos", REPO_COLUMNS),
    ("events", "fact", FACT_COLUMNS),
    ("repo_ownership", "ownership", ["repo_id", "owner_user_id", "owner_org_id"]),
)
_STORED = {
    "user_id": "bigint", "repo_id": "bigint", "org_id": "bigint", "actor_id": "bigint",
    "forkee_repo_id": "bigint", "owner_user_id": "bigint", "owner_org_id": "bigint",
    "site_admin": "boolean", "is_private": "boolean", "is_fork": "boolean",
    "is_public": "boolean", "created_at": "timestamp", "updated_at": "timestamp",
    "pushed_at": "timestamp", "size": "int", "forks_count": "int",
    "stargazers_count": "int", "watchers_count": "int",
}

ORACLE: dict[str, str] = {}


def _add(name: str, ctes: str, body: str) -> None:
    ORACLE[name] = _with(ctes, body) if ctes else body.strip()


_add(
    "scan_nested_json",
    RAW,
    """
SELECT CASE WHEN ok THEN id END AS id, CASE WHEN ok THEN type END AS type,
  CASE WHEN ok THEN public END AS public, CASE WHEN ok THEN created_text END AS created_at,
  CASE WHEN ok THEN actor_id END AS actor_id, CASE WHEN ok THEN actor_login END AS actor_login,
  CASE WHEN ok THEN repo_id END AS repo_id, CASE WHEN ok THEN org_id END AS org_id,
  CASE WHEN ok THEN f_id END AS fork_id, CASE WHEN ok THEN f_owner_login END AS owner_login,
  CASE WHEN ok THEN f_size END AS fork_size
FROM (SELECT *, event_id % 83 <> 0 AS ok FROM raw)""",
)
_add(
    "stream_change_topic",
    SHOP,
    "SELECT message_id, status, sha256(value) AS value_sha FROM orders_sealed",
)
_NEWER = """WHERE log_timestamp > TIMESTAMP '2024-01-01 00:00:00.500'
  OR (log_timestamp = TIMESTAMP '2024-01-01 00:00:00.500' AND log_id > 4500)"""
_add(
    "incremental_log_read", ORDER_LOG, f"SELECT {_select(ORDER_LOG_TEXTS)} FROM olog {_NEWER}"
)
_add(
    "incremental_log_cursor",
    ORDER_LOG,
    f"""
SELECT 'orders' AS table_name, {_text("log_timestamp")} AS cursor_ts, log_id AS cursor_id
FROM olog {_NEWER} ORDER BY log_timestamp DESC, log_id DESC LIMIT 1""",
)
_COMMITS = f"""{ORDER_LOG}, commits AS (
  SELECT *, CAST(greatest(CASE WHEN log_id % 15 = 0 THEN 3 WHEN log_id % 5 = 0 THEN 2 ELSE 1 END,
    CASE WHEN log_id > 1000 THEN 2 ELSE 1 END) AS INTEGER) AS committed FROM olog)"""
_add("log_gaps", _COMMITS, f"SELECT {_select(ORDER_LOG_TEXTS)}, committed AS pass FROM commits")
_add(
    "log_gap_state",
    f"""{_COMMITS}, numbers AS (
  SELECT log_id AS n FROM commits WHERE committed <= 2 UNION SELECT CAST(-1 AS BIGINT)),
  following AS (SELECT n, lead(n) OVER (ORDER BY n) AS after FROM numbers),
  first_pass AS (SELECT max(log_id) AS reached, max(log_timestamp) AS at FROM commits WHERE committed = 1),
  second_pass AS (SELECT max(log_timestamp) AS at FROM commits WHERE committed = 2)""",
    f"""
SELECT 'orders' AS table_name, n + 1 AS gap_from, after - 1 AS gap_to,
  CASE WHEN after IS NOT NULL THEN CASE WHEN n < first_pass.reached THEN {_text("first_pass.at")}
    ELSE {_text("second_pass.at")} END END AS seen_at
FROM following, first_pass, second_pass WHERE after IS NULL OR after > n + 1""",
)
_nulls = ", ".join(
    f"CAST(NULL AS {'BIGINT' if c == 'c_custkey' else 'INTEGER' if c == 'c_nationkey' else 'VARCHAR'}) AS {c}"
    for c in CUSTOMER_COLUMNS
)
_no_orders = ", ".join(
    f"CAST(NULL AS {'BIGINT' if c in ('o_orderkey', 'o_custkey') else 'VARCHAR'}) AS {c}"
    for c in ORDER_COLUMNS
)
_add(
    "collect_change_logs",
    f"{ORDER_LOG}, {CUSTOMER_LOG}",
    f"""
SELECT log_id, {_select(ORDER_TEXTS)}, status, {_text("log_timestamp")} AS log_timestamp,
  'orders' AS table_name, {_nulls}
FROM olog {_NEWER}
UNION ALL BY NAME
SELECT log_id, {_no_orders}, status, {_text("log_timestamp")} AS log_timestamp,
  'customer' AS table_name, c_custkey, c_name, c_nationkey,
  CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
FROM clog""",
)

_add("users_dim", USERS, f"SELECT {_times(USER_COLUMNS)} FROM users")
_add("orgs_dim", ORGS, f"SELECT {_times(ORG_COLUMNS)} FROM orgs")
_add("repos_dim", REPOS, f"SELECT {_times(REPO_COLUMNS)} FROM repos")
_add("events_fact", FACT, f"SELECT {_times(FACT_COLUMNS)} FROM fact")
_add("repo_ownership", OWNERSHIP, "SELECT * FROM ownership")
_add(
    "dedup_by_key",
    "",
    f"""
SELECT l_orderkey, l_linenumber, {_text("l_shipdate")} AS l_shipdate, l_partkey, l_suppkey,
  l_returnflag
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate, l_partkey, l_suppkey, l_returnflag) = 1""",
)
_add(
    "users_docs",
    USERS,
    f"SELECT user_id AS _id, {_times(USER_COLUMNS[1:])} FROM users",
)
_add("orgs_docs", ORGS, f"SELECT org_id AS _id, {_times(ORG_COLUMNS[1:])} FROM orgs")
_add(
    "repo_docs",
    REPO_DOCS,
    f"""
SELECT * REPLACE ({_text("created_at")} AS created_at, {_text("updated_at")} AS updated_at,
  {_text("pushed_at")} AS pushed_at)
FROM repo_docs""",
)
_add(
    "event_docs",
    RAW,
    f"SELECT * REPLACE ({_text('created_at')} AS created_at) FROM ({EVENT_DOCS})",
)

_before = {
    f"before_{c}": f"CASE WHEN o_orderkey % 10 <> 2 THEN {sql} END"
    for c, sql in ORDER_TEXTS.items()
}
_after = {
    f"after_{c}": f"CASE WHEN o_orderkey % 10 <> 0 THEN {sql} END"
    for c, sql in ORDER_TEXTS.items()
}
_after["after_o_totalprice"] = (
    "CASE o_orderkey % 10 WHEN 0 THEN NULL"
    " WHEN 1 THEN CAST(CAST(o_totalprice + 1 AS DECIMAL(18,2)) AS VARCHAR)"
    " ELSE CAST(o_totalprice AS VARCHAR) END"
)
_add(
    "snapshot_diff",
    ORDERS,
    f"""
SELECT o_orderkey,
  CASE o_orderkey % 10 WHEN 0 THEN 'DELETE' WHEN 1 THEN 'UPDATE' ELSE 'INSERT' END AS status,
  {_select(_before)}, {_select(_after)}
FROM o WHERE o_orderkey % 10 < 3""",
)
_add(
    "snapshot_changes",
    ORDERS,
    f"""
SELECT o_orderkey,
  CASE o_orderkey % 10 WHEN 0 THEN 'DELETE' WHEN 1 THEN 'UPDATE' ELSE 'INSERT' END AS status,
  {_select(_before)}, {_select(_after)}
FROM o WHERE o_orderkey % 10 < 3""",
)
_add(
    "snapshot_conflicts",
    "",
    """
SELECT l_orderkey, count(*) AS n_before,
  count(*) FILTER (WHERE (l_orderkey + l_linenumber) % 10 <> 0) AS n_after
FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1""",
)
_add("after_image_log", ORDER_LOG, f"SELECT {_select(ORDER_LOG_TEXTS)} FROM olog")
_add(
    "before_image_log",
    f"{ORDERS}, olog AS ({_diff('o', 'o_orderkey', '', '', ORDER_COLUMNS)})",
    f"SELECT {_select(ORDER_LOG_TEXTS)} FROM olog",
)
_end = """SELECT '{0}' AS table_name, {1} AS cursor_ts, log_id AS cursor_id,
  CAST(0 AS BIGINT) AS replayed
FROM {2} ORDER BY log_timestamp DESC, log_id DESC LIMIT 1"""
_add(
    "bootstrap_cutover",
    f"{ORDER_LOG}, {CUSTOMER_LOG}",
    f"({_end.format('orders', _text('log_timestamp'), 'olog')}) UNION ALL "
    f"({_end.format('customer', _text('log_timestamp'), 'clog')})",
)

_add("seal_records", SHOP, "SELECT * FROM orders_sealed")
_add(
    "verify_records",
    VERIFIED,
    """
SELECT k AS key, reason = '' AS is_valid, known_id AS message_id,
  nullif(reason, '') AS error_reason
FROM verified""",
)
_add(
    "valid_records",
    VERIFIED,
    """
SELECT value, 'changes' AS topic, CAST(k % 4 AS INTEGER) AS "partition", k AS "offset"
FROM verified WHERE reason = ''""",
)
_add(
    "dead_letters",
    VERIFIED,
    """
SELECT value AS original_record, reason AS error_reason, known_id AS message_id,
  CAST(sent AS BIGINT) AS "timestamp", 'changes' AS topic,
  CAST(k % 4 AS INTEGER) AS "partition", k AS "offset"
FROM verified WHERE reason <> ''""",
)
_add(
    "publish_topic",
    VERIFIED,
    """
SELECT CASE WHEN reason = '' THEN 'verified' ELSE 'rejected' END AS topic,
  CASE WHEN reason = '' THEN value END AS message, nullif(reason, '') AS error_reason,
  CASE WHEN reason <> '' THEN k END AS "offset",
  CASE WHEN reason NOT IN ('', 'Malformed JSON')
       THEN '2024-06-01T00:00:00.000000' END AS original_producer_timestamp
FROM verified""",
)
_add(
    "parse_envelopes", SHOP, f"{_wide('orders')} UNION ALL BY NAME {_wide('customer')}"
)
_add(
    "route_by_table",
    MIXED,
    """
SELECT CASE lower(table_name) WHEN 'orders' THEN 'orders' WHEN 'customer' THEN 'customer'
       ELSE '(unrouted)' END AS route, table_name, log_id, status
FROM mixed WHERE table_name IS NOT NULL AND table_name <> 'REPO_OWNERSHIP'""",
)
_created = _SECONDS.format("created_at")
_add(
    "cdc_users",
    _feed_diff(USERS, "users", "user_id", "login", USER_COLUMNS),
    f"""
SELECT user_id AS _id, status, login, avatar_url, url, type, site_admin,
  {_created} AS created_at FROM flog""",
)
_add(
    "cdc_repos",
    _feed_diff(REPOS, "repos", "repo_id", "name", REPO_COLUMNS),
    f"""
SELECT repo_id AS _id, status, name, full_name, description, is_private, is_fork, language,
  size, {_created} AS created_at FROM flog""",
)
_add(
    "cdc_orgs",
    _feed_diff(ORGS, "orgs", "org_id", "login", ORG_COLUMNS),
    f"""
SELECT org_id AS _id, status, login, avatar_url, {_text("log_timestamp")} AS log_timestamp,
  log_id FROM flog""",
)
_add(
    "cdc_events",
    _feed_diff(FACT, "fact", "event_id", "event_type", FACT_COLUMNS),
    f"""
SELECT event_id AS _id, status, event_type AS type, actor_id, repo_id, org_id, is_public,
  {_created} AS created_at FROM flog""",
)
_add(
    "cdc_fallback",
    SHOP,
    """
SELECT status, log_id, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  o_orderpriority, CAST(NULL AS BIGINT) AS c_custkey, CAST(NULL AS VARCHAR) AS c_name,
  CAST(NULL AS INTEGER) AS c_nationkey, CAST(NULL AS VARCHAR) AS c_acctbal,
  CAST(NULL AS VARCHAR) AS c_mktsegment
FROM orders_sealed""",
)
_add(
    "non_null_columns",
    MIXED,
    """
SELECT route, column_name,
  (SELECT count(*) FROM mixed WHERE lower(table_name) = route) AS non_nulls
FROM (VALUES ('table_name'), ('status'), ('log_timestamp'), ('message_id'), ('hash'),
  ('log_id'), ('c_custkey'), ('c_name'), ('c_nationkey'), ('c_acctbal'), ('c_mktsegment'),
  ('o_orderkey'), ('o_custkey'), ('o_orderstatus'), ('o_totalprice'), ('o_orderdate'),
  ('o_orderpriority')) AS t(column_name)
JOIN (VALUES ('customer'), ('orders')) AS r(route)
  ON column_name[2] <> '_' OR column_name[1] = route[1]""",
)
_add(
    "run_stream",
    VERIFIED,
    """
SELECT 'orders' AS collection, l.o_orderkey AS key, l.status, l.log_id
FROM olog l JOIN orders_verified v ON l.o_orderkey = v.k
WHERE v.reason = '' AND l.status <> 'DELETE'
UNION ALL
SELECT 'customer', l.c_custkey, l.status, l.log_id
FROM clog l JOIN customer_verified v ON l.c_custkey = v.k
WHERE v.reason = '' AND l.status <> 'DELETE'
UNION ALL
SELECT 'dead_letters', NULL, reason, NULL FROM verified WHERE reason <> ''""",
)
_add("apply_upsert", ROUNDS, f"{_APPLIED} FROM applied")
_add("apply_late_changes", ROUNDS, f"{_APPLIED} FROM applied")
_add(
    "apply_deletes",
    ROUNDS,
    f"{_APPLIED} FROM applied WHERE status IS NULL OR status <> 'DELETE'",
)
_add(
    "apply_patch",
    ROUNDS,
    f"""
SELECT a._id,
  CASE WHEN a.status IS NULL OR a.status = 'UPDATE' AND a._id % 10 <> 2
       THEN o.o_custkey END AS o_custkey,
  a.o_orderstatus, CAST(a.o_totalprice AS VARCHAR) AS o_totalprice,
  CASE WHEN a.status IS NULL OR a.status = 'UPDATE' AND a._id % 10 <> 2
       THEN {_text("o.o_orderdate")} END AS o_orderdate,
  a.o_orderpriority, a.status, a.log_id
FROM applied a JOIN o ON a._id = o.o_orderkey""",
)
_add(
    "document_sink",
    ROUNDS,
    """SELECT o_orderkey AS _id, o_custkey, o_orderstatus,
  CAST(o_totalprice AS VARCHAR) AS o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS o_orderdate,
  o_orderpriority, status, log_id FROM latest""",
)
_add("bucketed_upsert", ROUNDS, f"{_APPLIED} FROM applied")
_add("stream_round_trip", BOTH_TARGETS, _SHOP_ROWS)
_add(
    "stream_dedup",
    SHOP,
    """
SELECT message_id, log_id, 1 AS passed FROM orders_wire
UNION ALL
SELECT 'late', NULL, count(*) FROM olog WHERE log_id % 50 = 7""",
)
_positions = {"users": 1, "repos": 2, "orgs": 3, "events": 4, "repo_ownership": 5}
_add(
    "ordered_load",
    LOADED,
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {_COUNTS}, 'equal' AS verdict, "
        f"CAST({_positions[name]} AS BIGINT) AS position FROM {cte}"
        for name, cte, _ in _TABLES
    ),
)
_add(
    "bootstrap_tables",
    LOADED,
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, "
        f"'{_STORED.get(c, 'string')}' AS data_type, count({c}) AS non_nulls FROM {cte}"
        for name, cte, columns in _TABLES
        for c in columns
    ),
)

_orders_counts = """SELECT (SELECT count(*) FROM o) AS source_count,
  (SELECT count(*) FROM target) AS target_count"""
_lines_counts = """SELECT (SELECT count(*) FROM lineitem),
  (SELECT count(*) FROM doubled)"""
_add(
    "reconcile_counts",
    f"{ORDER_TARGET}, {LINES}",
    f"""
SELECT *, abs(source_count - target_count) AS gap,
  CASE WHEN source_count = target_count THEN 'equal' ELSE 'different' END AS verdict
FROM ({_orders_counts}, 'orders' AS table_name
  UNION ALL {_lines_counts}, 'lineitem')""",
)
_line = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_shipdate"
_add(
    "reconcile_content",
    f"{ORDER_TARGET}, {LINES}",
    f"""
SELECT *, abs(source_count - target_count) AS gap,
  CASE WHEN missing = 0 AND unexpected = 0 THEN 'equal' ELSE 'different' END AS verdict
FROM (
  {_orders_counts}, 'orders' AS table_name,
    (SELECT count(*) FROM (SELECT * FROM o EXCEPT ALL SELECT * FROM target)) AS missing,
    (SELECT count(*) FROM (SELECT * FROM target EXCEPT ALL SELECT * FROM o)) AS unexpected
  UNION ALL
  {_lines_counts}, 'lineitem',
    (SELECT count(*) FROM (SELECT {_line} FROM lineitem EXCEPT ALL SELECT * FROM doubled)),
    (SELECT count(*) FROM (SELECT * FROM doubled EXCEPT ALL SELECT {_line} FROM lineitem))
)""",
)
_add(
    "missing_rows",
    LINES,
    f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag,
  {_text("l_shipdate")} AS l_shipdate
FROM (SELECT * FROM doubled EXCEPT ALL SELECT {_line} FROM lineitem)""",
)
_add(
    "unexpected_rows",
    ORDER_TARGET,
    f"SELECT {_select(ORDER_TEXTS)} FROM (SELECT * FROM target EXCEPT ALL SELECT * FROM o)",
)
_add(
    "reconcile_tree",
    ORDER_TARGET,
    f"""
SELECT 'missing' AS side, {_select(ORDER_TEXTS)} FROM (SELECT * FROM o EXCEPT ALL SELECT * FROM target)
UNION ALL
SELECT 'unexpected', {_select(ORDER_TEXTS)} FROM (SELECT * FROM target EXCEPT ALL SELECT * FROM o)""",
)
_add(
    "missing_tables",
    "",
    """
SELECT table_name
FROM (VALUES ('view'), ('click'), ('purchase'), ('signup'), ('fork'), ('star')) t(table_name)
WHERE table_name NOT IN (SELECT lower(event_type) FROM events)""",
)
_add(
    "probe_row",
    "",
    """
SELECT probe, probe IN (SELECT o_orderkey FROM orders) AS found
FROM (VALUES (1), (-1)) t(probe)""",
)
_add(
    "schema_violations",
    DOCUMENTS,
    """
SELECT _id, path, coalesce(found, 'missing') AS found_type,
  CASE WHEN found IS NULL THEN 'required' ELSE 'type' END AS rule
FROM typed
WHERE (found IS NULL AND required) OR (found IS NOT NULL AND NOT list_contains(allowed, found))
UNION ALL
SELECT NULL, '$', CASE WHEN j IS NULL THEN 'unparsable' ELSE 'array' END, 'type'
FROM docs WHERE j IS NULL OR j = '[1]'""",
)
_add(
    "null_violations",
    FACT,
    """
SELECT event_id, 'event_id' AS column_name FROM fact WHERE event_id IS NULL
UNION ALL SELECT event_id, 'event_type' FROM fact WHERE event_type IS NULL
UNION ALL SELECT event_id, 'created_at' FROM fact WHERE created_at IS NULL""",
)
_add(
    "unique_violations",
    "",
    """
SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY ALL HAVING count(*) > 1""",
)
_lines_cols = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_add(
    "orphans",
    "",
    f"""
SELECT {_lines_cols} FROM lineitem l WHERE NOT EXISTS (
  SELECT 1 FROM orders WHERE o_orderkey = l.l_orderkey AND o_orderkey % 10 <> 0)""",
)
_add(
    "cascade_delete",
    "",
    f"""
SELECT {_lines_cols} FROM lineitem WHERE l_orderkey NOT IN (
  SELECT o_orderkey FROM orders WHERE o_orderkey % 10 = 0)""",
)
_add(
    "cascade_set_null",
    "",
    """
SELECT o_orderkey, CASE WHEN o_custkey NOT IN (
    SELECT c_custkey FROM customer WHERE c_custkey % 10 = 0) THEN o_custkey END AS o_custkey,
  o_orderstatus FROM orders""",
)
_add(
    "cascade_graph",
    LOADED,
    """
SELECT 'users' AS table_name, count(*) AS row_count, count(*) AS fk_count
FROM users WHERE user_id % 10 <> 0
UNION ALL SELECT 'orgs', count(*), count(*) FROM orgs WHERE org_id % 5 <> 0
UNION ALL
SELECT 'events', count(*), count(CASE WHEN org_id % 5 <> 0 THEN 1 END)
FROM fact WHERE actor_id IS NULL OR actor_id % 10 <> 0
UNION ALL
SELECT 'repo_ownership', count(*), count(CASE WHEN owner_user_id % 10 <> 0 THEN 1 END)
FROM ownership""",
)
_add(
    "cascade_closure",
    """RECURSIVE cust AS (
  SELECT CAST(c_custkey AS BIGINT) AS c_custkey,
    CASE WHEN c_custkey > 6 THEN CAST(c_custkey // 7 AS BIGINT) END AS c_referrer,
    CASE WHEN c_custkey % 9 = 0 THEN CAST(c_custkey * 2 AS BIGINT) END AS c_order
  FROM customer
), links AS (
  SELECT 'customer' AS t, c_custkey AS k, 'customer' AS pt, c_referrer AS pk FROM cust
  UNION ALL SELECT 'customer', c_custkey, 'orders', c_order FROM cust
  UNION ALL SELECT 'orders', o_orderkey, 'customer', o_custkey FROM orders
), gone AS (
  SELECT 'customer' AS t, c_custkey AS k FROM cust WHERE c_custkey % 97 = 5
  UNION
  SELECT l.t, l.k FROM gone g JOIN links l ON l.pt = g.t AND l.pk = g.k
)""",
    """
SELECT 'customer' AS table_name, c_custkey AS key, c_referrer AS parent
FROM cust WHERE c_custkey NOT IN (SELECT k FROM gone WHERE t = 'customer')
UNION ALL
SELECT 'orders', o_orderkey, o_custkey
FROM orders WHERE o_orderkey NOT IN (SELECT k FROM gone WHERE t = 'orders')
UNION ALL
SELECT 'lineitem', l_orderkey * 10 + l_linenumber,
  CASE WHEN l_orderkey NOT IN (SELECT k FROM gone WHERE t = 'orders') THEN l_orderkey END
FROM lineitem
UNION ALL
SELECT 'gone from ' || t, k, NULL FROM gone""",
)
_add(
    "fill_defaults",
    REPOS,
    """
SELECT repo_id, name, CAST(NULL AS VARCHAR) AS full_name, CAST(NULL AS INTEGER) AS size,
  0 AS forks_count, 0 AS stargazers_count,
  CASE WHEN repo_id % 2 = 0 THEN watchers_count END AS watchers_count
FROM repos""",
)
_add(
    "length_violations",
    "",
    """
SELECT doc_id, 'text' AS column_name, CAST(length(text) AS INTEGER) AS found_length
FROM documents WHERE length(text) > 512
UNION ALL
SELECT doc_id, 'source', CAST(length(source) AS INTEGER) FROM documents WHERE length(source) > 4""",
)

_reports = [
    f"SELECT 'tables/{name}' AS table_name, count(*) AS n FROM {cte}"
    for name, cte, _ in _TABLES
] + [
    "SELECT 'collections/users', count(*) FROM users",
    "SELECT 'collections/orgs', count(*) FROM orgs",
    "SELECT 'collections/repos', count(DISTINCT _id) FROM repo_docs",
    "SELECT 'collections/events', count(DISTINCT id) FROM raw",
]
_add(
    "batch_load_report",
    f"{LOADED}, {REPO_DOCS.removeprefix(RAW).lstrip(',')}",
    f"""
SELECT table_name, n AS source_count, n AS target_count, CAST(0 AS BIGINT) AS gap,
  CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS unexpected, 'equal' AS verdict
FROM ({" UNION ALL ".join(_reports)})""",
)
_add(
    "cdc_round_trip",
    BOTH_TARGETS,
    _SHOP_ROWS,
)
