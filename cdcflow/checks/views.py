"""Operator inputs derived from the given tables.

The same derivations are written in SQL in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.functions.times import FEED_PATTERN
from cdcflow.operators.capture import after_image_log, snapshot_diff
from cdcflow.operators.entities import events_fact, orgs_dim, repos_dim, users_dim
from cdcflow.operators.envelope import message_id, seal_records
from cdcflow.specs import EVENTS, ORGS, REPOS, USERS, TableSpec
from cdcflow.specs import Column as Field

LONG, INT, STRING = T.LongType(), T.IntegerType(), T.StringType()
MONEY = T.DecimalType(18, 2)

ORDERS = TableSpec(
    name="orders",
    key="o_orderkey",
    columns=(
        Field("o_orderkey", LONG, required=True, unique=True),
        Field("o_custkey", LONG),
        Field("o_orderstatus", STRING),
        Field("o_totalprice", MONEY),
        Field("o_orderdate", T.TimestampType(), digits=0),
        Field("o_orderpriority", STRING),
    ),
)
CUSTOMER = TableSpec(
    name="customer",
    key="c_custkey",
    columns=(
        Field("c_custkey", LONG, required=True, unique=True),
        Field("c_name", STRING),
        Field("c_nationkey", INT),
        Field("c_acctbal", MONEY),
        Field("c_mktsegment", STRING),
    ),
)
SHOP = {"orders": ORDERS, "customer": CUSTOMER}

FORK_TYPE = "purchase"
PRODUCED_AT = "2024-06-01T00:00:00.000000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def typed(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.select(*[F.col(c.name).cast(c.type).alias(c.name) for c in spec.columns])


# --- raw feed ----------------------------------------------------------------


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed events out of events, their customer, its nation and a part."""
    events = table(spark, sf_dir, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("bigint")
    )
    # these grow with the events: below Spark's threshold each would go through the driver
    customer = table(spark, sf_dir, "customer").hint("merge")
    nation = table(spark, sf_dir, "nation")
    part = table(spark, sf_dir, "part").hint("merge")
    joined = (
        events.join(customer, F.col("user_id") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(part, F.col("k") == F.col("p_partkey"))
    )
    key, user, k = F.col("event_id"), F.col("user_id"), F.col("k")
    created = F.when(key % 97 == 0, "bad").otherwise(F.date_format("ts", FEED_PATTERN))
    in_org = F.col("event_type").isin("view", "click")
    org_id = F.when(in_org, F.col("n_nationkey").cast("bigint"))
    owner = 10000 + (user + 1) % 200

    actor = F.struct(
        F.when(key % 50 != 0, user).alias("id"),
        F.col("c_name").alias("login"),
        F.concat(F.lit("u/"), user.cast("string")).alias("url"),
        F.concat(F.lit("a/"), user.cast("string")).alias("avatar_url"),
    )
    repo = F.struct(
        k.alias("id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("r/"), k.cast("string")).alias("url"),
    )
    org = F.struct(
        org_id.alias("id"),
        F.col("n_name").alias("login"),
        F.concat(F.lit("o/"), org_id.cast("string")).alias("url"),
        F.lit(None).cast("string").alias("avatar_url"),
    )
    forkee = F.struct(
        (1000 + k * 10 + user % 10).alias("id"),
        F.col("p_name").alias("name"),
        F.concat_ws("/", "c_name", "p_name").alias("full_name"),
        F.struct(
            F.when(key % 29 != 0, owner).alias("id"),
            F.concat(F.lit("w"), owner.cast("string")).alias("login"),
            F.lit("User").alias("type"),
        ).alias("owner"),
        F.lit(False).alias("private"),
        F.lit(True).alias("fork"),
        *[F.lit(None).cast("string").alias(n) for n in ("html_url", "description", "homepage")],
        F.col("p_size").alias("size"),
        F.col("p_brand").alias("language"),
        k.cast("int").alias("forks_count"),
        (k + 1).cast("int").alias("stargazers_count"),
        (k + 2).cast("int").alias("watchers_count"),
        F.lit(None).cast("string").alias("default_branch"),
        created.alias("created_at"),
        created.alias("updated_at"),
        created.alias("pushed_at"),
    )
    forked = (F.col("event_type") == FORK_TYPE) | (key % 13 == 0)
    payload = F.struct(
        F.when(forked, forkee).alias("forkee"),
        F.col("event_type").alias("ref"),
        F.lit(None).cast("string").alias("head"),
    )
    copies = F.when(key % 100 == 7, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    return joined.withColumn("copy", F.explode(copies)).select(
        key.cast("string").alias("id"),
        F.col("event_type").alias("type"),
        (key % 10 != 0).alias("public"),
        created.alias("created_at"),
        actor.alias("actor"),
        repo.alias("repo"),
        org.alias("org"),
        payload.alias("payload"),
    )


# --- snapshots and change logs -----------------------------------------------


def snapshots(rows: DataFrame, key: str, changed: str, new: Column):
    """Rows before and after: by key, some deleted, updated, inserted."""
    rest = F.pmod(F.col(key).cast("bigint"), F.lit(10))
    before = rows.filter(rest != 2)
    after = rows.filter(rest != 0)
    return before, after.withColumn(
        changed, F.when(rest == 1, new).otherwise(F.col(changed))
    )


def shop_snapshots(spark, sf_dir, name):
    spec = SHOP[name]
    amount = {"orders": "o_totalprice", "customer": "c_acctbal"}[name]
    rows = typed(table(spark, sf_dir, name), spec)
    new = (F.col(amount) + 1).cast(MONEY)
    return snapshots(rows, spec.key, amount, new)


def log_time(spec: TableSpec) -> Column:
    """Thousand distinct milliseconds, so that many changes share one."""
    ms = 1704067200000 + F.pmod(F.col(spec.key).cast("bigint"), F.lit(1000))
    return F.timestamp_millis(ms)


def log_number(spec: TableSpec) -> Column:
    return F.col(spec.key).cast("bigint")


def change_log(before: DataFrame, after: DataFrame, spec: TableSpec) -> DataFrame:
    changes = snapshot_diff(before, after, [spec.key])
    return after_image_log(changes, log_time(spec), log_number(spec))


def shop_log(spark, sf_dir, name):
    before, after = shop_snapshots(spark, sf_dir, name)
    return change_log(before, after, SHOP[name])


def feed_log(spark, sf_dir, name):
    """Change log of a feed table between two states of it."""
    raw = raw_events(spark, sf_dir)
    build, spec, changed = {
        "users": (users_dim, USERS, "login"),
        "repos": (repos_dim, REPOS, "name"),
        "orgs": (orgs_dim, ORGS, "login"),
        "events": (lambda df: events_fact(df, FORK_TYPE), EVENTS, "event_type"),
    }[name]
    new = F.concat(F.col(changed), F.lit("!"))
    before, after = snapshots(build(raw), spec.key, changed, new)
    return change_log(before, after, spec), spec


# --- messages ----------------------------------------------------------------


def shop_messages(spark, sf_dir, name) -> DataFrame:
    log = shop_log(spark, sf_dir, name)
    return seal_records(log, SHOP[name], PRODUCED_AT)


def damaged_messages(spark, sf_dir, name) -> DataFrame:
    """Sealed changes, some damaged by key, with source coordinates."""
    spec = SHOP[name]
    key = F.col(spec.key)
    identity = F.when(key % 29 != 0, message_id(spec))
    log = shop_log(spark, sf_dir, name)
    value = F.col("value")

    def where(every, pattern):
        # a pattern that never matches where the key asks for no damage
        return F.when(key % every == 0, F.lit(pattern)).otherwise(F.lit("\n"))

    def but_last(text):
        return F.char_length(text) - F.when(key % 31 == 0, 5).otherwise(0)

    broken = F.replace(value, where(17, '"status":"'), F.lit('"status":"X'))
    broken = F.replace(
        broken, where(19, f'"table_name":"{name}"'), F.lit('"table_name":null')
    )
    broken = F.regexp_replace(
        broken, where(23, '"hash":"[0-9a-f]*"'), F.lit('"hash":null')
    )
    return (
        seal_records(log, spec, PRODUCED_AT, message=identity)
        .withColumn("value", broken)
        .withColumn("value", value.substr(F.lit(1), but_last(value)))
        .select(
            value.cast("binary").alias("value"),
            F.timestamp_millis(1704067200000 + key).alias("timestamp"),
            F.lit("changes").alias("topic"),
            (key % 4).cast("int").alias("partition"),
            key.alias("offset"),
        )
    )


def all_damaged(spark, sf_dir) -> DataFrame:
    return damaged_messages(spark, sf_dir, "orders").unionByName(
        damaged_messages(spark, sf_dir, "customer")
    )
