import json

import pytest
from cdcflow.checks import views
from cdcflow.operators import integrity, reconcile
from cdcflow.operators.entities import feed_tables
from cdcflow.session import new_dir
from cdcflow.sources import files
from cdcflow.specs import CASCADE, DOCUMENT_RULES, FEED_TABLES, SET_NULL, ForeignKey, TableSpec
from cdcflow.specs import Column as Field
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG = T.LongType()


def violations(spark, collection, *docs):
    texts = [(d if isinstance(d, str) or d is None else json.dumps(d),) for d in docs]
    found = integrity.schema_violations(
        spark.createDataFrame(texts, "json string"), DOCUMENT_RULES[collection]
    )
    return sorted((r.path, r.found_type, r.rule) for r in found.collect())


GOOD = {
    "users": {"_id": 1, "login": "l", "avatar_url": None, "site_admin": True},
    "orgs": {"_id": 2**40, "login": None},
    "repos": {"_id": 1, "stats": {"size": 1, "forks_count": None}, "owner": None,
              "dates": {"created_at": "2024"}},
    "events": {"_id": "1", "type": None, "payload": {"forkee": None, "ref": "r"}, "org": None},
}


@pytest.mark.parametrize("collection", GOOD)
def test_sound_documents(spark, collection):
    assert violations(spark, collection, GOOD[collection]) == []


WRONG = {"int": "x", "string": 1, "bool": 0, "object": [1]}


@pytest.mark.parametrize("collection", GOOD)
def test_one_wrong_type_per_field(spark, collection):
    for_rules, expected = [], []
    for rule in DOCUMENT_RULES[collection]:
        value = WRONG[rule.types[0]]
        doc = json.loads(json.dumps(GOOD[collection]))
        at = doc
        *parents, leaf = rule.path.split(".")
        for parent in parents:
            if not isinstance(at.get(parent), dict):
                at[parent] = {}
            at = at[parent]
        at[leaf] = value
        kind = {str: "string", int: "int", list: "array"}[type(value)]
        for_rules.append(doc)
        expected.append((rule.path, kind, "type"))
    assert violations(spark, collection, *for_rules) == sorted(expected)


def test_missing_is_not_null(spark):
    assert violations(spark, "users", {"_id": 1}) == [("login", "missing", "required")]
    assert violations(spark, "users", {"_id": 1, "login": None}) == [("login", "null", "type")]
    assert violations(spark, "events", {"_id": "1"}) == [("type", "missing", "required")]


def test_unreadable_documents(spark):
    found = violations(spark, "orgs", "oops", None, "[1]", "5", " {\"_id\": 1}")
    assert found == [("$", "array", "type"), ("$", "int", "type"),
                     ("$", "unparsable", "type"), ("$", "unparsable", "type")]


def test_constraints(spark):
    users = spark.createDataFrame(
        [(1, "a" * 256, "t"), (1, None, "é" * 50), (2, None, "é" * 51)],
        "user_id bigint, login string, type string",
    )
    spec = FEED_TABLES["users"]
    nulls = integrity.null_violations(users, spec).collect()
    assert sorted(map(tuple, nulls)) == [(1, "login"), (2, "login")]
    lengths = integrity.length_violations(users, spec).collect()
    assert sorted(map(tuple, lengths)) == [(1, "login", 256), (2, "type", 51)]
    assert [tuple(r) for r in integrity.unique_violations(users, ["user_id"]).collect()] == [(1, 2)]
    assert integrity.unique_violations(users, ["login"]).count() == 0


def test_defaults_fill_absent_columns_only(spark):
    repos = spark.createDataFrame([(1, None)], "repo_id bigint, forks_count int")
    row = integrity.fill_defaults(repos, FEED_TABLES["repos"], "2024-01-01").first()
    assert (row.forks_count, row.watchers_count, row.created_at) == (None, 0, None)
    user = integrity.fill_defaults(
        spark.createDataFrame([(1,)], "user_id bigint"), FEED_TABLES["users"], "2024-01-01"
    ).first()
    assert str(user.created_at) == "2024-01-01 00:00:00" and user.login is None


def test_missing_tables_and_probe(spark):
    present = spark.createDataFrame([("USERS",), ("orgs",)], "name string")
    required = ["users", "Repos", "orgs"]
    missing = integrity.missing_tables(spark, required, present)
    assert [r.table_name for r in missing.collect()] == ["repos"]
    present.createOrReplaceTempView("orgs")
    missing = integrity.missing_tables(spark, required)
    assert sorted(r.table_name for r in missing.collect()) == ["repos", "users"]
    spark.catalog.dropTempView("orgs")
    assert integrity.probe_row(present, "name", "orgs").first().found is True
    assert integrity.probe_row(present, "name", "x").first().found is False


# --- foreign keys ---

A = TableSpec("a", "id", (Field("id", LONG),))
B = TableSpec("b", "id", (Field("id", LONG), Field("a", LONG)), (ForeignKey("a", "a", CASCADE),))
C = TableSpec(
    "c", "id", (Field("id", LONG), Field("b", LONG), Field("a", LONG)),
    (ForeignKey("b", "b", CASCADE), ForeignKey("a", "a", SET_NULL)),
)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_orphans(spark):
    parent = spark.createDataFrame([(1,)], "id bigint")
    child = spark.createDataFrame([(10, 1), (11, 2), (12, None)], "id bigint, a bigint")
    assert rows(integrity.orphans(child, "a", parent, "id")) == [(11, 2)]


def test_deletes_run_down_the_graph(spark):
    tables = {
        "a": spark.createDataFrame([(1,), (2,)], "id bigint"),
        "b": spark.createDataFrame([(10, 1), (20, 2), (30, None)], "id bigint, a bigint"),
        "c": spark.createDataFrame(
            [(100, 10, 2), (200, 20, 1), (300, None, 1), (400, 30, 2)],
            "id bigint, b bigint, a bigint",
        ),
    }
    keys = spark.createDataFrame([(1,), (1,)], "id bigint")
    left, gone = integrity.cascade(tables, [C, B, A], {"a": keys})
    assert rows(left["a"]) == [(2,)]
    assert rows(left["b"]) == [(20, 2), (30, None)]
    assert rows(left["c"]) == [(200, 20, None), (300, None, None), (400, 30, 2)]
    assert {n: rows(k) for n, k in gone.items()} == {
        "a": [(1,)] if gone["a"].count() == 1 else [(1,), (1,)], "b": [(10,)], "c": [(100,)],
    }


def test_a_parent_of_a_third_of_the_children(spark):
    child = spark.range(30000).selectExpr("id", "IF(id % 3 = 0, 0, id) AS a", "'v' AS v")
    deleted = spark.createDataFrame([(0,), (1,), (0,)], "k bigint")
    emptied = integrity.cascade_set_null(child, "a", deleted)
    assert emptied.columns == child.columns
    assert (emptied.count(), emptied.filter("a IS NULL").count()) == (30000, 10001)
    assert integrity.cascade_delete(child, "a", deleted).count() == 19999


def test_a_table_that_refers_to_itself_is_refused(spark):
    fields = (Field("id", LONG), Field("up", LONG))
    tree = TableSpec("tree", "id", fields, (ForeignKey("up", "tree", CASCADE),))
    rows = spark.createDataFrame([(1, None), (2, 1), (3, 2)], "id bigint, up bigint")
    with pytest.raises(ValueError, match="refers to itself"):
        integrity.cascade({"tree": rows}, [tree], {"tree": rows.select("id").limit(1)})


def test_deletes_run_through_chains_and_circles(spark):
    fields = (Field("id", LONG), Field("up", LONG), Field("b", LONG))
    tree = TableSpec("tree", "id", fields, (ForeignKey("up", "tree", CASCADE), ForeignKey("b", "b", SET_NULL)))
    b = TableSpec("b", "id", (Field("id", LONG), Field("tree", LONG)), (ForeignKey("tree", "tree", CASCADE),))
    # 1 <- 2 <- 3 ... <- 9, 20 and 21 refer to each other, 30 to itself, one row has no key
    links = [(1, None, 100), *((i, i - 1, 102) for i in range(2, 10)), (20, 21, 100), (21, 20, 101), (30, 30, 102), (None, 4, None)]
    tables = {
        "tree": spark.createDataFrame(links, "id bigint, up bigint, b bigint"),
        "b": spark.createDataFrame([(100, 7), (101, 21), (102, None)], "id bigint, tree bigint"),
    }
    deleted = {"tree": spark.createDataFrame([(3,), (20,), (20,), (77,)], "id bigint")}
    left, gone = integrity.cascade_closure(tables, [tree, b], deleted)
    assert sorted(r[0] for r in gone["tree"].collect() if r[0]) == [3, 4, 5, 6, 7, 8, 9, 20, 21, 77]
    assert rows(gone["b"]) == [(100,), (101,)]
    assert rows(left["tree"]) == [(1, None, None), (2, 1, 102), (30, 30, 102)]
    assert rows(left["b"]) == [(102, None)]


def test_the_plan_of_a_closure_does_not_grow_with_its_chains(spark):
    tree = TableSpec("tree", "id", (Field("id", LONG), Field("up", LONG)), (ForeignKey("up", "tree", CASCADE),))
    links = spark.createDataFrame([(None, 11), *((i, i - 1) for i in range(2, 13))], "id bigint, up bigint")
    left, gone = integrity.cascade_closure({"tree": links}, [tree], {"tree": spark.createDataFrame([(3,)], "id int")})
    assert sorted(r[0] or 0 for r in gone["tree"].collect()) == [0, *range(3, 13)]
    assert rows(left["tree"]) == [(2, 1)]
    assert gone["tree"]._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_a_plan_of_the_graph_reads_a_table_once_a_use(spark):
    raw = files.land_parquet(views.raw_events(spark, "/root/testdata/sf0.001"), new_dir(spark, "raw"))
    tables = {n: files.land_parquet(t, new_dir(spark, n)) for n, t in feed_tables(raw).items()}
    users = tables["users"].filter("user_id % 10 = 0").select("user_id")
    left, _ = integrity.cascade(tables, FEED_TABLES.values(), {"users": users})
    plan = left["events"]._jdf.queryExecution().executedPlan().toString()
    # the table itself, and the keys that went: of users twice if two keys refer to them
    assert plan.count("FileScan") <= 1 + 3


# --- reconciliation ---


def test_only_rows_of_differing_leaves_are_compared(spark):
    source = spark.range(20_000).selectExpr("id", "IF(id % 3 = 0, NULL, id) AS a", "IF(id % 3 = 0, id, NULL) AS b")
    target = source.withColumn("a", F.when(F.col("id") == 7, -7).otherwise(F.col("a"))).filter("id <> 9").unionByName(source.filter("id = 5"))
    trees = [reconcile.digest_tree(df) for df in (source, target)]
    differ = reconcile.differing_branches(*trees).collect()
    leaves = [r for r in differ if r.bits == reconcile.LEAF_BITS]
    assert 1 <= len(leaves) <= 4 and sum(r.bits == 0 for r in differ) == 1
    found = sorted((r.side, r.id, r.a) for r in reconcile.reconcile_tree(source, target).collect())
    assert found == [("missing", 7, 7), ("missing", 9, None), ("unexpected", 5, 5), ("unexpected", 7, -7)]
    assert reconcile.reconcile_tree(source, source.repartition(7)).count() == 0
    assert reconcile.reconcile_tree(source.limit(0), source.limit(0)).count() == 0
    swapped = source.select("id", F.col("b").alias("a"), F.col("a").alias("b"))
    assert reconcile.reconcile_tree(source, swapped).count() == 2 * 20_000




def test_digests_tell_nested_values_apart(spark):
    nested = [
        "named_struct('t', TIMESTAMP '2024-01-01 00:00:00.000001')", "named_struct('t', TIMESTAMP '2024-01-01 00:00:00.000002')",
        "named_struct('t', CAST(NULL AS TIMESTAMP))", "CAST(NULL AS STRUCT<t: TIMESTAMP>)",
        "named_struct('a', named_struct('x', 1, 'y', CAST(NULL AS INT)))", "named_struct('a', named_struct('x', CAST(NULL AS INT), 'y', 1))",
        "array(1, NULL)", "array(NULL, 1)",
    ]
    digests = {tuple(d.agg(*reconcile.row_digests(d)).first()) for d in (spark.sql(f"SELECT 1 AS id, {v} AS v") for v in nested)}
    assert len(digests) == len(nested)


def test_equal_counts_of_different_rows_do_not_pass(spark):
    a = spark.createDataFrame([(1, None), (2, "x"), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "x"), (3, "x")], "k int, v string")
    assert tuple(reconcile.reconcile_counts(a, b).first()) == (3, 3, 0, "equal")
    assert tuple(reconcile.reconcile(a, b).first()) == (3, 3, 0, 1, 1, "different")
    assert rows(reconcile.missing_rows(a, b)) == [(2, "x")]
    assert rows(reconcile.unexpected_rows(a, b)) == [(3, "x")]


def test_reconcile_is_multiset_and_takes_empty_sides(spark):
    a = spark.createDataFrame([(1,)], "k int")
    doubled = a.union(a)
    assert tuple(reconcile.reconcile(a, doubled).first()) == (1, 2, 1, 0, 1, "different")
    assert tuple(reconcile.reconcile(a, a).first()) == (1, 1, 0, 0, 0, "equal")
    none = a.limit(0)
    assert tuple(reconcile.reconcile(none, none).first()) == (0, 0, 0, 0, 0, "equal")
    assert tuple(reconcile.reconcile_counts(none, a).first()) == (0, 1, 1, "different")


def test_many_copies_of_one_row_are_multiplied_in_portions(spark):
    source = spark.range(0, 60000, 1, 8).selectExpr(
        "IF(id % 3 = 0, NULL, id) AS k", "'v' AS v"
    )
    target = source.filter("k IS NULL").limit(5).union(source.filter("k < 10"))
    found = reconcile.missing_rows(source, target)
    assert found.count() == 60000 - 5 - 6
    assert found.filter("k IS NULL").count() == 20000 - 5
    exact = source.exceptAll(target)
    assert found.exceptAll(exact).count() == 0 and exact.exceptAll(found).count() == 0
    tasks = found.filter("k IS NULL").select(F.spark_partition_id()).distinct().count()
    assert tasks > 1
