from cdcflow.checks.queries import QUERIES
from cdcflow.operators import routing
from cdcflow.specs import FEED_TABLES, load_order, wide_schema
from pyspark.sql import types as T

NAMES = ["Users", "users", "REPO_OWNERSHIP", "other", None]


def parsed(spark):
    rows = [(f'{{"table_name":"{n}","user_id":{i},"site_admin":1,"producer_timestamp":"p"}}',)
            if n else (f'{{"user_id":{i}}}',) for i, n in enumerate(NAMES)]
    return routing.parse_envelopes(spark.createDataFrame(rows, "value string"))


def test_wide_schema_is_the_union_of_all_tables():
    schema = wide_schema(FEED_TABLES.values())
    assert len(schema) == 37  # 36 published before, and log_id
    assert schema["site_admin"].dataType == T.IntegerType()
    assert schema["created_at"].dataType == T.StringType()


def test_names_are_routed_without_case(spark):
    routes = routing.route_by_table(parsed(spark), FEED_TABLES)
    assert set(routes) == {"users", "repos", "orgs", "events"}
    assert sorted(r.user_id for r in routes["users"].collect()) == [0, 1]
    left = routing.unrouted(parsed(spark), FEED_TABLES).collect()
    assert [r.table_name for r in left] == ["other"]


def test_malformed_text_is_all_null_and_unknown_keys_are_dropped(spark):
    df = spark.createDataFrame([("oops",), ('{"size":"x","name":"n"}',), (None,)], "value string")
    rows = routing.parse_envelopes(df).collect()
    assert len(rows) == 3
    assert set(rows[0]) == {None} and set(rows[2]) == {None}
    assert (rows[1].name, rows[1].size) == ("n", None)
    assert "producer_timestamp" not in rows[0].asDict()


def test_document_fields(spark):
    rows = parsed(spark)
    fields = {t: routing.cdc_docs(t, rows).columns for t in ("users", "repos", "orgs", "events")}
    assert fields["users"] == "_id status login avatar_url url type site_admin created_at".split()
    assert fields["repos"] == (
        "_id status name full_name description is_private is_fork language size created_at"
    ).split()
    assert fields["orgs"] == "_id status login avatar_url".split()
    assert fields["events"] == (
        "_id status type actor_id repo_id org_id is_public created_at"
    ).split()
    assert dict(routing.cdc_docs("users", rows).dtypes)["site_admin"] == "boolean"
    other = routing.cdc_docs("other", rows).columns
    assert "_id" not in other
    assert not {"table_name", "hash", "message_id", "log_timestamp"} & set(other)
    assert "log_timestamp" in routing.cdc_docs("other", rows, ["log_timestamp"]).columns


def test_filled_columns_take_one_pass(spark):
    df = parsed(spark)
    counts = {r.column_name: r.non_nulls for r in routing.non_null_columns(df).collect()}
    assert counts == {"table_name": 4, "user_id": 5, "site_admin": 4}
    assert routing.prune_null_columns(df).columns == ["table_name", "user_id", "site_admin"]


def test_parents_load_before_children():
    names = [s.name for s in load_order(FEED_TABLES.values())]
    assert set(names[:3]) == {"users", "repos", "orgs"}
    assert set(names[3:]) == {"events", "repo_ownership"}


def test_messages_are_parsed_once_for_all_routes(spark):
    plan = QUERIES["route_by_table"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "from_json" not in plan
