"""Hand-made events with known answers: duplicates, precedence, NULLs."""

from datetime import datetime

import pytest
from cdcflow.checks.views import raw_events
from cdcflow.operators import documents, entities
from cdcflow.specs import RAW_EVENT_SCHEMA
from pyspark.sql import functions as F


def event(id, type="PushEvent", at="2024-01-01T00:00:00Z", actor=None, repo=None, org=None,
          fork=None, public=True):
    return {
        "id": id, "type": type, "public": public, "created_at": at,
        "actor": actor, "repo": repo, "org": org,
        "payload": {"forkee": fork, "ref": "main", "head": None},
    }


def person(id, login="x"):
    return {"id": id, "login": login, "url": "u", "avatar_url": "a"}


def fork(id, owner=None, at="2024-01-01T00:00:00Z"):
    return {"id": id, "name": f"fork{id}", "owner": owner, "private": True, "fork": True,
            "size": 7, "forks_count": 3, "created_at": at}


@pytest.fixture
def raw(spark):
    def build(*events):
        return spark.createDataFrame(list(events), RAW_EVENT_SCHEMA)

    return build


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_actor_wins_over_owner_even_if_later(raw):
    df = raw(
        event("1", fork=fork(5, {"id": 9, "login": "owner", "type": "Organization"})),
        event("2", at="2024-02-01T00:00:00Z", actor=person(9, "actor")),
    )
    user = one(entities.users_dim(df))
    assert (user.login, user.type, user.avatar_url) == ("actor", "User", "a")
    assert user.site_admin is False
    assert user.created_at == datetime(2024, 2, 1)


def test_owner_keeps_own_type_and_has_no_urls(raw):
    df = raw(event("1", fork=fork(5, {"id": 9, "login": "o", "type": "Organization"})))
    user = one(entities.users_dim(df))
    assert (user.type, user.avatar_url, user.url) == ("Organization", None, None)


def test_bad_time_is_null_and_loses(raw):
    df = raw(
        event("1", at="bad", actor=person(9, "first")),
        event("2", actor=person(9, "second")),
    )
    assert one(entities.users_dim(df)).login == "second"
    only_bad = one(entities.users_dim(raw(event("1", at="bad", actor=person(9)))))
    assert only_bad.created_at is None


def test_event_ids_order_as_numbers(raw):
    df = raw(event("10", actor=person(9, "ten")), event("9", actor=person(9, "nine")))
    assert one(entities.users_dim(df)).login == "nine"


def test_event_repo_wins_over_fork_target(raw):
    df = raw(
        event("1", fork=fork(5)),
        event("2", repo={"id": 5, "name": "base", "url": "r"}),
        event("3", fork=fork(6, at="bad")),
    )
    rows = {r.repo_id: r for r in entities.repos_dim(df).collect()}
    assert (rows[5].name, rows[5].size, rows[5].is_private) == ("base", 0, False)
    assert (rows[6].name, rows[6].size, rows[6].is_private) == ("fork6", 7, True)
    assert rows[6].watchers_count is None and rows[6].created_at is None


def test_organisation_owns_before_user(raw):
    org = person(3, "org")
    df = raw(
        event("1", fork=fork(5, {"id": 9, "login": "o", "type": "User"})),
        event("2", repo={"id": 5, "name": "n", "url": "r"}, org=org),
        event("3", repo={"id": 6, "name": "n", "url": "r"}),
    )
    owner = one(entities.repo_ownership(df))
    assert tuple(owner) == (5, None, 3)


def test_fork_target_only_for_the_fork_type_and_null_ids_stay(raw):
    df = raw(
        event("1", type="ForkEvent", fork=fork(5)),
        event("2", type="PushEvent", fork=fork(5)),
        event("3", type=None, fork=fork(5)),
        event(None),
        event(None),
    )
    rows = {r.event_id: r.forkee_repo_id for r in entities.events_fact(df).collect()}
    assert rows == {"1": 5, "2": None, "3": None, None: None}
    assert entities.events_fact(df).count() == 4


def test_null_keys_give_no_entities(raw):
    df = raw(event("1"), event("2", actor=person(None), org=person(None)))
    assert entities.users_dim(df).count() == 0
    assert entities.orgs_dim(df).count() == 0
    assert entities.repos_dim(df).count() == 0
    assert entities.repo_ownership(df).count() == 0


def test_repo_documents_keep_one_per_event_and_need_an_owner(raw):
    owner = {"id": 9, "login": "o", "type": "User"}
    df = raw(
        event("1", fork=fork(5, owner)),
        event("2", fork=fork(5, {"id": 8, "login": "later", "type": "User"})),
        event("3", fork=fork(6, None)),
        event("4", fork=fork(7, {"id": None, "login": "n", "type": "User"})),
    )
    docs = documents.repo_docs(df).collect()
    assert [(d["_id"], d.owner.id, d.stats.size) for d in docs] == [(5, 9, 7), (5, 9, 7)]


def test_the_last_event_gives_the_document(raw):
    owner = {"id": 9, "login": "o", "type": "User"}
    unnamed = fork(5, owner) | {"name": None}
    df = raw(
        event("1", fork=unnamed),
        event("3", at="2024-01-02T00:00:00Z", fork=fork(5, owner) | {"name": "last"}),
        event("2", at="2024-01-02T00:00:00Z", fork=unnamed),
        event("4", at="bad", fork=unnamed),
    )
    latest = documents.latest_documents(documents.repo_docs(df, position=True))
    assert one(latest).name == "last"
    assert latest.columns == documents.repo_docs(df).columns
    twice = raw(event("1", type="old"), event("1", type="new", at="2024-01-02T00:00:00Z"))
    assert one(documents.latest_documents(documents.event_docs(twice, position=True))).type == "new"


def test_only_the_organisation_is_a_null_object(raw):
    df = raw(event("1", public=False), event("1", public=False, org=person(3, "org")))
    docs = documents.event_docs(df).orderBy(F.col("org").isNotNull()).collect()
    assert docs[0].org is None and docs[1].org.login == "org"
    assert docs[0].actor is not None and docs[0].actor.id is None
    assert docs[0].payload.forkee.id is None
    assert docs[0].payload.forkee.public is False


def test_hot_key_reaches_its_reducer_combined(spark):
    rows = spark.range(0, 90000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"),
        (-F.col("id")).alias("at"),
        F.col("id").cast("string").alias("v"),
    )
    kept = entities.dedup_by_key(rows, ["k"], ["at"])
    assert kept.count() == 60001
    assert kept.filter("k = -1").first().v == "89997"
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_tables_that_grow_with_the_feed_are_not_broadcast(spark):
    plan = raw_events(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastExchange") <= 1  # the nations


def test_a_feed_with_its_times_parsed_gives_the_same(raw):
    owner = {"id": 9, "login": "o", "type": "User"}
    times = ["2024-01-02T00:00:00Z", "0001-01-01T00:00:00Z", "9999-12-31T23:59:59Z", "bad", "", None, "2024-01-01T00:00:00Z"]
    feed = raw(*[
        event(str(i % 5), at=at, actor=person(i % 3, f"a{i}"), repo=person(i % 2), org=person(1, f"o{i}"), fork=fork(70 + i % 2, owner))
        for i, at in enumerate(times)
    ])
    parsed = entities.feed_times(feed)
    assert parsed.schema["created_at"].dataType.simpleString() == "timestamp"
    texts = lambda df: sorted(r[0] for r in df.select(F.to_json(F.struct("*"))).collect())
    for build in (entities.feed_tables, documents.feed_documents):
        for name, rows in build(feed).items():
            same = build(parsed)[name]
            assert same.schema == rows.schema
            assert texts(same) == texts(rows), name


def test_repositories_are_folded_before_they_meet_their_owners(raw):
    first, other = {"id": 1, "login": "a", "type": "User"}, {"id": 2, "login": "b", "type": "User"}
    forks = [
        ("1", "2024-01-02T00:00:00Z", fork(7, other)),
        ("2", "2024-01-01T00:00:00Z", fork(7, first)),
        ("3", "2024-01-03T00:00:00Z", fork(7, None) | {"name": "last"}),
        ("3", "2024-01-03T00:00:00Z", fork(7, None) | {"name": "last", "size": 8}),
        ("4", None, fork(8, None)),
        ("5", "bad", fork(9, other)),
        (None, None, fork(9, other) | {"name": "unplaced"}),
        ("6", "2024-01-01T00:00:00Z", fork(None, other)),
    ]
    feed = raw(*[event(id, at=at, fork=target) for id, at, target in forks])
    latest = documents.repo_docs(feed, latest=True)
    wanted = documents.latest_documents(documents.repo_docs(feed, position=True))
    assert latest.dtypes == wanted.dtypes
    assert sorted(map(str, latest.collect())) == sorted(map(str, wanted.collect()))
    assert sorted((r["_id"], r["name"], r.stats.size, r.owner.id) for r in latest.collect()) == [(7, "last", 8, 1), (9, "fork9", 7, 2)]
    plan = latest._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("max(struct")
