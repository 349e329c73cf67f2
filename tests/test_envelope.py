import hashlib
import json

import pytest
from cdcflow.checks import views
from cdcflow.operators import envelope
from cdcflow.sources.topics import as_messages
from cdcflow.specs import EVENTS, USERS
from pyspark.sql import functions as F


def canonical(record):
    text = json.dumps(record, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return hashlib.sha256(text.encode()).hexdigest()


def spaced(record):
    return hashlib.sha256(json.dumps(record, sort_keys=True).encode()).hexdigest()


GOOD = {"table_name": "users", "message_id": "users_1_t", "user_id": 1, "login": "é\"\n",
        "site_admin": 0, "url": None, "extra": "unknown field"}


def sealed(record=GOOD, digest=canonical, **more):
    record = {**record, **more}
    return {**record, "hash": digest(record)}


def verify(spark, *texts, style="canonical"):
    rows = [(i, t) for i, t in enumerate(texts)]
    messages = spark.createDataFrame(rows, "n int, value string")
    verified = envelope.verify_records(messages, style).orderBy("n")
    return [(r.is_valid, r.message_id, r.error_reason) for r in verified.collect()]


def test_member_order_and_spaces_do_not_matter(spark):
    record = sealed()
    shuffled = dict(reversed(list(record.items())))
    texts = [json.dumps(record), json.dumps(shuffled, indent=1), json.dumps(record, ensure_ascii=False)]
    assert verify(spark, *texts) == [(True, "users_1_t", None)] * 3


@pytest.mark.parametrize(
    "text, message_id, reason",
    [
        (json.dumps({**sealed(), "hash": ""}), "users_1_t", envelope.NO_HASH),
        (json.dumps({**sealed(), "hash": None}), "users_1_t", envelope.NO_HASH),
        (json.dumps({**sealed(), "hash": 0}), "users_1_t", envelope.NO_HASH),
        (json.dumps(GOOD), "users_1_t", envelope.NO_HASH),
        (json.dumps(sealed(table_name="")), "users_1_t", envelope.NO_TABLE),
        (json.dumps(sealed(table_name=None)), "users_1_t", envelope.NO_TABLE),
        (json.dumps({**sealed(), "table_name": None, "hash": None}), "users_1_t", envelope.NO_HASH),
        (json.dumps(sealed(message_id="unknown")), "unknown", envelope.NO_ID),
        (json.dumps(sealed(message_id=None)), "unknown", envelope.NO_ID),
        ("not json", "unknown", envelope.MALFORMED),
        ("[1]", "unknown", envelope.MALFORMED),
        ("null", "unknown", envelope.MALFORMED),
        ("", "unknown", envelope.MALFORMED),
        (None, "unknown", envelope.MALFORMED),
        (json.dumps(sealed()) + " x", "unknown", envelope.MALFORMED),
        (json.dumps(sealed()) + "}", "unknown", envelope.MALFORMED),
        (json.dumps(sealed()).replace('"', "'"), "unknown", envelope.MALFORMED),
        (json.dumps(sealed())[:-5], "unknown", envelope.MALFORMED),
    ],
)
def test_reasons(spark, text, message_id, reason):
    assert verify(spark, text) == [(False, message_id, reason)]


def test_an_empty_message_id_passes(spark):
    assert verify(spark, json.dumps(sealed(message_id=""))) == [(True, "", None)]


def test_mismatch_names_both_hashes(spark):
    record = sealed()
    tampered = {**record, "login": "other"}
    rest = {k: v for k, v in tampered.items() if k != "hash"}
    expected = f"Hash mismatch (received: {record['hash']}, computed: {canonical(rest)})"
    assert verify(spark, json.dumps(tampered)) == [(False, "users_1_t", expected)]


def test_nested_hash_member_is_not_the_seal(spark):
    record = sealed(payload={"hash": "x", "b": [1, {"hash": None}]})
    assert verify(spark, json.dumps(record))[0][0]
    record["payload"]["hash"] = "y"
    assert not verify(spark, json.dumps(record))[0][0]


def test_records_hashed_in_spaced_form(spark):
    record = json.dumps(sealed(digest=spaced))
    assert verify(spark, record, style="spaced") == [(True, "users_1_t", None)]
    assert not verify(spark, record)[0][0]
    tampered = record.replace('"user_id": 1', '"user_id": 2')
    assert not verify(spark, tampered, style="spaced")[0][0]


def log(spark, rows):
    schema = "log_id bigint, user_id bigint, login string, avatar_url string, url string, type string, site_admin boolean, created_at timestamp, status string, log_timestamp timestamp"
    return spark.createDataFrame(rows, "log_id bigint, user_id bigint, login string, avatar_url string, url string, type string, site_admin boolean, created_at string, status string, log_timestamp string").select(
        *[F.col(f.split()[0]).cast(f.split()[1]) for f in schema.split(", ")]
    )


ROWS = [
    (1, 7, "né\"w\\\t", None, "u", "User", True, "2024-01-01 01:02:03", "INSERT", "2024-01-01 00:00:00.123"),
    (2, 0, "😀", "a", None, None, None, None, "DELETE", "2024-01-01 00:00:00.5"),
    (3, None, "n", "a", None, None, False, None, "UPDATE", "2024-01-01 00:00:00.5"),
]


def test_sealed_form(spark):
    out = envelope.seal_records(log(spark, ROWS), USERS, "now").orderBy("log_id").collect()
    first = json.loads(out[0].value)
    assert first.pop("hash") == out[0].hash == canonical(first)
    assert first == {
        "log_id": 1, "user_id": 7, "login": "né\"w\\\t", "avatar_url": None, "url": "u",
        "type": "User", "site_admin": 1, "created_at": "2024-01-01 01:02:03",
        "status": "INSERT", "log_timestamp": "2024-01-01 00:00:00.123000",
        "table_name": "users", "message_id": "users_7_2024-01-01 00:00:00.123000",
        "producer_timestamp": "now",
    }
    assert [r.message_id.split("_")[1] for r in out] == ["7", "0", "unknown"]


@pytest.mark.parametrize("style", ["canonical", "spaced"])
def test_what_is_sealed_verifies(spark, style):
    messages = envelope.seal_records(log(spark, ROWS), USERS, style=style).select("value")
    assert envelope.verify_records(messages, style).filter("is_valid").count() == 3


def test_any_changed_character_is_noticed(spark):
    value = envelope.seal_records(log(spark, ROWS[:1]), USERS, "now").first().value
    changed = [
        value[:i] + ("x" if value[i] != "x" else "y") + value[i + 1 :] for i in range(len(value))
    ]
    cut = [value[:i] for i in range(len(value))] + [value + c for c in " }x]\n,"]
    cut.remove(value + " "), cut.remove(value + "\n")  # white space is no change in JSON
    verdicts = verify(spark, *changed, *cut)
    assert not any(valid for valid, _, _ in verdicts)


def test_legacy_id_takes_the_first_filled_column(spark):
    rows = spark.createDataFrame([("e1", 5, None), ("e2", 0, 3), ("e3", None, None)],
                                 "event_id string, repo_id bigint, org_id bigint")
    rows = rows.withColumn("log_timestamp", F.lit("2024-01-01").cast("timestamp"))
    ids = rows.select(
        envelope.message_id(EVENTS, legacy_id=True).alias("old"),
        envelope.message_id(EVENTS).alias("own"),
    ).collect()
    assert [r.old.split("_")[1] for r in ids] == ["5", "3", "e3"]
    assert [r.own.split("_")[1] for r in ids] == ["e1", "e2", "e3"]


def test_valid_and_dead_make_up_the_input(spark):
    messages = views.damaged_messages(spark, "/root/testdata/sf0.001", "orders")
    valid, dead = envelope.split_records(envelope.verify_records(messages))
    both = valid.select(F.col("value").cast("string")).unionAll(dead.select("original_record"))
    assert both.exceptAll(messages.select(F.col("value").cast("string"))).isEmpty()
    assert both.count() == messages.count()


def test_dead_letter_nests_what_it_can_read(spark):
    messages = spark.createDataFrame([('{"a":1}',), ("bad",)], "value string")
    dead = envelope.dead_letters(envelope.verify_records(messages))
    letters = [json.loads(r.value) for r in envelope.dead_letter_messages(dead).collect()]
    assert [x["original_record"] for x in letters] == [{"a": 1}, "bad"]
    assert letters[0]["offset"] is None


def test_records_become_messages(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert as_messages(df).first().value == '{"a":1,"b":null}'
    assert as_messages(df, "a").first().key == "1"
