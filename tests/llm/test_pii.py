import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from llm.pii import KINDS, find_pii, pii_digest

#: The plain patterns, as the contract writes them.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    found = [
        (m.start(), KINDS.index(kind), kind, m.end())
        for kind, pattern in PLAIN.items()
        for m in re.finditer(pattern, text or "")
        if valid(kind, m.group())
    ]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(found)]


PARTS = ["a@b.co", "x.y_d@e.f.g", "@", ".", "_", "1.2.3.4", "300.1.1.1", "010.0.0.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "5", " ", "-", "  ", "+1 (425) 555-0957", "+", "(", ")", "é", "🙂", "word", "\n", "12", "+4915112345678"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    made = ["".join(rng.choices(PARTS, k=rng.randint(0, 30))) for _ in range(2500)]
    return [None, "", *made, "1 " * 60_000, "9" * 50_000, "a" * 60_000 + "@", "a.b@" * 20_000, "+1" * 30_000]


def test_base_spans_equal_the_plain_patterns(spark, texts):
    docs = spark.createDataFrame([(i if i % 5 else None, i, t) for i, t in enumerate(texts)], "spans long, doc_id long, text string")
    rows = pii_digest(find_pii(docs)).collect()
    assert len(rows) == len(texts)
    for row in rows:
        want = brute(texts[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), texts[row.doc_id]
        base = [s for s in row.spans.split(",") if s.split(":")[0] in KINDS[:4]]
        assert base == want
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(w.startswith(k) for w in want) for k in KINDS[:4]]


def test_method_adds_account_and_context_spans(spark):
    good, bad = "GB82 WEST 1234 5698 7654 32", "GB83 WEST 1234 5698 7654 32"
    docs = spark.createDataFrame(
        [(1, f"pay {good} now"), (2, f"pay {bad} now"), (3, "his SSN is 123-45-6789."), (4, "part 123-45-6789."), (5, "SSN 000-45-6789")],
        "doc_id long, text string",
    )
    got = {r.doc_id: [s for s in r.spans if s["kind"] in KINDS[4:]] for r in find_pii(docs).collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in got[1]] == [("iban", 4, 31)]
    assert [(s["kind"], s["start"], s["end"], round(s["score"], 2)) for s in got[3]] == [("ssn", 11, 22, 0.6)]
    assert got[2] == got[4] == got[5] == []


def test_no_rows_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a@b.co")] * 3 + [(None, None)], "doc_id long, text string")
    assert find_pii(docs).where("false").count() == 0 and find_pii(docs.limit(0)).collect() == []
    rows = find_pii(docs).select("doc_id", F.size("spans").alias("n")).collect()
    assert sorted((r.doc_id or 0, r.n) for r in rows) == [(0, 0), (1, 1), (1, 1), (1, 1)]


def test_many_matches_in_one_text(spark):
    """Starts and contexts stay right far behind the text's start, and in linear time."""
    parts = [f"{'é🙂'[: i % 3]}u{i}@b.co" if i % 3 else f"ssn {i % 90 + 100}-12-3456" for i in range(100_000)]
    text = " ".join(parts)
    [row] = find_pii(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert len(row.spans) == 100_000
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}"}
    want = sorted((m.start(), m.end(), k) for k, p in kinds.items() for m in re.finditer(p, text))
    assert [(s.start, s.end, s.kind) for s in row.spans] == want
    assert all(s.score == pytest.approx(0.6) for s in row.spans if s.kind == "ssn")
