"""Repeated strings against counting every string, with large buckets cut and not."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from llm import repeats
from llm.queries import QUERIES, table
from llm.text import rolling_hashes, span_hashes

SF_DIR = "/root/testdata/sf0.01"


def brute(texts, width):
    """Per text its bytes, the number of repeated ones, their runs, and the rest."""
    counts = Counter(hash(t[i : i + width]) for t in texts for i in range(len(t) - width + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, dtype=bool)
        reach = 0
        for i in range(len(t) - width + 1):
            if counts[hash(t[i : i + width])] > 1:
                gone[max(i, reach) : i + width] = True
                reach = i + width
        kept = bytes(b for b, drop in zip(t, gone) if not drop)
        runs = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[0])
        out.append((len(t), int(gone.sum()), runs, kept))
    return out


def rows_of(df):
    return [(r.doc_id, r.n_bytes, sum(s.beyond - s.first for s in r.spans), len(r.spans), bytes(r.kept)) for r in df.collect()]


def related_texts(seed, alphabet="abcd"):
    """Texts cut from one another, with edits, doubled parts and short periods."""
    rng = random.Random(seed)
    texts = []
    for _ in range(60):
        text = [rng.choice(alphabet) for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 4)):
            source = rng.choice(texts) if texts and rng.random() < 0.8 else text
            a = rng.randint(0, len(source))
            text += source[a : a + rng.randint(0, 90)]
        for _ in range(rng.randint(0, 3)):
            if text:
                text[rng.randrange(len(text))] = rng.choice(alphabet)
        if rng.random() < 0.1:
            text += ["a", "b"][: rng.randint(1, 2)] * 40
        texts.append(text)
    return ["".join(t) for t in texts]


@pytest.mark.parametrize("classes", [4096, 2])
@pytest.mark.parametrize("alphabet", ["abcd", "aé€"])
def test_equals_counting_every_string(spark, classes, alphabet):
    texts = related_texts(len(alphabet), alphabet)
    texts += [texts[3], texts[3]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = sorted(rows_of(repeats.remove_repeats(docs, width=40, bucket_classes=classes)))
    expected = [(i, *row) for i, row in enumerate(brute([t.encode() for t in texts], 40))]
    # what is kept need not be whole characters, so bytes are compared
    assert found == expected
    assert sum(row[2] > 0 for row in expected) > 20


def test_marks_of_many_classes_are_not_sent_to_every_task(spark):
    wide = "text_key binary, bucket long, context long, at int"
    places = spark.createDataFrame([(b"t", 7, 7, 3)], wide)
    for n, sent in ((100, True), (40_000, False)):
        marks = spark.range(n).selectExpr("id bucket", "id context", "0L low", "2L high")
        met = repeats._covered(places, marks, 400)
        assert ("strategy=broadcast" in met._jdf.queryExecution().optimizedPlan().toString()) == sent
        assert [(r.first, r.beyond) for r in met.collect()] == [(3, 405)]


def test_two_stage_order_equals_sorting():
    rng = random.Random(5)
    for _ in range(200):
        width = rng.choice([2, 5, 9])
        contexts = [bytes(rng.choice(b"aab" if rng.random() < 0.5 else b"abcd") for _ in range(rng.randint(width, 30))) for _ in range(5)]
        begin = np.concatenate(([0], np.cumsum([len(c) + 1 for c in contexts])))[:-1]
        data = np.concatenate([np.frombuffer(c + b"\xff", dtype=np.uint8) + np.uint8(1) for c in contexts])
        last = begin + np.array([len(c) - width for c in contexts])
        order = repeats.two_stage_order(data, begin, last, width)
        full = [int(i) for i in order if any(a <= i <= b for a, b in zip(begin, last))]
        strings = [data.tobytes()[i : i + width] for i in full]
        assert len(full) == len(set(full)) == int((last - begin + 1).sum())
        assert strings == sorted(strings)


def test_odd_rows(spark):
    passage = "".join(random.Random(1).choices("abcdefghij \n", k=900))
    long_text = "".join(random.Random(2).choices("klmnopq ", k=1_500_000))
    rows = [(None, "head " + passage), (1, passage + " tail"), (2, None), (3, ""), (4, "x" * 399), (5, "y" * 401), (6, "x" * 399), (7, long_text), (7, long_text[700_000:700_500]), (8, "z" * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS text_key", "2 AS spans")
    found = {(r.doc_id, r.n_bytes): r for r in repeats.remove_repeats(docs).collect()}
    assert len(found) == 10
    assert bytes(found[None, 905].kept) == b"head " and [tuple(s) for s in found[None, 905].spans] == [(5, 905)]
    assert bytes(found[1, 905].kept) == b" tail"
    assert bytes(found[2, 0].kept) == b"" and found[3, 0].spans == []
    assert len(found[4, 399].kept) == 399 and len(found[5, 401].kept) == 0
    assert [tuple(s) for s in found[7, 1_500_000].spans] == [(700_000, 700_500)]
    assert len(found[7, 500].kept) == 0 and len(found[8, 300_000].kept) == 0
    assert repeats.remove_repeats(docs.limit(0)).collect() == []


def test_query(spark):
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    expected = brute([(r.text or "").encode() for r in docs], 400)
    found = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_suffix_dedup"](spark, SF_DIR).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()}
    assert len(found) == len(docs)
    wrong = [r.doc_id for r, e in zip(docs, expected) if found[r.doc_id] != (*e[:3], hashlib.sha256(e[3]).hexdigest())]
    assert wrong == []
    assert any(0 < e[1] < e[0] for e in expected)


@pytest.mark.parametrize("width", [1, 5, 40, 400])
def test_strings_are_compared_whole(width):
    rng = np.random.default_rng(width)
    data = np.tile(rng.integers(1, 4, 3 * width).astype(np.uint8), 3)
    data[7 * width + width // 3] = 9  # one byte off, between those that are looked at first
    a, b = rng.integers(0, len(data), (2, 3000))
    a[:1000], b[:1000] = np.arange(1000) % (3 * width), np.arange(1000) % (3 * width) + 6 * width
    want = [bytes(data[i : i + width]).ljust(width, b"\0") == bytes(data[j : j + width]).ljust(width, b"\0") for i, j in zip(a, b)]
    assert repeats.equal_strings(data, a, b, width).tolist() == want


def test_rolling_hashes_are_those_of_the_spans():
    data = np.random.default_rng(1).integers(0, 256, 500).astype(np.uint8)
    at = np.arange(500 - 300)
    assert (rolling_hashes(data, 301) == span_hashes(data, at, at + 301)).all()
    assert len(rolling_hashes(data, 501)) == 0
