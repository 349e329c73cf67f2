"""Periodic runs against the definition, and tiles of long texts against whole ones."""

import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from llm import runs
from llm.queries import QUERIES, table

SF_DIR = "/root/testdata/sf0.01"


def split(text):
    return [w.decode() for w in (text or "").encode().split()]


def brute_runs(words):
    """``start, period, length``: every stretch that agrees with itself, by period."""
    out, seen, n = [], set(), len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            first = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - first + q
            if length >= max(24, 3 * q) and (first, length) not in seen:
                seen.add((first, length))  # a multiple of the period comes later
                out.append((first, q, length))
    return sorted(out)


def collapsed(words, found):
    gone = {i for start, q, length in found for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def rows_of(df):
    return [(r.doc_id, r.n_words, [(x.start, x.period, x.length) for x in r.runs], r.collapsed) for r in df.collect()]


def periodic_words(seed):
    rng = random.Random(seed)
    n = rng.randint(0, 400)
    words = [rng.choice("abcdefgh") if seed % 3 else "a" for _ in range(n)]
    for _ in range(rng.randint(0, 4)):
        if n:
            a = rng.randrange(n)
            p = rng.randint(1, max(1, (n - a) // 3))
            for i in range(a, rng.randint(a, n)):
                words[i] = words[a + (i - a) % p]
    return words


def test_runs_equal_the_definition(spark):
    texts = {i: " \t".join(periodic_words(i)) for i in range(120)}
    found = rows_of(runs.periodic_runs(spark.createDataFrame(list(texts.items()), "doc_id long, text string")))
    assert len(found) == 120
    for doc_id, n_words, got, kept in found:
        words = split(texts[doc_id])
        assert (n_words, got) == (len(words), brute_runs(words))
        assert kept == collapsed(words, got)
    assert sum(len(got) for _, _, got, _ in found) > 60


def test_tiles_dealt_over_tasks_give_the_same(spark):
    docs = spark.createDataFrame([(i, " ".join(periodic_words(i))) for i in range(60)], "doc_id long, text string")
    whole = rows_of(runs.periodic_runs(docs))
    tiled = rows_of(runs.periodic_runs(docs, long_bytes=1, group_words=8))
    assert sorted(whole) == sorted(tiled)


def test_odd_rows(spark):
    long_text = "x y z " * 20_000 + "end"
    docs = spark.createDataFrame(
        [(None, "a " * 24, 1), (1, None, 1), (2, "", 1), (2, " \n\t", 1), (3, "a " * 23, 1), (4, "a a " * 30, 1), (5, long_text, 1), (5, long_text, 1)],
        "doc_id long, text string, runs int",
    ).withColumnRenamed("runs", "text_key")
    found = sorted(rows_of(runs.periodic_runs(docs)), key=repr)
    assert (None, 24, [(0, 1, 24)], "a") in found
    assert (1, 0, [], "") in found and found.count((2, 0, [], "")) == 2
    assert (3, 23, [], " ".join(["a"] * 23)) in found
    assert (4, 30, [(0, 1, 30)], "a a") in found
    assert found.count((5, 60_001, [(0, 3, 60_000)], "x y z end")) == 2
    assert rows_of(runs.periodic_runs(docs.limit(0))) == []


@pytest.mark.parametrize("ids", [None, "string"])
def test_ids_keep_their_type(spark, ids):
    docs = spark.createDataFrame([(7, "b " * 30)], "doc_id long, text string")
    docs = docs.withColumn("doc_id", docs.doc_id.cast(ids)) if ids else docs
    assert runs.periodic_runs(docs).schema["doc_id"].dataType == docs.schema["doc_id"].dataType


def test_query(spark):
    expected = {}
    for row in table(spark, SF_DIR, "documents").collect():
        words, code = split(row.text), zlib.crc32(str(row.doc_id).encode())
        n, g = len(words), code // 10
        if code % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = brute_runs(words) if n < 3000 else None
        expected[row.doc_id] = words, found
    got = QUERIES["op11_periodic_runs"](spark, SF_DIR).collect()
    assert len(got) == len(expected)
    checked = 0
    for row in got:
        words, found = expected[row.doc_id]
        if found is None:
            continue
        best = min(found, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1]), default=(None,) * 3)
        text = "".join(f"{s},{length},{q}\n" for s, q, length in found)
        assert (row.n_runs, row.start, row.period, row.length) == (len(found), *best)
        assert row.exponent_milli == (1000 * best[2] // best[1] if found else None)
        assert row.runs_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapsed(words, found).encode()).hexdigest()
        checked += bool(found)
    assert checked > 50
