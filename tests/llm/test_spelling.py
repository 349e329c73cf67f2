"""Spelling variants against every pair of words that deletions can make equal."""

import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from llm import spelling
from llm.queries import QUERIES, table

SF_DIR = "/root/testdata/sf0.001"


def brute_counts(rows, drop_every):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            code = zlib.crc32(f"{doc_id}:{word}".encode())
            if drop_every and doc_id is not None and code % drop_every == 0:
                k = code % len(word)
                word = word[:k] + word[k + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute_variants(counts):
    """By what is left of words when one place is cut out: two replaced at one place leave
    the same there, a shorter word is itself what a longer one leaves."""
    holes = defaultdict(set)
    near = defaultdict(set)
    for word in counts:
        for k in range(len(word)):
            rest = word[:k] + word[k + 1 :]
            holes[k, rest].add(word)
            if rest in counts:
                near[word].add(rest)
                near[rest].add(word)
    for group in holes.values():
        for word in group:
            near[word] |= group - {word}
    forms = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda w: (-counts[w], w), default=None)
        if best is not None and counts[best] >= 2 * n:
            forms[word] = best
    out = []
    for word, n in counts.items():
        root = word
        while root in forms:
            root = forms[root]
        form = forms.get(word)
        out.append((word, form, root, n, len(near[word]), counts[form] if form else None))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_query_equals_brute_force(spark):
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text").collect()
    expected = brute_variants(brute_counts(docs, 97))
    assert rows_of(QUERIES["op12_spelling_variants"](spark, SF_DIR)) == expected
    assert sum(r[1] is not None for r in expected) > 100


def test_all_kinds_of_edits_and_ties(spark):
    counts = {
        "colour": 40, "color": 90, "colouur": 3, "kolour": 5, "coloru": 4, "olour": 6, "colours": 20, "xcolour": 3,
        "aaaaa": 3, "aaaaaa": 3, "aaaaaaa": 12, "abcde": 4, "abcdf": 4, "abcdg": 8, "abxde": 8, "éclair": 3, "eclair": 6,
    }
    vocabulary = spark.createDataFrame(list(counts.items()), "word string, n long").withColumn("form", F.lit("x"))
    assert rows_of(spelling.variants(vocabulary)) == brute_variants(counts)


def test_long_words_take_few_rounds(spark):
    stem = "ab" * 3000
    counts = {stem: 9, stem + "c": 3, stem[:2999] + "x" + stem[3000:]: 4, "y" + stem: 3, stem[1:]: 30, "short": 5}
    vocabulary = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(spelling.variants(vocabulary)) == brute_variants(counts)


def test_odd_rows(spark):
    rows = [(1, None), (None, "Straße STRAßE straße"), (2, ""), (3, "12 345 ---"), (4, "strasse " * 3), (4, "strasse " * 3), (5, "tinyy tin")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(0))
    assert sorted(tuple(r) for r in spelling.letter_words(docs).collect()) == [("strasse", 6), ("straße", 3)]
    assert rows_of(spelling.spelling_variants(docs)) == [("strasse", None, "strasse", 6, 0, None), ("straße", None, "straße", 3, 0, None)]
    assert rows_of(spelling.spelling_variants(docs.limit(0))) == []
