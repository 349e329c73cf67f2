"""Toxicity, language, quality and mixing on tiny tables and odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm import mixing
from llm import toxicity as tox
from llm.chat import TURNS, conversations, preferences, reply_pairs
from llm.language import identify
from llm.quality import chi_square, chi_square_quantile, quality
from llm.text import blocks
from llm.toxicity import fold, toxicity, without_toxic

SF_DIR = "/root/testdata/sf0.1"


def sentences(rng, words, n):
    return " ".join(rng.choices(words, k=n))


@pytest.fixture(scope="module")
def speech():
    rng = random.Random(8)
    common = [f"{a}{b}" for a in ("the", "of", "an", "re", "st") for b in ("nt", "ea", "or", "in", "ly", "sh")]
    docs = []
    for i in range(600):
        words = rng.choices(common, k=rng.randint(20, 80))
        if i % 6 == 0:
            words[::9] = [rng.choice(["idiot", "scum", "moron"]) for _ in words[::9]]
        docs.append((i, " ".join(words), i % 6 == 0))
    return docs


def test_toxic_texts_score_high(spark, speech):
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in speech] + [(9000, None, "x"), (9001, "", "x"), (None, "...", "x"), (0, speech[0][1], "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(bad)) for i, _, bad in speech if i < 450] + [(None, 1), (3, None), (0, 0)], "doc_id long, toxic int")
    got = {}
    for r in toxicity(docs, labels).collect():
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        got.setdefault(r.doc_id, []).append(r.predicted)
    late = [(got[i][0], int(bad)) for i, _, bad in speech if i >= 450]
    assert sum(a == b for a, b in late) >= 0.95 * len(late)
    assert len(set(got[0])) == 1 and len(got[0]) == 2 and 9000 in got and 9001 in got
    left = without_toxic(docs, labels)
    assert left.columns == docs.columns and left.where("doc_id is null").count() == 1


def test_toxic_rows_are_told_apart_by_id_and_text(spark, speech):
    bad, good = next(t for i, t, b in speech if b and i > 450), next(t for i, t, b in speech if not b and i > 450)
    odd = [(None, bad), (None, good), (700, bad), (700, good), (701, bad), (701, bad), (702, " ".join([good] * 3000)), (703, " ".join([bad] * 3000))]
    rows = [(i, t, "k") for i, t, _ in speech if i < 450] + [(i, t, "odd") for i, t in odd]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")  # a name the operator uses itself
    labels = spark.createDataFrame([(i, int(b)) for i, _, b in speech if i < 450], "doc_id long, toxic int")
    left = without_toxic(docs, labels).where("key = 'odd'").collect()
    assert sorted((r.doc_id or -1, len(r.text)) for r in left) == sorted([(-1, len(good)), (700, len(good)), (702, len(odd[6][1]))])


def test_rare_pairs_are_asked_for_at_every_size(spark):
    counts = [(k, 1, 0 if k < 50 else tox.LEAST_PAIRS) for k in range(60)]
    head = tox._head(spark.createDataFrame(counts, "key long, toxic long, ordinary long"), tox.LEAST_PAIRS)
    assert head.keys.tolist() == list(range(50, 60))


@pytest.mark.parametrize("head", [1, 40, 1 << 20])  # nothing, a part and all of the tables
def test_rare_words_and_pairs_count_however_little_tasks_hold(spark, speech, monkeypatch, head):
    split = lambda t: re.findall(r"[a-z]+", (t or "").lower())
    pairs_of = lambda t: list(zip([None, *split(t)], split(t), strict=False))
    taught = [(t + (" vile rot" if i in (6, 12) else " once" if i == 18 else ""), int(bad)) for i, t, bad in speech[:80]]
    asked = [t for _, t, _ in speech[80:110]] + ["vile rot", "the vile rot", "once", "never met", "rot vile rot", "", None]
    table = spark.createDataFrame(taught, "text string, toxic int")
    docs = spark.createDataFrame(list(enumerate(asked)), "i long, text string")
    monkeypatch.setattr(tox, "WORDS", 4)  # tasks hold a few words and no pair
    monkeypatch.setattr(tox, "PAIRS", 1)
    monkeypatch.setattr(tox, "HEAD", head)
    model, rare = tox.fit(table)
    single, double = (Counter(), Counter()), (Counter(), Counter())
    for text, toxic in taught:
        single[1 - toxic].update(split(text))
        double[1 - toxic].update(pairs_of(text))
    held = {w for w in single[0] + single[1] if any(s[w] >= max(2, s.total() / 4) for s in single)}
    got = {r["key"]: (r.toxic, r.ordinary) for r in rare.pairs.collect()}
    assert len(model.vocabulary) == len(held) and not len(model.pairs)
    assert sorted(got.values()) == sorted((n, double[1][p]) for p, n in double[0].items())
    rare_words = [{w: n for w, n in s.items() if w not in held} for s in single]
    assert rare.words.count() == len(rare_words[0])
    shares, unmet = [], []
    for a, b in (rare_words, double):
        shares.append((sum(a.values()) + 1) / (sum(a.values()) + sum(b.values()) + 2))
        once, others = sum(n == 1 for n in a.values()), sum(n for k, n in b.items() if k not in a)
        unmet.append(min((once + 1) / (once + others + 2), shares[-1]))
    assert rare.shares == pytest.approx(shares) and rare.unmet == pytest.approx(unmet)
    logit = lambda q: math.log(q / (1 - q))
    rows = {r.i: r for r in tox._measured(docs, model, rare, "long").collect()}
    assert len(rows) == len(asked)
    for i, text in enumerate(asked):
        block = next(blocks(pa.array([text or ""])))
        want = float(tox._coarse(model, block)[3].sum())
        for v, w in pairs_of(text):
            kind = 0 if w not in held else 1
            base = own = shares[kind]
            if not kind and not single[0][w] or kind and not double[0][v, w]:
                want += logit(unmet[kind]) - logit(base)
                continue
            if not kind:
                own = (single[0][w] + tox.PSEUDO * base) / (single[0][w] + single[1][w] + tox.PSEUDO)
            n = (double[0][v, w], double[1][v, w]) if double[0][v, w] else (0, 0)
            want += logit((n[0] + tox.PSEUDO * own) / (sum(n) + tox.PSEUDO)) - logit(base)
        assert rows[i].n_words == len(split(text))
        assert (rows[i].speaks_for + rows[i].speaks_against) * max(len(split(text)), 1) == pytest.approx(want, abs=1e-4)
    total = lambda t: rows[asked.index(t)].speaks_for + rows[asked.index(t)].speaks_against
    assert total("vile rot") > total("once") > total("never met")


def test_toxicity_without_anything_to_learn(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    for rows in ([], [(1, 0)], [(1, 1)], [(7, 1)]):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        assert toxicity(docs, labels).count() == 2
        assert toxicity(docs.limit(0), labels).count() == 0


def test_held_out_toxic_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity(docs, labels.where(fold("doc_id", 4) != 2)).join(labels, "doc_id").where(fold("doc_id", 4) == 2)
    hit, said, true = scored.agg(F.sum(F.col("predicted") * F.col("toxic")), F.sum("predicted"), F.sum("toxic")).first()
    assert hit / said > 0.6 and hit / true > 0.6


def test_languages(spark):
    rng = random.Random(9)
    words = {"aa": ["salu", "mundi", "ora", "lume"], "bb": ["krzt", "wolk", "zwij", "stkr"], "cc": ["ñoño", "ción", "ária", "ôkê"]}
    docs = [(i, sentences(rng, words[lang], rng.randint(1, 30)), lang) for i in range(300) for lang in [("aa", "bb", "cc")[i % 3]]]
    odd = [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 !?", "cc"), (None, "ora mundi", None), (1003, "ора", None), (0, docs[0][1], "aa")]
    kind = "doc_id long, text string, lang string"
    table = spark.createDataFrame(docs + odd, kind)
    rows = identify(table, spark.createDataFrame(docs[:200], kind)).collect()
    assert len(rows) == len(docs) + len(odd)
    got = {r.doc_id: r for r in rows}
    assert all(got[i].lang_pred == lang for i, _, lang in docs) and got[None].lang_pred == "aa"
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1000, 1001, 1002))
    assert got[1003].lang_pred in words and all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in identify(table, table.where("lang is null and text is null")).collect()} == {"und"}
    assert identify(table.limit(0), table).collect() == []


def test_quality_keeps_ordinary_and_rejects_odd_texts(spark):
    rng = random.Random(10)
    words = ["the", "of", "ered", "tion", "honest", "alpha", "beta", "gamma"]
    words += [f"{a}{b}{c}" for a in "bcdfghjk" for b in "aeiou" for c in "lmnrst"]
    docs = [(i, sentences(rng, words, rng.randint(20, 200)), "en", "s") for i in range(400)]
    docs += [(900, sentences(rng, words, 60).replace(" ", "#$% ") + "#$%", "en", "s"), (901, sentences(rng, words, 80).upper(), "en", "s"), (902, "w x y z v " * 40, "en", "s")]
    docs += [(903, None, None, None), (904, "", "en", "s"), (905, "few words", "en", None), (None, docs[0][1], "en", "s"), (0, docs[0][1], "en", "s"), (906, sentences(rng, words, 50), None, "rare")]
    table = spark.createDataFrame([(*d, "m") for d in docs], "doc_id long, text string, lang string, source string, m string")
    rows = quality(table).collect()
    assert len(rows) == len(docs)
    got = {r.doc_id: r for r in rows}
    assert sum(got[i].kept for i in range(400)) >= 395 and got[906].kept
    assert not any(got[i].kept for i in range(900, 906)) and not got[900].base_failed and got[902].base_failed
    assert (got[905].n_words, got[905].word_chars, got[900].n_symbols) == (2, 8, 180)
    assert quality(table.limit(0)).collect() == []


def test_chi_square():
    assert abs(chi_square(5.348, 6) - 0.5) < 1e-3 and abs(chi_square_quantile(0.95, 3) - 7.815) < 1e-2


def test_mixture_meets_its_limits(spark):
    rows = [(i, "w " * 9, s, 1.0) for i, s in enumerate(["big"] * 6000 + ["mid"] * 2000 + [None] * 600)]
    rows += [(50_000, None, "mid", 1.0), (None, "a b", "big", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, weight double")
    used = mixing.mix(docs).groupBy("source").agg(F.sum("n_tokens").alias("t"), F.first("weight").alias("w"), F.max("epoch").alias("e"), F.countDistinct("doc_id").alias("n"), F.min("position").alias("low"), F.max("position").alias("high")).collect()
    total = sum(r.t for r in used)
    assert abs(sum(r.w for r in used) - 1) < 1e-9
    for r in used:
        assert abs(r.t / total - r.w) < 0.005 and 0 <= r.low <= r.high < 1
        assert r.n == {"big": 6000, "mid": 2001, None: 600}[r.source] and r.e <= 1
    again = mixing.mixed_documents(docs)
    assert again.columns == docs.columns and again.count() == mixing.mix(docs).count()
    assert mixing.mix(docs.limit(0)).collect() == [] and mixing.mixed_documents(docs.limit(0)).collect() == []


def test_exponent_by_entropy():
    tokens = [900.0, 90.0, 10.0]
    a = mixing.exponent_of(tokens, None, 0.8)
    assert 0 < a < 1 and abs(mixing.entropy(mixing.weights(tokens, a)) - 0.8) < 1e-6
    assert mixing.exponent_of(tokens, None, math.log(3)) < 1e-6 and mixing.exponent_of([5.0, 5.0]) == 0


def test_preferences(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (1, 1, "assistant", "yo"), (1, 2, "user", "why"), (1, 3, "assistant", "so"), (1, 4, "user", "ok"),
             (2, 0, "user", None), (2, None, None, "pre"), (2, 1, "assistant", "x"), (3, 0, "assistant", "alone"), (None, 0, "user", "lost"), (4, 0, "user", "no reply")]
    table = spark.createDataFrame([(*t, "p") for t in turns], "conv_id long, turn long, role string, text string, prompt string")
    got = {r.conv_id: r for r in preferences(reply_pairs(conversations(table))).collect()}
    assert set(got) == {1, 2}
    one = got[1]
    assert one.n_common == 3 and one.prompt == "<|user|>\nhi<|end|>\n<|assistant|>\nyo<|end|>\n<|user|>\nwhy<|end|>\n"
    assert (one.chosen, one.rejected) == ("<|assistant|>\nso<|end|>\n", "<|assistant|>\nyo<|end|>\n")
    assert [one.chosen[m["start"] : m["end"]] for m in one.chosen_mask] == ["so<|end|>\n"]
    assert got[2].prompt == "<|" + "|>\npre<|end|>\n<|user|>\n<|end|>\n" and got[2].rejected == "<|assistant|>\n<|end|>\n"
    assert conversations(table.limit(0)).collect() == []
    pairs = spark.createDataFrame([(1, [("user", "a")], [("user", "a"), ("assistant", "b")]), (2, None, None), (3, [("u", "x")], [("u", "y")])], f"conv_id long, chosen {TURNS}, rejected {TURNS}")
    rows = {r.conv_id: (r.n_common, r.chosen, r.rejected, len(r.rejected_mask)) for r in preferences(pairs).collect()}
    assert rows == {1: (1, "", "<|assistant|>\nb<|end|>\n", 1), 2: (0, "", "", 0), 3: (0, "<|u|>\nx<|end|>\n", "<|u|>\ny<|end|>\n", 0)}


def test_the_scale_is_fitted_on_all_rows_set_apart(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(0, [0.2, 1.0], (3000, 2))
    y = (rng.random(3000) < 1 / (1 + np.exp(1 - 20 * x[:, 0] - x[:, 1]))).astype(int)
    rows = spark.createDataFrame([(int(t), float(a), float(b)) for t, (a, b) in zip(y, x, strict=True)], "toxic int, speaks_for double, speaks_against double")
    w = tox.logistic(rows)
    p = 1 / (1 + np.exp(-(w[0] + x @ w[1:])))
    slope = np.array([(p - y).sum(), *(x.T @ (p - y) + (w[1:] - np.array(tox.PRIOR)) / np.array(tox.PRIOR_SPREAD) ** 2)])
    assert np.abs(slope).max() < 1e-3 and not hasattr(tox, "CALIBRATION_ROWS")
    assert tox.logistic(rows.limit(0)).tolist() == [0.0, *tox.PRIOR]
