"""Near duplicates, decontamination and their edge cases, against brute force."""

import itertools
import random

import numpy as np
import pytest

from llm import decontam, near_dedup
from llm.components import components
from llm.decontam import common_subsequence, find_leaks, without_leaks
from llm.near_dedup import COORDINATES, near_duplicates, one_of_each, sketch

KIND = "doc_id long, text string, node string, label string"


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    out = [None, "", " \t\n", "One", "one", "A b C", "a B c", "É x", "é x", "a b c d e", "a b c d e f"]
    for _ in range(12):
        base = rng.choices(words, k=rng.choice([8, 30, 120]))
        out.append(" ".join(base))
        for _ in range(9):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append("  ".join(copy).upper() if rng.random() < 0.3 else " ".join(copy))
    return out + ["long " * 30_000, "x y z"] + ["x y z"] * 300


def brute_components(texts):
    sets = [shingle_set(t) for t in texts]
    label = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 75 * len(a | b) and label[i] != label[j]:
            low, high = sorted((label[i], label[j]))
            label = [low if x == high else x for x in label]
    return {i: label[i] for i in range(len(texts))}, [len(s) for s in sets]


def test_near_duplicates_equal_brute_force(spark, texts):
    want, sizes = brute_components(texts)
    rows = near_duplicates(spark.createDataFrame([(i, t, "n", "l") for i, t in enumerate(texts)], KIND)).collect()
    assert {r.doc_id: r.component_id for r in rows} == want
    assert all(r.n_shingles == sizes[r.doc_id] and r.kept == (want[r.doc_id] == r.doc_id) for r in rows)


@pytest.mark.parametrize("n_main", [0, 1, 6])
def test_tiles_are_small_and_each_pair_meets_once(spark, monkeypatch, n_main):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    nodes = [(7, bytes([i]), b"main" if i < n_main else bytes([i])) for i in range(40)]
    main = b"main" if n_main > 1 else bytes([39])
    open_ = [(7, main, max(n_main, 1), 40 - max(n_main, 1))]
    nodes = [(b, k, main if n_main > 1 and i < n_main else k) for i, (b, k, _) in enumerate(nodes)]
    members = spark.createDataFrame([(*x, bytes(128)) for x in nodes], "bucket long, node binary, label binary, sig binary")
    rows = near_dedup._tiles(members.join(spark.createDataFrame(open_, "bucket long, main binary, n_main long, n_apart long"), "bucket"))
    tiles, met = {}, []
    for r in rows.collect():
        tiles.setdefault(r.block, []).append((bytes(r.node), bytes(r.label), r.side))
    for tile in tiles.values():
        assert len(tile) <= 2 * 12  # blocks are dealt by a hash, 4 on average
        met += [frozenset((a, b)) for (a, la, x), (b, lb, y) in itertools.combinations(tile, 2) if la != lb and (x != y or x == 2)]
    label = {k: x for _, k, x in nodes}
    want = {frozenset(p) for p in itertools.combinations(label, 2) if label[p[0]] != label[p[1]]}
    assert len(met) == len(set(met)) and set(met) == want
    one = rows.coalesce(1).sortWithinPartitions("bucket", "block", "side", "node").mapInArrow(near_dedup._proposer(None), "a binary, b binary").collect()
    assert len(one) == len(want)  # equal sketches: each pair is proposed, once


def test_links_across_blocks_only(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 0.02)  # two classes are in two of 100 blocks
    base = " ".join(f"w{i}" for i in range(60))
    rows = near_duplicates(spark.createDataFrame([(1, f"{base} x", "n", "l"), (2, f"{base} y", "n", "l")], KIND)).collect()
    assert {r.component_id for r in rows} == {1}


def test_a_common_passage_makes_no_pairs_of_rows(spark, monkeypatch):
    sets_of, made = near_dedup._confirmed, []

    def confirmed(proposed, sets):
        made.append(proposed.count())
        return sets_of(proposed, sets)

    monkeypatch.setattr(near_dedup, "_confirmed", confirmed)
    passage = " ".join(f"p{i}" for i in range(90))  # a similarity of 86 / 146, so no links
    texts = [f"{passage} " + " ".join(f"o{k}-{i}" for i in range(30)) for k in range(60)]
    texts += [f"{t} end" for t in texts[:5]]
    rows = near_duplicates(spark.createDataFrame([(i, t, "n", "l") for i, t in enumerate(texts)], KIND)).collect()
    assert {r.doc_id: r.component_id for r in rows} == brute_components(texts)[0]
    assert sum(made) < 4 * len(texts)  # of 1,830 pairs that are similar


def test_null_and_repeated_ids(spark):
    same = "a b c d e f g h"
    docs = spark.createDataFrame([(None, same, "n", "l"), (3, same, "n", "l"), (3, same, "n", "l"), (5, same, "n", "l"), (None, "alone here", "n", "l"), (6, None, "n", "l")], KIND)
    rows = near_duplicates(docs).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in rows) == [(-1, -1, True), (-1, 3, False), (3, 3, True), (3, 3, True), (5, 3, False), (6, 6, True)]
    assert near_duplicates(docs.limit(0)).collect() == []
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "6", "None", "None"]


def test_every_bin_fills_and_agreement_is_similarity():
    rng = np.random.default_rng(1)
    one = rng.integers(0, 2**63, 400, dtype=np.uint64)
    two = np.concatenate([one[:320], rng.integers(0, 2**63, 80, dtype=np.uint64)])
    value = np.concatenate([one, two, one[:1]])
    bins = sketch(3, np.repeat([0, 1, 2], [400, 400, 1]), value)
    assert bins.shape == (3, COORDINATES) and (bins != np.uint64(2**64 - 1)).all()
    assert abs((bins[0] == bins[1]).mean() - 320 / 480) < 0.15


def test_components_of_paths_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_subsequence(a, b):
    best = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, best[j] = best[j], before + 1 if x == y else max(best[j], best[j - 1])
    return best[-1]


def test_common_subsequence():
    rng = random.Random(4)
    for _ in range(200):
        a, b = (np.array(rng.choices(range(6), k=rng.randint(1, 70)), dtype=np.uint64) for _ in range(2))
        assert common_subsequence(a, b) == brute_subsequence(a.tolist(), b.tolist())


def test_leaks_and_paraphrases_are_found(spark):
    rng = random.Random(6)
    words = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "lmnrst"]
    say = lambda n: rng.choices(words, k=n)
    items = [say(rng.randint(15, 80)) for _ in range(40)]
    docs, want = [], set()
    for i in range(300):
        text = say(rng.randint(20, 400))
        if i % 5 == 0:
            k = rng.randrange(40)
            item = list(items[k])
            if i % 10 == 0:  # a paraphrase: a third of the words changed, the answer kept
                for at in rng.sample(range(len(item) - decontam.ANSWER), (len(item) - decontam.ANSWER) // 3):
                    item[at] = rng.choice(words)
            at = rng.randrange(len(text))
            text[at:at] = item
            want.add((i, k))
        docs.append((i, " ".join(text).title(), "x"))
    docs += [(1000, None, "x"), (1001, "", "x"), (None, " ".join(items[0]), "x"), (0, docs[0][1], "x")]
    table = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    benchmark = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)] + [(0, " ".join(items[0])), (90, None), (91, "!")], "item_id long, text string")
    rows = [(r.doc_id, r.item_id) for r in find_leaks(table, benchmark).collect()]
    assert len(rows) == len(set(rows))
    found = set(rows) - {(None, 0)}
    assert (None, 0) in rows and len(found & want) >= 0.9 * len(want) and not found - want
    assert find_leaks(table, benchmark.limit(0)).collect() == [] and find_leaks(table.limit(0), benchmark).collect() == []
    left = without_leaks(table, benchmark)
    assert left.columns == table.columns and left.where("doc_id is null").count() == 0  # the copy without an id goes as well
    assert left.count() == table.count() - len({d for d, _ in found}) - 2
    leaked = min(d for d, _ in found)
    shared = table.union(spark.createDataFrame([(leaked, "a clean text", "x"), (None, "another", "x")], table.schema))
    kept = without_leaks(shared, benchmark).where(f"doc_id = {leaked} or doc_id is null").select("text")
    assert sorted(r.text for r in kept.collect()) == ["a clean text", "another"]


def test_partial_copies_and_changed_ends_are_found(spark):
    rng = random.Random(12)
    words = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "lmnrst"]
    say = lambda n: rng.choices(words, k=n)
    items = [say(59) for _ in range(12)]
    docs = [(i, " ".join(say(rng.randint(50, 300)))) for i in range(40)]
    want = set()
    for k, item in enumerate(items):
        changed = list(item)
        for at in [*rng.sample(range(54), 15), 54 + k % 5]:
            changed[at] = rng.choice(words) + "x"
        for i, part in ((100 + k, item[:41]), (200 + k, changed)):
            docs.append((i, " ".join(say(30) + part + say(40))))
            want.add((i, k))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in find_leaks(table, benchmark).collect()} == want


def test_the_basis_is_fitted_on_every_document(spark, monkeypatch):
    monkeypatch.setattr(decontam, "RANK", 3)
    monkeypatch.setattr(decontam, "OVERSAMPLE", 100)
    rng = np.random.default_rng(3)
    names = [f"term{i}" for i in range(24)]
    # 4,000 texts of one run, two terms each; which two is seen in the sum of all texts only
    texts = [" ".join(rng.choice(names, 2, replace=False)) for _ in range(4000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    items = [
        decontam.Item(k, t, t, False, decontam._grams(t), decontam._masks(t))
        for k, t in enumerate(decontam._terms(" ".join(names[i : i + 8])) for i in (0, 8, 16))
    ]
    index = decontam.build_index(docs, items)
    n = len(index.terms)
    place = {name: int(np.searchsorted(index.terms, decontam._terms(name)[0])) for name in names}
    frequency = np.bincount([place[w] for t in texts for w in t.split()], minlength=n)
    weight = np.log((4001) / (frequency + 0.5)).clip(min=0.05) ** 2
    unit = lambda at: (x := np.bincount(at, minlength=n) * weight) / np.linalg.norm(x)
    rows = np.array([unit([place[w] for w in t.split()]) for t in texts] + [unit(decontam._places(index.terms, x.terms)) for x in items])
    _, vectors = np.linalg.eigh(rows.T @ rows)
    got, want = index.basis / weight[:, None], vectors[:, ::-1][:, :3]
    assert np.allclose(got @ got.T, want @ want.T, atol=1e-3)


def test_rows_of_an_uncut_bucket_are_in_one_tile_once(spark):
    rows = [(7, bytes([i]), b"main" if i < 30 else bytes([i]), bytes(128), b"main", 30, 10) for i in range(40)]
    kind = "bucket long, node binary, label binary, sig binary, main binary, n_main long, n_apart long"
    tiles = near_dedup._tiles(spark.createDataFrame(rows, kind)).collect()
    assert len(tiles) == 40 and len({r.block for r in tiles}) == 1
    assert {r.side for r in tiles if r.label == b"main"} == {0} and {r.side for r in tiles if r.label != b"main"} == {2}
