"""MinHash near-duplicates by fast similarity sketching, banding and exact checks.

*Sketch.* A document's set is that of its distinct 5-word shingles, as 64-bit hashes.
Its sketch has ``COORDINATES`` bins. In round ``i`` every shingle is hashed to one bin
and leaves the value ``i + u`` there (``u`` uniform in [0, 1)), the smallest staying;
from round ``COORDINATES`` on, round ``i`` puts every shingle into the one bin
``i - COORDINATES``. The rounds end when every bin is filled, after ``2 * COORDINATES``
at the latest, so even a set of one shingle fills them all and two sets agree in each bin
with the probability of their similarity. Most documents need one round, whatever the
number of bins.

*Bands.* ``COORDINATES / WIDTH`` bands of ``WIDTH`` bins each: two sets at similarity
0.75 share no band with a probability of 5e-6. Within a bucket, pairs are compared by a
byte of every bin; a pair at 0.75 is passed over with a probability below 1e-6.

*Verification.* What is left is confirmed on the full sets. Identical sets are one class
from the start. Buckets are cut into blocks of about ``BLOCK`` classes; a block proposes a
spanning forest of its likeliest pairs, no more edges than classes. Components of the
confirmed edges are then labels, and later rounds compare across labels only. In them the
largest label of a bucket and its other classes are blocks of their own, and a task holds
the tile of two of them, so each pair of a bucket meets in one tile. The last round confirms
all pairs that are left, so a link is lost to no limit: the sets of a tile's classes that
have such a pair go to the tile, and pairs are compared there and are never rows of a table.
A pair that shares several buckets is compared in that of its first band.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.components import components
from llm.storage import drop, land, small_if
from llm.text import blocks, mix, word_hashes, words

SHINGLE = 5
COORDINATES = 128
WIDTH = 4
BANDS = COORDINATES // WIDTH
BLOCK = 256
#: Blocks' worth of classes on each side of a tile.
TILE = 2
#: Sets that one set is compared with at a time.
MET = 64
#: Bins whose bytes must agree for a pair to be checked: 0.75 less 5.3 deviations.
LEAST_EQUAL = 70
#: The same for the rounds before the last, whose pairs should be links.
LIKELY_EQUAL = 90
_EMPTY = np.uint64(2**64 - 1)
_LOW = np.uint64(2**48 - 1)


def shingles(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per block: first row, number of rows, and the distinct shingles as (row, hash)
    in order of hash. A text of fewer words is one shingle, one without words has none."""
    for block in blocks(column):
        found = words(block)
        row, one = found.row, word_hashes(block, found, lower=True)
        count = np.bincount(row, minlength=block.rows)
        begin = np.cumsum(count) - count
        place = np.arange(len(row)) - begin[row]
        size = np.minimum(count, SHINGLE)
        lead = place <= (count - size)[row]
        at = np.flatnonzero(lead)
        value = size[row[at]].astype(np.uint64)
        for k in range(SHINGLE):
            inside = k < size[row[at]]
            part = one[np.minimum(at + k, max(len(one) - 1, 0))]
            value = np.where(inside, mix(value ^ part, k), value)
        order = np.argsort(value, kind="stable")
        value, owner = value[order], row[at][order]
        fresh = np.ones(len(value), dtype=bool)
        fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        yield block.first, block.rows, owner[fresh], value[fresh]


def sketch(rows: int, owner: np.ndarray, value: np.ndarray) -> np.ndarray:
    """``rows`` x ``COORDINATES`` values; a row without shingles stays at the maximum."""
    t = COORDINATES
    bins = np.full((rows, t), _EMPTY, dtype=np.uint64)
    flat = bins.reshape(-1)
    for i in range(2 * t):
        if not len(owner):
            break
        hashed = mix(value, i)
        left = (np.uint64(i) << np.uint64(48)) | (hashed & _LOW)
        column = (hashed >> np.uint64(48)) % np.uint64(t) if i < t else np.uint64(i - t)
        np.minimum.at(flat, owner * t + np.asarray(column).astype(np.int64), left)
        active = np.unique(owner) if i else np.arange(rows)
        open_ = np.zeros(rows, dtype=bool)
        open_[active] = (bins[active] == _EMPTY).any(axis=1)
        keep = open_[owner]
        owner, value = owner[keep], value[keep]
    return bins


SKETCHED = "doc_id long, n_shingles long, node binary, sig binary, bands array<long>"


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for first, rows, owner, value in shingles(batch.column(1)):
            n = np.bincount(owner, minlength=rows)
            bins = mix(sketch(rows, owner, value))
            digest = np.zeros((rows, 2), dtype=np.uint64)
            for k in (0, 1):
                np.add.at(digest[:, k], owner, mix(value, 1000 + k))
                digest[:, k] = mix(digest[:, k] ^ n.astype(np.uint64), k)
            low = bins.astype(np.uint8)
            bands = np.zeros((rows, BANDS), dtype=np.uint64)
            for k in range(WIDTH):  # of the bytes, so that two rows of bytes say which bands are shared
                bands = mix(bands ^ low[:, k::WIDTH].astype(np.uint64), k)
            band = np.arange(BANDS, dtype=np.uint64)
            bands = mix(bands + band)
            bands += band - bands % np.uint64(BANDS)
            node = [x.tobytes() if c else None for x, c in zip(digest, n, strict=True)]
            sig = [x.tobytes() if c else None for x, c in zip(low, n, strict=True)]
            flat = pa.array(bands.view(np.int64).reshape(-1))
            edges = np.arange(rows + 1, dtype=np.int32) * bands.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(first, rows),
                    pa.array(n.astype(np.int64)),
                    pa.array(node, pa.binary()),
                    pa.array(sig, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(edges), flat),
                ],
                names=["doc_id", "n_shingles", "node", "sig", "bands"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, rows, owner, value in shingles(batch.column(1)):
            n = np.bincount(owner, minlength=rows)
            digest = np.zeros((rows, 2), dtype=np.uint64)
            for k in (0, 1):
                np.add.at(digest[:, k], owner, mix(value, 1000 + k))
                digest[:, k] = mix(digest[:, k] ^ n.astype(np.uint64), k)
            order = np.argsort(owner, kind="stable")
            edges = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x.tobytes() for x in digest], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(edges), pa.array(value[order].view(np.int64))),
                ],
                names=["node", "shingles"],
            )


def _pairs(table: pa.Table, least: int, first_band: bool) -> tuple[np.ndarray, ...]:
    """Pairs of rows of the same (bucket, block) with different labels, and of different
    sides unless side is 2: the block of each, its rows, their labels, and how many bytes agree.

    Rows come sorted by bucket, block and side; columns: bucket, block, node, label, sig, side.
    With ``first_band`` a pair is one of the bucket of the first band that it shares only.
    """
    bucket = table.column("bucket").to_numpy()
    block = table.column("block").to_numpy()
    n = len(bucket)
    new = np.ones(n, dtype=bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | (block[1:] != block[:-1])
    group = np.cumsum(new) - 1
    label = np.unique(np.array(table.column("label").to_pylist(), dtype=object), return_inverse=True)[1]
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), dtype=np.uint8).reshape(n, -1)
    side = table.column("side").to_numpy()
    band = (bucket.view(np.uint64) % np.uint64(BANDS)).astype(np.int64)
    size = np.bincount(group)
    last = (np.cumsum(size) - 1)[group]
    left, right, equal = [], [], []
    at = np.arange(n)
    for step in range(1, int(size.max(initial=1))):
        at = at[at + step <= last[at]]
        other = at + step
        take = (label[at] != label[other]) & ((side[at] != side[other]) | (side[at] == 2))
        i, j = at[take], other[take]
        alike = sig[i] == sig[j]
        same = alike.sum(axis=1, dtype=np.int32)
        good = same >= least
        if first_band:
            good[good] = alike[good].reshape(-1, BANDS, WIDTH).all(axis=2).argmax(axis=1) == band[i[good]]
        left.append(i[good])
        right.append(j[good])
        equal.append(same[good])
    i, j, e = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (left, right, equal))
    la, lb = np.minimum(label[i], label[j]), np.maximum(label[i], label[j])
    order = np.lexsort((-e, lb, la, group[i]))
    return tuple(x[order] for x in (group[i], i, j, la, lb, e))


def _edges(table: pa.Table, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    nodes = table.column("node")
    a, b = nodes.take(pa.array(i)).to_pylist(), nodes.take(pa.array(j)).to_pylist()
    return pa.RecordBatch.from_arrays(
        [pa.array(map(max, a, b), pa.binary()), pa.array(map(min, a, b), pa.binary())], names=["a", "b"]
    )


def _proposer(limit: int | None):
    """Proposes a spanning forest of the likely pairs of each block, or without a limit all
    pairs that may be links."""

    def propose(table: pa.Table) -> list[pa.RecordBatch]:
        g, i, j, la, lb, e = _pairs(table, LIKELY_EQUAL if limit else LEAST_EQUAL, False)
        keep = np.ones(len(i), dtype=bool)
        if limit:
            keep[1:] = (g[1:] != g[:-1]) | (la[1:] != la[:-1]) | (lb[1:] != lb[:-1])
            keep = _forest(g, la, lb, e, keep)
        return [_edges(table, i[keep], j[keep])]

    return _by_block(propose)


def _ask(table: pa.Table) -> list[pa.RecordBatch]:
    """The rows that have a pair to be confirmed."""
    _, i, j, *_ = _pairs(table, LEAST_EQUAL, True)
    return table.take(pa.array(np.union1d(i, j))).combine_chunks().to_batches() if len(i) else []


def _confirm(table: pa.Table) -> list[pa.RecordBatch]:
    """A spanning forest of the links of each tile; rows have their sets, in order, as well."""
    g, i, j, la, lb, e = _pairs(table, LEAST_EQUAL, True)
    listed = table.column("shingles").combine_chunks()
    edges = listed.offsets.to_numpy()
    flat = listed.values.to_numpy().view(np.uint64)
    size = np.diff(edges).astype(np.int64)
    linked = 100 * np.minimum(size[i], size[j]) >= 75 * np.maximum(size[i], size[j])
    open_ = np.flatnonzero(linked)
    open_ = open_[np.argsort(i[open_], kind="stable")]
    for part in np.split(open_, np.flatnonzero(np.diff(i[open_])) + 1):
        if len(part):
            own, others = flat[edges[i[part[0]]] : edges[i[part[0]] + 1]], j[part]
            for k in range(0, len(part), MET):
                those = others[k : k + MET]
                theirs = np.concatenate([flat[edges[x] : edges[x + 1]] for x in those])
                there = own[np.minimum(np.searchsorted(own, theirs), len(own) - 1)] == theirs
                common = np.add.reduceat(there, np.cumsum(size[those]) - size[those], dtype=np.int64)
                linked[part[k : k + MET]] = 100 * common >= 75 * (len(own) + size[those] - common)
    keep = _forest(g, la, lb, e, linked)
    return [_edges(table, i[keep], j[keep])]


def _by_block(solve):
    """``solve`` for the whole blocks among the rows so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            bucket, block = held.column("bucket"), held.column("block")
            n = held.num_rows
            same = (bucket.to_numpy() == bucket[n - 1].as_py()) & (block.to_numpy() == block[n - 1].as_py())
            cut = int(np.argmax(same))
            if cut:
                yield from solve(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield from solve(held)

    return run


def _forest(group, la, lb, equal, keep) -> np.ndarray:
    """Of the pairs kept, those of a spanning forest of every group, likeliest first."""
    parent: dict[tuple[int, int], tuple[int, int]] = {}

    def root(x):
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    out = np.zeros(len(keep), dtype=bool)
    chosen = np.flatnonzero(keep)
    for k in chosen[np.lexsort((-equal[chosen], group[chosen]))]:
        a, b = root((group[k], la[k])), root((group[k], lb[k]))
        if a != b:
            parent[a] = b
            out[k] = True
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, node, component_id, kept`` for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links (100 * intersection >=
    75 * union), the row's own included; ``kept`` says that it is the row's own. Rows
    without words are linked with nothing and kept. Rows with the same id are rows of
    their own, so repeated rows are all kept together; ``one_of_each`` leaves one. A null
    id never names a component: such a row takes the smallest id of its component, or
    null. No rows give no rows; other columns do not matter.
    """
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketched = land(given.mapInArrow(_sketched, SKETCHED), "sketches")
    classes = land(
        sketched.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"), F.first("bands").alias("bands")),
        "classes",
    )
    members = _members(classes)
    wanted = members.select("rep").distinct()
    texts = given.join(small_if(land(wanted, "wanted")), given.doc_id.eqNullSafe(F.col("rep")), "left_semi")
    sets = land(
        texts.mapInArrow(_sets, "node binary, shingles array<long>").dropDuplicates(["node"]), "sets"
    )
    roots = None
    for k, links in enumerate((_proposed_links, _proposed_links, _all_links)):
        met = members
        if k == 1:
            met = members.where("n_blocks > 1")  # all classes of the other buckets have met
            if not met.head(1):
                continue
        confirmed = land(links(_labelled(met, roots, k == 0), sets), "links")
        if confirmed.head(1):  # else the components stay as they are
            # their stars stand for the links of earlier rounds: as connected, and short
            roots = components(confirmed if roots is None else confirmed.union(roots.select("node", "root")))
    named = classes.select("node", "rep")
    if roots is None:
        named = named.select("node", F.col("rep").alias("component_id"))
    else:
        linked = named.join(roots, "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root"))
        linked = land(linked, "linked")
        smallest = land(linked.groupBy("root").agg(F.min("rep").alias("component_id")), "smallest")
        named = land(linked.join(smallest, "root").select("node", "component_id"), "named")
    drop(members, sets)
    out = sketched.select("doc_id", "n_shingles", "node").join(named, "node", "left")
    out = out.withColumn("component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "n_shingles", "node", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _members(classes: DataFrame) -> DataFrame:
    """Classes by the buckets that hold at least two of them, cut into blocks."""
    placed = classes.select("node", F.explode("bands").alias("bucket"))
    shared = land(placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
    met = placed.join(small_if(shared), "bucket").select(
        "bucket",
        "node",
        F.ceil(F.col("size") / BLOCK).alias("n_blocks"),
        F.pmod(F.xxhash64("bucket", "node"), F.ceil(F.col("size") / BLOCK)).alias("block"),
    )
    met = land(met, "met")
    return land(met.join(classes.select("node", "rep", "sig"), "node"), "members")


def _labelled(members: DataFrame, roots: DataFrame | None, first: bool) -> DataFrame:
    """Blocks in the first round, then tiles of buckets with at least two labels, sorted for
    the proposer."""
    if first:
        rows = members.select("bucket", "block", "node", F.col("node").alias("label"), "sig", F.lit(2).alias("side"))
    else:
        if roots is None:
            known = members.withColumn("label", F.col("node"))
        else:
            known = land(members.join(roots, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root"), "labelled")
        share = known.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
        open_ = land(
            share.groupBy("bucket").agg(F.max(F.struct("n", "label")).alias("top"), F.count(F.lit(1)).alias("labels"), F.sum("n").alias("size")).where("labels > 1")
            .select("bucket", F.col("top.label").alias("main"), F.col("top.n").alias("n_main"), (F.col("size") - F.col("top.n")).alias("n_apart")),
            "open",
        )
        rows = known.join(open_, "bucket")
        rows = _tiles(rows)
    return _by_tile(rows)


def _by_tile(rows: DataFrame) -> DataFrame:
    return rows.repartition("bucket", "block").sortWithinPartitions("bucket", "block", "side", "node")


def _proposed_links(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links among likely pairs, no more of them than a block has classes."""
    return _confirmed(land(rows.mapInArrow(_proposer(1), "a binary, b binary").distinct(), "proposed"), sets)


def _all_links(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links that connect whatever the pairs of the tiles link."""
    asked = land(rows.mapInArrow(_by_block(_ask), rows.schema), "asked")
    return _by_tile(asked.join(sets, "node")).mapInArrow(_by_block(_confirm), "a binary, b binary").distinct()


def _tiles(rows: DataFrame) -> DataFrame:
    """Rows (``bucket, node, label, sig, main, n_main, n_apart``) in every tile of two blocks
    that they belong to: ``block`` names the tile, ``side`` 0 or 1 the block in it, 2 the one
    whose own pairs are compared there too.

    The main label's classes are in blocks of about ``TILE * BLOCK``, the others in blocks
    numbered on from there; no tile is of two blocks of the main label, nor of one block
    alone: the pairs inside a block are those of its tile with block 0.
    """
    n_main, n_apart = (F.ceil(F.col(c) / (TILE * BLOCK)).cast("long") for c in ("n_main", "n_apart"))
    is_main = F.col("label") == F.col("main")
    place = F.xxhash64("bucket", "node")
    own = F.when(is_main, F.pmod(place, n_main)).otherwise(n_main + F.pmod(place, n_apart))
    n = n_main + n_apart
    # a class of the main label meets the blocks of the others only, each of them the main label's first at least
    others = F.when(is_main, F.sequence(n_main, n - 1)).otherwise(F.filter(F.sequence(F.lit(0).cast("long"), n - 1), lambda x: x != own))
    met = rows.withColumn("own", own).withColumn("n", n).withColumn("other", F.explode(others))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(F.col("own") == low, 0).when(low == 0, 2).otherwise(1)
    return met.select("bucket", (low * F.col("n") + high).alias("block"), "node", "label", "sig", side.alias("side"))


def _confirmed(proposed: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = proposed.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    union = F.size("sa").cast("long") + F.size("sb") - F.col("common")
    return both.select("a", "b", "sa", "sb", common.alias("common")).where(100 * F.col("common") >= 75 * union).select("a", "b")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, each once.

    Rows without words stay. Of rows that repeat an id with the same set of shingles
    one stays. Rows with a null id cannot be told apart by it: they stay together if one
    of them has a component without any id.
    """
    found = near_duplicates(docs, id_col, text_col)
    ids = land(found.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")), "kept")
    gone, again = ids.where("not kept").select("doc_id"), ids.where("kept and n > 1").select("doc_id")
    kept = docs.join(small_if(gone), docs[id_col].eqNullSafe(gone["doc_id"]), "left_anti")
    if not again.head(1):
        return kept
    again = small_if(again)
    same = docs[id_col].eqNullSafe(again["doc_id"])
    repeated = kept.join(again, same, "left_semi").dropDuplicates([id_col, text_col])
    return kept.join(again, same, "left_anti").unionByName(repeated)
