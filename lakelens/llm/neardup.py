"""N-gram Jaccard join: a metric-space join on the Jaccard distance of word-shingle sets, exact.

1. Classes. Documents with equal shingle sets form a class; one row of each goes on, so copies are never paired.
2. Prefix cells. Where texts share nothing all distances are 1, and pivots can't cut the space; so shingles cut it first.
   All shingles have one global order: rarest first as far as they are frequent (counts of frequent shingles come from
   all documents), then by hash. A set lies in the cells of its first n - ceil(0.8 n) + 1 shingles; two sets of
   similarity 0.8 share one of these. Where they first share one, at places i and j of their orders, at most
   min(n - i, m - j) shingles are common; a cell brings together only what this bound, and the sizes, allow.
3. Pivots: in each cell the set that comes to it earliest in its order, so the one with the fewest shingles of its own.
   Sets are compared with the pivots of their cells.
4. Regions: a set belongs to all pivots within REGION of it, by its distance or what bounds it (6), whose regions are one. A region whose cells bring together many
   pairs for its sets is dense. It is split into blocks by hash, and its sets meet where two blocks meet, each set once for each
   block: there the intersections of all pairs come from bit columns of shared shingles, and what leaves is a row for each
   set, with the number of its links, and one for each set that joins another's component. No row stands for a pair.
5. Triangle inequality: of the sets that share a cell, and no dense region, those with |d(x, p) - d(y, p)| above 0.2 aren't linked.
6. Sketches: a set's sketch has a bit for each bucket of its shingles, set where their number is odd. Where the bits of two
   sketches differ, the sets do; so the differing bits bound the distance from below, and most pairs end here.
   What is left is compared as whole sets where blocks of regions meet, or at one of the two sets where pairs are few.
7. Components of the links by stars (large and small in turn), in tables. A row's n_links are the other rows it is linked
   with, copies (linked with similarity 1) by their number.

A dense region of m sets costs m * m / 2 intersections, done by words of 64 shingles, and m * m / DENSE_SETS sets sent.

The order of shingles, the pivots and the regions change cost only: every choice gives the same links.

Nulls: a null text, or one without words, has the empty set and is linked with nothing (n_links 0). A null doc_id is a document of
its own; component_id is the smallest doc_id that isn't null. Repeated rows are linked as copies are. An empty table gives
an empty result. Extra columns, of whatever name, are ignored by near_duplicates and kept by near_dedup. Texts of fewer than
five words are one shingle; a very long text is one set, and a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bitmap, discard, drop_rows, materialize, maybe_in, numbered, words_for
from .hashing import lean, ngrams, word_hashes

WINDOW = 5
#: Similarity as a fraction, 80 of 100.
PART, WHOLE = 80, 100
#: Shingles a task's summary of frequent ones holds, and how many the ordering uses: a bound, not a filter.
SUMMARY, FREQUENT, LEAST = 1 << 15, 1 << 15, 16
#: Regions of pivots with a set this near to both, as far as is known, are one.
REGION = 0.5
#: Sets and shingles of a block, about.
BLOCK_SETS, BLOCK_SHINGLES = 64, 200_000
#: Sets of a dense region's block, the pairs for each set sent that make a region dense, and the shared shingles held as bits at once.
DENSE_SETS, DENSE_PAIRS, COLUMNS = 512, 4, 1 << 13


def shingle_set(text: str | None) -> np.ndarray:
    words = word_hashes(text)
    return np.unique(ngrams(words, WINDOW if len(words) >= WINDOW else len(words))) if len(words) else np.zeros(0, np.uint64)


def prefix_length(n: int) -> int:
    return n - -(-PART * n // WHOLE) + 1 if n else 0


class Frequent:
    """Misra-Gries summary, a batch at a time: what stays has its count less at most total / SUMMARY."""

    def __init__(self) -> None:
        self.keys, self.counts, self.held, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

    def add(self, keys: np.ndarray) -> None:
        self.held.append(keys)
        self.size += len(keys)
        if self.size > 400_000:
            self.merge()

    def merge(self) -> None:
        if not self.held:
            return
        new, counts = np.unique(np.concatenate(self.held), return_counts=True)
        self.held, self.size = [], 0
        keys, at = np.unique(np.concatenate([self.keys, new]), return_inverse=True)
        sums = np.bincount(at, weights=np.concatenate([self.counts, counts])).astype(np.int64)
        if len(keys) > SUMMARY:
            sums = sums - np.partition(sums, -SUMMARY - 1)[-SUMMARY - 1]
        more = sums > 0
        self.keys, self.counts = keys[more], sums[more]


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """At most FREQUENT shingles in ascending order of their estimated counts over all documents."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Frequent()
        for batch in batches:
            for text in batch.column(0):
                found.add(shingle_set(text.as_py()))
        found.merge()
        more = found.counts > 1
        yield pa.RecordBatch.from_arrays([pa.array(found.keys[more].view(np.int64)), pa.array(found.counts[more])], ["h", "n"])

    got = docs.select("rec.text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)
    top = got.orderBy(F.desc("n"), "h").limit(FREQUENT).toArrow()
    return top.column("h").to_numpy().view(np.uint64)[::-1].copy()


def ordered_prefix(found: np.ndarray, keys: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first shingles of a sorted set in the global order; keys are the frequent ones, sorted, with their rank."""
    k = prefix_length(len(found))
    if len(keys):
        at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
        often = keys[at] == found
        if often.any():
            last = found[often][np.argsort(rank[at[often]], kind="stable")]
            found = np.concatenate([found[~often], last])
    return found[:k]


def sketch(found: np.ndarray) -> bytes:
    """A set's shingles by bucket, modulo 2: at least two buckets for each shingle, a power of two of them, packed."""
    size = 1 << max(9, min(20, (2 * len(found) - 1).bit_length())) if len(found) else 512
    odd = np.bincount((found >> np.uint64(7) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(bool)).tobytes()


def differing(a: bytes, b: bytes) -> int:
    """At least so many shingles are in one of two sets only. The longer sketch is folded to the length of the other."""
    x, y = (np.frombuffer(v, np.uint64) for v in ((a, b) if len(a) <= len(b) else (b, a)))
    if len(y) > len(x):
        y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def describe(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """Of a numbered table: _row, doc_id, n, key (of the set), prefix (the shingles of its window), sketch."""
    sort = np.argsort(frequent)
    shared = docs.sparkSession.sparkContext.broadcast((frequent[sort], sort))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, rank = shared.value
        for batch in batches:
            n, key, prefix, odd = [], [], [], []
            for text in batch.column(2):
                found = shingle_set(text.as_py())
                n.append(len(found))
                key.append(xxhash.xxh3_128_digest(found.tobytes()))
                prefix.append(ordered_prefix(found, keys, rank).tobytes())
                odd.append(sketch(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int32()), pa.array(key, pa.binary()), pa.array(prefix, pa.binary()), pa.array(odd, pa.binary())], ["_row", "doc_id", "n", "key", "prefix", "sketch"])

    rows = docs.select("_row", "rec.doc_id", "rec.text")
    return rows.mapInArrow(run, "_row long, doc_id long, n int, key binary, prefix binary, sketch binary")


def cells(rows: DataFrame) -> DataFrame:
    """h, x, n, i: a row for each cell that a set's window reaches; i is the cell's place in the set's order."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 500):
                part = batch.slice(a, 500)
                prefix = [np.frombuffer(x.as_py(), np.int64) for x in part.column(2)]
                lengths = [len(p) for p in prefix]
                x, n = (np.repeat(part.column(k).to_numpy(), lengths) for k in (0, 1))
                at = np.concatenate([np.arange(k, dtype=np.int32) for k in lengths])
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (np.concatenate(prefix), x, n, at)], ["h", "x", "n", "i"])

    return rows.select("x", "n", "prefix").mapInArrow(run, "h long, x long, n int, i int")


def allowed(n: str, i: str, m: str, j: str):
    """Whether sets of n and m shingles can be similar enough if they first share one at their places i and j."""
    return F.expr(f"{WHOLE + PART} * least({n} - {i}, {m} - {j}) >= {PART} * ({n} + {m}) and {WHOLE} * least({n}, {m}) >= {PART} * greatest({n}, {m})")


def sets_by_block(docs: DataFrame, needs: DataFrame) -> DataFrame:
    """block, x, shingles: the set of each needed row, once for each block. needs has x and its blocks."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                blocks = batch.column(2)[k].values
                raw = shingle_set(batch.column(1)[k].as_py()).tobytes()
                most = max(1, (4 << 20) // max(1, len(raw)))
                for a in range(0, len(blocks), most):
                    part = blocks.slice(a, most)
                    yield pa.RecordBatch.from_arrays([part, pa.array(np.full(len(part), batch.column(0)[k].as_py())), pa.array([raw] * len(part), pa.binary())], ["block", "x", "shingles"])

    size = words_for(needs.count())
    rows = maybe_in(docs.select(F.col("_row").alias("x"), F.col("rec.text").alias("text")), bitmap(needs, F.col("x"), size), F.col("x"), "_maybe", size)
    return rows.where("_maybe").join(needs, "x").select("x", "text", "blocks").mapInArrow(run, "block long, x long, shingles binary")


def overlaps(pairs: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
    """Of one block: its pairs with the exact sizes of intersection and union."""
    known = {x: np.frombuffer(s, np.uint64) for x, s in zip(sets["x"], sets["shingles"], strict=True)}
    both, union = [], []
    for x, y in zip(pairs["x"], pairs["y"], strict=True):
        merged = np.concatenate([known[x], known[y]])
        merged.sort(kind="stable")
        both.append(int((merged[1:] == merged[:-1]).sum()))
        union.append(len(merged) - both[-1])
    return pd.DataFrame({"x": pairs["x"], "y": pairs["y"], "both": np.array(both, np.int32), "all": np.array(union, np.int32)})


def bounded(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """A table of pairs (x, y), a table, with low: the distance is at least that, by their sketches."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = []
            for n, a, m, b in zip(*(batch.column(k).to_pylist() for k in range(2, 6)), strict=True):
                least = max(abs(n - m), differing(a, b))
                low.append(2 * least / (n + m + least))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(low, pa.float64())], ["x", "y", "low"])

    wanted = pairs.select("x").unionByName(pairs.select(F.col("y").alias("x")))
    size = words_for(2 * pairs.count())
    known = maybe_in(rows.select(F.col("_row").alias("x"), "n", "sketch"), bitmap(wanted, F.col("x"), size), F.col("x"), "_maybe", size).where("_maybe")
    left = pairs.select("x", "y").join(known.select("x", "n", F.col("sketch").alias("a")), "x")
    joined = left.join(known.select(F.col("x").alias("y"), F.col("n").alias("m"), F.col("sketch").alias("b")), "y")
    return materialize(joined.select("x", "y", "n", "a", "m", "b").mapInArrow(run, "x long, y long, low double"), "bounds")


def compared(docs: DataFrame, pairs: DataFrame, regions: DataFrame) -> DataFrame:
    """A table of pairs (x, y), a table, with the exact sizes of intersection and union. regions: x, n, region, a table with a
    row for each member of a pair at least."""
    members = pairs.select("x").unionByName(pairs.select(F.col("y").alias("x"))).distinct()
    here = materialize(members.join(regions, "x").select("x", "n", "region"), "members")
    at = here.select("x", F.col("region").alias("at_x"))
    joined = pairs.select("x", "y").join(at, "x").join(at.select(F.col("x").alias("y"), F.col("at_x").alias("at_y")), "y")
    inside = joined.where("at_x = at_y").groupBy(F.col("at_x").alias("region")).agg(F.count("*").alias("pairs"))
    blocks = here.groupBy("region").agg(F.count("*").alias("sets"), F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    dense = blocks.join(inside, "region").where("sets * blocks <= sets + pairs").select(F.col("region").alias("at_x"), "blocks")
    stars = pairs.groupBy("x").agg(F.ceil(F.count("*") / BLOCK_SETS).alias("parts"))
    home = lambda v: F.xxhash64("at_x", F.pmod(F.xxhash64(v), F.col("blocks")))
    of_blocks = F.when((F.col("at_x") == F.col("at_y")) & F.col("blocks").isNotNull(), F.xxhash64(F.least(home("x"), home("y")), F.greatest(home("x"), home("y"))))
    of_star = F.xxhash64("x", F.pmod(F.xxhash64("y"), F.col("parts")))
    met = joined.join(dense, "at_x", "left").join(stars, "x").select("x", "y", F.coalesce(of_blocks, of_star).alias("block"))
    met = materialize(met, "met")
    needs = met.select("x", "block").unionByName(met.select(F.col("y").alias("x"), "block")).groupBy("x").agg(F.collect_set("block").alias("blocks"))
    needs = materialize(needs, "needs")
    sets = sets_by_block(docs, needs)
    got = materialize(met.groupBy("block").cogroup(sets.groupBy("block")).applyInPandas(overlaps, "x long, y long, both int, all int"), "overlaps")
    discard(here, met, needs)
    return got


def linked():
    return F.expr(f"{WHOLE} * both >= {PART} * all")


def intersections(sets: list[np.ndarray], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The sizes of the intersections of the sets at the places first with those at second."""
    got = np.zeros((len(first), len(second)), np.int64)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = count > 1
    kept = shared[column]
    row, column = row[kept], (np.cumsum(shared) - 1)[column[kept]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for a in range(0, int(shared.sum()), COLUMNS):
        low, high = np.searchsorted(column, [a, a + COLUMNS])
        bits = np.zeros((len(sets), COLUMNS), bool)
        bits[row[low:high], column[low:high] - a] = True
        words = np.packbits(bits, axis=1).view(np.uint64)
        others = words[second]
        for k, x in enumerate(first):
            got[k] += np.bitwise_count(others & words[x]).sum(axis=1, dtype=np.int64)
    return got


def least_linked(links: np.ndarray) -> np.ndarray:
    """Of a symmetric matrix of links: the least place in the component of each."""
    label = np.arange(len(links))
    while True:
        near = np.minimum(label, np.where(links, label, len(links)).min(axis=1, initial=len(links)))
        np.minimum.at(near, label, near.copy())
        near = near[near]
        if (near == label).all():
            return label
        label = near


def meeting(members: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
    """Where two blocks of a dense region meet, or a block itself: x and others, the rows in sets linked with it; x and y, a set
    of its component here."""
    known = {x: np.frombuffer(s, np.uint64) for x, s in zip(sets["x"], sets["shingles"], strict=True)}
    members = members.sort_values("x")
    x, copies, side = (members[k].to_numpy() for k in ("x", "copies", "side"))
    held = [known[k] for k in x]
    n = np.array([len(s) for s in held])
    own = not (side == 1).any()
    first, second = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    both = intersections(held, first, second)
    near = WHOLE * both >= PART * (n[first][:, None] + n[second] - both)
    links = np.zeros((len(x), len(x)), bool)
    links[np.ix_(first, second)] = near
    if not own:
        links[np.ix_(second, first)] = near.T
    np.fill_diagonal(links, False)
    others = links @ copies
    root = least_linked(links)
    some, apart = np.flatnonzero(others), np.flatnonzero(root != np.arange(len(x)))
    counted = pd.DataFrame({"x": x[some], "y": pd.array([None] * len(some), "Int64"), "others": pd.array(others[some], "Int64")})
    joined = pd.DataFrame({"x": x[apart], "y": pd.array(x[root[apart]], "Int64"), "others": pd.array([None] * len(apart), "Int64")})
    return pd.concat([counted, joined], ignore_index=True)


def dense_regions(known: DataFrame, regions: DataFrame) -> DataFrame:
    """A table region, blocks: the regions whose cells bring together many pairs for the sets that their blocks send."""
    inside = known.groupBy("h", "region").agg(F.count("*").alias("c")).where("c > 1").groupBy("region").agg(F.sum(F.expr("c * (c - 1) / 2")).alias("pairs"))
    blocks = F.greatest(F.ceil(F.count("*") / DENSE_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES))
    sizes = regions.groupBy("region").agg(F.count("*").alias("sets"), blocks.alias("blocks"))
    return materialize(sizes.join(inside, "region").where(f"{DENSE_PAIRS} * sets * blocks <= least(pairs, sets * (sets - 1) / 2)").select("region", "blocks"), "dense-regions")


def dense_links(docs: DataFrame, dense: DataFrame) -> DataFrame:
    """A table x, y, others (see meeting) of all links inside dense regions. dense: x, region, blocks, copies."""
    block = F.expr("pmod(xxhash64(x), blocks)")
    met = dense.withColumn("own", block).withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    met = met.select(F.xxhash64("region", F.least("own", "other"), F.greatest("own", "other")).alias("block"), "x", "copies", F.expr("case when own < other then 0 when own > other then 1 else 2 end").alias("side"))
    met = materialize(met, "dense-blocks")
    needs = materialize(met.groupBy("x").agg(F.collect_list("block").alias("blocks")), "dense-needs")
    sets = sets_by_block(docs, needs)
    got = materialize(met.groupBy("block").cogroup(sets.groupBy("block")).applyInPandas(meeting, "x long, y long, others long"), "dense-links")
    discard(met, needs)
    return got


def components(edges: DataFrame) -> DataFrame:
    """A table node, root (smallest reachable) of each node that has an edge (a, b). Each round is a table of at most as many
    rows as there are edges; rounds grow with the logarithm of a component's diameter."""
    state = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    state, before = materialize(state, "stars"), None
    while True:
        x = state.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if before == (x.n, x.s):
            break
        before = (x.n, x.s)
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        pulled = large.join(least, "a").select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e")).select(F.col("e.b").alias("a"), F.col("e.m").alias("b"))
        used, state = state, materialize(pulled.where("a <> b").distinct(), "stars")
        discard(used)
    roots = state.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    got = materialize(roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()), "roots")
    discard(state)
    return got


def pivoted_cells(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """A table of the cells of one set of each class, without those that one set reaches alone: h, x, n, i, the pivot p of
    each, its pn and pi, and the count c. A filter keeps most of the lone cells from being shuffled a second time."""
    some = rows.where("n > 0")
    copies = materialize(some.select("_row", "key").join(classes.select("key", "x"), "key").where("_row <> x").select("_row"), "class-copies")
    entries = cells(drop_rows(some.select("_row", "n", "prefix"), copies).withColumnRenamed("_row", "x"))
    first = F.min(F.struct("i", "x", "n")).alias("p")
    shared = materialize(entries.groupBy("h").agg(F.count("*").alias("c"), first).where("c > 1").select("h", "c", F.col("p.x").alias("p"), F.col("p.n").alias("pn"), F.col("p.i").alias("pi")), "shared-cells")
    size = words_for(shared.count())
    maybe = maybe_in(entries, bitmap(shared, F.col("h"), size), F.col("h"), "_maybe", size).where("_maybe").select("h", "x", "n", "i")
    joined = materialize(maybe.join(shared, "h"), "cells")
    discard(copies, shared)
    return joined


def ordered(x: str, y: str) -> list:
    return [F.greatest(x, y).alias("x"), F.least(x, y).alias("y")]


def cell_pairs(known: DataFrame) -> DataFrame:
    """x, y: the pairs of a cell that share no dense region g (-1: none) and may be linked. Groups meet first, by the bounds of
    their sets, so that the sets of one dense region are never joined with each other."""
    groups = known.groupBy("h", "g").agg(F.min("n").alias("a"), F.max("n").alias("b"), F.max(F.expr("n - i")).alias("l"), F.count("*").alias("c"))
    second = groups.select("h", *[F.col(c).alias(f"{c}2") for c in ("g", "a", "b", "l")])
    met = groups.join(second, "h").where(
        f"(g < g2 or g = -1 and g2 = -1 and c > 1) and {WHOLE} * b >= {PART} * a2 and {WHOLE} * b2 >= {PART} * a and {WHOLE + PART} * least(l, l2) >= {PART} * (a + a2)"
    )
    other = known.select("h", *[F.col(c).alias(f"{c}2") for c in ("g", "x", "n", "i", "d", "low")])
    limit = 1 - PART / WHOLE
    pairs = known.join(met.select("h", "g", "g2"), ["h", "g"]).join(other, ["h", "g2"]).where(
        ((F.col("x") > F.col("x2")) | (F.col("g") != F.col("g2")))
        & allowed("n", "i", "n2", "i2")
        & F.coalesce(F.col("low2") - F.col("d") <= limit + 1e-9, F.lit(True))
        & F.coalesce(F.col("low") - F.col("d2") <= limit + 1e-9, F.lit(True))
    )
    return pairs.select(*ordered("x", "x2")).distinct()


def links(docs: DataFrame, rows: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tables a, b: every link between classes (by their rows, a > b) outside dense regions, once; and x, y, others: those inside
    of them, as the number of rows linked with x, or a set y that x is connected with."""
    limit = 1 - PART / WHOLE
    entries = pivoted_cells(rows, classes)
    homes = materialize(entries.groupBy("x").agg(F.first("n").alias("n"), F.min("p").alias("region")), "first-regions")
    stars = entries.where((F.col("x") != F.col("p")) & allowed("n", "i", "pn", "pi")).select("x", F.col("p").alias("y")).distinct()
    stars = materialize(stars, "star-pairs")
    bounds = bounded(rows, stars)
    near = compared(docs, materialize(bounds.where(F.col("low") <= limit + 1e-9), "star-pairs"), homes)
    exact = near.select("x", F.col("y").alias("p"), (1 - F.col("both") / F.col("all")).alias("d"))
    distance = bounds.select("x", F.col("y").alias("p"), "low").join(exact, ["x", "p"], "left").select("x", "p", "d", F.coalesce("d", "low").alias("low"))
    distance = materialize(distance, "distances")
    roots = components(distance.where(F.col("low") <= REGION).select(F.col("x").alias("a"), F.col("p").alias("b")))
    regions = homes.join(roots, F.col("x") == F.col("node"), "left").select("x", "n", F.coalesce("root", "x").alias("region"))
    regions = materialize(regions, "regions")
    placed = entries.where("c > 2 and x <> p").select("h", "x", "n", "i", "p").join(distance, ["x", "p"], "left").join(regions.select("x", "region"), "x")
    placed = materialize(placed.select("h", "x", "n", "i", "d", "low", "region"), "cells-by-distance")
    where = dense_regions(placed, regions)
    dense = materialize(regions.join(where, "region").join(classes.select("x", "copies"), "x").select("x", "region", "blocks", "copies"), "dense-sets")
    inside = dense_links(docs, dense)
    known = placed.join(where.select("region", F.col("region").alias("g")), "region", "left").select("h", "x", "n", "i", "d", "low", F.coalesce("g", F.lit(-1).cast("long")).alias("g"))
    known = materialize(known, "cells-by-region")
    pairs = materialize(cell_pairs(known).join(stars.select(*ordered("x", "y")), ["x", "y"], "left_anti"), "pairs")
    discard(entries, placed, known)
    further = bounded(rows, pairs)
    more = compared(docs, materialize(further.where(F.col("low") <= limit + 1e-9), "bounded-pairs"), regions)
    at = dense.select("x", F.col("region").alias("at_x"))
    apart = near.where(linked()).select(*ordered("x", "y")).join(at, "x", "left").join(at.select(F.col("x").alias("y"), F.col("at_x").alias("at_y")), "y", "left")
    apart = apart.where("coalesce(at_x <> at_y, true)").select("x", "y")
    found = apart.unionByName(more.where(linked()).select(*ordered("x", "y")))
    found = materialize(found.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "links")
    discard(homes, stars, bounds, near, distance, pairs, roots, regions, where, dense, further, more)
    return found, inside


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: _row, doc_id, n_shingles, component_id, keep_row (of the document that stays), n_links."""
    rows = numbered(docs.select("doc_id", "text"))
    found = near_numbered(rows)
    discard(rows)
    return found


def near_numbered(docs: DataFrame) -> DataFrame:
    """near_duplicates of a numbered table, as a table."""
    rows = materialize(describe(docs, frequent_shingles(docs)), "shingle-sets")
    some = rows.where("n > 0")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("_row").alias("c")))
    classes = materialize(some.groupBy("key").agg(F.min("_row").alias("x"), first.alias("best"), F.count("*").alias("copies")), "classes")
    found, inside = links(docs, rows, classes)
    roots = components(found.unionByName(inside.where("y is not null").select(F.col("x").alias("a"), F.col("y").alias("b"))))
    both = found.select("a", "b").unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(classes.select(F.col("x").alias("b"), "copies"), "b").select("a", "copies")
    others = others.unionByName(inside.where("others is not null").select(F.col("x").alias("a"), F.col("others").alias("copies"))).groupBy("a").agg(F.sum("copies").alias("others"))
    rooted = classes.select("key", "x", "best", "copies").join(roots, F.col("x") == F.col("node"), "left").withColumn("root", F.coalesce("root", "x"))
    best = rooted.groupBy("root").agg(F.min("best").alias("best"))
    n_links = (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    final = rooted.join(others, F.col("x") == F.col("a"), "left").select("key", "root", n_links).join(best, "root")
    final = final.select("key", F.col("best.b").alias("component_id"), F.col("best.c").alias("keep_row"), "n_links")
    named = rows.select("_row", "doc_id", "n", "key").where("n > 0").join(final, "key").drop("key")
    empty = rows.where("n = 0").select("_row", "doc_id", "n", F.col("doc_id").alias("component_id"), F.col("_row").alias("keep_row"), F.lit(0).cast("long").alias("n_links"))
    got = named.unionByName(empty).select("_row", "doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id", "keep_row", "n_links")
    got = materialize(got, "near-duplicates")
    discard(rows, classes, found, inside, roots)
    return got


def near_dedup(docs: DataFrame) -> DataFrame:
    """One document of each component, with all its columns: the one of smallest doc_id."""
    rows = numbered(docs)
    found = near_numbered(rows)
    dropped = materialize(found.where("_row <> keep_row").select("_row"), "near-dropped")
    discard(found)
    return drop_rows(rows, dropped).select("rec.*")
