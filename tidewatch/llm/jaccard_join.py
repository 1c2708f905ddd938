"""Exact Jaccard join on word shingles by T-occurrence search, and its components.

Documents with equal shingle sets are one node. Two nodes link when their sets overlap by a required number of
shingles, so linking asks how many inverted lists they share. In one fixed order of all shingles, rare ones
first, linked sets share some of their first shingles; only the lists of these are built and merged by a shuffle:

1. A sketch of fixed size counts all shingles; its levels give the order, which only steers the work.
2. Every node puts its first shingles into inverted lists; lists with one node are dropped.
3. In each list the node that shares most of its shingles is a star: the other nodes are searched for it. A star's
   search is DivideSkip: short lists are merged with a heap, long ones probed by binary search, and nodes that reach the
   required overlap are kept. Blocks of a star's candidates are searched apart, so a group of any size is split.
4. Nodes linked so far are components. Where a list still holds several, stars are tried anew while that
   helps; then every pair of nodes from different components that shares enough lists is searched.

Pairs within a component are never listed, and no pair that could join two components is left out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import chunks_of, free_name, lower_ascii
from tidewatch.runtime import MIB, broadcast_counted, materialize

SHINGLE = 5
#: Linked: SHARE[1] * intersection >= SHARE[0] * union.
SHARE = (4, 5)
#: Lists that linked sets share at least, among those of their first shingles.
COMMON = 4

#: Bins of the sketch, and how it is cut for adding up.
BINS = 1 << 22
CHUNK = 1 << 14

#: Candidates of a query searched at a time.
BLOCK = 256

#: Nodes of a component, and nodes that look for partners in it, that meet in one block.
SIDE = 512

#: A list with nodes of more components than this one is a crowd: its pairs are not joined as rows but searched in blocks.
CROWD = 128

#: Shingles of a level above this one are frequent, and their lists are dealt by node into so many parts. A list of any
#: other shingle holds at most about 2^OFTEN / BINS of all shingles.
OFTEN = 4
PARTS = 64

#: What is asked of the documents is broadcast up to this many bytes, at so many a row; beyond, it is joined by a shuffle.
BROADCAST_ROLES = 32 * MIB
ROLE_BYTES = 40

CHUNK_BYTES = 4 << 20
_SHIFT = np.uint64(64 - BINS.bit_length() + 1)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


# Shingle sets

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The distinct shingles of each text as ascending 64-bit hashes. With fewer words than a shingle has, the
    sequence is the one element; without words there is none."""
    tokens = [lower_ascii(t).split() for t in texts]
    known = dict.fromkeys(chain.from_iterable(tokens))
    for word in known:
        known[word] = xxhash.xxh64_intdigest(word)
    sizes = [len(found) for found in tokens]
    codes = np.fromiter(map(known.__getitem__, chain.from_iterable(tokens)), np.uint64, sum(sizes))
    h = np.full(len(codes), SHINGLE, np.uint64)
    for i in range(SHINGLE):  # all texts at once; shingles across two texts are not used
        h[:len(h) - i] = _mix(h[:len(h) - i] * _MULTIPLIER + codes[i:])
    out, at = [], 0
    for n in sizes:
        if n >= SHINGLE:
            own = np.sort(h[at:at + n - SHINGLE + 1])
            fresh = own[1:] != own[:-1]
            out.append(own if fresh.all() else own[np.concatenate([[True], fresh])])
        elif n:
            short = np.full(1, n, np.uint64)
            for code in codes[at:at + n]:
                short = _mix(short * _MULTIPLIER + code)
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def fingerprint(shingles: np.ndarray) -> int:
    """A signed 64-bit number of a set; 0 for the empty one."""
    return xxhash.xxh64_intdigest(shingles.tobytes(), seed=len(shingles)) - (1 << 63) if len(shingles) else 0


def least_overlap(a: int, b: int) -> int:
    """The overlap that sets of a and b shingles need: 9 * overlap >= 4 * (a + b) for 4/5."""
    top, bottom = SHARE
    return -(-top * (a + b) // (top + bottom))


def first_shingles(n: int) -> int:
    """How many of a set's first shingles must be looked at so that linked sets share COMMON of them."""
    return n - -(-SHARE[0] * n // SHARE[1]) + COMMON


# 1. Nodes and the sketch

_NODE = "doc_id bigint, fp bigint, n int, chunk int, counts binary"


def read_sets(docs: DataFrame) -> DataFrame:
    """Document rows (doc_id, fp, n) and, per task, the sketch of its shingles in chunks."""
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    names = ["doc_id", "fp", "n", "chunk", "counts"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(BINS, np.int32)
        for part in chunks_of(batches, "text", CHUNK_BYTES):
            sets = shingle_sets(part.column("text").to_pylist())
            bins, times = np.unique((np.concatenate(sets) >> _SHIFT).astype(np.int64), return_counts=True)
            sketch[bins] += times.astype(np.int32)
            n = len(sets)
            columns = [part.column("doc_id"), [fingerprint(s) for s in sets], [len(s) for s in sets], [None] * n, [None] * n]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)], names)
        cuts = sketch.reshape(-1, CHUNK)
        there = np.flatnonzero(cuts.sum(axis=1)).tolist()
        columns = [[None] * len(there)] * 3 + [there, [np.minimum(cuts[i], 0xFFFF).astype("<u2").tobytes() for i in there]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return docs.mapInArrow(read, _NODE)


def order_levels(read: DataFrame) -> np.ndarray:
    """A level per bin: 0 for common counts, higher for bins that hold frequent shingles. BINS bytes."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts")):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(counts.as_py(), "<u2").astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
                                         ["chunk", "counts"])

    parts = read.where("chunk is not null").select("chunk", "counts").repartition("chunk").mapInArrow(add, "chunk int, counts binary")
    counts = np.zeros(BINS)
    for chunk, data in parts.collect():  # the sketch has a fixed size
        counts[chunk * CHUNK:(chunk + 1) * CHUNK] = np.frombuffer(data, "<i8")
    usual = max(counts.mean(), 1.0)
    noise = usual + 4 * np.sqrt(usual)
    return np.clip(np.floor(np.log2(np.maximum(counts / noise, 0.5))) + 1, 0, 255).astype(np.uint8)


# 2. Inverted lists of first shingles

def list_entries(docs: DataFrame, levels: np.ndarray) -> DataFrame:
    """(s, fp, n, often): each set's first shingles, and which of them are frequent. Copies met by the same task enter
    once."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, met = shared.value, set()
        for part in chunks_of(batches, "text", CHUNK_BYTES):
            shingles, fps, sizes, often = [], [], [], []
            for s in shingle_sets(part.column("text").to_pylist()):
                n = len(s)
                if n < COMMON:  # so small sets link with equal ones only
                    continue
                fp = fingerprint(s)
                if fp in met:
                    continue
                if len(met) > 1_000_000:
                    met.clear()
                met.add(fp)
                first = first_shingles(n)
                of = level[(s >> _SHIFT).astype(np.int64)]
                if first < n:
                    chosen = np.argsort(of, kind="stable")[:first]  # s is ascending: ties go by hash
                    s, of = s[chosen], of[chosen]
                shingles.append(s)
                often.append(of > OFTEN)
                fps.append(fp)
                sizes.append(n)
            lens = [len(s) for s in shingles]
            flat = np.concatenate(shingles).view(np.int64) if shingles else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(np.repeat(np.array(fps, np.int64), lens)),
                                              pa.array(np.repeat(np.array(sizes, np.int32), lens)),
                                              pa.array(np.concatenate(often) if often else np.zeros(0, bool))],
                                             ["s", "fp", "n", "often"])

    return docs.mapInArrow(read, "s bigint, fp bigint, n int, often boolean")


def shared_lists(entries: DataFrame) -> DataFrame:
    """(s, fp, n, shared): the entries of lists with two nodes at least, and of frequent shingles; `shared` is how many
    such lists a node is in.

    One shuffle by shingle drops repeated entries and counts the nodes of a list. The lists of frequent shingles are dealt
    by shingle and node, and kept: only a text with very many copies can be alone in one.
    """
    dealt = entries.withColumn("part", F.when(F.col("often"), F.pmod(F.xxhash64("fp"), F.lit(PARTS))).otherwise(0).cast("int"))
    dealt = dealt.repartition("s", "part").dropDuplicates(["s", "part", "fp", "n"])
    dealt = dealt.withColumn("nodes", F.count(F.lit(1)).over(Window.partitionBy("s", "part")))
    kept = materialize(dealt.where("often or nodes > 1").select("s", "fp", "n"), "join-lists")
    shared = kept.groupBy("fp").agg(F.count(F.lit(1)).alias("shared")).withColumnRenamed("fp", "of")
    return materialize(kept.join(shared, F.col("fp") == F.col("of")).drop("of"), "join-shared")


# 3. T-occurrence search

def divide_skip(query: np.ndarray, candidates: list[np.ndarray], mu: float = 0.02) -> list[tuple[int, int]]:
    """(candidate, overlap) of the candidates whose overlap with the query reaches what their sizes require.

    `query` and candidates are ascending. The inverted lists of the query's shingles hold candidates, ascending. The
    longest lists are set aside; whoever is in enough of the others, merged with a heap, is looked up in the long ones.
    """
    sizes = np.array([len(c) for c in candidates])
    need = np.array([least_overlap(len(query), n) for n in sizes.tolist()])
    flat = np.concatenate(candidates)
    of = np.repeat(np.arange(len(candidates)), sizes)
    place = np.minimum(np.searchsorted(query, flat), len(query) - 1)
    hit = query[place] == flat
    place, of = place[hit], of[hit]
    if not len(place):
        return []
    order = np.lexsort((of, place))
    place, of = place[order], of[order]
    cuts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1], [True]]))
    return reach([of[a:b] for a, b in zip(cuts, cuts[1:])], need, mu)


def reach(lists: list[np.ndarray], need: np.ndarray, mu: float = 0.02) -> list[tuple[int, int]]:
    """(candidate, lists it is in) of the candidates that are in as many of the lists as they need.

    The lists hold candidates, ascending, as places of `need`.
    """
    lists = sorted(lists, key=len, reverse=True)
    least = int(need.min())
    if len(lists) < least:
        return []
    aside = min(least - 1, int(least / (mu * np.log2(len(lists[0]) + 1) + 1)))
    long, short = lists[:aside], lists[aside:]
    found, counts = [], []
    current, count = -1, 0
    for candidate in heapq.merge(*[x.tolist() for x in short]):
        if candidate == current:
            count += 1
            continue
        if count >= least - aside and current >= 0:
            found.append(current)
            counts.append(count)
        current, count = candidate, 1
    if count >= least - aside and current >= 0:
        found.append(current)
        counts.append(count)
    found, counts = np.array(found, np.int64), np.array(counts, np.int64)
    for left, held in zip(range(len(long), 0, -1), long):
        alive = counts + left >= need[found]  # skip who can no longer reach it
        if not alive.all():
            found, counts = found[alive], counts[alive]
        if not len(found):
            return []
        at = np.minimum(np.searchsorted(held, found), len(held) - 1)
        counts = counts + (held[at] == found)
    good = counts >= need[found]
    return list(zip(found[good].tolist(), counts[good].tolist()))


def role_sets(docs: DataFrame, roles: DataFrame) -> DataFrame:
    """(a, block, b, shingles): the set of every role (rep, fp, a, block, b), read again from one document of the node.

    Rows of one text follow each other, so its set is made once in a slice of them.
    """
    held = F.broadcast(roles) if ROLE_BYTES * roles.count() <= BROADCAST_ROLES else roles
    texts = docs.join(held, F.col("doc_id").eqNullSafe(F.col("rep"))).select("text", "fp", "a", "block", "b")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[tuple] = set()  # repeated ids ask for the same again
        for part in chunks_of(batches, "text", CHUNK_BYTES):
            asked = list(zip(*[part.column(c).to_pylist() for c in ("text", "fp", "a", "block", "b")]))
            texts = list({text for text, *_ in asked})
            sets = {text: (fingerprint(s), s.tobytes()) for text, s in zip(texts, shingle_sets(texts))}
            if len(met) > 500_000:
                met.clear()
            out = []
            for text, fp, *role in asked:
                found, data = sets[text]
                key = (fp, *role)
                if found == fp and key not in met:  # repeated ids may stand for other texts
                    met.add(key)
                    out.append((*role, data))
            columns = list(zip(*out)) if out else [[]] * 4
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["a", "block", "b", "shingles"])

    return texts.mapInArrow(read, "a bigint, block int, b bigint, shingles binary")


def search(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b): the linked ones among candidate pairs (a, b), each a a query with its candidates b.

    The texts of the nodes are met where they are scanned, and each set goes once to every block that needs it.
    """
    pairs = materialize(pairs, "join-pairs")
    width = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")).withColumnRenamed("a", "q")
    dealt = pairs.join(width, F.col("a") == F.col("q")).select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("block"))
    asked = dealt.select("a", "block").distinct().select("a", "block", F.lit(None).cast("bigint").alias("b"))
    roles = asked.unionByName(dealt.select("a", "block", "b")).withColumn("of", F.coalesce("b", "a"))
    roles = materialize(roles.join(nodes, F.col("of") == F.col("fp")).select("rep", "fp", "a", "block", "b"), "join-roles")
    rows = role_sets(docs, roles).repartition("a", "block").sortWithinPartitions("a", "block", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, own, ids, sets_here = np.zeros(0, np.uint64), None, [], []

        def finish() -> list[tuple[int, int]]:
            return [(own, ids[i]) for i, _ in divide_skip(query, sets_here)] if ids else []

        for batch in batches:
            out = []
            for a, b, data in zip(*[batch.column(c).to_pylist() for c in ("a", "b", "shingles")]):
                if b is None:
                    out += finish()
                    query, own, ids, sets_here = np.frombuffer(data, np.uint64), a, [], []
                else:
                    ids.append(b)
                    sets_here.append(np.frombuffer(data, np.uint64))
                    if len(ids) >= BLOCK:
                        out += finish()
                        ids, sets_here = [], []
            columns = list(zip(*out)) if out else [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])
        out = finish()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])

    return materialize(rows.mapInArrow(run, "a bigint, b bigint"), "join-links")


# 4. Components

def components(links: DataFrame) -> DataFrame:
    """(fp, comp): the smallest node reachable, for every node with a link. Labels pass along links and are then
    looked up at the label itself, so that chains shorten by halves."""
    both = materialize(links.select("a", "b").union(links.select("b", "a")).distinct(), "join-edges")
    labels = materialize(both.groupBy(F.col("a").alias("fp")).agg(F.min("b").alias("b")).select(
        "fp", F.least("fp", "b").alias("comp")), "join-labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("fp")).groupBy("a").agg(F.min("comp").alias("near"))
        own = labels.join(near, F.col("fp") == F.col("a")).select("fp", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        far = labels.select(F.col("fp").alias("at"), F.col("comp").alias("far"))
        new = materialize(own.join(far, F.col("comp") == F.col("at"), "left").select(
            "fp", "old", F.least("comp", F.coalesce("far", "comp")).alias("comp")), "join-labels")
        changed = new.where("old <> comp").limit(1).count()
        labels = new.select("fp", "comp")
        if not changed:
            return labels


def _labelled(lists: DataFrame, links: DataFrame) -> DataFrame:
    """The entries of lists that hold several components, with `comp`."""
    labels = components(links).withColumnRenamed("fp", "of")
    met = lists.join(labels, F.col("fp") == F.col("of"), "left").select("s", "fp", "n", "shared", F.coalesce("comp", "fp").alias("comp"))
    met = materialize(met, "join-labelled")
    mixed = met.groupBy("s").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("s")
    return materialize(met.join(mixed, "s"), "join-mixed")


def _sizes_fit(a: str, b: str) -> str:
    return f"{SHARE[1]} * least({a}, {b}) >= {SHARE[0]} * greatest({a}, {b})"


def star_pairs(lists: DataFrame, turn: int) -> DataFrame:
    """(a, b): for each node b at most two stars a of its lists, of another component: the one that shares most
    lists altogether and the one met most often. A list's star is the node that shares most; in later turns
    another one by hash."""
    best = F.struct("shared", "fp", "n", "comp") if not turn else F.struct(F.xxhash64("fp", F.lit(turn)).alias("h"), "fp", "n", "comp")
    stars = lists.groupBy("s").agg(F.max(best).alias("star")).select(
        "s", F.col("star").getItem(best_name(turn)).alias("rank"), F.col("star.fp").alias("a"), F.col("star.n").alias("na"),
        F.col("star.comp").alias("ca"))
    met = lists.join(stars, "s").where(f"fp <> a and comp <> ca and {_sizes_fit('n', 'na')}")
    met = met.groupBy(F.col("fp").alias("b"), "a").agg(F.count(F.lit(1)).alias("common"), F.max("rank").alias("rank"))
    met = met.where(F.col("common") >= COMMON).groupBy("b").agg(
        F.max(F.struct("rank", "a"))["a"].alias("top"), F.max(F.struct("common", "rank", "a"))["a"].alias("often"))
    return met.select(F.explode(F.array_distinct(F.array("top", "often"))).alias("a"), "b")


def best_name(turn: int) -> str:
    return "h" if turn else "shared"


def _needed(a: str, lo: str, hi: str) -> str:
    """The lists a set of size `a` must share with one of a size from `lo` to `hi`: the overlap they need, less the most
    that they can share beyond their first shingles, which is the larger of the two rests."""
    top, bottom = SHARE
    rest = [f"({top} * {n} + {bottom - 1}) div {bottom} - {COMMON}" for n in (a, hi)]
    return f"greatest({COMMON}, ({top} * ({a} + {lo}) + {top + bottom - 1}) div {top + bottom} - greatest({', '.join(rest)}))"


def rest_pairs(lists: DataFrame) -> DataFrame:
    """(a, b): all pairs of nodes of different components that share enough lists and fit in size.

    Pairs that share a list of many components, as a common passage makes it, meet in blocks (`crowded_pairs`). All
    lists of any other pair hold few components: there nodes are counted against whole components (the node's is
    the one with fewer entries in all lists). A component of one node is a pair then; in others that share enough lists
    the nodes meet in blocks.
    """
    crowds = lists.groupBy("s").agg(F.countDistinct("comp").alias("comps")).where(F.col("comps") > CROWD)
    crowds = broadcast_counted(materialize(crowds.select(F.col("s").alias("crowd")), "join-crowds"))
    told = materialize(lists.join(crowds, F.col("s") == F.col("crowd"), "left"), "join-told")
    crowded = crowded_pairs(lists, told.where("crowd is not null").drop("crowd"))
    few = told.where("crowd is null").drop("crowd")
    sizes = lists.groupBy("comp").agg(
        F.count(F.lit(1)).alias("entries"), F.min("n").alias("lo"), F.max("n").alias("hi"),
        F.when(F.min("fp") == F.max("fp"), F.min("fp")).alias("only"))
    sizes = broadcast_counted(materialize(sizes, "join-sizes"))
    met = few.join(sizes, "comp")
    comps = met.select(*[F.col(c).alias(f"{c}_") for c in ("s", "comp", "entries", "lo", "hi")]).distinct()
    smaller = (F.col("entries") < F.col("entries_")) | ((F.col("entries") == F.col("entries_")) & (F.col("comp") < F.col("comp_")))
    fits = F.expr(f"{SHARE[1]} * n >= {SHARE[0]} * lo_ and {SHARE[1]} * hi_ >= {SHARE[0]} * n")
    near = met.join(comps, (F.col("s") == F.col("s_")) & smaller & fits).groupBy("fp", "comp_").agg(
        F.count(F.lit(1)).alias("common")).where(F.col("common") >= COMMON)
    own = few.select(F.col("fp").alias("a"), "n").distinct()
    near = near.join(own, F.col("fp") == F.col("a")).join(
        sizes.select("comp", "lo", "hi", F.col("only").alias("only_")), F.col("comp_") == F.col("comp"))
    near = materialize(near.where(f"common >= {_needed('n', 'lo', 'hi')}").select(
        "a", F.col("comp_").alias("towards"), "only_"), "join-near")
    single = near.where("only_ is not null").select("a", F.col("only_").alias("b"))
    asks = near.where("only_ is null").select(F.col("a").alias("fp"), F.col("towards").alias("of"))
    members = lists.select("fp", F.col("comp").alias("of")).distinct()
    return single.union(crowded).union(block_pairs(lists, members, asks, once=False))


def crowded_pairs(lists: DataFrame, crowded: DataFrame) -> DataFrame:
    """(a, b): the pairs among nodes that share a list of many components.

    Lists joined by common nodes are one crowd (the lists of a passage, and the texts that are mostly that passage).
    Linked sets differ in size by less than one step of `size_class`, so each class of a crowd meets itself and the next.
    """
    crowds = components(crowded.select(F.col("fp").alias("a"), F.col("s").alias("b"))).withColumnsRenamed({"fp": "at", "comp": "crowd"})
    nodes = crowded.select("fp", "n").distinct().join(crowds, F.col("fp") == F.col("at"))
    step = F.floor(F.ln("n") / F.ln(F.lit(SHARE[1] / SHARE[0])))
    nodes = materialize(nodes.select("fp", "crowd", step.alias("step")), "join-crowded")
    members = nodes.select("fp", F.xxhash64("crowd", "step").alias("of"))
    asks = nodes.select("fp", F.explode(F.array(F.xxhash64("crowd", "step"), F.xxhash64("crowd", F.col("step") + 1))).alias("of"))
    return block_pairs(lists, members, asks, once=True)


def size_class(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log(n) / np.log(SHARE[1] / SHARE[0]))


def block_pairs(lists: DataFrame, members: DataFrame, asks: DataFrame, once: bool) -> DataFrame:
    """(a, b): the pairs of a node that asks and a member of what it asks `of`, both (fp, of), of different components, that
    share enough lists. `once`: those of one size class ask each other, and only the smaller of two gives the pair.

    Nodes carry their lists as one array. Blocks of members meet blocks of the nodes that ask, so a
    component of any size is split, and the lists are merged there; only pairs that reach the number come out.
    """
    held = materialize(lists.groupBy("fp", "comp").agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list("s")).alias("held")), "join-held")  # at most a text's first shingles
    held = held.withColumnRenamed("fp", "node")
    asking = asks.groupBy("of").agg(F.ceil(F.count(F.lit(1)) / SIDE).cast("int").alias("asking"))
    holding = members.groupBy(F.col("of").alias("of_")).agg(F.ceil(F.count(F.lit(1)) / SIDE).cast("int").alias("holding"))
    blocks = asking.join(holding, F.col("of") == F.col("of_")).select(F.col("of").alias("of_"), "asking", "holding")
    blocks = broadcast_counted(materialize(blocks, "join-blocks"))

    def dealt(nodes: DataFrame, is_asking: bool) -> DataFrame:
        own, other = ("asking", "holding") if is_asking else ("holding", "asking")
        mine = F.pmod(F.xxhash64("fp"), F.col(own)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        row, column = (every, mine) if is_asking else (mine, every)
        met = nodes.join(blocks, F.col("of") == F.col("of_")).select("fp", "of", row.alias("row"), column.alias("column"))
        return met.join(held, F.col("fp") == F.col("node")).select(
            "of", "row", "column", F.lit(is_asking).alias("asks"), "fp", "n", "comp", "held")

    place = ["of", "row", "column"]
    rows = dealt(members, False).unionByName(dealt(asks, True)).repartition(*place).sortWithinPartitions(*place, "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, ids, sizes, comps, own, index = None, [], [], [], [], None
        for batch in batches:
            out = []
            keys = zip(*[batch.column(c).to_pylist() for c in place])
            columns = [batch.column(c).to_pylist() for c in ("asks", "fp", "n", "comp")]
            for key, asking, fp, n, comp, s in zip(keys, *columns, batch.column("held")):
                if key != here:
                    here, ids, sizes, comps, own, index = key, [], [], [], [], None
                s = s.values.to_numpy(zero_copy_only=False)
                if not asking:
                    ids.append(fp)
                    sizes.append(n)
                    comps.append(comp)
                    own.append(s)
                    continue
                if not ids:
                    continue
                if index is None:
                    flat, of = np.concatenate(own), np.repeat(np.arange(len(own)), [len(x) for x in own])
                    order = np.argsort(flat, kind="stable")
                    index = flat[order], of[order], np.array(sizes, np.int64), np.array(comps, np.int64), np.array(ids, np.int64)
                need = lists_needed(n, index[2])
                passed = index[3] == comp
                if once:
                    passed |= (size_class(index[2]) == size_class(np.array(n))) & (index[4] <= fp)
                need[passed] = n + 1  # more lists than it has
                starts, stops = (np.searchsorted(index[0], s, side) for side in ("left", "right"))
                out += [(fp, ids[i]) for i, _ in reach([index[1][a:b] for a, b in zip(starts, stops) if a < b], need)]
            columns = list(zip(*out)) if out else [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    return rows.mapInArrow(run, "a bigint, b bigint")


def lists_needed(n: int, sizes: np.ndarray) -> np.ndarray:
    """`_needed` of a set of size n against sets of these sizes; more than it has where sizes do not fit."""
    top, bottom = SHARE
    larger = np.maximum(n, sizes)
    need = -(-top * (n + sizes) // (top + bottom)) - (-(-top * larger // bottom) - COMMON)
    fits = bottom * np.minimum(n, sizes) >= top * larger
    return np.where(fits, np.maximum(need, COMMON), n + 1)


def find_links(docs: DataFrame, nodes: DataFrame, lists: DataFrame) -> DataFrame:
    """(a, b): links whose components are those of all links."""
    lists = lists.withColumn("comp", F.col("fp"))
    links, left, turn = None, lists, 0
    while True:
        tried = materialize(star_pairs(left, turn), "join-stars")
        found = search(docs, nodes, tried)
        links = found if links is None else links.unionByName(found)
        left = _labelled(lists.drop("comp"), links)
        turn += 1
        # Stars pay while many of them link; what they leave is searched pair by pair.
        if 10 * found.count() <= tried.count():
            break
    return links.unionByName(search(docs, nodes, rest_pairs(left)))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp, n) per input row, and (fp, rep, comp) per distinct set: its smallest id, its component."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    read = materialize(read_sets(rows), "join-read")
    sets = read.where("chunk is null").select("doc_id", "fp", "n")
    nodes = materialize(sets.where("n > 0").groupBy("fp", "n").agg(F.min("doc_id").alias("rep")).select("fp", "rep"), "join-nodes")
    links = find_links(rows, nodes, shared_lists(list_entries(rows, order_levels(read))))
    labels = components(links).withColumnRenamed("fp", "of")
    return sets, nodes.join(labels, F.col("fp") == F.col("of"), "left").select("fp", "rep", F.coalesce("comp", "fp").alias("comp"))


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, component_sets), one row per input row.

    `component_id` is the smallest id reachable by links. Null, empty and wordless texts have no shingles, link with
    nothing and are their own component. Null ids are passed over for the smallest id (a component of null
    ids only has a null one). Repeated rows are equal sets, hence linked. An empty table gives no rows.
    """
    sets, nodes = near_duplicates(docs, doc_id, text)
    nodes = materialize(nodes, "join-comps")
    smallest = nodes.groupBy("comp").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("n_sets"))
    named = nodes.join(smallest, "comp").select(F.col("fp").alias("of"), "component_id", "n_sets")
    named = materialize(named, "join-named")
    met = sets.join(named, (F.col("fp") == F.col("of")) & (F.col("n") > 0), "left")
    return met.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                      F.coalesce("n_sets", F.lit(1)).cast("bigint").alias("component_sets"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component (smallest id, then smallest set number), with the columns of `docs` only; texts without
    words all stay."""
    _, nodes = near_duplicates(docs, doc_id, text)
    stays = nodes.groupBy("comp").agg(F.min(F.struct(F.col("rep").isNull(), "rep", "fp")).alias("k")).select(
        F.col("k.rep").alias("_rep"), F.col("k.fp").alias("_of"))
    stays = materialize(stays, "join-stays")
    name, nth = free_name(docs, "_fp"), free_name(docs, "_nth")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields] + [f"`{name}` bigint"])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks_of(batches, text, CHUNK_BYTES):
            fps = [fingerprint(s) for s in shingle_sets(part.column(text).to_pylist())]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(fps, pa.int64())], [*part.schema.names, name])

    marked = docs.mapInArrow(mark, schema)
    empty = marked.where(F.col(name) == 0).drop(name)
    stays = stays.withColumnsRenamed({"_rep": name + "_rep", "_of": name + "_of"})
    met = marked.where(F.col(name) != 0).join(
        stays, (F.col(name) == F.col(name + "_of")) & F.col(doc_id).eqNullSafe(F.col(name + "_rep")))
    first = Window.partitionBy(name).orderBy(F.lit(0))
    one = met.withColumn(nth, F.row_number().over(first)).where(F.col(nth) == 1)
    return one.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(empty)
