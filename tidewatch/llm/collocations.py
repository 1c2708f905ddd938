"""Collocations by a multikey three-way quicksort of suffix pointers.

A suffix is the words from a word on, up to the end of its piece; only its first `DEPTH` words matter. A slice of texts
merges its equal suffixes, so a phrase is at most one entry a slice however often it occurs. Entries are routed by a
hash of their two leading words: what begins alike meets in one group, which is sorted on its own. Single words are
entries of their own with nothing after them.

The sort takes pointers to entries and one word at a time: a pivot cuts a part into smaller, equal and greater. The
equal part shares one more word, its occurrences are the count of the phrase so far, and it goes on at the next word;
the other two go on at the same word. Any part with fewer than `LEAST` occurrences is abandoned: nothing in it can be
frequent. All parts of a group take a step together, as array operations.

There are as many routes as the counted bytes ask for. Where one route still holds too many entries (a pair of words
with a great many words after it), its entries are dealt by all three words into parts; a pair's counts from those parts are
added up by Spark, and only phrases of three words are abandoned there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.byte_words import Texts, byte_table, crc_values, number_words
from tidewatch.llm.common import chunks_of
from tidewatch.runtime import broadcast_counted, materialize

DEPTH = 3
LEAST = 10
COVERED = 50
TOP = 2000

#: Each language's best are first found in so many shares of its phrases, so that no task ranks a whole language.
SHARES = 64

#: Bytes of text for one route, entries that one group may hold, groups a task sorts one after another.
ROUTE_BYTES = 8 << 20
MOST_ENTRIES = 2_000_000
GROUPS_PER_TASK = 4
CHUNK_BYTES = 8 << 20

#: Up to so many words of a slice, three word numbers are one 63-bit number; beyond, they are ordered as three.
PACKED = 1 << 21

ENDS_PIECE = byte_table(b".,;:!?", range(10, 14))
IN_WORD = ~(ENDS_PIECE | byte_table(b" \t"))

_BLOCK = "lang string, route bigint, entries bigint, words bigint, payload binary"


def _mix(*sums: np.ndarray) -> np.ndarray:
    """One 64-bit number from 32-bit sums, the same in every task."""
    out = np.zeros(len(sums[0]), dtype=np.uint64)
    for one in sums:
        out = (out ^ one.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def merged_suffixes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.LargeBinaryArray]:
    """(entries x 3 word numbers with 0 for none, occurrences, words with the empty one first) of some texts: every
    distinct suffix of two or three words, and every distinct word followed by nothing."""
    texts = Texts.of(column)
    starts, lengths = texts.spans(IN_WORD)
    number, distinct = number_words(texts.data, starts, lengths)
    names = pa.concat_arrays([pa.array([b""], pa.large_binary()), distinct])
    piece = np.searchsorted(np.flatnonzero(ENDS_PIECE[texts.data]), starts)
    first = number + 1
    second, third = np.zeros_like(first), np.zeros_like(first)
    if len(first) > 1:
        second[:-1] = np.where(piece[1:] == piece[:-1], first[1:], 0)
    if len(first) > 2:
        third[:-2] = np.where(piece[2:] == piece[:-2], first[2:], 0)
    more = second > 0
    first, second, third = first[more], second[more], third[more]
    wide = len(names)
    pair = first * wide + second  # word numbers lie below 2^31
    if wide < PACKED:
        key, n = np.unique(pair * wide + third, return_counts=True)
        ids = np.column_stack([key // wide // wide, key // wide % wide, key % wide])
    else:
        order = np.lexsort((third, pair))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (pair[order[1:]] != pair[order[:-1]]) | (third[order[1:]] != third[order[:-1]])
        at = np.flatnonzero(new)
        n = np.diff(np.append(at, len(order)))
        ids = np.column_stack([first, second, third])[order[at]]
    alone = np.bincount(number, minlength=wide - 1)
    single = np.zeros((wide - 1, DEPTH), dtype=np.int64)
    single[:, 0] = np.arange(1, wide)
    return np.concatenate([single, ids]), np.concatenate([alone, n]), names


def route_numbers(ids: np.ndarray, names: pa.Array, routes: int) -> np.ndarray:
    """The route of every entry, from its two leading words."""
    sums = crc_values(names)[0]
    return (_mix(sums[ids[:, 0]], sums[ids[:, 1]]) % np.uint64(routes)).astype(np.int64)


def pack(ids: np.ndarray, n: np.ndarray, names: pa.Array, group: np.ndarray) -> Iterator[tuple[int, int, int, bytes]]:
    """(group, entries, occurrences of single words, payload) of each group: three words a line, then the occurrences."""
    order = np.argsort(group, kind="stable")
    ids, n, group = ids[order], n[order], group[order]
    stop = pa.scalar(b"\n", pa.large_binary())
    space = pa.scalar(b" ", pa.large_binary())
    one, two, three = (names.take(pa.array(ids[:, k])) for k in range(DEPTH))
    lines = pc.binary_join_element_wise(pc.binary_join_element_wise(one, two, three, space), pa.scalar(b"", pa.large_binary()), stop)
    ends = np.frombuffer(lines.buffers()[1], np.int64)[:len(lines) + 1] if len(lines) else np.zeros(1, np.int64)
    data = memoryview(lines.buffers()[2]) if len(lines) else memoryview(b"")
    at = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    zip_ = zstandard.ZstdCompressor(level=1)
    single = np.where(ids[:, 1] == 0, n, 0)
    for a, b in zip(at, np.append(at[1:], len(group))):
        counts = n[a:b].astype("<u4").tobytes()
        yield int(group[a]), int(b - a), int(single[a:b].sum()), zip_.compress(counts + bytes(data[ends[a]:ends[b]]))


def unpack(payloads: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(entries x 3 word numbers with 0 for none, occurrences, words with the empty one first) of payloads with their
    numbers of entries."""
    unzip = zstandard.ZstdDecompressor()
    raw = [(entries, unzip.decompress(x)) for entries, x in payloads]
    n = np.concatenate([np.frombuffer(x, "<u4", entries) for entries, x in raw]).astype(np.int64)
    data = np.frombuffer(b"".join(x[4 * entries:] for entries, x in raw), np.uint8)
    stops = np.flatnonzero((data == 32) | (data == 10))
    starts = np.append(0, stops[:-1] + 1)
    number, distinct = number_words(data, starts, stops - starts)
    # The empty word becomes number 0; where there is none, it is put in front.
    empty = pc.index(distinct, pa.scalar(b"", pa.large_binary())).as_py()
    if empty < 0:
        return (number + 1).reshape(-1, DEPTH), n, pa.concat_arrays([pa.array([b""], pa.large_binary()), distinct])
    new = np.arange(len(distinct))
    new[[0, empty]] = [empty, 0]
    return new[number].reshape(-1, DEPTH), n, distinct.take(pa.array(new))


def quicksort_counts(ids: np.ndarray, n: np.ndarray, least: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(an entry, length, occurrences) of each phrase of one to three words with at least `least[length - 1]` occurrences.

    `pointers` holds the entries of all open parts side by side; a part is a stretch of them at one depth. `least` must
    not fall with the length: a part at a depth is abandoned when it is too rare for a phrase that ends there."""
    pointers = np.arange(len(ids))
    sizes, depths = np.array([len(ids)]), np.array([0])
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    ids, n, least = np.ascontiguousarray(ids, dtype=np.int32), n.astype(np.int64), np.array(least)
    while len(pointers):
        parts = np.arange(len(sizes))
        starts = np.cumsum(sizes) - sizes
        part = np.repeat(parts, sizes)
        words = ids[pointers, depths[part]]
        three = np.sort(np.stack([words[starts], words[starts + sizes // 2], words[starts + sizes - 1]]), axis=0)
        pivot = three[1]
        side = np.sign(words - pivot[part]).astype(np.int8) + 1
        slot = 3 * part + side
        held = np.bincount(slot, minlength=3 * len(parts))
        weight = np.bincount(slot, n[pointers], 3 * len(parts)).astype(np.int64)
        # Stable dealing of every part into its three: equal sides keep their order.
        places = np.cumsum(held) - held
        moved = np.empty_like(pointers)
        for which in range(3):
            some = np.flatnonzero(side == which)
            mine = held[which::3]
            moved[np.repeat(places[which::3] - (np.cumsum(mine) - mine), mine) + np.arange(len(some))] = pointers[some]
        depth = np.repeat(depths, 3)
        equal = np.tile([False, True, False], len(parts))
        none = equal & np.repeat(pivot == 0, 3)
        # A word followed by nothing counts the single word; equal second and third words count their phrases.
        length = np.where(none, np.where(depth == 1, 1, 0), np.where(equal & (depth > 0), depth + 1, 0))
        told = (length > 0) & (held > 0) & (weight >= least[np.maximum(length, 1) - 1])
        found.append((moved[places[told]], length[told], weight[told]))
        goes_to = depth + equal
        open_ = (held > 0) & ~none & (goes_to < DEPTH)
        # Rarer than the least phrase that could still end here: a part that has two words decided looks for three.
        open_ &= weight >= least[np.minimum(goes_to, DEPTH - 1)]
        pointers, sizes, depths = moved[np.repeat(open_, held)], held[open_], goes_to[open_]
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3


def suffix_blocks(docs: DataFrame, text: str, lang: str, routes: int) -> DataFrame:
    """(lang, route, entries, words, payload): the merged suffixes of every slice of texts, by route. `words` counts the
    word occurrences of the block's single words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks_of(batches, "text", CHUNK_BYTES):
            langs = part.column("lang")
            for name in pc.unique(langs):
                ids, n, names = merged_suffixes(part.column("text").filter(pc.equal(langs, name)))
                if len(ids):
                    blocks = list(pack(ids, n, names, route_numbers(ids, names, routes)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name.as_py()] * len(blocks), pa.string()),
                         *[pa.array(c, pa.int64()) for c in list(zip(*blocks))[:3]],
                         pa.array([b[3] for b in blocks], pa.binary())], ["lang", "route", "entries", "words", "payload"])

    mine = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    return materialize(mine.mapInArrow(cut, _BLOCK), "suffix-blocks")


def dealt_groups(blocks: DataFrame, most: int = MOST_ENTRIES) -> tuple[DataFrame, int]:
    """(the blocks with the part of their route they belong to, number of groups): routes with more than `most`
    entries are dealt into parts by all three words."""
    sizes = materialize(blocks.groupBy("lang", "route").agg(
        F.ceil(F.sum("entries") / most).cast("bigint").alias("parts")).withColumnsRenamed({"lang": "_lang", "route": "_route"}),
        "route-sizes")
    groups = sizes.agg(F.sum("parts")).first()[0] or 0
    met = blocks.join(broadcast_counted(sizes), (F.col("lang") == F.col("_lang")) & (F.col("route") == F.col("_route")))
    met = met.select("lang", "route", "parts", "entries", "payload")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, route, parts, entries, payload in zip(*(c.to_pylist() for c in batch.columns)):
                ids, n, names = unpack([(entries, payload)])
                sums = crc_values(names)[0]
                part = _mix(*(sums[ids[:, k]] for k in reversed(range(DEPTH)))) % np.uint64(parts)
                blocks = list(pack(ids, n, names, part.astype(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(blocks), pa.string()), pa.array([route] * len(blocks), pa.int64()),
                     pa.array([b[0] for b in blocks], pa.int64()), pa.array([parts] * len(blocks), pa.int64()),
                     pa.array([b[1] for b in blocks], pa.int64()), pa.array([b[3] for b in blocks], pa.binary())],
                    ["lang", "route", "part", "parts", "entries", "payload"])

    split = met.where("parts > 1").mapInArrow(
        deal, "lang string, route bigint, part bigint, parts bigint, entries bigint, payload binary")
    whole = met.where("parts = 1").select("lang", "route", F.lit(0).cast("bigint").alias("part"), "parts", "entries", "payload")
    return whole.unionByName(split), groups


def frequent_phrases(blocks: DataFrame, least: int = LEAST, most: int = MOST_ENTRIES) -> DataFrame:
    """(lang, w1, w2, w3, f): all phrases of one to three words with at least `least` occurrences."""
    dealt, groups = dealt_groups(blocks, most)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes]] = []
        open_ = None

        def close() -> pa.RecordBatch:
            ids, n, names = unpack(held)
            # Only whole groups can tell that a word or a pair is rare.
            early = least if open_[3] == 1 else 1
            entry, length, often = quicksort_counts(ids, n, (early, early, least))
            words = [names.take(pa.array(np.where(length > k, ids[entry, k], 0))).cast(pa.binary()) for k in range(DEPTH)]
            return pa.RecordBatch.from_arrays(
                [pa.array([open_[0]] * len(entry), pa.string()), *words, pa.array(often, pa.int64())],
                ["lang", "w1", "w2", "w3", "f"])

        for batch in batches:
            for *group, entries, payload in zip(*(c.to_pylist() for c in batch.columns)):
                if open_ is not None and group != open_:
                    yield close()
                    held.clear()
                open_ = group
                held.append((entries, payload))
        if open_ is not None:
            yield close()

    tasks = max(1, -(-groups // GROUPS_PER_TASK))
    keys = ["lang", "route", "part"]
    sorted_ = dealt.repartition(tasks, *keys).sortWithinPartitions(*keys)
    counted = sorted_.mapInArrow(count, "lang string, w1 binary, w2 binary, w3 binary, f bigint")
    words = [F.col(c).cast("string").alias(c) for c in ("w1", "w2", "w3")]
    summed = counted.select("lang", *words, "f").groupBy("lang", "w1", "w2", "w3").agg(F.sum("f").alias("f"))
    return materialize(summed.where(F.col("f") >= least), "phrases")


def score_phrases(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score, k) of every phrase of two or three words: its worst cut, in whole numbers.

    Common words are parts of many phrases; the joins carry counts only and are left to AQE, which splits such keys."""
    shorter = phrases.where("w3 = ''").select(
        F.col("lang").alias("_lang"), F.expr("if(w2 = '', w1, concat(w1, ' ', w2))").alias("_part"), F.col("f").alias("_f"))
    pair, triple = F.expr("concat(w1, ' ', w2)"), F.expr("concat(w1, ' ', w2, ' ', w3)")
    two = phrases.where("w2 != '' and w3 = ''").select(
        "lang", pair.alias("phrase"), F.col("f").alias("a"), F.lit(1).alias("k"), F.col("w1").alias("left"), F.col("w2").alias("right"))
    three = phrases.where("w3 != ''").select("lang", triple.alias("phrase"), F.col("f").alias("a"), F.expr("""
        inline(array(named_struct('k', 1, 'left', w1, 'right', concat(w2, ' ', w3)),
                     named_struct('k', 2, 'left', concat(w1, ' ', w2), 'right', w3)))"""))
    cuts = two.unionByName(three)
    for side, name in (("left", "l"), ("right", "r")):
        met = (F.col("lang") == F.col("_lang")) & (F.col(side) == F.col("_part"))
        cuts = cuts.join(shorter, met).withColumn(name, F.col("_f")).drop("_lang", "_part", "_f")
    exact = "(1000000BD * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))"
    worst = F.min(F.struct(F.expr(exact).alias("score"), "k", "l", "r"))
    return cuts.groupBy("lang", "phrase", "a").agg(worst.alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", "cut.k")


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, covered: int = COVERED, top: int = TOP,
         route_bytes: int = ROUTE_BYTES, most: int = MOST_ENTRIES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` phrases of each language.

    Null and empty texts have no words; a null language is `und`; equal rows count as often as they occur; ties in
    score go to the larger count, then to the phrase first in byte order; an empty table gives no rows. A very long
    text is a slice of its own, read whole. Other columns, whatever their names, play no part.
    """
    held = docs.agg(F.sum(F.octet_length(text).cast("bigint"))).first()[0] or 0
    blocks = suffix_blocks(docs, text, lang, max(1, -(-held // route_bytes)))
    totals = blocks.groupBy(F.col("lang").alias("_lang")).agg(F.sum("words").alias("n"))
    phrases = frequent_phrases(blocks, least, most)
    inside = phrases.where("w3 != ''").select(F.col("lang").alias("_lang"), "f", F.expr(
        "explode(array(concat(w1, ' ', w2), concat(w2, ' ', w3)))").alias("_part"))
    inside = inside.groupBy("_lang", "_part").agg(F.max("f").alias("longest"))
    scored = score_phrases(phrases).join(inside, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_part")), "left")
    kept = scored.where(F.coalesce(100 * F.col("longest") < covered * F.col("a"), F.lit(True)))
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    ranked = kept.select("lang", "phrase", "a", "l", "r", "score", share.alias("share"))
    for keys in (["lang", "share"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*best))
        ranked = ranked.withColumn("rank", place).where(F.col("rank") <= top)
    return ranked.join(totals, F.col("lang") == F.col("_lang")).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: The same rows in SQL.
SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^.,;:!?\x0A-\x0D]+')) as piece
  from documents
), worded as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), suffixes as (
  select lang, unnest(list_concat([[w[i]] for i in range(1, len(w) + 1)], list_concat([w[i:i+1] for i in range(1, len(w))],
    [w[i:i+2] for i in range(1, len(w) - 1)]))) as p
  from worded
), counted as (select lang, p, count(*) as f from suffixes group by all
), totals as (select lang, sum(f)::bigint as n from counted where len(p) = 1 group by lang
), cuts as (
  select lang, p, f, unnest(range(1, len(p))) as k from counted where len(p) > 1 and f >= 10
), scored as (
  select c.lang, c.p, c.f as a, k, x.f as l, y.f as r,
    ((1000000::hugeint * c.f * c.f) // (x.f::hugeint * y.f))::bigint as score
  from cuts c join counted x on x.lang = c.lang and x.p = c.p[1:k] join counted y on y.lang = c.lang and y.p = c.p[k+1:len(c.p)]
), worst as (
  select * from scored qualify row_number() over (partition by lang, p order by score, k) = 1
), inside as (
  select lang, p, max(f) as longest from (
    select lang, unnest([p[1:2], p[2:3]]) as p, f from counted where len(p) = 3 and f >= 10) group by lang, p
), ranked as (
  select w.lang, array_to_string(w.p, ' ') as phrase, a, l, r, score from worst w left join inside i on i.lang = w.lang and i.p = w.p
  where longest is null or 100 * longest < 50 * a
  qualify row_number() over (partition by w.lang order by score desc, a desc, array_to_string(w.p, ' ')) <= 2000
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from ranked join totals using (lang)
"""
