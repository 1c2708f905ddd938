"""Token ids as files of Re-Pair grammars, with random access.

Documents are laid out in ascending order of their id, each task holding one range of ids, and encoded there.
The ids of neighbouring documents form shards of bounded size. In a shard the pairs of neighbouring symbols that are
frequent become rules: a new symbol takes the place of every occurrence, again and again, until no pair is
frequent. A shard's block stores the rules, the length each rule expands to, and the remaining sequence. With
the lengths, any range of ids is found and expanded without expanding what stands before it.

Files are written and read by Spark, one row a shard; `shards` have these columns:
    task, shard      place of the shard: range of ids, number within it
    n_tokens         ids in the shard
    doc_ids          the shard's documents, ascending
    ends             number of ids up to the end of each document, counted from the start of the shard
    block            bytes, all little-endian: 4 x u4 header (format 1, first rule symbol, rules, sequence length),
                     then u4 left and u4 right of each rule, u4 expansion lengths, u4 sequence
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm import encoding
from tidewatch.llm.common import chunks_of
from tidewatch.runtime import new_folder

#: Ids of a shard, at which it is closed (a longer document is a shard of its own).
SHARD_IDS = 1 << 18

#: A pair is frequent from so many occurrences on, whatever the size of its shard.
MIN_COUNT = 8

END = 0
CHUNK_BYTES = 16 << 20
_MOST_BITS = 17


def codes_of(seq: np.ndarray, at: np.ndarray) -> np.ndarray:
    """left * 2^32 + right of the pairs that begin at the places `at`."""
    return (seq[at].astype(np.uint64) << np.uint64(32)) | seq[at + 1]


def bins_of(code: np.ndarray, bits: int) -> np.ndarray:
    """Hashes of the pairs, of so many bits."""
    return ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def frequent_pairs(code: np.ndarray, least: int) -> np.ndarray:
    """The codes met at least `least` times, most frequent first."""
    pairs, counts = np.unique(code, return_counts=True)
    keep = counts >= least
    pairs, counts = pairs[keep], counts[keep]
    return pairs[np.lexsort((pairs, -counts))]


def choose(pairs: np.ndarray) -> list[tuple[int, int]]:
    """The pairs, most frequent first, of which no two can overlap in a sequence."""
    left, right, chosen = set(), set(), []
    for a, b in zip((pairs >> np.uint64(32)).tolist(), (pairs & np.uint64(0xFFFFFFFF)).tolist()):
        if a in right or b in left or (a == b and (a in left or a in right)):
            continue
        chosen.append((a, b))
        left.add(a)
        right.add(b)
    return chosen


def occurrences(at: np.ndarray, code: np.ndarray, bins: np.ndarray, bits: int,
                pairs: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(places of `at` where one of `pairs` is to be replaced, number of that pair), leftmost first in runs."""
    codes = np.array([(a << 32) | b for a, b in pairs], dtype=np.uint64)
    order = np.argsort(codes)
    codes = codes[order]
    slot = np.full(1 << bits, -1, np.int32)
    slot[bins_of(codes, bits)] = np.arange(len(codes), dtype=np.int32)
    place = slot[bins]
    likely = np.flatnonzero(place >= 0)
    at, code, place = at[likely], code[likely], place[likely]
    other = np.flatnonzero(codes[place] != code)  # pairs that share a hash
    place[other] = np.minimum(np.searchsorted(codes, code[other]), len(codes) - 1)
    found = np.flatnonzero(codes[place] == code)
    at, place = at[found], place[found]
    # Only a pair of equal symbols can overlap with itself: in a run of matches every second one stands.
    new_run = np.concatenate([[True], np.diff(at) != 1])
    run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
    stand = (np.arange(len(at)) - run_start) % 2 == 0
    return at[stand], order[place[stand]]


def _lengths(symbols: np.ndarray, first: int, lengths: np.ndarray) -> np.ndarray:
    """Number of ids that each symbol stands for; `lengths` are those of the rules."""
    out = np.ones(symbols.shape, np.int64)
    ruled = symbols >= first
    out[ruled] = lengths[symbols[ruled].astype(np.int64) - first]
    return out


def compress(ids: np.ndarray, one_in: int | None = None, min_count: int = MIN_COUNT) -> bytes:
    """The block of a sequence of ids; `one_in` leaves pairs that stand for less than one in so many ids spelled out."""
    seq = np.array(ids, dtype=np.uint32)
    first = int(seq.max(initial=0)) + 1
    least = max(min_count, len(seq) // one_in if one_in else 0)
    rules: list[tuple[int, int]] = []
    lengths = np.empty(0, np.int64)
    # Places where a frequent pair may begin. A pair only gets rarer while both its symbols are old, so after the first
    # round these are the places whose pair may have been frequent, and those next to a new symbol.
    at = np.arange(max(len(seq) - 1, 0))
    while len(at):
        bits = min(_MOST_BITS, len(at).bit_length() + 1)
        code = codes_of(seq, at)
        bins = bins_of(code, bits)
        # Counts of hashes leave out most pairs; the rest are counted one by one.
        likely = np.flatnonzero((np.bincount(bins, minlength=1 << bits) >= least)[bins])
        at, code, bins = at[likely], code[likely], bins[likely]
        chosen = choose(frequent_pairs(code, least))
        if not chosen:
            break
        begins, number = occurrences(at, code, bins, bits, chosen)
        seq[begins] = first + len(rules) + number
        open_at, keep = np.zeros(len(seq), bool), np.ones(len(seq), bool)
        open_at[at] = True
        open_at[begins] = True
        open_at[np.maximum(begins - 1, 0)] = True
        keep[begins + 1] = False
        seq, open_at = seq[keep], open_at[keep]
        at = np.flatnonzero(open_at[:-1])
        pair = np.array(chosen, np.int64)
        lengths = np.concatenate([lengths, _lengths(pair, first, lengths).sum(axis=1)])
        rules += chosen
    table = np.array(rules, dtype="<u4").reshape(-1, 2)
    head = np.array([1, first, len(rules), len(seq)], dtype="<u4")
    return b"".join(x.tobytes() for x in (head, table[:, 0].astype("<u4"), table[:, 1].astype("<u4"),
                                          lengths.astype("<u4"), seq.astype("<u4")))


class Block:
    """A stored block; `read` expands any range of its ids."""

    def __init__(self, data: bytes):
        kind, self.first, n, size = np.frombuffer(data, "<u4", 4).tolist()
        if kind != 1:
            raise ValueError(f"unknown format {kind}")
        self.left, self.right, self.lengths = (np.frombuffer(data, "<u4", n, 16 + 4 * n * i) for i in range(3))
        self.seq = np.frombuffer(data, "<u4", size, 16 + 12 * n)
        self.flat = np.empty(0, np.uint32)
        self.flat_from = np.empty(0, np.int64)
        self._expand_rules()
        self.sizes = _lengths(self.seq, self.first, self.lengths)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])

    def _expand_rules(self) -> None:
        """All rules written out one after another, those of a depth at a time: a rule only uses less deep ones."""
        pair = np.stack([self.left, self.right], axis=1).astype(np.int64)
        ruled, child = pair >= self.first, np.maximum(pair - self.first, 0)
        depth = np.zeros(len(pair), np.int64)
        while len(pair):
            deeper = np.where(ruled, depth[child] + 1, 0).max(axis=1)
            if np.array_equal(deeper, depth):
                break
            depth = deeper
        self.flat = np.empty(int(self.lengths.sum()), np.uint32)
        self.flat_from = np.concatenate([[0], np.cumsum(self.lengths[:-1], dtype=np.int64)])
        sizes = _lengths(pair, self.first, self.lengths)
        to = np.stack([self.flat_from[:len(pair)], self.flat_from[:len(pair)] + sizes[:, 0]], axis=1)
        for level in range(int(depth.max(initial=-1)) + 1):
            here = (depth == level)[:, None]
            ids, rules = here & ~ruled, here & ruled
            self.flat[to[ids]] = pair[ids]
            size = sizes[rules]
            within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            self.flat[np.repeat(to[rules], size) + within] = self.flat[np.repeat(self.flat_from[child[rules]], size) + within]

    def __len__(self) -> int:
        return int(self.starts[-1])

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids `start` to `stop`, or to the end, expanding only the symbols that hold them."""
        stop = min(stop, len(self))
        if stop <= start:
            return np.empty(0, np.uint32)
        a = int(np.searchsorted(self.starts, start, "right")) - 1
        b = int(np.searchsorted(self.starts, stop, "left"))
        seq = self.seq[a:b]
        # Every symbol takes a row of places of the rules written out, followed by the symbols themselves.
        ruled = seq >= self.first
        place = len(self.flat) + np.arange(len(seq))
        place[ruled] = self.flat_from[seq[ruled].astype(np.int64) - self.first]
        place = np.repeat(place + self.starts[a] - self.starts[a:b], self.sizes[a:b])
        out = np.concatenate([self.flat, seq])[place + np.arange(len(place))]
        skip = start - int(self.starts[a])
        return out[skip:skip + stop - start]


SHARD = "task int, shard int, n_tokens bigint, doc_ids array<bigint>, ends array<bigint>, block binary"


def write_shards(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", path: str | None = None,
                 shard_ids: int = SHARD_IDS) -> None:
    """Encode the texts of `docs` and write them as shards into `folder`, each document ended by id 0.

    A null text counts as empty; a null id stands first; rows with equal ids stand in order of their texts.
    """
    path = path or encoding.default_vocabulary()
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.repartitionByRange(tasks, "doc_id").sortWithinPartitions("doc_id", "text")
    rows = rows.withColumn("task", F.spark_partition_id())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding.encoder(path)
        end = np.array([END], "<u4").tobytes()
        task, shard, ids, parts, sizes, total = 0, 0, [], [], [], 0

        def close() -> pa.RecordBatch:
            block = compress(np.frombuffer(b"".join(parts), "<u4"))
            return pa.RecordBatch.from_arrays([
                pa.array([task], pa.int32()), pa.array([shard], pa.int32()), pa.array([total], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())), pa.array([np.cumsum(sizes).tolist()], pa.list_(pa.int64())),
                pa.array([block], pa.binary())], ["task", "shard", "n_tokens", "doc_ids", "ends", "block"])

        for part in chunks_of(batches, "text", CHUNK_BYTES):
            task = part.column("task")[0].as_py()
            for i, found in zip(part.column("doc_id").to_pylist(), encoder.encode(part.column("text").to_pylist())):
                size = len(found) // 4 + 1
                if total and total + size > shard_ids:
                    yield close()
                    shard, ids, parts, sizes, total = shard + 1, [], [], [], 0
                ids.append(i)
                parts += [found, end]
                sizes.append(size)
                total += size
        if total:
            yield close()

    rows.mapInArrow(pack, SHARD).write.parquet(folder)


def shard_starts(shards: DataFrame) -> DataFrame:
    """(task, shard, shard_start): ids in all shards before; tasks first (one row each), then shards within a task."""
    sizes = shards.select("task", "shard", "n_tokens")
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = sizes.groupBy("task").agg(F.sum("n_tokens").alias("in_task"))
    tasks = tasks.select("task", F.coalesce(F.sum("in_task").over(before), F.lit(0)).alias("task_start"))
    inside = Window.partitionBy("task").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.join(F.broadcast(tasks), "task").select(  # one row a task
        "task", "shard", (F.col("task_start") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("shard_start"))


def read_documents(spark: SparkSession, folder: str, ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32 and, as asked, ids) of every document in the files."""
    shards = spark.read.schema(SHARD).parquet(folder)
    schema = "task int, shard int, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<int>" if ids else "")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block(batch.column("block")[row].as_py())
                ends = batch.column("ends")[row].values.to_numpy()
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                whole = block.read(0, len(block)).astype("<u4")
                found = [whole[a:b] for a, b in zip(starts, ends)]
                n = len(found)
                columns = [pa.array([batch.column(c)[row].as_py()] * n, pa.int32()) for c in ("task", "shard")]
                columns += [batch.column("doc_ids")[row].values, pa.array(starts), pa.array(ends - starts),
                            pa.array([zlib.crc32(x.tobytes()) for x in found], pa.int64())]
                if ids:
                    columns.append(pa.array([x.astype(np.int32) for x in found], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, [c.split(" ")[0] for c in schema.split(", ")])

    rows = shards.mapInArrow(expand, schema).join(shard_starts(shards), ["task", "shard"])
    return rows.select("doc_id", (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32",
                       *(["ids"] if ids else []))


def write_and_read(docs: DataFrame, **options) -> DataFrame:
    """Write `docs` as shards into a new shared folder and read every document back."""
    folder = new_folder(docs.sparkSession, "token-shards")
    write_shards(docs, folder, **options)
    return read_documents(docs.sparkSession, folder)
