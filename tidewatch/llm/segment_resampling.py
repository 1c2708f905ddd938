"""Target-distribution importance resampling with segment deduplication.

Features are runs of one to three words, hashed. A document's weight is the sum over its features of how much commoner
their place is in the target texts than in the corpus; seeded noise on the weights makes the highest scores a draw.

A line feed separates words, so a text is a sequence of lines: every feature lies within one line or crosses lines. Lines
repeat. The corpus counts take each distinct line once: Spark merges equal lines, the features of what is left are
counted and multiplied by the line's occurrences. Features that cross lines depend on at most the two outer words of
each line and are added separately. Weights go the same way: a slice of documents weighs each distinct line once,
documents add up their lines and what crosses them.

Sums of hashes of runs are made from those of the words (`byte_words`), never from the joined strings.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.byte_words import Texts, byte_table, crc_joined, crc_words
from tidewatch.llm.common import chunks_of, running_sums
from tidewatch.runtime import materialize

PLACES = 10_000
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
CHUNK_BYTES = 4 << 20

#: Bytes of words: 0-9, a-z once lower-cased, and all of characters beyond ASCII.
IN_WORD = byte_table(range(48, 58), range(97, 123), range(128, 256))


@dataclass
class Runs:
    """Features of some words in order: place of each, and the group it belongs to."""

    place: np.ndarray
    group: np.ndarray


def runs_of(crc: np.ndarray, length: np.ndarray, group: np.ndarray, line: np.ndarray | None = None) -> Runs:
    """Runs of one to three words within a group; with `line`, only those of words of more than one line."""
    found = [] if line is not None else [(crc, group)]
    two = np.flatnonzero(group[1:] == group[:-1])
    # The sum of two words serves the run of three as well, so it is made wherever two follow each other.
    pair = np.zeros(max(len(crc) - 1, 0), dtype=np.uint32)
    pair[two] = crc_joined(crc[two], crc[two + 1], length[two + 1])
    three = two[two + 2 < len(crc)]
    three = three[group[three + 2] == group[three]]
    if line is not None:
        two, three = two[line[two] != line[two + 1]], three[line[three] != line[three + 2]]
    found.append((pair[two], group[two]))
    found.append((crc_joined(pair[three], crc[three + 2], length[three + 2]), group[three]))
    return Runs(np.concatenate([c for c, _ in found]) % np.uint32(PLACES), np.concatenate([g for _, g in found]))


class Lines:
    """The distinct lines of some texts with their words, and which texts have them where."""

    def __init__(self, column: pa.Array):
        texts = Texts.of(column)
        stops = np.flatnonzero(texts.data == 10) + 1
        ends = np.concatenate([[0], stops]).astype(np.int64)
        every = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(stops), [None, pa.py_buffer(ends), pa.py_buffer(texts.data)])
        coded = pc.dictionary_encode(every)
        self.distinct, self.number = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.text = texts.text_of(stops - 1)
        self.n_texts = len(column)
        self._read()

    def _read(self) -> None:
        ends = np.frombuffer(self.distinct.buffers()[1], np.int64)[:len(self.distinct) + 1] if len(self.distinct) else np.zeros(1, np.int64)
        data = np.frombuffer(self.distinct.buffers()[2], np.uint8)[:ends[-1]] if len(self.distinct) else np.zeros(0, np.uint8)
        starts, self.length = Texts(data, ends[1:]).spans(IN_WORD)
        self.crc = crc_words(data, starts, self.length)[0]
        self.line = np.searchsorted(ends[1:], starts, side="right")
        self.words = np.bincount(self.line, minlength=len(self.distinct))
        self.first = np.cumsum(self.words) - self.words

    def within(self) -> Runs:
        """Features within the distinct lines; the group is the number of the line."""
        return runs_of(self.crc, self.length, self.line)

    def across(self) -> Runs:
        """Features that cross lines; the group is the number of the text. Of every line, only its first two and last
        two words can be part of one."""
        held = self.words[self.number]
        kept = np.minimum(held, 4)
        at = np.repeat(np.arange(len(self.number)), kept)
        place = np.arange(len(at)) - np.repeat(np.cumsum(kept) - kept, kept)
        place = np.where((held[at] > 4) & (place >= 2), held[at] - 4 + place, place)
        word = self.first[self.number[at]] + place
        return runs_of(self.crc[word], self.length[word], self.text[at], at)


def lines_only(distinct: pa.Array) -> Lines:
    """The words of lines that are distinct already."""
    out = Lines.__new__(Lines)
    out.distinct = distinct.cast(pa.large_binary())
    if out.distinct.offset:
        out.distinct = pa.concat_arrays([out.distinct])
    out._read()
    return out


def feature_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How many features of all texts fall on each of the places.

    Rows of (line, place, n) are merged by Spark, on every task first: a line with its occurrences, or a place with the
    number of features that cross lines. Each distinct line is then read once, in one task.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks_of(batches, "text", CHUNK_BYTES):
            lines = Lines(part.column("text"))
            often = np.bincount(lines.number, minlength=len(lines.distinct))
            crossing = np.bincount(lines.across().place, minlength=PLACES)
            places = np.flatnonzero(crossing)
            some = np.flatnonzero(lines.words)  # a line without a word has no features
            kept = lines.distinct.take(pa.array(some)).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([kept, pa.nulls(len(places), pa.binary())]),
                 pa.concat_arrays([pa.nulls(len(some), pa.int32()), pa.array(places, pa.int32())]),
                 pa.array(np.concatenate([often[some], crossing[places]]), pa.int64())], ["line", "place", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(PLACES, dtype=np.int64)
        for batch in batches:
            for part in chunks_of([batch], "line", CHUNK_BYTES):
                n = part.column("n").to_numpy()
                is_line = part.column("line").is_valid().to_numpy(zero_copy_only=False)
                np.add.at(held, part.column("place").filter(pa.array(~is_line)).to_numpy(), n[~is_line])
                runs = lines_only(part.column("line").filter(pa.array(is_line))).within()
                np.add.at(held, runs.place, n[is_line][runs.group])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(PLACES, dtype=np.int32)), pa.array(held)], ["place", "n"])

    cut_up = docs.select(F.col(text).alias("text")).mapInArrow(cut, "line binary, place int, n bigint")
    merged = cut_up.groupBy("line", "place").agg(F.sum("n").alias("n"))
    sums = merged.mapInArrow(count, "place int, n bigint").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(PLACES, dtype=np.int64)
    out[sums["place"].to_numpy()] = sums["n"].to_numpy()
    return out


def place_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(rate in the target / rate in the corpus)) by place, with one added to every count."""
    s, t = corpus.astype(float), target.astype(float)
    all_s, all_t = float(corpus.sum() + PLACES), float(target.sum() + PLACES)
    return np.floor(1000 * np.log((t + 1) * all_s / ((s + 1) * all_t))).astype(np.int64)


def document_weights(docs: DataFrame, gains: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks_of(batches, "text", CHUNK_BYTES):
            lines = Lines(part.column("text"))
            within, across = lines.within(), lines.across()
            of_line = np.zeros(len(lines.distinct), dtype=np.int64)
            np.add.at(of_line, within.group, gains[within.place])
            weight, words = (np.zeros(lines.n_texts, dtype=np.int64) for _ in range(2))
            np.add.at(weight, lines.text, of_line[lines.number])
            np.add.at(weight, across.group, gains[across.place])
            np.add.at(words, lines.text, lines.words[lines.number])
            features = words + np.maximum(words - 1, 0) + np.maximum(words - 2, 0)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(words), pa.array(features), pa.array(weight)],
                                             ["doc_id", "n_words", "n_features", "weight"])

    mine = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return mine.mapInArrow(
        weigh, f"doc_id {dict(mine.dtypes)['doc_id']}, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Seeded Gumbel noise in thousandths, from the id alone."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
             percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank), one row per input row; rank is null where a document is not drawn.

    Null and empty texts have no features, weight 0 and are never drawn. A null id counts as the empty text in the noise
    and comes first among equal scores. Equal rows are documents of their own and get ranks of their own, in
    any order. An empty corpus gives no rows, an empty target gains that only tell rare places from common ones. Very
    long texts are read whole, a line at a time where they have lines. Other columns, whatever their names, play no part.
    """
    gains = place_gains(feature_counts(docs, text), feature_counts(target, target_text))
    weighed = document_weights(docs, gains, doc_id, text)
    weighed = weighed.select("doc_id", "n_features", "weight", (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score"),
                             (F.col("n_words") >= least_words).alias("eligible"),
                             # Rows equal in everything else are told apart, so that they too spread over tasks.
                             F.xxhash64(F.monotonically_increasing_id()).alias("spread"))
    weighed = materialize(weighed, "resample-weights")
    n, rows = weighed.agg(F.count_if("eligible"), F.count(F.lit(1))).first()
    order = [F.col("eligible").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("spread")]
    ranked = running_sums(weighed.withColumn("one", F.lit(1)), order, ["one"], "resample-order", rows)
    drawn = F.col("eligible") & (F.col("before_one") < percent * n // 100)
    return ranked.select("doc_id", "n_features", "weight", "score",
                         F.when(drawn, (F.col("before_one") + 1).cast("bigint")).alias("rank"))


#: The same rows in SQL. CRC-32 is folded over the bytes of each distinct feature, with its table made from the polynomial.
SQL = r"""
with crc_table as (
  select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as crcs
  from range(256) r(i)
), texts as (
  select 0 as kind, row_number() over () as nth, doc_id, text from documents
  union all select 1, row_number() over (), null, text from benchmark
), worded as (
  select kind, nth, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as words
  from texts
), features as (
  select kind, nth, unnest(list_concat(words, list_concat(
    [words[i] || ' ' || words[i+1] for i in range(1, len(words))],
    [words[i] || ' ' || words[i+1] || ' ' || words[i+2] for i in range(1, len(words) - 1)]))) as feature
  from worded
), counted as (select kind, nth, feature, count(*) as n from features group by all
), placed as (
  select feature, xor(list_reduce(
    list_concat([4294967295::bigint], [('0x' || substr(h, 2*i+1, 2))::bigint for i in range(0, len(h)//2)]),
    lambda c, b: xor(crcs[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 as place
  from (select feature, hex(encode(feature)) as h from (select distinct feature from counted)), crc_table
), held as (
  select kind, nth, place, n from counted join placed using (feature)
), places as (
  select p.place, coalesce(sum(n) filter (kind = 0), 0)::double as s, coalesce(sum(n) filter (kind = 1), 0)::double as t
  from range(10000) p(place) left join held on held.place = p.place group by p.place
), gains as (
  select place, floor(1000 * ln((t + 1) * ((select sum(s) from places) + 10000)
    / ((s + 1) * ((select sum(t) from places) + 10000))))::bigint as gain
  from places
), weighed as (
  select nth, sum(n * gain)::bigint as weight from held join gains using (place) where kind = 0 group by nth
), noisy as (
  select nth, doc_id, len(words) as n_words, ('0x' || substr(sha256('42:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint as h
  from worded where kind = 0
), scored as (
  select doc_id, n_words, n_words + greatest(n_words - 1, 0) + greatest(n_words - 2, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0)))::bigint as score
  from noisy left join weighed using (nth)
), ranked as (
  select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id) as place,
    count(*) filter (n_words >= 20) over () as eligible
  from scored
)
select doc_id, n_features::bigint as n_features, weight::bigint as weight, score::bigint as score,
  case when n_words >= 20 and place <= 5 * eligible // 100 then place end as rank
from ranked
"""
