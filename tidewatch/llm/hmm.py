"""Scoring texts with a hidden Markov model of words.

Latent states emit word classes, classes emit words: P(word | state) = P(class | state) P(word | class). The most
frequent words and the end of a text are classes of their own; other words fall into a fixed number of classes
by their ending. What a word weighs within its class are smoothed counts over the whole training part, so that
table grows with the corpus and is only ever joined, while the model of states stays small.

1. Documents are laid out in blocks: word numbers within the block, and the block's words.
2. Words meet across blocks, which gives every word its count in the training part, and go back to their blocks.
3. Blocks become sequences of classes, with each document's sums over its words.
4. Baum-Welch: every task adds up expected counts of its documents, the sums give the next model.
5. The scaled forward recursion gives the exact likelihood of every class sequence.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import chunks_of, lower_ascii, training_remainder
from tidewatch.runtime import materialize

FOLDS = 5
HELD_OUT = 1

#: Latent states, words with a class of their own, classes of the other words, rounds of Baum-Welch.
STATES = 6
OWN_CLASSES = 2048
ENDING_CLASSES = 2048
ROUNDS = 3

#: Groups that the training documents are dealt to at first, and rounds over all of them that sort whole documents
#: to states before Baum-Welch begins.
GROUPS = 64
SORTING_ROUNDS = 3

#: Bytes of text in a block and in a slice of it that is read at a time, and tokens handled at a time within one.
BLOCK_BYTES = 8 << 20
SLICE_BYTES = 1 << 20
STRIDE = 50_000

#: Tokens whose weights are added at a time when documents are dealt to groups.
CACHED = 2_048

#: Tokens of a segment: within segments all steps are taken side by side.
SEGMENT = 64

END_CLASS = 0
END_WORD = "\n"  # no word holds a line feed
SMOOTH = 0.5


# 1. Blocks

_BLOCK = ("block bigint, doc_ids array<bigint>, held array<boolean>, ends array<bigint>, low binary, high binary, "
          "pos int, word string, n_train bigint")
_BLOCK_TYPES = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary(),
                pa.int32(), pa.string(), pa.int64()]


def _names(schema: str) -> list[str]:
    return [c.split(" ")[0] for c in schema.split(", ")]


def lay_out(docs: DataFrame) -> DataFrame:
    """Block rows (documents as word numbers, the low and the high two bytes of each apart) and word rows (block, pos, word,
    n_train) from rows (doc_id, text, held)."""
    names = _names(_BLOCK)

    def block_of(block: int, number: dict, parts: list, sizes: list, doc_ids: list, held: list) -> Iterator[pa.RecordBatch]:
        ids = np.concatenate(parts)
        train = np.bincount(ids[np.repeat(np.logical_not(held), sizes)], minlength=len(number))
        order = np.argsort(-np.bincount(ids, minlength=len(number)), kind="stable")  # frequent words get small numbers
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        ids = rank[ids] if len(ids) else ids
        words = list(number)
        words = [words[i] for i in order.tolist()]
        train = train[order]
        row = [[block], [doc_ids], [held], [np.cumsum(sizes).tolist()],
               [(ids & 0xFFFF).astype("<u2").tobytes()], [(ids >> 16).astype("<u2").tobytes()], [None], [None], [None]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, _BLOCK_TYPES)], names)
        for first in range(0, len(words), 100_000):
            some = words[first:first + 100_000]
            n = len(some)
            table = [[block] * n, *[[None] * n] * 5, list(range(first, first + n)), [w.decode() for w in some],
                     train[first:first + n]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(table, _BLOCK_TYPES)], names)

    def fresh() -> tuple[dict, list, list, list, list]:
        number: dict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        return number, [], [], [], []

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, task, made = 0, 0, 0
        number, parts, sizes, doc_ids, helds = fresh()
        for batch in chunks_of(batches, "text", SLICE_BYTES):
            for doc_id, text, held, task in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text", "held", "task")]):
                if total and total + len(text or "") > BLOCK_BYTES:
                    yield from block_of((task << 32) + made, number, parts, sizes, doc_ids, helds)
                    total, made = 0, made + 1
                    number, parts, sizes, doc_ids, helds = fresh()
                found = lower_ascii(text).split()  # texts go as soon as they are numbers
                sizes.append(len(found))
                parts.append(np.fromiter(map(number.__getitem__, found), np.int32, len(found)))
                doc_ids.append(doc_id)
                helds.append(held)
                total += len(text or "")
        if sizes:
            yield from block_of((task << 32) + made, number, parts, sizes, doc_ids, helds)

    return docs.withColumn("task", F.spark_partition_id().cast("bigint")).mapInArrow(lay, _BLOCK)


# 2. Words across blocks

def ending_class(word: Column) -> Column:
    stem = F.regexp_replace(word, r"[.,;:!?]+$", "")
    return (F.pmod(F.xxhash64(F.right(stem, F.lit(3))), F.lit(ENDING_CLASSES)) + 1 + OWN_CLASSES).cast("int")


@dataclass
class Vocabulary:
    """Counts of the training part and, per class, what its words' counts add up to."""

    tokens: int
    distinct: int
    docs: int
    class_tokens: np.ndarray
    class_words: np.ndarray


def count_words(laid: DataFrame) -> DataFrame:
    """(block, pos, word, c, is_first): the training count of each word of each block. A word has at most one row a block."""
    of_word = Window.partitionBy("word")
    rows = laid.where("word is not null").select("block", "pos", "word", "n_train")
    return rows.select("block", "pos", "word", F.sum("n_train").over(of_word).alias("c"),
                       (F.row_number().over(of_word.orderBy("block")) == 1).alias("is_first"))


def classify(counted: DataFrame, docs: int) -> tuple[DataFrame, Vocabulary]:
    """(block, pos, c, class) and the sums behind the smoothing."""
    known = counted.where("is_first and c > 0")
    order = Window.orderBy(F.col("c").desc(), "word")
    top = known.orderBy(F.col("c").desc(), "word").limit(OWN_CLASSES).select(
        F.col("word").alias("top_word"), F.row_number().over(order).alias("top_class"))
    top = F.broadcast(materialize(top, "hmm-top"))  # OWN_CLASSES rows at most
    met = counted.join(top, F.col("word") == F.col("top_word"), "left")
    classed = met.withColumn("class", F.coalesce("top_class", ending_class(F.col("word"))))
    sums = classed.where("is_first and c > 0").groupBy("class").agg(F.sum("c"), F.count(F.lit(1))).collect()
    size = 1 + OWN_CLASSES + ENDING_CLASSES
    tokens, words = np.zeros(size), np.zeros(size)
    for k, c, n in sums:  # a row per class
        tokens[k], words[k] = c, n
    vocabulary = Vocabulary(int(tokens.sum()) + docs, int(words.sum()) + (docs > 0), docs, tokens, words)
    return classed.select("block", "pos", "c", "class"), vocabulary


# 3. Sequences of classes

_CODED = ("doc_ids array<bigint>, held array<boolean>, ends array<bigint>, classes binary, n_known array<bigint>, "
          "counts_log array<double>, within_log array<double>")


def code(laid: DataFrame, classed: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per block the class of each token (ends of texts included) and, per document, the known tokens, the sum of
    log10(c + 0.5) and that of log10 P(word | class)."""
    names = _names(_CODED)
    blocks = laid.where("word is null").select("block", "doc_ids", "held", "ends", "low", "high")
    tables = classed.groupBy("block").agg(F.collect_list(F.struct("pos", "c", "class")).alias("words"))  # one block's words
    met = blocks.join(tables, "block", "left")
    spread = vocabulary.class_tokens + SMOOTH * (vocabulary.class_words + 1)
    docs = vocabulary.docs

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                low = np.frombuffer(batch.column("low")[row].as_py(), "<u2")
                ids = low.astype(np.int64) + (np.frombuffer(batch.column("high")[row].as_py(), "<u2").astype(np.int64) << 16)
                words = batch.column("words")[row]
                c = kind = np.zeros(0, np.int64)
                if words.is_valid and len(words):
                    pos, c0, k0 = (words.values.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                    c, kind = np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64)
                    c[pos], kind[pos] = c0, k0
                counts_log = np.log10(c + SMOOTH)
                own = kind <= OWN_CLASSES
                within = np.where(own, 0.0, counts_log - np.log10(spread[kind])) if len(kind) else counts_log
                ends = batch.column("ends")[row].values.to_numpy()
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)

                def per_doc(values: np.ndarray) -> np.ndarray:
                    total = np.concatenate([[0], np.cumsum(values[ids])]) if len(ids) else np.zeros(1)
                    return total[ends] - total[starts]

                n = len(ends)
                classes = np.full(len(ids) + n, END_CLASS, dtype="<u2")  # one more token a document
                classes[np.arange(len(ids)) + np.repeat(np.arange(n), ends - starts)] = kind[ids] if len(ids) else 0
                columns = [batch.column("doc_ids")[row].as_py(), batch.column("held")[row].as_py(),
                           (ends + np.arange(1, n + 1)).tolist(), classes.tobytes(),
                           (per_doc((c > 0).astype(np.int64)).astype(np.int64) + (docs > 0)).tolist(),
                           (per_doc(counts_log) + np.log10(docs + SMOOTH)).tolist(), per_doc(within).tolist()]
                types = [pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()),
                         pa.list_(pa.float64()), pa.list_(pa.float64())]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(columns, types)], names)

    return met.mapInArrow(encode, _CODED)


# 4., 5. The model of states

@dataclass
class Model:
    start: np.ndarray  # K
    moves: np.ndarray  # K x K
    emits: np.ndarray  # C x K: P(class | state)


class Segments:
    """Some documents' classes, cut into segments of at most SEGMENT tokens.

    Tokens are laid out by their step within the segment, longest segments first: those that take a step are a prefix of
    those that took the step before, so every step is one slice of arrays of K rows. `order` says which token is where.
    """

    def __init__(self, classes: np.ndarray, sizes: np.ndarray):
        self.sizes = sizes
        per_doc = -(-sizes // SEGMENT)
        doc = np.repeat(np.arange(len(sizes)), per_doc)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
        starts = np.cumsum(sizes) - sizes
        length = np.minimum(SEGMENT, sizes[doc] - nth * SEGMENT)
        order = np.argsort(-length, kind="stable")
        at, self.length, self.first = (starts[doc] + nth * SEGMENT)[order], length[order], (nth == 0)[order]
        running = np.searchsorted(-self.length, -np.arange(SEGMENT), side="left")
        self.running = running[:np.count_nonzero(running)].tolist()
        self.offset = np.concatenate([[0], np.cumsum(self.running)]).astype(np.int64).tolist()
        self.order = np.concatenate([at[:n] + t for t, n in enumerate(self.running)]) if self.running else np.zeros(0, np.int64)
        self.classes = classes[self.order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        # For each number of a segment within its document: the documents that have it, and where it is.
        by_nth = np.argsort(nth, kind="stable")
        cuts = np.searchsorted(nth[by_nth], np.arange(int(per_doc.max(initial=0)) + 1))
        self.turns = [(doc[by_nth[a:b]], place[by_nth[a:b]]) for a, b in zip(cuts, cuts[1:])]

    def emissions(self, model: Model) -> tuple[np.ndarray, np.ndarray]:
        """P(class | state) of each token (K x N), scaled to a sum of 1, and the logarithm of the scale."""
        b = np.take(np.ascontiguousarray(model.emits.T), self.classes, axis=1)
        scale = b.sum(axis=0)
        b /= scale
        return b, np.log(scale)

    def products(self, model: Model, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per segment the product of its step matrices (K x K x segments), scaled, and the logarithm of the scale."""
        k, n = len(model.start), len(self.length)
        turn = np.ascontiguousarray(model.moves.T)
        p = np.where(self.first, np.eye(k)[:, :, None], model.moves[:, :, None]) * b[None, :, :n]
        log = np.zeros(n)
        for t, n in enumerate(self.running):
            if not t:
                continue
            p[:, :, :n] = np.matmul(turn, p[:, :, :n]) * b[None, :, self.offset[t]:self.offset[t] + n]
            if t % 8 == 7:
                scale = p[:, :, :n].sum(axis=(0, 1))
                p[:, :, :n] /= scale
                log[:n] += np.log(scale)
        scale = p.sum(axis=(0, 1))
        return p / scale, log + np.log(scale)

    def forward(self, model: Model, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state before each segment, log likelihood of each document but for the scales of emissions and products)."""
        matrix = np.ascontiguousarray(p.transpose(2, 0, 1))
        state = np.tile(model.start, (len(self.sizes), 1))
        before = np.empty((len(self.length), len(model.start)))
        whole = np.zeros(len(self.sizes))
        for docs, at in self.turns:
            before[at] = state[docs]
            after = np.matmul(state[docs][:, None, :], matrix[at])[:, 0]
            scale = after.sum(axis=1)
            state[docs] = after / scale[:, None]
            whole[docs] += np.log(scale)
        return before.T, whole

    def likelihood(self, model: Model) -> np.ndarray:
        """Log likelihood of each document."""
        b, scale = self.emissions(model)
        p, log = self.products(model, b)
        whole = self.forward(model, p)[1]
        for docs, at in self.turns:
            whole[docs] += log[at]
        in_order = np.empty(len(scale))
        in_order[self.order] = scale
        return whole + np.add.reduceat(in_order, np.cumsum(self.sizes) - self.sizes)  # a document has a token at least

    def backward(self, p: np.ndarray) -> np.ndarray:
        """What follows each segment, per state, scaled."""
        matrix = np.ascontiguousarray(p.transpose(2, 0, 1))
        k = len(p)
        later = np.ones((len(self.sizes), k))
        after = np.empty((len(self.length), k))
        for docs, at in reversed(self.turns):
            after[at] = later[docs]
            now = np.matmul(matrix[at], later[docs][:, :, None])[:, :, 0]
            later[docs] = now / now.sum(axis=1)[:, None]
        return after.T

    def expected(self, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected (start, moves, state of each token (K x N, in `order`)), exact for whole documents."""
        b, _ = self.emissions(model)
        p, _ = self.products(model, b)
        before, _ = self.forward(model, p)
        after = self.backward(p)
        k, n = len(model.start), len(self.length)
        turn = np.ascontiguousarray(model.moves.T)
        alpha, beta = np.empty_like(b), np.empty_like(b)
        moves = np.zeros((k, k))
        now = np.where(self.first, before, turn @ before) * b[:, :n]
        alpha[:, :n] = now / now.sum(axis=0)
        for t, (start, n) in enumerate(zip(self.offset, self.running)):
            if t:
                now = (turn @ now[:, :n]) * b[:, start:start + n]
                if t % 8 == 7:
                    now /= now.sum(axis=0)
                alpha[:, start:start + n] = now
        for t in range(len(self.running) - 1, -1, -1):
            start, n = self.offset[t], self.running[t]
            on = self.running[t + 1] if t + 1 < len(self.running) else 0
            beta[:, start + on:start + n] = after[:, on:n]  # segments that end here
            if on:
                ahead = b[:, start + n:start + n + on] * beta[:, start + n:start + n + on]
                back = model.moves @ ahead
                here = alpha[:, start:start + on]
                moves += (here / (here * back).sum(axis=0)) @ ahead.T
                beta[:, start:start + on] = back / back.sum(axis=0) if t % 8 == 0 else back
        n = len(self.length)
        inner = ~self.first  # from the segment before into this one
        ahead = (b[:, :n] * beta[:, :n])[:, inner]
        here = before[:, inner]
        moves += (here / (here * (model.moves @ ahead)).sum(axis=0)) @ ahead.T
        alpha *= beta
        alpha /= alpha.sum(axis=0)
        return alpha[:, :n][:, self.first].sum(axis=1), moves * model.moves, alpha


def _strides(classes: np.ndarray, ends: np.ndarray, pick: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(documents, classes, sizes) of the picked documents of a block, about STRIDE tokens at a time."""
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    docs, total = [], 0
    for d in [*np.flatnonzero(pick).tolist(), -1]:
        size = int(ends[d] - starts[d]) if d >= 0 else 0
        if docs and (d < 0 or total + size > STRIDE):
            yield np.array(docs), np.concatenate([classes[starts[i]:ends[i]] for i in docs]), ends[docs] - starts[docs]
            docs, total = [], 0
        docs.append(d)
        total += size


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.RecordBatch, int]]:
    for batch in batches:
        for row in range(batch.num_rows):
            classes = np.frombuffer(batch.column("classes")[row].as_py(), "<u2").astype(np.int64)
            yield (classes, batch.column("ends")[row].values.to_numpy(),
                   np.array(batch.column("held")[row].as_py(), dtype=bool), batch, row)


def expected_counts(coded: DataFrame, model: Model) -> list:
    """Rows (what, n_1, ..., n_K) summed over all training documents: what is a class, or -1 for starts, or
    -2 - i for moves out of state i."""
    k, size = len(model.start), len(model.emits)
    names = ["what", *[f"n{i}" for i in range(k)]]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, moves, emits = np.zeros(k), np.zeros((k, k)), np.zeros((size, k))
        for classes, ends, held, _, _ in _rows(batches):
            for _, some, sizes in _strides(classes, ends, ~held):
                segments = Segments(some, sizes)
                first, between, gamma = segments.expected(model)
                start += first
                moves += between
                for i in range(k):
                    emits[:, i] += np.bincount(segments.classes, weights=gamma[i], minlength=size)
        there = np.flatnonzero(emits.sum(axis=1))
        what = np.concatenate([there, [-1], -2 - np.arange(k)])
        table = np.vstack([emits[there], start, moves])
        yield pa.RecordBatch.from_arrays([pa.array(what, pa.int64()), *[pa.array(table[:, i]) for i in range(k)]], names)

    parts = coded.mapInArrow(count, ", ".join(["what bigint", *[f"n{i} double" for i in range(k)]]))
    return parts.groupBy("what").agg(*[F.sum(n).alias(n) for n in names[1:]]).collect()


def next_model(rows: list, size: int, k: int) -> Model:
    start, moves, emits = np.ones(k), np.ones((k, k)), np.full((size, k), 0.01)
    for what, *n in rows:
        if what >= 0:
            emits[what] += n
        elif what == -1:
            start += n
        else:
            moves[-2 - what] += n
    return Model(start / start.sum(), moves / moves.sum(axis=1)[:, None], emits / emits.sum(axis=0))


def doc_sums(weights: np.ndarray, classes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of the weights of each document's classes. Few tokens at a time, so that their weights stay in the cache."""
    out = np.zeros((len(sizes), weights.shape[1]))
    ends = np.cumsum(sizes)
    starts = ends - sizes
    for first in range(0, len(classes), CACHED):
        last = min(first + CACHED, len(classes))
        a, z = np.searchsorted(ends, first, side="right"), np.searchsorted(starts, last)
        out[a:z] += np.add.reduceat(weights[classes[first:last]], np.maximum(starts[a:z] - first, 0), axis=0)
    return out


def group_sums(coded: DataFrame, weights: np.ndarray) -> np.ndarray:
    """Class counts (C x K) of the training documents, each counted at the state whose weights fit its classes best."""
    size, k = weights.shape
    names = ["what", *[f"n{i}" for i in range(k)]]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size * k, np.int64)
        for classes, ends, held, _, _ in _rows(batches):
            for _, some, sizes in _strides(classes, ends, ~held):
                own = np.argmax(doc_sums(weights, some, sizes), axis=1)
                sums += np.bincount(some * k + np.repeat(own, sizes), minlength=size * k)
        table = sums.reshape(size, k)
        there = np.flatnonzero(table.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), *[pa.array(table[there, i]) for i in range(k)]], names)

    parts = coded.mapInArrow(add, ", ".join(f"{n} bigint" for n in names))
    sums = np.zeros((size, k))
    for what, *n in parts.groupBy("what").agg(*[F.sum(n).alias(n) for n in names[1:]]).collect():  # a row per class
        sums[what] = n
    return sums


def far_apart(sums: np.ndarray, k: int) -> np.ndarray:
    """Class counts (C x K) of `k` sets of groups: centres far from each other, then each group to its nearest."""
    total = sums.sum(axis=0)
    sums = sums[:, (total > 0) & (4 * total >= total.mean())]  # roots of shares compare by their inner product
    if not sums.shape[1]:
        return np.zeros((len(sums), k))
    roots = np.sqrt(sums / sums.sum(axis=0)).T
    centres = [roots[int(np.argmin(roots @ roots.mean(axis=0)))]]
    while len(centres) < k:
        centres.append(roots[int(np.argmin(np.max(roots @ np.array(centres).T, axis=1)))])
    own = np.argmax(roots @ np.array(centres).T, axis=1)
    return np.stack([sums[:, own == i].sum(axis=1) for i in range(k)], axis=1)


def first_model(coded: DataFrame, vocabulary: Vocabulary, k: int = STATES) -> Model:
    """States from class counts of all training documents: a seeded projection of their class shares deals them to
    groups, the groups make states far from each other, then each document goes to the state that gives its classes the
    highest probability, some rounds long.

    Only sums per class and group leave the tasks. Seeded noise keeps states apart whose documents are alike.
    """
    rng = np.random.default_rng(5)
    base = vocabulary.class_tokens + 1
    base[END_CLASS] += vocabulary.docs
    base = base / base.sum()
    lean = rng.standard_normal((len(base), GROUPS))
    noise = np.exp(0.1 * rng.standard_normal((len(base), k)))
    sums = far_apart(group_sums(coded, lean - base @ lean), k)
    for turn in range(SORTING_ROUNDS + 1):
        total = sums.sum(axis=0)
        share = np.where(total > 0, sums / np.maximum(total, 1), base[:, None])
        emits = (0.2 * base[:, None] + 0.8 * share) * noise
        emits /= emits.sum(axis=0)
        if turn < SORTING_ROUNDS:
            sums = group_sums(coded, np.log(emits))
    moves = np.full((k, k), 0.1 / max(k - 1, 1))
    np.fill_diagonal(moves, 0.9 if k > 1 else 1.0)
    return Model(np.full(k, 1 / k), moves, emits)


_SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, counts_log double, model_log double"


def score(coded: DataFrame, model: Model) -> DataFrame:
    """Per document the sums, and log10 P(text): P(word | class) of its words and the forward likelihood of its classes."""
    names = _names(_SCORED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for classes, ends, held, batch, row in _rows(batches):
            whole = np.zeros(len(ends))
            for docs, some, sizes in _strides(classes, ends, np.ones(len(ends), bool)):
                whole[docs] = Segments(some, sizes).likelihood(model) / np.log(10)
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            within = batch.column("within_log")[row].values.to_numpy()
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_ids")[row].values, pa.array(held), pa.array(ends - starts), batch.column("n_known")[row].values,
                batch.column("counts_log")[row].values, pa.array(whole + within)], names)

    return coded.mapInArrow(run, _SCORED)


def train(coded: DataFrame, vocabulary: Vocabulary, states: int = STATES, rounds: int = ROUNDS) -> Model:
    size = 1 + OWN_CLASSES + ENDING_CLASSES
    model = first_model(coded, vocabulary, states)
    for _ in range(rounds):
        model = next_model(expected_counts(coded, model), size, states)
    return model


def score_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", states: int = STATES,
                rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per input row.

    Words are lower-cased in A-Z; the end of a text is a token too, so null and empty texts have one token. A null id
    counts as the empty text in the fold. A word not met in training falls into the class of its ending and
    has the weight of half a count there. Repeated rows count each and score alike. An empty table gives no rows; with
    no training rows the base score is 0 and the model knows nothing.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"),
                       (training_remainder(F.col(doc_id), FOLDS) == HELD_OUT).alias("held"))
    laid = materialize(lay_out(rows), "hmm-blocks")
    n_docs = laid.where("word is null").select(F.sum(F.expr("size(filter(held, h -> not h))"))).first()[0] or 0
    counted = materialize(count_words(laid), "hmm-words")
    classed, vocabulary = classify(counted, n_docs)
    coded = materialize(code(laid, classed, vocabulary), "hmm-classes")
    scored = score(coded, train(coded, vocabulary, states, rounds))
    base = F.lit(float(np.log10(vocabulary.tokens + SMOOTH * (vocabulary.distinct + 1))))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(vocabulary.tokens).cast("bigint").alias("train_tokens"),
                         (F.col("counts_log") - F.col("n_tokens") * base).alias("base_score"), F.col("model_log").alias("score"))
