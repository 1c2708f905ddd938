"""Document quality from a linear-chain conditional random field over lines.

Every line with a word gets a few numbers about its form; its features are these, those of the line before and
those of the line after. The field labels the lines of a document good or bad, with weights on features and on
neighbouring labels. Forward and backward sums give each line's probability of being good, and a document's
score is their mean weighted by the length of the lines.

Weights are fitted on labelled documents (all lines carry the label of their document): each round, every task adds
up the gradient of its documents' likelihood, and the driver takes one step with the sum of a few dozen numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import chunks_of, free_name, training_remainder
from tidewatch.runtime import materialize

#: Bound on the labelled documents that the weights are fitted on; more are thinned by a hash of their id.
MOST_LABELLED = 20_000

#: Rounds of fitting, step size, and the pull of weights towards 0.
ROUNDS = 40
STEP = 0.25
DECAY = 1e-3

FOLDS = 3
HELD_OUT = 1
CHUNK_BYTES = 4 << 20

FORMS = ("words", "word_length", "upper", "digits", "symbols", "pipes", "shouts", "stops", "repeats", "seen", "short")
N_FEATURES = 1 + 3 * len(FORMS)

_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digits": b"0123456789",
            "symbols": b"#*$%&<>@^~=+{}[]\\/_", "pipes": b"|", "shouts": b"!?", "stops": b".,;:"}
_TABLES = {}
for _name, _bytes in _CLASSES.items():
    _TABLES[_name] = np.zeros(256, dtype=np.int32)
    _TABLES[_name][list(_bytes)] = 1


@dataclass
class Lines:
    """The lines of some documents, one after another: forms (rows x FORMS), byte lengths, lines per document."""

    forms: np.ndarray
    sizes: np.ndarray
    counts: np.ndarray


def read_lines(texts: list[str | None]) -> Lines:
    """Lines cut at line feeds; those without a word are left out. Null and empty texts have no lines."""
    lines, counts, words, distinct, seen = [], [], [], [], []
    for text in texts:
        met: set[bytes] = set()
        before = len(lines)
        for line in (text or "").encode("utf-8", "replace").split(b"\n"):
            found = line.split()
            if not found:
                continue
            lines.append(line)
            words.append(len(found))
            distinct.append(len(set(found)))
            seen.append(line in met)
            met.add(line)
        counts.append(len(lines) - before)
    if not lines:
        return Lines(np.zeros((0, len(FORMS))), np.zeros(0), np.array(counts, dtype=np.int64))
    sizes = np.array([len(x) for x in lines], dtype=np.int64)
    data = np.frombuffer(b"".join(lines), dtype=np.uint8)
    starts = np.concatenate([[0], np.cumsum(sizes[:-1])])
    of = {name: np.add.reduceat(t[data], starts).astype(float) for name, t in _TABLES.items()}
    n = np.array(words, dtype=float)
    forms = np.column_stack([
        np.log1p(n) / 5, np.minimum(sizes / n, 40) / 10, of["upper"] / np.maximum(of["upper"] + of["lower"], 1),
        of["digits"] / sizes, np.minimum(of["symbols"] / n, 4), np.minimum(of["pipes"] / n, 2),
        np.minimum(of["shouts"] / n, 3), np.minimum(of["stops"] / n, 2), 1 - np.array(distinct) / n,
        np.array(seen, dtype=float), (n < 4).astype(float)])
    return Lines(forms, sizes.astype(float), np.array(counts, dtype=np.int64))


def features(forms: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A constant, a line's forms, those of the line before and after it (zeros beyond the document)."""
    n = len(forms)
    ends = np.cumsum(counts[counts > 0])
    before, after = np.zeros_like(forms), np.zeros_like(forms)
    if n:
        before[1:], after[:-1] = forms[:-1], forms[1:]
        before[np.concatenate([[0], ends[:-1]])] = 0
        after[ends - 1] = 0
    return np.hstack([np.ones((n, 1)), forms, before, after])


def forward_backward(good: np.ndarray, links: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(probability of good per line, expected label pairs (2 x 2), log partition per document with lines).

    `good` is the score of label 1 against label 0 of each line, `links[a, b]` the score of label b after a. All
    documents take a step at a time, the longest first, so that those still running are a prefix.
    """
    counts = counts[counts > 0]
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64) if len(counts) else np.zeros(0, np.int64)
    order = np.argsort(-counts, kind="stable")
    lens, first = counts[order], starts[order]
    alpha, beta = np.zeros((len(good), 2)), np.zeros((len(good), 2))
    unary = np.column_stack([np.zeros(len(good)), good])
    longest = int(lens.max(initial=0))
    running = np.searchsorted(-lens, -np.arange(longest), side="left")  # documents with more than t lines
    if longest:
        alpha[first] = unary[first]
    for t in range(1, longest):
        at = first[:running[t]] + t
        prior = alpha[at - 1]
        alpha[at] = np.logaddexp(prior[:, :1] + links[0], prior[:, 1:] + links[1]) + unary[at]
    for t in range(longest - 2, -1, -1):
        at = first[:running[t + 1]] + t
        later = beta[at + 1] + unary[at + 1]
        beta[at] = np.logaddexp(later[:, :1] + links[:, 0], later[:, 1:] + links[:, 1])
    whole = np.zeros(len(counts))
    if longest:
        last = starts + counts - 1
        whole = np.logaddexp(alpha[last, 0], alpha[last, 1])
    per_line = np.repeat(whole, counts)
    chance = np.exp(alpha[:, 1] + beta[:, 1] - per_line)
    pairs = np.zeros((2, 2))
    if len(good) > 1:
        inner = np.ones(len(good), bool)
        inner[starts] = False
        now = np.flatnonzero(inner)
        later = beta[now] + unary[now]
        for a in range(2):
            for b in range(2):
                pairs[a, b] = np.exp(alpha[now - 1, a] + links[a, b] + later[:, b] - per_line[now]).sum()
    return chance, pairs, whole


@dataclass
class Field:
    weights: np.ndarray
    links: np.ndarray

    def score(self, texts: list[str | None]) -> list[float]:
        """Length-weighted share of good lines; a text without a word has nothing good in it and scores 0."""
        lines = read_lines(texts)
        chance, _, _ = forward_backward(features(lines.forms, lines.counts) @ self.weights, self.links, lines.counts)
        ends = np.concatenate([[0], np.cumsum(lines.counts)])
        total = np.concatenate([[0], np.cumsum(lines.sizes)])
        good = np.concatenate([[0], np.cumsum(lines.sizes * chance)])
        a, b = ends[:-1], ends[1:]
        return np.clip(np.where(b > a, (good[b] - good[a]) / np.maximum(total[b] - total[a], 1), 0.0), 0, 1).tolist()


def labelled_lines(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, doc_id: str = "doc_id",
                   text: str = "text", label: str = "quality") -> DataFrame:
    """(label, counts, forms): the training documents among `labels`, at most about `most`, as forms of their lines."""
    marked = labels.select(F.col(doc_id).alias("marked_id"), F.col(label).cast("double").alias("label"))
    marked = marked.where(F.col("marked_id").isNotNull() & F.col("label").isin(0, 1)
                          & (training_remainder(F.col("marked_id"), FOLDS) != HELD_OUT))
    share = min(1.0, most / max(1, marked.count()))
    grain = 1 << 20
    marked = marked.where(F.pmod(F.xxhash64("marked_id"), F.lit(grain)) < int(share * grain))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks_of(batches, "text", CHUNK_BYTES):
            lines = read_lines(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([
                pa.array([part.column("label").to_pylist()], pa.list_(pa.float64())), pa.array([lines.counts], pa.list_(pa.int64())),
                pa.array([lines.forms.astype("<f4").tobytes()], pa.binary())], ["label", "counts", "forms"])

    # `marked` has about `most` rows of 16 bytes at the most.
    met = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(
        F.broadcast(marked), F.col("doc_id") == F.col("marked_id")).select("text", "label")
    return materialize(met.mapInArrow(read, "label array<double>, counts array<bigint>, forms binary"), "crf-lines")


def _gradient(batches: Iterator[pa.RecordBatch], weights: np.ndarray, links: np.ndarray, balance: tuple[float, float]) -> np.ndarray:
    """Sums over the documents of some batches: gradient by weight, by link, and the number of weighted lines."""
    out = np.zeros(N_FEATURES + 4 + 1)
    for batch in batches:
        for row in range(batch.num_rows):
            label = np.array(batch.column("label")[row].as_py())
            counts = np.array(batch.column("counts")[row].as_py(), dtype=np.int64)
            forms = np.frombuffer(batch.column("forms")[row].as_py(), "<f4").reshape(-1, len(FORMS)).astype(float)
            for value in (0.0, 1.0):  # rare labels weigh more, so the two kinds are taken in turn
                own = counts * (label == value)
                here = np.repeat(label == value, counts)
                x = features(forms[here], own)
                chance, pairs, _ = forward_backward(x @ weights, links, own)
                out[:N_FEATURES] += balance[int(value)] * (x.T @ (value - chance))
                seen = np.zeros((2, 2))
                seen[int(value), int(value)] = (own[own > 0] - 1).sum()
                out[N_FEATURES:-1] += balance[int(value)] * (seen - pairs).ravel()
                out[-1] += balance[int(value)] * len(x)
    return out


def fit(lines: DataFrame, rounds: int = ROUNDS) -> Field:
    """Weights by gradient ascent; every round is one pass whose tasks send a few dozen sums each."""
    totals = lines.select(F.explode(F.arrays_zip("label", "counts")).alias("d")).select("d.label", "d.counts")
    size = {r[0]: r[1] for r in totals.groupBy("label").agg(F.sum("counts")).collect()}
    size = [float(size.get(k) or 0) for k in (0.0, 1.0)]
    mean = sum(size) / 2
    balance = tuple(mean / s if s else 0.0 for s in size)
    weights, links = np.zeros(N_FEATURES), np.zeros((2, 2))
    first, second = np.zeros(N_FEATURES + 4), np.zeros(N_FEATURES + 4)
    for turn in range(1, rounds + 1 if all(size) else 1):

        def add(batches: Iterator[pa.RecordBatch], w=weights, k=links) -> Iterator[pa.RecordBatch]:
            yield pa.RecordBatch.from_arrays([pa.array([_gradient(batches, w, k, balance)], pa.list_(pa.float64()))], ["sums"])

        parts = lines.mapInArrow(add, "sums array<double>")
        sums = parts.select(F.posexplode("sums").alias("place", "value")).groupBy("place").agg(F.sum("value")).collect()
        found = np.array([v for _, v in sorted((r[0], r[1]) for r in sums)])
        step = found[:-1] / max(found[-1], 1) - DECAY * np.concatenate([weights, links.ravel()])
        first, second = 0.9 * first + 0.1 * step, 0.99 * second + 0.01 * step ** 2
        move = STEP * (first / (1 - 0.9 ** turn)) / (np.sqrt(second / (1 - 0.99 ** turn)) + 1e-8)
        weights, links = weights + move[:N_FEATURES], links + move[N_FEATURES:].reshape(2, 2)
    if not all(size):  # one kind of label only: everything is like it
        weights[0] = 10.0 if size[1] else (-10.0 if size[0] else 0.0)
    return Field(weights, links)


def with_scores(docs: DataFrame, field: Field, text: str = "text") -> tuple[DataFrame, str]:
    """`docs` with a column of scores, and the name it got."""
    name = free_name(docs, "score")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields] + [f"`{name}` double"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks_of(batches, text, CHUNK_BYTES):
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(field.score(part.column(text).to_pylist()), pa.float64())],
                                             [*part.schema.names, name])

    return docs.mapInArrow(score, schema), name


def quality_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   label: str = "quality", most: int = MOST_LABELLED) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per input row.

    The fold of a document is crc32 of its id as text modulo 3 (a null id counts as the empty text); labels of
    fold 1 are never read. Null labels are left out; a label table that is empty, or has one kind only, gives
    the same score to all texts with words. Null and empty texts score 0. Repeated rows score alike.
    """
    field = fit(labelled_lines(docs, labels, most, doc_id, text, label))
    scored, _ = with_scores(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), field)
    return scored.select("doc_id", (training_remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_accepted(docs: DataFrame, labels: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of `docs` that score at least 0.5, with the columns of `docs` only."""
    field = fit(labelled_lines(docs, labels, text=text, **options))
    scored, name = with_scores(docs, field, text)
    return scored.where(F.col(name) >= 0.5).drop(name)
