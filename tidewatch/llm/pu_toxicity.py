"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic documents and text without a label are learned from; a label 0 serves for nothing but the class
prior. Three passes:

* `word_lifts` counts, over all documents outside the held-out fold, how many hold each word or word beginning (hashed),
  and how many of the confirmed toxic ones do. What the unlabelled rate holds above prior times the toxic rate is the
  clean rate, never below 0, and a feature's lift is the log of toxic over clean.
* `signals` describes a text by a few numbers about its lifted words.
* `fit` trains numpy classifiers on a bounded sample of both kinds. The risk on clean text is not seen, but is the risk
  of calling unlabelled text clean, less prior times the same risk on toxic text. That difference cannot be negative in
  truth; where a step finds it so, the classifier has begun to learn single documents, and steps back.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.byte_words import Texts, byte_table, crc_values, number_words
from tidewatch.llm.common import chunks_of, training_remainder
from tidewatch.runtime import materialize

#: Bounds on the documents that the classifiers are fitted on, thinned by a hash of their id; the lifts count all
#: unlabelled documents, and the confirmed ones within the bound.
MOST_CONFIRMED = 20_000
MOST_UNLABELLED = 20_000

#: Features are whole words and their first k bytes, hashed to 2^BITS places.
BITS = 18
PREFIXES = (4, 5, 6, 8)
SMOOTH = 2.0

#: Classifiers trained, each without one part of the unlabelled sample; rounds, step size, pull to 0.
CLASSIFIERS = 5
ROUNDS = 300
STEP = 0.05
DECAY = 1e-4

FOLDS = 5
HELD_OUT = 0
CHUNK_BYTES = 4 << 20
GRAIN = 1 << 62

LETTERS = byte_table(range(48, 58), range(97, 123), range(128, 256))
LEVELS = (1.5, 2.0, 3.0, 4.0)
LONG_TEXT = 256
N_SIGNALS = 4 + len(LEVELS)


@dataclass
class Words:
    """The words of some texts: text and word number of each, and the hashed features of each distinct word, with
    2^BITS where a word is too short for one."""

    text: np.ndarray
    number: np.ndarray
    features: np.ndarray
    n_texts: int


def read_words(column: pa.Array) -> Words:
    texts = Texts.of(column)
    starts, lengths = texts.spans(LETTERS)
    number, distinct = number_words(texts.data, starts, lengths)
    sizes = np.diff(np.frombuffer(distinct.buffers()[1], np.int64)[:len(distinct) + 1]) if len(distinct) else np.zeros(0, np.int64)
    whole, *begins = crc_values(distinct, PREFIXES)
    shift = np.uint32(32 - BITS)
    features = np.full((len(distinct), 1 + len(PREFIXES)), 1 << BITS, dtype=np.int64)
    features[:, 0] = whole >> shift
    for place, (k, found) in enumerate(zip(PREFIXES, begins), 1):
        # Another place for each length, so that a short word and a beginning equal to it stay apart.
        mixed = ((found + np.uint32(k)) * np.uint32(0x9E3779B1)) >> shift
        features[:, place] = np.where(sizes >= k, mixed, 1 << BITS)
    return Words(texts.text_of(starts), number, features, len(column))


def signals(column: pa.Array, lifts: np.ndarray) -> np.ndarray:
    """(texts x N_SIGNALS): highest lift of a word, lift above 1 in all and by length, words above each level, and
    shortness: texts over LONG_TEXT words hold more lifted words by chance. A text without words has 0 throughout."""
    words = read_words(column)
    n = words.n_texts
    of_word = np.append(lifts, lifts.min(initial=0.0))[words.features].max(axis=1, initial=0.0)
    lift = of_word[words.number] if len(words.number) else np.zeros(0)
    count = np.bincount(words.text, minlength=n)
    highest = np.zeros(n)
    if len(lift):
        met = np.flatnonzero(count)
        highest[met] = np.maximum(np.maximum.reduceat(lift, np.searchsorted(words.text, met)), 0)
    above = np.bincount(words.text, np.maximum(lift - 1, 0), n)
    return np.column_stack([
        highest, np.log1p(above), above / np.sqrt(np.maximum(count, 1)),
        *[np.log1p(np.bincount(words.text, lift > level, n)) for level in LEVELS],
        -np.log(np.maximum(count / LONG_TEXT, 1))])


def confirmed_and_prior(labels: DataFrame, doc_id: str = "doc_id", label: str = "toxic",
                        most: int = MOST_CONFIRMED) -> tuple[DataFrame, float]:
    """(ids of confirmed toxic documents outside the held-out fold, at most about `most`; share of toxic ones among
    the labelled). An id labelled both ways is toxic; null ids and labels are left out."""
    marked = labels.select(F.col(doc_id).alias("marked_id"), F.col(label).cast("double").alias("label")).where(
        F.col("marked_id").isNotNull() & F.col("label").isin(0, 1)
        & (training_remainder(F.col("marked_id"), FOLDS) != HELD_OUT))
    marked = materialize(marked.groupBy("marked_id").agg(F.max("label").alias("label")), "pu-labels")
    n, toxic = marked.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    share = min(1.0, most / max(1.0, toxic))
    kept = F.xxhash64("marked_id").bitwiseAND(F.lit(GRAIN - 1)) < F.lit(int(share * GRAIN))
    return marked.where((F.col("label") == 1) & kept).select("marked_id"), min(toxic / max(n, 1), 0.99)


def training_texts(docs: DataFrame, confirmed: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text, confirmed) of the documents outside the held-out fold."""
    out = docs.where(training_remainder(F.col(doc_id), FOLDS) != HELD_OUT).select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # `confirmed` has at most about MOST_CONFIRMED distinct ids.
    return out.join(F.broadcast(confirmed), F.col("doc_id") == F.col("marked_id"), "left").select(
        "doc_id", "text", F.col("marked_id").isNotNull().alias("confirmed"))


def word_lifts(texts: DataFrame, prior: float) -> np.ndarray:
    """The lift of each hashed feature: log of confirmed documents that hold it over clean ones, were there as many.

    Every task adds up its documents in two arrays of 2^BITS numbers; Spark adds those up by place."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, (1 << BITS) + 2), dtype=np.int64)  # the last place: documents
        for batch in batches:
            for part in chunks_of([batch], "text", CHUNK_BYTES):
                words = read_words(part.column("text"))
                toxic = part.column("confirmed").to_numpy(zero_copy_only=False).astype(bool)
                wide = max(1, len(words.features))
                met = np.unique(words.text * wide + words.number)  # a word once a document
                for row, some in enumerate((met, met[toxic[met // wide]])):
                    often = np.bincount(some % wide, minlength=wide)[:len(words.features)]
                    for place in words.features.T:
                        held[row] += np.bincount(place, often, held.shape[1]).astype(np.int64)
                held[:, -1] += len(toxic), int(toxic.sum())
        places = np.flatnonzero(held[0])
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(held[0, places]), pa.array(held[1, places])],
                                         ["place", "n", "n_toxic"])

    found = texts.select("text", "confirmed").mapInArrow(count, "place bigint, n bigint, n_toxic bigint")
    found = found.groupBy("place").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic")).toArrow()
    held = np.zeros((2, (1 << BITS) + 2))
    held[:, found["place"].to_numpy()] = found["n"].to_numpy(), found["n_toxic"].to_numpy()
    every, toxic = np.maximum(held[:, -1], 1)
    clean = np.maximum(held[0] / every - prior * held[1] / toxic, 0) / (1 - prior)
    return np.log((held[1] + SMOOTH) / (clean * toxic + SMOOTH))[:1 << BITS].astype(np.float32)


def risk(scores_p: np.ndarray, scores_u: np.ndarray, prior: float) -> tuple[float, float]:
    """(prior x risk on toxic texts, estimated (1 - prior) x risk on clean texts) of the logistic loss."""
    clean = np.logaddexp(0, scores_u).mean() - prior * np.logaddexp(0, scores_p).mean()
    return prior * float(np.logaddexp(0, -scores_p).mean()), float(clean)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (the last one constant) by gradient steps on the non-negative risk. Signals speak for toxicity only:
    their weights stay at 0 or above, no text is toxic for what it lacks."""
    p, u = (np.hstack([x, np.ones((len(x), 1))]) for x in (positive, unlabelled))
    weights = np.zeros(p.shape[1])
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for turn in range(1, rounds + 1):
        zp, zu = p @ weights, u @ weights
        sp = _sigmoid(zp)
        slope = _sigmoid(zu) @ u / len(u) - prior * (sp @ p) / len(p)
        slope = slope - prior * ((1 - sp) @ p) / len(p) if risk(zp, zu, prior)[1] >= 0 else -slope
        slope = slope + DECAY * weights
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope ** 2
        weights = weights - STEP * (first / (1 - 0.9 ** turn)) / (np.sqrt(second / (1 - 0.99 ** turn)) + 1e-8)
        weights[:-1] = np.maximum(weights[:-1], 0)
    return weights


@dataclass
class Model:
    """Lifts of the features, centre and spread of the signals, and weights (classifiers x signals and a constant)."""

    lifts: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def score(self, column: pa.Array) -> np.ndarray:
        """Mean of the classifiers' log-odds, as a probability."""
        x = (signals(column, self.lifts) - self.centre) / self.spread
        return _sigmoid((np.hstack([x, np.ones((len(x), 1))]) @ self.weights.T).mean(axis=1))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        most: int = MOST_UNLABELLED, most_confirmed: int = MOST_CONFIRMED, prior: float | None = None) -> Model | None:
    """The classifiers; None where no confirmed toxic document has been met. `prior` replaces the estimated one."""
    confirmed, estimated = confirmed_and_prior(labels, doc_id, label, most_confirmed)
    prior = estimated if prior is None else prior
    texts = training_texts(docs, confirmed, doc_id, text)
    lifts = word_lifts(texts, prior)
    share = min(1.0, most / max(1, docs.count()))
    drawn = F.xxhash64(F.lit("unlabelled"), F.col("doc_id")).bitwiseAND(F.lit(GRAIN - 1)) < F.lit(int(share * GRAIN))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks_of(batches, "text", CHUNK_BYTES):
            rows = signals(part.column("text"), lifts)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("drawn"), part.column("confirmed"), pa.array(list(rows), pa.list_(pa.float64()))],
                ["doc_id", "drawn", "confirmed", "signals"])

    picked = texts.withColumn("drawn", F.coalesce(drawn, F.lit(False))).where(F.col("drawn") | F.col("confirmed"))
    kind = dict(docs.dtypes)[doc_id]
    sample = picked.select("doc_id", "text", "drawn", "confirmed").mapInArrow(
        describe, f"doc_id {kind}, drawn boolean, confirmed boolean, signals array<double>")
    # One row an id: about as many as the two bounds, however often an id is repeated.
    sample = sample.groupBy("doc_id", "drawn", "confirmed").agg(F.max("signals").alias("signals"))
    rows = sample.orderBy(F.col("doc_id").asc_nulls_first()).toArrow()
    if not rows.num_rows:
        return None
    x = np.array(rows["signals"].to_pylist(), dtype=float)
    toxic, drawn = (rows[c].to_numpy().astype(bool) for c in ("confirmed", "drawn"))
    if not toxic.any() or not drawn.any():
        return None
    centre, spread = x[drawn].mean(axis=0), x[drawn].std(axis=0) + 1e-6
    x = (x - centre) / spread
    part = np.arange(drawn.sum()) % CLASSIFIERS
    some = x[drawn]
    weights = [train(x[toxic], some[part != k] if (part != k).any() else some, prior) for k in range(CLASSIFIERS)]
    return Model(lifts, centre, spread, np.array(weights))


def toxicity_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
                    **options) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per input row.

    The fold of a document is crc32 of its id as text modulo 5 (a null id counts as the empty text); labels of fold 0
    are never read, nor is its text learned from. Null and empty texts have no words and score what the classifiers say
    of that; repeated rows and equal texts score alike; a table without confirmed toxic documents scores 0
    throughout; an empty table gives no rows; very long texts are read in one piece, whole; other columns, whatever
    their names, play no part.
    """
    model = fit(docs, labels, doc_id, text, label, **options)
    mine = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks_of(batches, "text", CHUNK_BYTES):
            found = model.score(part.column("text")) if model else np.zeros(part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    scored = mine.mapInArrow(score, f"doc_id {dict(mine.dtypes)['doc_id']}, score double")
    return scored.select("doc_id", (training_remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
