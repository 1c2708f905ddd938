"""Collocations, importance resampling and toxicity against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewatch.llm import byte_words, collocations, pu_toxicity, segment_resampling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, score double, words string, place int, n bigint, line string"


def made(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, g, 0.5, "w", 1, 2, "x") for i, t, g in rows], DOCS)


# --- sums of words -----------------------------------------------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abÀ z09é\n", max_size=90), max_size=6))
def test_sums_of_words_and_beginnings(texts):
    read = byte_words.Texts.of(pa.array([*texts, None], pa.string()))
    starts, lengths = read.spans(segment_resampling.IN_WORD)
    words = [read.data[s:s + n].tobytes() for s, n in zip(starts, lengths)]
    assert words == [w for t in texts for w in re.findall(rb"[0-9a-z\x80-\xff]+", t.translate(LOWER).encode())]
    whole, four = byte_words.crc_words(read.data, starts, lengths, (4,))
    assert whole.tolist() == [zlib.crc32(w) for w in words]
    assert four.tolist() == [zlib.crc32(w[:4]) if len(w) >= 4 else 0 for w in words]
    number, distinct = byte_words.number_words(read.data, starts, lengths)
    assert [distinct[int(k)].as_py() for k in number] == words


def test_sums_are_joined_at_any_length():
    sizes = [1, 2, 47, 48, 49, 63, 64, 65, 130, 5000, 70001]
    words = [bytes([97 + k]) * n for k, n in enumerate(sizes)]
    crc = np.array([zlib.crc32(w) for w in words], np.uint32)
    joined = byte_words.crc_joined(crc[:-1], crc[1:], np.array(sizes[1:]))
    assert joined.tolist() == [zlib.crc32(a + b" " + b) for a, b in zip(words, words[1:])]
    data = np.frombuffer(b" ".join(words), np.uint8)
    starts = np.cumsum([0, *[n + 1 for n in sizes[:-1]]])
    assert byte_words.crc_words(data, starts, np.array(sizes))[0].tolist() == crc.tolist()


# --- collocations ------------------------------------------------------------------------------------------------

def plain_collocations(rows, least=10, covered=50, top=2000):
    f = Counter()
    for _, text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            f.update((lang or "und", *w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    n = Counter()
    for (lang, *w), a in f.items():
        n[lang] += a if len(w) == 1 else 0
    out = {}
    for (lang, *w), a in f.items():
        if len(w) < 2 or a < least:
            continue
        cuts = [(1000000 * a * a // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        if len(w) == 2 and any(g >= least and len(v) == 4 and v[0] == lang and tuple(w) in (v[1:3], v[2:4]) and 100 * g >= covered * a
                               for v, g in f.items()):
            continue
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1))


def wordy(seed, n=60):
    rng = np.random.default_rng(seed)
    words = ["The", "of", "ox", "é", "a-b", "x" * 70, "rare", "Zig", "zag", "\x1f", "#"]
    weights = np.array([20, 12, 6, 4, 3, 2, 1, 3, 3, 1, 1]) / 56
    ends = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "? "]
    return ["".join(rng.choice(words, p=weights) + rng.choice(ends) for _ in range(rng.integers(0, 120))) for _ in range(n)]


@pytest.mark.parametrize("route_bytes,most", [(8 << 20, 2_000_000), (2000, 40), (500, 7)])
def test_collocations_like_plain(spark, route_bytes, most):
    rows = [(i, t, ["en", "de", None][i % 3]) for i, t in enumerate(wordy(3))]
    rows += [(None, None, "en"), (7, "", "en"), (7, "lone", "fr"), (8, " \n.", "fr"), *[(9, "Zig zag hot pair", "en")] * 40]
    rows += [(10, "of the ox " * 3000, "de")]
    found = collocations.mine(made(spark, rows), route_bytes=route_bytes, most=most).collect()
    assert sorted(map(tuple, found)) == plain_collocations(rows)
    cut = collocations.mine(made(spark, rows), top=3, least=5, route_bytes=route_bytes, most=most).collect()
    assert sorted(map(tuple, cut)) == plain_collocations(rows, least=5, top=3)


def test_collocations_of_nothing(spark):
    assert collocations.mine(made(spark, [])).count() == 0
    assert collocations.mine(made(spark, [(1, None, None), (2, "", "en")])).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 4_000_000_000_000
    rows = [("en", "a", "", "", big), ("en", "b", "", "", big + 1), ("en", "a", "b", "", big - 1)]
    scored = collocations.score_phrases(spark.createDataFrame(rows, "lang string, w1 string, w2 string, w3 string, f bigint"))
    assert scored.first()["score"] == 1000000 * (big - 1) ** 2 // (big * (big + 1))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(0, 4), st.integers(0, 4), st.integers(1, 9)), max_size=50), st.integers(1, 12))
def test_quicksort_counts_prefixes(rows, least):
    rows = {(a, b, c if b else 0): n for a, b, c, n in rows}
    ids = np.array(list(rows), dtype=np.int64).reshape(-1, 3)
    entry, length, often = collocations.quicksort_counts(ids, np.array(list(rows.values()), dtype=np.int64), (least,) * 3)
    want = Counter()
    for (a, b, c), n in rows.items():
        want[(a,) if not b else (a, b)] += n
        if c:
            want[(a, b, c)] += n
    assert {tuple(ids[e, :k]): n for e, k, n in zip(entry.tolist(), length.tolist(), often.tolist())} == {
        k: n for k, n in want.items() if n >= least}


def test_slices_with_very_many_words(monkeypatch):
    column = pa.array(wordy(5), pa.string())
    ids, n, names = collocations.merged_suffixes(column)
    monkeypatch.setattr(collocations, "PACKED", 0)
    other, m, _ = collocations.merged_suffixes(column)
    assert sorted(map(tuple, np.column_stack([ids, n]))) == sorted(map(tuple, np.column_stack([other, m])))
    back, k, again = collocations.unpack([(b[1], b[3]) for b in collocations.pack(ids, n, names, ids[:, 0] % 3)])
    assert sorted((*(names[int(x)].as_py() for x in row), int(c)) for row, c in zip(ids, n)) == sorted(
        (*(again[int(x)].as_py() for x in row), int(c)) for row, c in zip(back, k))


# --- importance resampling ---------------------------------------------------------------------------------------

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_resampling(rows, target, percent=5, least_words=20):
    def features(text):
        w = WORD.findall((text or "").translate(LOWER))
        return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]

    docs = [(i, *features(t)) for i, t, _ in rows]
    s, t = Counter(p for d in docs for p in d[2]), Counter(p for x in target for p in features(x)[1])
    all_s, all_t = sum(s.values()) + 10000, sum(t.values()) + 10000
    gain = [math.floor(1000 * math.log((t[p] + 1) * all_s / ((s[p] + 1) * all_t))) for p in range(10000)]
    out = []
    for i, n, found in docs:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[p] for p in found)
        out.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= least_words))
    chosen = sorted((-d[3], -1 if d[0] is None else d[0]) for d in out if d[4])
    return out, chosen[:percent * len(chosen) // 100]


def test_resampling_like_plain(spark):
    rng = np.random.default_rng(11)
    words = ["One", "two", "É", "3", "x" * 60, "the", "of"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", "\n", "\n\n", ", ", "-"]) for _ in range(rng.integers(0, 70))) for _ in range(120)]
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(None, None, None), (500, "", "en"), (501, "\n\n", None), (502, "solo", "en")]
    rows += [(600, "same line of the two\n" * 30, "en")] * 25 + [(None, "hot null id " * 10, "en")] * 25 + [(700, "of the " * 40000, "en")]
    target = ["one two of\nthe é", None, "", "3 3 3"]
    goal = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id bigint, text string")
    found = segment_resampling.resample(made(spark, rows).repartition(5), goal).collect()
    want, chosen = plain_resampling(rows, target)
    assert sorted(map(repr, ((r.doc_id, r.n_features, r.weight, r.score) for r in found))) == sorted(repr(w[:4]) for w in want)
    ranked = sorted((r["rank"], r.score, r.doc_id) for r in found if r["rank"] is not None)
    assert [k for k, _, _ in ranked] == list(range(1, len(chosen) + 1))
    assert [(-s, -1 if i is None else i) for _, s, i in ranked] == chosen


def test_resampling_of_nothing(spark):
    goal = spark.createDataFrame([], "item_id bigint, text string")
    assert segment_resampling.resample(made(spark, []), goal).count() == 0
    rows = [(i, "word " * 30, "en") for i in range(40)]
    found = segment_resampling.resample(made(spark, rows), goal).collect()
    assert sorted(r["rank"] for r in found if r["rank"]) == [1, 2]
    assert sorted((r.doc_id, r.weight) for r in found) == sorted((d[0], d[2]) for d in plain_resampling(rows, [])[0])


# --- toxicity ----------------------------------------------------------------------------------------------------

def fold(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5


def test_toxicity_learns_from_confirmed_and_unlabelled(spark):
    rng = np.random.default_rng(2)
    clean = [f"w{k}" for k in range(300)]

    def text(bad):
        words = list(rng.choice(clean, rng.integers(20, 60)))
        return " ".join(words + (["Nasty", "vile"] if bad else [])) + ".\n"

    bad = [bool(rng.random() < 0.15) for _ in range(1500)]
    rows = [(i, text(b), "en") for i, b in enumerate(bad)]
    rows += [(None, None, None), (9000, "", "en"), (9001, "nasty " * 20000, "en"), (9001, "nasty " * 20000, "en")]
    # Labels of the held-out fold are turned round: they must change nothing. Half of the rest is unlabelled.
    labels = [(i, 1 - int(b) if fold(i) == 0 else int(b)) for i, b in enumerate(bad) if i % 2 or fold(i) == 0]
    labels += [(1, int(bad[1])), (None, 1), (3, None)]
    marked = spark.createDataFrame([(i, 0, t) for i, t in labels], "doc_id bigint, quality int, toxic int")
    docs = made(spark, rows)
    found = pu_toxicity.toxicity_scores(docs, marked).collect()
    assert len(found) == len(rows)
    assert all(r.held_out == (fold(r.doc_id) == 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r for r in found}
    right = [by_id[i].predicted == int(b) for i, b in enumerate(bad) if fold(i) == 0]
    assert np.mean(right) > 0.98
    assert by_id[9001].predicted == 1 and by_id[9000].predicted == 0 and by_id[None].score == by_id[9000].score
    again = pu_toxicity.toxicity_scores(docs.repartition(7), marked.repartition(3)).collect()
    assert {r.doc_id: round(r.score, 9) for r in again} == {r.doc_id: round(r.score, 9) for r in found}


def test_toxicity_without_examples(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert [r.score for r in pu_toxicity.toxicity_scores(made(spark, [(1, "a", "en"), (2, None, "en")]), none).collect()] == [0, 0]
    assert pu_toxicity.toxicity_scores(made(spark, []), none).count() == 0


def test_risk_is_corrected_by_the_prior():
    rng = np.random.default_rng(4)
    prior = 0.2
    p, n = rng.normal(2, 1, 4000), rng.normal(-2, 1, 16000)
    toxic, clean = pu_toxicity.risk(p, np.concatenate([p, n]), prior)
    assert abs(toxic - prior * np.logaddexp(0, -p).mean()) < 1e-9
    assert abs(clean - (1 - prior) * np.logaddexp(0, n).mean()) < 1e-9  # the risk on clean texts, never seen alone


def test_steps_back_where_the_clean_risk_is_negative():
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (12, 30))
    weights = pu_toxicity.train(x[:6], x[6:], 0.9, 400)  # more signals than rows: any labelling could be learned by heart
    scores = np.hstack([x, np.ones((12, 1))]) @ weights
    assert pu_toxicity.risk(scores[:6], scores[6:], 0.9)[1] > -0.2
