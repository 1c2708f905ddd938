"""The corpus operators on hard small inputs, against plain versions."""

from __future__ import annotations

import hashlib
import html as html_lib
import inspect
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tests.conftest import SF
from tidewatch.llm import (
    encoding, hmm, html_text, jaccard_join, line_crf, mixing, quality_rules, repair, token_counts, topk, trie_bpe,
)
from tidewatch.llm.common import running_sums
from tools.check_queries import rows_of

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"word{i % 997} and{i % 31}." for i in range(6000))
SENTENCE = "the quick brown fox jumps over the lazy dog while many small birds sing in tall green trees near old stone walls"
HARD = [
    (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n ", None, None, 4), (4, "one", "de", "b", 3),
    (5, LONG, "en", "a", len(LONG)), (6, SENTENCE * 3, "en", "b", 1), (7, SENTENCE * 3, "en", "b", 1), (7, SENTENCE * 3, "en", "b", 1),
    (8, SENTENCE.upper() * 3, "fr", None, 1), (None, "no id at all", None, None, None), (9, "a<|endoftext|>b  c d\nDÉJÀ vu É́ Σας", "el", "c", 1),
    (10, "it's I'LL 12345 !!!??? 漢字かな \U0001f600 aaa aaaa ababab", "ja", "c", 1), (11, "x" * 3000, "en", "c", 3000),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(HARD, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def clashing(docs):
    """Columns named like those the operators add or use inside."""
    extra = ("n_tokens", "score", "n_words", "size", "target", "fp", "copies", "ids", "held", "kept", "_digest", "_nth", "_copies", "row")
    return docs.withColumns({c: F.lit("x") for c in extra})


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# Shared helpers

def test_running_sums(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    got = running_sums(df, [F.col("id").desc()], ["v"], "t").collect()
    assert {r["id"]: r["before_v"] for r in got} == {i: sum(j % 7 for j in range(i + 1, 1000)) for i in range(1000)}


# SQL-expressible queries

@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if re.match(r"op\d+_", n)))
@pytest.mark.parametrize("kind", ["given", "hard", "empty"])
def test_query_equals_sql(spark, tmp_path, docs, empty, name, kind):
    folder = SF
    if kind != "given":
        folder = str(tmp_path)
        vectors = [(0, [0.5, -0.25]), (50, [0.5, -0.25]), (50, [0.5, -0.25]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]),
                   (6, [float("inf"), 1.0]), (7, [1.0, 1.0]), (8, [1.0, 1.0]), (None, [1.0, 1.0]), (100, [0.0, 0.0])]
        kept = [v for v in vectors if v[0] != 50 or v is vectors[1]] if kind == "hard" else []
        some = docs.where("doc_id is not null").dropDuplicates(["doc_id"]) if kind == "hard" else empty
        some.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame(kept, "vec_id bigint, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
        some.selectExpr("doc_id as item_id", "text").where("item_id % 3 = 0").write.parquet(f"{folder}/benchmark.parquet")
    db = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        path = f"{folder}/{t}.parquet" + ("/*.parquet" if kind != "given" else "")
        db.execute(f"create view {t} as select * from '{path}'")
    df = entry.queries()[name](spark, folder)
    cursor = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cursor.fetchall())


# 1 HTML

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body class="has-sidebar"><nav><ul><li><a href=x>Home</a>
</ul></nav><header>Site</header><div class="cookie-notice">We use cookies</div><article><header><h1>Head &amp; line</h1><p>by me</p></header>
<p><b>One  two<br>three<p>Four&nbsp;five</b> six</p><aside>see also</aside><form>mail <input></form><div class="comments"><p>first!</p></div>
<ul><li>a<li>b</ul></article><footer>&copy; x</footer></body>"""


def test_html_declared_article(spark):
    rows = [(1, "http://a.example/x", PAGE), (2, None, None), (2, None, ""), (None, "::bad::", "<p>just text"), (4, "u", PAGE[:PAGE.index("Four") + 4])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))
    got = sorted(((r["page_id"] or -1, r["text"], r["n_chars"]) for r in html_text.extract(pages).collect()))
    text = "Head & line One two three Four five six a b"
    assert got == [(-1, "just text", 9), (1, text, len(text)), (2, "", 0), (2, "", 0), (4, "Head & line One two three Four", 30)]
    assert html_text.extract(pages.limit(0)).collect() == []


def test_html_repeated_runs_on_a_host(spark):
    top, low = "welcome to our little site about all sorts of things", "call us or write us at any time of the day or night"
    def page(i):
        body = f"<div><p>{top}</p></div><div><p>story {i} begins {i}</p><p>{low}</p><p>and story {i} ends {i}</p></div><div><p>{low}</p></div>"
        return (i, f"https://host.example/{i}", body)
    pages = spark.createDataFrame([page(i) for i in range(6)], "page_id bigint, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    assert got == {i: f"story {i} begins {i} {low} and story {i} ends {i}" for i in range(6)}
    lone = spark.createDataFrame([page(0)], "page_id bigint, url string, html string")
    assert html_text.extract(lone).first()["text"].startswith(top)


def test_html_copies_are_one_page(spark):
    """A page held under many urls keeps its text; menus of different pages go, also where a copy is among them."""
    menu = "welcome to our little site about all sorts of things"
    def page(i, url):
        return (i, f"https://host.example/{url}", f"<div><p>{menu}</p></div><div><p>story {i // 10} begins with many words of its own {i // 10}</p></div>")
    rows = [page(i, f"a?session={i}#{i}") for i in range(5)] + [page(0, "a?session=0#0")]
    extract = lambda rows: sorted((r["page_id"], r["text"]) for r in html_text.extract(
        spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)).collect())
    story = "story 0 begins with many words of its own 0"
    assert extract(rows) == [(i, f"{menu} {story}") for i in (0, 0, 1, 2, 3, 4)]
    more = rows + [page(10, "b"), page(20, "c")]
    assert extract(more) == [(i, story) for i in (0, 0, 1, 2, 3, 4)] + [
        (10 * i, f"story {i} begins with many words of its own {i}") for i in (1, 2)]


@pytest.mark.parametrize("repeated", ["<h2>Background of it</h2>", "<blockquote><p>Background of it</p></blockquote>", "<pre>Background of it</pre>",
                                      "<table><tr><td>Background of it</td></tr></table>"])
def test_html_repeated_parts_inside_a_text(spark, repeated):
    pages = [(i, f"https://host.example/{i}", f"<body><h2>Home of us</h2><div><p>story {i} begins {i}</p>{repeated}<p>and story {i} ends {i}</p></div>")
             for i in range(4)]
    got = html_text.extract(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {i: f"story {i} begins {i} Background of it and story {i} ends {i}" for i in range(4)}


def test_html_runs_decide_inside_articles(spark):
    """A notice without markup at the end of articles goes where other pages of the host show it outside theirs; passages that
    only articles share, titles and teasers that lists repeat, short blocks, and an article that is nothing but the notice stay."""
    notice = "Sign up today to get all of our stories sent straight to your inbox every morning"
    shared = "This long paragraph was quoted word by word in every one of these articles on this host"
    teaser = "A teaser opens the first article and is listed in the menus of all the other pages"
    rows = []
    for i in range(4):
        top = teaser if i == 0 else f"Only page {i} opens with these words and with no others that anybody else wrote"
        body = f"<h2>More news</h2><p>{top}</p><p>{shared}</p><p>End of page {i}</p><p>{notice}</p>"
        rows.append((i, f"http://h.example/{i}", f"<nav>More news</nav><article>{body}</article><ul class=related><li>{teaser}</li></ul>"))
    rows += [(10 + i, f"http://h.example/n{i}", f"<article><p>Text number {i}</p></article><footer>{notice}</footer>") for i in range(3)]
    rows += [(20, "http://h.example/all", f"<article><p>{notice}</p></article>"), (21, "http://other.example/", f"<article><p>a {i}</p><p>{notice}</p></article>")]
    got = {r["page_id"]: r["text"] for r in html_text.extract(
        spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)).collect()}
    for i in range(4):
        assert got[i].startswith("More news ") and got[i].endswith(f"{shared} End of page {i}")
    assert teaser in got[0] and got[10] == "Text number 0" and got[20] == notice and got[21].endswith(notice)
    few = [r for r in rows if r[0] != 3] + [(30 + i, f"http://h.example/few{i}", f"<article><p>Some other text {i}</p></article>") for i in range(3)]
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(few, "page_id bigint, url string, html string")).collect()}
    assert all(got[i].endswith(notice) for i in range(3))  # in few of the host's articles: a quotation


def test_html_runs_of_articles_alone_decide(spark):
    """The suffix arrays take in articles: a notice that stands in articles only, and in most of a host's, goes, in whatever
    slices they lie; a passage in half of them, copies of one article, and versions that have most words in common stay."""
    notice = "Sign up today to get all of our stories sent straight to your inbox every morning"
    shared = "This long paragraph was quoted word by word in one half of the articles on this host"
    body = lambda i: f"<p>Only page {i} {' '.join(f'word{i}x{k}' for k in range(30))}</p>"
    rows = [(i, f"http://h.example/{i}", f"<article>{body(i)}{f'<p>{shared}</p>' * (i % 2)}<p>End of {i}</p><p>{notice}</p></article>")
            for i in range(6)]
    rows += [(10 + i, f"http://h.example/c{i}", f"<nav>Menu {i}</nav>{rows[0][2]}") for i in range(9)]
    rows += [(20 + i, f"http://v.example/{i}", f"<article>{body(0)}<p>{notice}</p><p>Version {i} has a few more words here</p></article>") for i in range(4)]
    rows += [(30 + i, f"http://two.example/{i}", f"<article>{body(i)}<p>{notice}</p></article>") for i in range(2)]
    rows += [rows[1], (40, "http://h.example/none", "<nav>Menu</nav>")]
    for parts in (1, 5):
        got = {r["page_id"]: r["text"] for r in html_text.extract(
            spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(parts)).collect()}
        for i in range(6):
            assert got[i].startswith(f"Only page {i}") and got[i].endswith(f"End of {i}") and (shared in got[i]) == (i % 2 == 1)
        assert all(got[10 + i] == got[0] for i in range(9)) and got[40] == ""
        assert all(got[20 + i].startswith("Only page 0") and f"{notice} Version {i}" in got[20 + i] for i in range(4))
        assert all(got[30 + i].endswith(notice) for i in range(2))


def test_html_runs_of_most_articles():
    """Half of a host's articles are not most, and blocks shorter than a run do not count; slices hold all rows in order."""
    run = "a b c d e f g h"
    texts = [[run, "short one"], [f"x {run}", "short one"], ["short one"], [run], [f"{run} y", f"{run} z"]]
    blocks = pa.array(texts, pa.list_(pa.string()))
    assert html_text.most_runs(["p", "p", "p", "q", "q"], blocks) == [(h, html_text.run_codes(run.split(" "))[0]) for h in "pq"]
    assert html_text.most_runs(["p", "p", "p", "p", "q"], blocks.slice(0, 4))[1:] == []
    assert html_text.most_runs(["p"] * 4, pa.array([[run], [run], ["k"], ["k"]], pa.list_(pa.string()))) == []
    assert html_text.most_runs([], blocks.slice(0, 0)) == []
    long = [f"w{i % 977}x{i // 7}" for i in range(20_000)]  # one block, all of whose runs count
    assert sorted(run for _, run in html_text.most_runs(["p"], pa.array([[" ".join(long)]], pa.list_(pa.string())))) == sorted(html_text.run_codes(long))
    batch = pa.RecordBatch.from_arrays([blocks], ["texts"])
    for limit in (1, 100, 1000):
        slices = list(html_text.slices_of([batch, batch.slice(0, 0), batch], limit))
        assert [x for part in slices for x in part.column(0).to_pylist()] == texts * 2
    assert len(slices) == 1 and len(list(html_text.slices_of([batch, batch], 1))) == 10


def test_html_runs_counted_like_windows():
    pages = [("h", ["a b c d e f g h i j", "x y"]), ("h", ["b c d e f g h i", "x y", "x y"]), ("g", ["x y"])]
    got = {(h, run): n for h, run, n in html_text.count_runs(pages)}
    want = Counter()
    for host, blocks in pages:
        want.update({(host, run) for text in blocks for run in html_text.run_codes(text.split(" "))})
    assert got == want


@pytest.mark.parametrize("html, want", [
    ('<body><form id="aspnetForm"><nav>Home</nav><article><p>real text</p></article></form>', "real text"),
    ('<div class="layout sidebar-right"><article><p>real text</p></article><div class="sidebar">links</div></div>', "real text"),
    ('<article><div class="article-header"><h1>Title</h1><p>by me</p></div><p>words</p></article>', "Title words"),
    ("<main><h1>Main</h1><p>text</p><article>teaser</article></main>", "Main text teaser"),
    ("<main><article><h1>T</h1><p>a b c d</p></article><p>more</p></main>", "T a b c d"),
    ('<article><p>a</p><p class="share-price">b</p><div class="share-buttons">tweet</div></article>', "a b"),
    ('<article><h1>T</h1><p>a</p></article><section class="comments"><article class="comment">many more words than it</article></section>',
     "T a"),
    ('<main><article><h1>T</h1><p>a</p></article><div class="related"><article>many more words than it</article></div></main>', "T a"),
    ('<form><section class="comment-list"><article>only comments here</article></section></form>', ""),
    ('<aside><article>teaser</article></aside><article><header><h1>T</h1><span>by</span></header><p>x</p></article>', "T x"),
])
def test_html_wrappers_and_names(html, want):
    assert html_text.settle(html_text.PageReader().read(html))[0] == want


@pytest.mark.parametrize("tag", ["<div>", "<b>", '<div class="sidebar">'])
def test_html_deep_pages_take_linear_time(tag):
    def seconds(n):
        start = time.process_time()
        assert html_text.PageReader().read(f"<article>{tag * n}x") or "side" in tag
        return time.process_time() - start

    seconds(1_000)
    assert seconds(40_000) < 4 * max(seconds(20_000), 0.2)  # four times would be quadratic


def test_html_given_pages(spark):
    for r in html_text.extract(spark.read.parquet(f"{SF}/pages.parquet")).join(
            spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        parts = [" ".join(html_lib.unescape(re.sub("<br>", " ", re.sub("</?b>", "", x))).split()) for x in re.split("</?(?:p|h1)>", inner)]
        assert r["text"] == " ".join(x for x in parts if x)


# 2, 10 byte-level encoding

def plain_ids(path, texts):
    tokenizer = Tokenizer.from_file(path)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_encoder_equals_library():
    texts = [t for _, t, *_ in HARD] + ["a\n\nb", "a \n b", " lead", "trail ", "end.\nThe next", "tab\tx y z   q", "a\x1cb \x1c c"]
    path = encoding.default_vocabulary()
    for _ in range(2):
        got = encoding.encoder(path).encode(texts)
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == plain_ids(path, texts)


def test_encoder_learns_words_in_one_call_and_drops_kept_ones(monkeypatch):
    texts = ["a " + " ".join(f"wörd{chr(97 + i % 26)}{chr(97 + i // 26)}!" for i in range(300)), "a ×÷ b× ª x́ don't 'q' .. , c.\nd\ne f",
             "x " + "y" * 90 + "!" * 99, "a b  c", "a<|endoftext|>b c", None, "", "one"]
    path = encoding.default_vocabulary()
    worker, asked = encoding.Encoder(path), []
    learn = worker.learn_words
    monkeypatch.setattr(worker, "learn_words", lambda words, before: asked.append((before, len(words))) or learn(words, before))
    assert [np.frombuffer(x, "<u4").tolist() for x in worker.encode(texts)] == plain_ids(path, texts)
    assert max(n for before, n in asked if before) >= 300 and len([1 for before, n in asked if before and n]) == 1
    monkeypatch.setattr(encoding, "MOST_PIECES", 3)
    for t in texts * 2:
        assert np.frombuffer(worker.encode([t])[0], "<u4").tolist() == plain_ids(path, [t])[0]
    assert len(worker.pieces.texts) < 10 and len(worker.words.texts) < 10 and worker.encode([]) == []


def test_token_counts(spark, docs, empty):
    limits = token_counts.limit_table(token_counts.length_histogram(docs))
    sizes = [len(x) for x in plain_ids(encoding.default_vocabulary(), [t for _, t, *_ in HARD])]
    rows = {r["context_limit"]: r for r in limits.collect()}
    assert set(rows) == set(sizes)
    for limit, r in rows.items():
        assert r["truncated_tokens"] == sum(min(s, limit) for s in sizes)
        assert r["docs_longer"] == sum(s > limit for s in sizes) and r["tokens_longer"] == sum(s for s in sizes if s > limit)
        assert r["n_docs"] == sizes.count(limit) and r["total_tokens"] == sum(sizes)
    for limit in (0, 1, 5, 77, 10 ** 6):
        r = token_counts.at_limit(limits, limit).first()
        assert r["truncated_tokens"] == sum(min(s, limit) for s in sizes)
    half = token_counts.length_quantile(limits, 0.5).first()[0]
    assert half == sorted(sizes)[-(-len(sizes) // 2) - 1]
    assert token_counts.limit_table(token_counts.length_histogram(empty)).collect() == []
    assert token_counts.at_limit(token_counts.limit_table(token_counts.length_histogram(empty)), 5).first()["truncated_tokens"] == 0


@given(st.lists(st.integers(0, 4), max_size=400), st.integers(2, 6))
@settings(max_examples=60, deadline=None)
def test_grammar_round_trip(ids, least):
    block = repair.Block(repair.compress(np.array(ids, np.uint32), one_in=1 << 30, min_count=least))
    assert block.read(0, len(block)).tolist() == ids and len(block) == len(ids)
    for start in range(0, len(ids), 7):
        assert block.read(start, start + 11).tolist() == ids[start:start + 11]


def test_grammar_replaces_frequent_pairs():
    block = repair.Block(repair.compress(np.array([5, 6, 7, 8] * 200, np.uint32)))
    assert len(block.seq) < 20 and len(block) == 800


def test_grammar_of_a_full_shard_has_rare_pairs():
    ids = np.arange(repair.SHARD_IDS, dtype=np.uint32) + 100
    ids[np.arange(300) * 800] = 7
    ids[np.arange(300) * 800 + 1] = 8
    block = repair.Block(repair.compress(ids))
    assert list(zip(block.left.tolist(), block.right.tolist())) == [(7, 8)] and len(block.seq) == len(ids) - 300


def test_grammar_looks_again_only_where_a_pair_may_be_frequent(monkeypatch):
    """Rounds after the first read few places, and end with the rules that rounds over all places give."""
    rng = np.random.default_rng(3)
    ids = np.concatenate([rng.integers(0, 50_000, 20_000), np.tile(rng.integers(0, 50_000, 40), 30), [7] * 25]).astype(np.uint32)
    read, codes_of = [], repair.codes_of
    monkeypatch.setattr(repair, "codes_of", lambda seq, at: read.append(len(at)) or codes_of(seq, at))
    block = repair.Block(repair.compress(ids))
    assert read[0] == len(ids) - 1 and len(read) > 3 and max(read[1:]) < len(ids) / 10
    seq, rules, first = ids.tolist(), [], int(ids.max()) + 1
    while True:
        counts = Counter(zip(seq, seq[1:]))
        ranked = sorted((p for p, n in counts.items() if n >= repair.MIN_COUNT), key=lambda p: (-counts[p], p))
        chosen = repair.choose(np.array([(a << 32) | b for a, b in ranked], np.uint64))
        if not chosen:
            break
        symbol = {p: first + len(rules) + i for i, p in enumerate(chosen)}
        out, i = [], 0
        while i < len(seq):
            found = symbol.get(tuple(seq[i:i + 2]))
            out.append(seq[i] if found is None else found)
            i += 1 if found is None else 2
        seq, rules = out, rules + chosen
    assert list(zip(block.left.tolist(), block.right.tolist())) == rules and block.seq.tolist() == seq
    assert block.read(0, len(block)).tolist() == ids.tolist()


def test_repair_query(spark, clashing, empty, tmp_path):
    repair.write_shards(clashing, str(tmp_path / "f"), shard_ids=300)
    got = [tuple(r) for r in repair.read_documents(spark, str(tmp_path / "f")).collect()]
    order = sorted(HARD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for (i, *_), ids in zip(order, plain_ids(encoding.default_vocabulary(), [r[1] for r in order])):
        data = np.array([*ids, 0], "<u4")
        want.append((i, start, len(data), zlib.crc32(data.tobytes())))
        start += len(data)
    assert sorted(got, key=lambda r: r[1]) == want
    assert repair.write_and_read(empty).collect() == []


# 3 mixing

def test_mix_targets_and_bounds(spark, real, clashing, empty):
    rows = mixing.mix(real).collect()
    total = sum(r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r["source"], [0, r["target"], r["source_size"], 0])
        by[r["source"]][0] += r["taken"]
        by[r["source"]][3] = max(by[r["source"]][3], r["size"])
        assert r["taken"] in (0, r["size"], 2 * r["size"], 3 * r["size"])
    assert abs(sum(t for _, t, _, _ in by.values()) - total) < 1e-6 * total and sum(t for t, *_ in by.values()) <= total
    for taken, target, size, longest in by.values():
        assert target <= 3 * size and abs(taken - target) <= 2 * longest
    again = mixing.mix(real.repartition(7)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in rows)
    assert mixing.mix(empty).collect() == [] and mixing.mix_documents(empty).collect() == []
    mixed, sizes = mixing.mix_documents(clashing), mixing.mix(clashing).collect()
    assert mixed.columns == clashing.columns
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({r: n for r, n in Counter(
        {i: sum(x["copies"] for x in sizes if x["doc_id"] == i) for i in {x["doc_id"] for x in sizes}}).items() if n})


# 4 trie BPE

def test_trie_equals_library(spark, clashing, empty, real):
    path = trie_bpe.default_vocabulary()
    tokenizer = Tokenizer.from_file(path)
    for docs in (clashing, real):
        out = trie_bpe.encode_documents(docs, ids=True)
        size, ids, sha, decoded = out.columns[-4:]
        assert out.columns[:-4] == docs.columns
        for r in out.collect():
            want = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
            assert r[ids] == want and r[size] == len(want)
            assert r[sha] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
            assert r[decoded] == hashlib.sha256(tokenizer.decode(want, skip_special_tokens=False).encode()).hexdigest()
    assert trie_bpe.encode_documents(empty).collect() == []
    rows = trie_bpe.decode_documents(trie_bpe.encode_documents(real.select("doc_id", "text"), ids=True, digests=False)).collect()
    assert all(r["decoded"] == tokenizer.decode(r["ids"], skip_special_tokens=False) for r in rows)


def test_trie_decodes_the_ids_it_gives():
    """A fault in the ids shows in the decoded text."""
    worker = trie_bpe.WordEncoder(trie_bpe.default_vocabulary())
    (ids, text), = worker.encode(["the quick fox"])
    numbers = np.frombuffer(ids, "<u4").tolist()
    assert text == worker.tokenizer.decode(numbers, skip_special_tokens=False)
    worker = trie_bpe.WordEncoder(trie_bpe.default_vocabulary())
    one, two = (worker.tokenizer.encode(w, add_special_tokens=False).tokens[0] for w in ("quick", "fox"))
    worker.merges.packed[one] = worker.merges.packed[two]
    (ids, wrong), = worker.encode(["the quick fox"])
    assert wrong == worker.tokenizer.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False) != text


def test_tokens_stay_apart_like_plain_merges():
    merges = trie_bpe.Merges(trie_bpe.default_vocabulary())
    assert merges.grown
    rng = np.random.default_rng(6)
    whole = [t for t in list(merges.ids)[::7] if merges.is_whole(t)]
    firsts = [t for t in whole if not t.endswith(merges.end)]
    runs = [c * n for c in "ao-" for n in (1, 2, 3, 4) if merges.is_whole(c * n)]
    pairs = [(firsts[i], whole[j]) for i, j in zip(rng.integers(0, len(firsts), 4000), rng.integers(0, len(whole), 4000))]
    for left, right in pairs + [(a, b) for a in runs for b in runs]:
        plain = merges.merged([*merges.symbols(left), *merges.symbols(right)]) == [left, right]
        assert merges.stay_apart(left, right) == plain, (left, right)


@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=12), max_size=5))
@settings(max_examples=80, deadline=None)
def test_trie_any_text(words):
    worker = trie_bpe.word_encoder(trie_bpe.default_vocabulary())
    text = " ".join(words)
    assert np.frombuffer(worker.encode([text])[0][0], "<u4").tolist() == worker.tokenizer.encode(text, add_special_tokens=False).ids


# 5 hidden Markov model

def brute_forward(model, classes):
    state = model.start * model.emits[classes[0]]
    for c in classes[1:]:
        state = (state @ model.moves) * model.emits[c]
    return np.log(state.sum())


def brute_expected(model, classes):
    n, k = len(classes), len(model.start)
    alpha, beta = np.zeros((n, k)), np.ones((n, k))
    alpha[0] = model.start * model.emits[classes[0]]
    for t in range(1, n):
        alpha[t] = (alpha[t - 1] @ model.moves) * model.emits[classes[t]]
    for t in range(n - 2, -1, -1):
        beta[t] = model.moves @ (model.emits[classes[t + 1]] * beta[t + 1])
    whole = alpha[-1].sum()
    moves = sum((np.outer(alpha[t - 1], model.emits[classes[t]] * beta[t]) * model.moves / whole for t in range(1, n)), np.zeros((k, k)))
    return alpha * beta / whole, moves


def test_forward_and_expected_counts():
    rng = np.random.default_rng(3)
    k, size = 3, 12
    model = hmm.Model(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(size), k).T)
    sizes = np.array([1, 64, 65, 7, 128, 130, 2])
    classes = rng.integers(0, size, sizes.sum())
    parts = np.split(classes, np.cumsum(sizes)[:-1])
    segments = hmm.Segments(classes, sizes)
    assert np.allclose(segments.likelihood(model), [brute_forward(model, p) for p in parts])
    start, moves, by_step = segments.expected(model)
    gamma = by_step.T[np.argsort(segments.order)]
    want = [brute_expected(model, p) for p in parts]
    assert np.allclose(gamma, np.vstack([g for g, _ in want])) and np.allclose(moves, sum(m for _, m in want))
    assert np.allclose(start, sum(g[0] for g, _ in want))


def test_sums_of_documents(monkeypatch):
    rng = np.random.default_rng(4)
    weights, sizes = rng.standard_normal((9, 5)), np.array([1, 30, 2, 8, 8, 1, 40, 3])
    classes = rng.integers(0, 9, sizes.sum())
    want = [weights[part].sum(axis=0) for part in np.split(classes, np.cumsum(sizes)[:-1])]
    for cached in (1, 8, 17, 1000):
        monkeypatch.setattr(hmm, "CACHED", cached)
        assert np.allclose(hmm.doc_sums(weights, classes, sizes), want)


def test_scores_and_base(spark, real, clashing, empty):
    for docs in (real, clashing):
        rows = docs.select("doc_id", "text").collect()
        tokens = {}
        for i, r in enumerate(rows):
            held = zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 5 == 1
            tokens[i] = (r["doc_id"], held, [*(r["text"] or "").encode().lower().split(), b"\n"])
        counts = Counter(w for _, held, found in tokens.values() if not held for w in found)
        n, v = sum(counts.values()), len(counts)
        want = sorted((i or -1, held, len(found), sum(counts[w] > 0 for w in found), n,
                       round(sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in found), 5)) for i, held, found in tokens.values())
        scored = hmm.score_texts(docs).collect()
        got = sorted((r["doc_id"] or -1, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in scored)
        assert [g[:5] for g in got] == [w[:5] for w in want] and np.allclose([g[5] for g in got], [w[5] for w in want])
        assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in scored)
        if docs is real:
            held = [r for r in scored if r["held_out"]]
            assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert hmm.score_texts(empty).collect() == []


def test_model_of_full_size():
    assert (hmm.STATES, hmm.ROUNDS) == (6, 3)
    for f in (hmm.score_texts, hmm.train, hmm.first_model):
        wanted = {"states": 6, "k": 6, "rounds": 3}
        assert all(p.default == wanted[n] for n, p in inspect.signature(f).parameters.items() if n in wanted)


def test_first_model_of_any_ids(spark):
    """All training documents shape the first states, whatever their ids and number."""
    classes = np.array([1, 1, 0, 2, 2, 0] * 2, "<u2").tobytes()
    coded = spark.createDataFrame([([None, -1, 5, 5], [False] * 4, [3, 6, 9, 12], classes, [0] * 4, [0.0] * 4, [0.0] * 4)], hmm._CODED)
    size = 1 + hmm.OWN_CLASSES + hmm.ENDING_CLASSES
    model = hmm.first_model(coded, hmm.Vocabulary(10 ** 9, 2, 10 ** 9, np.zeros(size), np.zeros(size)), 2)
    assert np.argmax(model.emits[1]) != np.argmax(model.emits[2])
    texts = [" ".join(f"{'ab'[i % 2]}{j % (5 + i)}" for j in range(40)) for i in range(20)]
    same = [sorted(r["score"] for r in hmm.score_texts(spark.createDataFrame([(i, t) for t in texts], "doc_id bigint, text string")).collect())
            for i in (None, -7, 4)]
    assert all(zlib.crc32(str(i).encode()) % 5 != 1 for i in (-7, 4))
    assert np.allclose(same[0], same[1]) and np.allclose(same[0], same[2])


# 6 quality rules

def test_rules_pipeline_form(spark, clashing, empty, real):
    kept = quality_rules.keep_good(real)
    verdicts = {r["doc_id"]: r["kept"] for r in quality_rules.quality_verdicts(real).collect()}
    assert kept.columns == real.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, k in verdicts.items() if k)
    assert quality_rules.keep_good(clashing).columns == clashing.columns
    assert quality_rules.keep_good(clashing).count() == sum(r["kept"] for r in quality_rules.quality_verdicts(clashing).collect())
    assert quality_rules.keep_good(empty).collect() == [] and quality_rules.quality_verdicts(empty).collect() == []


def test_rules_follow_the_group(spark):
    """A group whose usual documents have many symbols keeps them, another one rejects them."""
    def doc(i, source, marks):
        return (i, " ".join([f"w{i}x{j}" for j in range(100)] + ["#"] * marks), "en", source, 1)
    rows = [doc(i, "code", 25 + i % 10) for i in range(300)] + [doc(1000 + i, "prose", 0) for i in range(300)]
    rows += [doc(2000, "code", 30), doc(2001, "prose", 30), doc(2002, "code", 400)]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.quality_verdicts(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[2000] and not got[2001] and not got[2002] and got[5] and got[1005]


def test_rules_move_with_the_ratios(spark):
    """The same texts are judged by what is usual where they stand: longer words around them move the fences."""
    def doc(i, source, length):
        return (i, " ".join([f"{j:03d}" + "x" * (length - 3 + i % 3) for j in range(200)]), "en", source, 1)
    rows = [doc(i, "short", 4) for i in range(150)] + [doc(1000 + i, "long", 14) for i in range(150)]
    rows += [doc(2000 + k, source, length) for k, (source, length) in enumerate([("short", 14), ("long", 14), ("short", 4), ("long", 4)])]
    frame = spark.createDataFrame(rows, DOCS)
    got = {r["doc_id"]: r["kept"] for r in quality_rules.quality_verdicts(frame).collect()}
    assert [got[2000 + k] for k in range(4)] == [False, True, True, False]
    counted = quality_rules.with_counts(frame.select("text", "lang", "source"))[0]
    limits = {r["source"]: r for r in quality_rules.fences(counted).collect()}
    assert limits["short"]["high_word_length"] < limits["long"]["low_word_length"]


def test_rules_leave_few_events_to_chance(spark):
    """Where all have none, one or two repeated lines or symbols in a text are within the noise, many are not."""
    def doc(i, repeats, marks):
        lines = [" ".join(f"w{i:03d}x{k}y{j:02d}" for j in range(12)) for k in range(8)]
        return (i, "\n".join(lines + ["one line again"] * (repeats + 1) + ["#"] * marks), "en", "a", 1)
    rows = [doc(i, 0, 0) for i in range(200)] + [doc(500, 2, 0), doc(501, 30, 0), doc(502, 0, 2), doc(503, 0, 40)]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.quality_verdicts(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(got[i] for i in range(200)) and [got[i] for i in range(500, 504)] == [True, False, True, False]


# 7 top-k

def test_top_k_blocks_and_repeats(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, [float(x) for x in rng.integers(-2, 3, 6)]) for i in range(120)] + [(50, [1.0] * 6), (50, [1.0] * 6)]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>").withColumn("w", F.lit(1))
    whole = sorted(tuple(r) for r in topk.top_k(df, k=3, every=10).collect())
    assert whole == sorted(tuple(r) for r in topk.top_k(df, k=3, every=10, query_block=3).collect())
    q = vectors[20][1]
    best = sorted(((-256 * 256 * int(sum(a * b for a, b in zip(q, v))), i) for i, v in vectors if i != 20))[:3]
    assert [(r[3], r[2]) for r in whole if r[0] == 20] == [(-s, i) for s, i in best]


# 8 Jaccard join

def brute_components(rows):
    sets = []
    for _, text, *_ in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((r[0], len(sets[i]), min(ids, default=None) if sets[i] else r[0]))
    return out


def copies(seed=1):
    rng = np.random.default_rng(seed)
    bank = [f"v{i}" for i in range(300)]
    base = [[str(rng.choice(bank)) for _ in range(n)] for n in (4, 5, 9, 30, 60, 60, 120, 120)]
    rows, i = [], 100
    for words in base:
        for edits in (0, 0, 1, 1, 2, 3, 4, 6, 8):
            w = list(words)
            for _ in range(edits):
                w[int(rng.integers(len(w)))] = str(rng.choice(bank))
            rows.append((i, " ".join(w), "en", "a", 1))
            i += 1
    shared = [str(rng.choice(bank)) for _ in range(40)]
    for _ in range(30):  # many documents with a long passage in common
        rows.append((i, " ".join(shared + [str(rng.choice(bank)) for _ in range(int(rng.integers(2, 30)))]), "en", "a", 1))
        i += 1
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed, monkeypatch):
    rows = copies(seed) + (HARD if seed == 1 else [])
    if seed == 2:
        monkeypatch.setattr(jaccard_join, "BLOCK", 3)
        monkeypatch.setattr(jaccard_join, "SIDE", 2)
        monkeypatch.setattr(jaccard_join, "BROADCAST_ROLES", 0)
    df = spark.createDataFrame(rows, DOCS).repartition(5).withColumns({"fp": F.lit(1), "n": F.lit(2), "s": F.lit(3)})
    key = lambda r: tuple((x is not None, x) for x in r)
    got = [tuple(r)[:3] for r in jaccard_join.jaccard_components(df).collect()]
    assert sorted(got, key=key) == sorted(brute_components(rows), key=key)
    kept = jaccard_join.keep_one(df)
    assert kept.columns == df.columns
    want = [i for i, n, c in brute_components(rows) if n == 0] + list({c for _, n, c in brute_components(rows) if n})
    assert sorted((r["doc_id"] for r in kept.collect()), key=lambda x: (x is not None, x)) == sorted(want, key=lambda x: (x is not None, x))


def test_components_empty(spark, empty):
    assert jaccard_join.jaccard_components(empty).collect() == [] and jaccard_join.keep_one(empty).collect() == []


def test_jaccard_texts_that_are_mostly_one_passage(spark, monkeypatch):
    """Sets that share 30 to 100 % with a passage of many texts: few of them link, all meet in the passage's lists."""
    rng = np.random.default_rng(8)
    passages = [" ".join(f"p{k}w{j}" for j in range(90)) for k in range(2)]
    rows = []
    for i in range(140):
        passage = passages[i % 2].split()
        start = int(rng.integers(0, 12))
        part = passage[start:start + int(rng.integers(50, 90))]
        own = [f"o{i if i % 5 else i // 10}x{j}" for j in range(int(rng.integers(0, 30)))]
        rows.append((i, " ".join(own[:len(own) // 2] + part + own[len(own) // 2:]), "en", "a", 1))
    df = spark.createDataFrame(rows, DOCS)
    want = sorted(brute_components(rows))
    assert len({c for _, _, c in want}) > 20
    for crowd, side in ((16, 512), (1, 5)):
        monkeypatch.setattr(jaccard_join, "CROWD", crowd)
        monkeypatch.setattr(jaccard_join, "SIDE", side)
        assert sorted(tuple(r)[:3] for r in jaccard_join.jaccard_components(df).collect()) == want


@given(st.lists(st.lists(st.integers(0, 30), min_size=1, max_size=25, unique=True), min_size=1, max_size=20),
       st.lists(st.integers(0, 30), min_size=4, max_size=25, unique=True))
@settings(max_examples=100, deadline=None)
def test_divide_skip(candidates, query):
    arrays = [np.unique(np.array(c, np.uint64)) for c in candidates]
    got = sorted(jaccard_join.divide_skip(np.unique(np.array(query, np.uint64)), arrays))
    want = [(i, len(set(c) & set(query))) for i, c in enumerate(candidates)
            if 5 * len(set(c) & set(query)) >= 4 * len(set(c) | set(query))]
    assert got == want


# 9 line field

def test_field_sums():
    rng = np.random.default_rng(2)
    counts, links = np.array([1, 3, 0, 5, 2]), rng.normal(size=(2, 2))
    good = rng.normal(size=counts.sum())
    chance, pairs, whole = line_crf.forward_backward(good, links, counts)
    at, want_chance, want_pairs, want_whole = 0, [], np.zeros((2, 2)), []
    for n in counts[counts > 0]:
        labels = [[(x >> i) & 1 for i in range(n)] for x in range(1 << n)]
        weight = np.exp([sum(good[at + i] * y[i] for i in range(n)) + sum(links[a, b] for a, b in zip(y, y[1:])) for y in labels])
        p = weight / weight.sum()
        want_chance += [sum(q * y[i] for q, y in zip(p, labels)) for i in range(n)]
        for q, y in zip(p, labels):
            for a, b in zip(y, y[1:]):
                want_pairs[a, b] += q
        want_whole.append(np.log(weight.sum()))
        at += n
    assert np.allclose(chance, want_chance) and np.allclose(pairs, want_pairs) and np.allclose(whole, want_whole)


def test_quality_scores(spark, real, clashing, empty):
    larger = SF.replace("0.001", "0.01")  # some hundred labels to learn from
    labels = spark.read.parquet(f"{larger}/labels.parquet")
    met = line_crf.quality_scores(spark.read.parquet(f"{larger}/documents.parquet"), labels).join(labels, "doc_id")
    met = met.where("held_out").collect()
    assert len(met) > 100 and sum(r["predicted"] == r["quality"] for r in met) >= 0.95 * len(met)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = line_crf.quality_scores(real, labels)
    fold = {r["doc_id"]: r["held_out"] for r in scored.collect()}
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in fold.items())
    hard = line_crf.quality_scores(clashing, labels.withColumn("extra", F.lit(1))).collect()
    assert len(hard) == len(HARD) and all(0 <= r["score"] <= 1 for r in hard)
    assert [r["score"] for r in hard if r["doc_id"] in (1, 2, 3)] == [0, 0, 0]
    assert line_crf.quality_scores(empty, labels).collect() == []
    assert line_crf.quality_scores(real, labels.limit(0)).count() == real.count()
    kept = line_crf.keep_accepted(real, labels)
    assert kept.columns == real.columns and kept.count() == scored.where("predicted = 1").count()
    assert line_crf.keep_accepted(clashing, labels).columns == clashing.columns
