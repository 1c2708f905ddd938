"""The main text of web pages, with host-wide suffix arrays over what the markup leaves open.

A page is cut into blocks. Its markup settles most of them: blocks inside a declared article are the text, blocks
inside menus, headers, footers and the like are not. Blocks outside both are open. The words of all blocks, those of
articles in streams of their own, are concatenated to one token stream per slice of pages, a suffix array of it (prefix
doubling up to the run length) brings equal runs together, and the distinct pages of each run are counted; pages of a
host with the same blocks are one page there, whatever their urls. Outside articles, counts of the slices are added up
per host and run, so a host may have any number of pages. Runs on several pages of a host are
boilerplate: an open block mostly covered by them is removed, at the edges of its container; what stands between unique
blocks stays.

Passages of articles repeat by right, so inside one a run is boilerplate only if several, and most, articles of the host
hold it: a notice that lost its markup, not a quotation, or a title that lists repeat. Articles of the same text are one.
A run in most articles of a host is in most of those of some slice, so only such runs of a slice are counted over all.
Blocks shorter than a run stay as declared, and so do articles that would lose all their text, or most of it to runs that
stand in articles only: these are versions of one article.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser
from typing import NamedTuple
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import chunks_of
from tidewatch.runtime import broadcast_counted, materialize

#: Words of a run (a power of two), and the distinct pages of a host that make it boilerplate.
RUN = 8
MIN_PAGES = 3

CHUNK_BYTES = 8 << 20

# Element names of HTML by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s
    samp small span strike strong sub sup time tt u var wbr""".split())
UNSEEN = set("""script style template noscript head title iframe object svg math canvas audio video select option textarea
    button datalist map""".split())
FURNITURE = set("nav header footer aside form dialog menu fieldset".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Elements that belong to the section around them, as do cells of tables without blocks of their own.
FLOW = INLINE | HEADINGS | set("p li dt dd blockquote pre figure figcaption".split())
TABLE = set("table caption thead tbody tfoot tr td th".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert toolbar menu menubar".split())
MAIN_NAMES = set("""article-body article-content article-text article__body articlebody post-body post-content post-text entry-content
    entry-text story-body story-content main-content maincontent page-content body-content content-body""".split())
#: Words in a class or id that name furniture.
HINTS = set("""ad ads adv advert adverts advertisement advertising adsense banner banners sponsor sponsored promo promotion sidebar
    menu nav navbar navigation breadcrumb breadcrumbs header footer masthead comment comments commentlist reply replies
    respond disqus cookie cookies consent gdpr notice notices newsletter subscribe subscription signup share sharing social
    related recommended popup modal overlay widget widgets pagination pager paging skip toolbar login copyright legal
    disclaimer tagcloud byline-share""".split())
_NAME = re.compile(r"[^a-z0-9]+|(?<=[a-z0-9])(?=[A-Z])")

ARTICLE, MAIN, NAMED, OPEN, OUT = 3, 2, 1, 0, -1


#: Words of names that only say what kind of box an element is, or whose; besides them a hint stands for the whole name.
BOX_WORDS = set("""area article articles banner bar block blocks body bottom box button buttons column container content entry
    footer form group head header heading icon icons inline inner item items left line link links list main module outer page
    panel post posts region right row section site slot stories story text title tools top unit wrap wrapper""".split())
COMMENT_WORDS = set("comment comments commentlist reply replies respond disqus".split())
HEADER_WORDS = set("header masthead banner banners".split())
#: Elements that end where the next one starts do so within the nearest of these.
BLOCK = set("div article main section body table ul ol nav aside header footer form blockquote".split())
_TEXT = {"p"} | HEADINGS
_ITEM_STOP = {"ul", "ol", "dl", "table"} | (BLOCK - {"form"})
_TEXT_STOP = BLOCK | {"li", "td", "th", "dd"}
_FLOW_STOP = {"article", "main", "body", "td", "th"}

OTHER, COMMENT, HEADER = range(3)


def hinted(names: str, inside: bool = False) -> int | None:
    """What furniture a class or id names (OTHER, COMMENT or HEADER), or None. "has-sidebar" and the like speak of the page,
    not of the element. Inside a declared text ("inside") a name made of several words must say nothing else: "share-price"
    is no share button."""
    kinds = set()
    for name in names.split():
        low = name.lower()
        if low.startswith(("has-", "no-", "with-")):
            continue
        words = {w.lower() for w in _NAME.split(name) if w}
        hints = HINTS & (words | {low})
        if inside and low not in HINTS and not all(w in HINTS or w in BOX_WORDS or w.isdigit() for w in words):
            continue
        if hints:
            kinds.add(COMMENT if hints & COMMENT_WORDS else HEADER if hints <= HEADER_WORDS else OTHER)
    if not kinds:
        return None
    return COMMENT if COMMENT in kinds else OTHER if OTHER in kinds else HEADER


class Element(NamedTuple):
    """An open element. Everything that its content inherits is worked out when it opens, so that no tag looks
    at all elements around it."""

    tag: str = ""
    declared: int = OPEN  # what the markup declares the content to be
    out: int = 0  # 1: in a header element only; 2: in other furniture
    unseen: bool = False
    mark: int = -1  # the innermost box with a name of furniture
    section: int = 0  # the container of text in here
    around: int = -1  # the container around the table
    in_cell: bool = False
    in_main: bool = False


class Mark(NamedTuple):
    """A box with a name of furniture, or a form: out, unless it turns out to be a wrapper of the page's text."""

    parent: int
    comment: bool  # in reader comments
    title: int  # the mark that a heading in here belongs to


class Block(NamedTuple):
    declared: int
    out: bool
    mark: int
    in_main: bool
    in_h1: bool
    container: int
    text: str


class PageReader(HTMLParser):
    """Cuts a page into blocks (level, container, text), in page order. Takes time linear in the page, however deep."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[Block] = []
        self.stack: list[Element] = [Element()]
        self.open_at: defaultdict[str, list[int]] = defaultdict(list)  # element -> where it is open
        self.marks: list[Mark] = []
        self.first: dict[str, int] = {}  # article, main, h1 -> the mark that the page's first one is in
        self.buffer: list[str] = []
        self.containers = 0

    def _flush(self) -> None:
        text = " ".join("".join(self.buffer).split())
        self.buffer = []
        here = self.stack[-1]
        if text and not here.unseen:
            container = here.around if here.in_cell else here.section
            self.found.append(Block(here.declared, here.out > 0, here.mark, here.in_main, bool(self.open_at["h1"]), container, text))

    def _close_to(self, names: Iterable[str], stop: Iterable[str]) -> None:
        """Closes the innermost of the named elements, unless one to stop at is open within it."""
        at = self.open_at
        found = max((at[n][-1] for n in names if n in at and at[n]), default=-1)
        if found >= 0 and all(at[n][-1] <= found for n in stop if n in at and at[n]):
            for element in self.stack[found:]:
                at[element.tag].pop()
            del self.stack[found:]

    def _mark(self, parent: int, kind: int, inside: bool) -> int:
        above = self.marks[parent] if parent >= 0 else Mark(-1, False, -1)
        number = len(self.marks)
        self.marks.append(Mark(parent, above.comment or kind == COMMENT, above.title if kind == HEADER and inside else number))
        return number

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.buffer.append(" ")
            return
        inline = tag in INLINE
        if not inline:
            self._flush()
        if tag in VOID:
            return
        if tag not in UNSEEN and tag != "html" and self.open_at["head"]:
            self._close_to(("head",), ())
        if tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            same = ("td", "th") if tag in ("td", "th") else ("dt", "dd") if tag in ("dt", "dd") else (tag,)
            self._close_to(same, _ITEM_STOP)
        elif not inline and tag not in UNSEEN:
            self._close_to(_TEXT, _TEXT_STOP)
        up = self.stack[-1]
        declared, out, mark, in_main = up.declared, up.out, up.mark, up.in_main
        unseen = up.unseen or tag in UNSEEN
        if tag in HEADINGS and declared > OPEN:  # a header inside a text holds its title; the rest of it is furniture
            out = 0 if out == 1 else out
            mark = self.marks[mark].title if mark >= 0 else mark
        names, roles, values = "", set(), {}
        if attrs:
            values = {k: v or "" for k, v in attrs}
            style = values.get("style", "").replace(" ", "").lower()
            names = f"{values.get('class', '')} {values.get('id', '')}"
            roles = set(values.get("role", "").lower().split())
            unseen = unseen or "hidden" in values or "display:none" in style or values.get("aria-hidden") == "true"
        if tag not in ("html", "body") and out != 2:
            form = tag == "form" or "form" in roles
            if tag == "header":
                out = 1 if out or not roles & ROLES - {"banner"} else 2
            elif tag in FURNITURE - {"form"} or roles & ROLES - {"form"}:
                out = 2
            if not out:
                kind = OTHER if form else hinted(names, declared > OPEN) if attrs else None
                if kind is not None:
                    mark = self._mark(mark, kind, declared > OPEN)
                if tag == "article":
                    declared = ARTICLE
                elif tag == "main" or "main" in roles:
                    declared, in_main = max(declared, MAIN), True
                elif "articlebody" in values.get("itemprop", "").lower() or MAIN_NAMES & set(names.lower().split()):
                    declared = max(declared, NAMED)
                if tag in ("article", "main", "h1") and not unseen and (mark < 0 or not self.marks[mark].comment):
                    self.first.setdefault(tag, mark)
        self.containers += 1
        section = up.section if tag in FLOW else self.containers
        in_cell = up.in_cell if inline else tag in ("td", "th", "caption")
        around = up.around if inline else -1
        if tag in TABLE:
            around = up.section if tag == "table" or up.around < 0 else up.around
        self.open_at[tag].append(len(self.stack))
        self.stack.append(Element(tag, declared, out, unseen, mark, section, around, in_cell, in_main))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            if tag == "br":
                self.buffer.append(" ")
            return
        if tag not in INLINE:
            self._flush()
        self._close_to((tag,), _FLOW_STOP - {tag} if tag in INLINE or tag in ("p", "li") else ())

    def handle_data(self, data: str) -> None:
        self.buffer.append(data)

    def _marks_out(self) -> list[bool]:
        """Which marks are furniture. A box is a wrapper, whatever its name, if it holds the page's first article (main
        element, or title, where there is none) and at least half of the words outside other furniture; comments never are."""
        first = next((self.first[t] for t in ("article", "main", "h1") if t in self.first), -1)
        holds = [False] * len(self.marks)
        while first >= 0:
            holds[first] = True
            first = self.marks[first].parent
        words, total = [0] * len(self.marks), 0
        for block in self.found:
            if not block.out:
                n = block.text.count(" ") + 1
                total += n
                if block.mark >= 0:
                    words[block.mark] += n
        for i in range(len(self.marks) - 1, -1, -1):  # a box opens after those around it
            if self.marks[i].parent >= 0:
                words[self.marks[i].parent] += words[i]
        out = []
        for i, mark in enumerate(self.marks):
            wrapper = holds[i] and not mark.comment and 2 * words[i] >= total
            out.append(not wrapper or (mark.parent >= 0 and out[mark.parent]))
        return out

    def read(self, html: str | None) -> list[tuple[int, int, str]]:
        if not html:
            return []
        self.feed(html)
        self.close()
        self._flush()
        marks_out = self._marks_out()
        levels = [OUT if b.out or (b.mark >= 0 and marks_out[b.mark]) else b.declared for b in self.found]
        # A main element with a title of its own, and more words than the untitled articles in it, is the text; they are cards.
        own = [i for i, b in enumerate(self.found) if levels[i] == MAIN and b.in_main]
        cards = [i for i, b in enumerate(self.found) if levels[i] == ARTICLE and b.in_main]
        size = lambda some: sum(self.found[i].text.count(" ") + 1 for i in some)
        if cards and any(self.found[i].in_h1 for i in own) and not any(self.found[i].in_h1 for i in cards) and size(own) > size(cards):
            levels = [min(level, NAMED) for level in levels]
            for i in [*own, *cards]:
                levels[i] = MAIN
        return [(level, b.container, b.text) for level, b in zip(levels, self.found)]


def settle(blocks: list[tuple[int, int, str]]) -> tuple[str | None, list[tuple[int, str]], list[str]]:
    """(declared text or None, blocks left to the runs (container, text): those of the declared text or the open ones,
    blocks of furniture)."""
    best = max((level for level, _, _ in blocks), default=OUT)
    if best > OPEN:
        inside = [(c, text) for level, c, text in blocks if level == best]
        return " ".join(text for _, text in inside), inside, [text for level, _, text in blocks if level != best]
    open_blocks = [(c, text) for level, c, text in blocks if level == OPEN]
    furniture = [text for level, _, text in blocks if level == OUT]
    return (None if open_blocks else ""), open_blocks, furniture


def run_codes(words: list[str]) -> list[int]:
    """A number for each run of a block: its RUN words, or all of them in a shorter block."""
    runs = max(1, len(words) - RUN + 1)
    return [xxhash.xxh64_intdigest("\x1f".join(words[i:i + RUN])) - (1 << 63) for i in range(runs)] if words else []


def suffix_runs(page_of: np.ndarray, host_of_page: np.ndarray, blocks: pa.Array, least: int = 1) -> tuple[np.ndarray, ...]:
    """(block, word, host, pages) of each run of a host in some blocks: where it stands first, and its distinct pages.
    `page_of` gives each block's page, in rising order. Blocks of fewer than `least` words are left out.

    One token stream of all words. Prefix doubling ranks all suffixes by their first RUN tokens, none beyond its block;
    in the order of ranks equal runs are neighbours.
    """
    words = pc.split_pattern(blocks, " ")
    edges = words.offsets.to_numpy().astype(np.int64)
    edges, tokens = edges - edges[0], words.flatten()
    sizes = np.diff(edges)
    at = np.arange(len(tokens))
    block_of = np.repeat(np.arange(len(sizes)), sizes)
    begin, end = edges[:-1][block_of], edges[1:][block_of]
    rank = tokens.dictionary_encode().indices.to_numpy().astype(np.int64) + 1
    step = 1
    while step < RUN:
        after = np.zeros(len(rank), dtype=np.int64)
        inside = at + step < end
        after[inside] = rank[at[inside] + step]
        _, rank = np.unique(rank * (len(rank) + 1) + after, return_inverse=True)
        rank += 1
        step *= 2
    suffixes = np.flatnonzero(((at + RUN <= end) | (at == begin)) & (end - begin >= least))
    if not len(suffixes):
        return (np.zeros(0, dtype=np.int64),) * 4
    pages = page_of[block_of[suffixes]]
    hosts = host_of_page[pages]
    key = rank[suffixes] * (host_of_page.max() + 1) + hosts
    order = np.argsort(key, kind="stable")  # the suffix array, by host; the pages of a run are in order
    key, pages = key[order], pages[order]
    new_run = np.concatenate([[True], key[1:] != key[:-1]])
    new_page = new_run | np.concatenate([[True], pages[1:] != pages[:-1]])
    heads = np.flatnonzero(new_run)
    counts = np.add.reduceat(new_page.astype(np.int64), heads)
    first = suffixes[order[heads]]
    return block_of[first], first - begin[first], hosts[order[heads]], counts


def _coded(blocks: pa.Array, block: np.ndarray, word: np.ndarray) -> list[int]:
    """The numbers of the runs that begin at these words of these blocks."""
    words = {b: blocks[b].as_py().split(" ") for b in set(block.tolist())}
    return [run_codes(words[b][i:i + RUN])[0] for b, i in zip(block.tolist(), word.tolist())]


def _numbered(hosts: list[str]) -> tuple[list[str], np.ndarray]:
    number: dict[str, int] = {}
    places = np.array([number.setdefault(h, len(number)) for h in hosts], dtype=np.int64)
    return list(number), places


def count_runs(pages: list[tuple[str, list[str]]]) -> list[tuple[str, int, int]]:
    """(host, run, pages) of some pages, given as (host, blocks)."""
    blocks = pa.array([text for _, texts in pages for text in texts], pa.string())
    if not len(blocks):
        return []
    names, hosts = _numbered([host for host, _ in pages])
    page_of = np.repeat(np.arange(len(pages)), [len(texts) for _, texts in pages])
    block, word, host, n = suffix_runs(page_of, hosts, blocks)
    return list(zip([names[h] for h in host.tolist()], _coded(blocks, block, word), n.tolist()))


def most_runs(hosts: list[str], blocks: pa.ListArray) -> list[tuple[str, int]]:
    """(host, run) of the runs that more than half of a host's pages hold, in blocks of at least RUN words."""
    names, host_of_page = _numbered(hosts)
    texts = blocks.flatten()
    page_of = np.repeat(np.arange(len(blocks)), pc.list_value_length(blocks).to_numpy(zero_copy_only=False))
    block, word, host, n = suffix_runs(page_of, host_of_page, texts, RUN)
    most = 2 * n > np.bincount(host_of_page, minlength=len(names))[host]
    return list(zip([names[h] for h in host[most].tolist()], _coded(texts, block[most], word[most])))


def slices_of(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """The batches cut and joined to slices of about `limit` bytes."""
    held, size = [], 0
    for batch in batches:
        rows = max(1, batch.num_rows * limit // max(batch.nbytes, 1))
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            if held and size + part.nbytes > limit:
                yield pa.concat_batches(held)
                held, size = [], 0
            held.append(part)
            size += part.nbytes
    if held:
        yield pa.concat_batches(held)


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def keep_unique(blocks: list[tuple[int, str]], covered: list[float]) -> str:
    """Open blocks without those mostly covered by repeated runs; within a container, what stands between two
    blocks that are not covered stays."""
    last: dict[int, int] = {}
    for i, (container, _) in enumerate(blocks):
        if covered[i] < 0.5:
            last[container] = i
    started: set[int] = set()
    out = []
    for i, (container, text) in enumerate(blocks):
        if covered[i] < 0.5:
            started.add(container)
        if container in started and i <= last[container]:
            out.append(text)
    return " ".join(out)


def without(blocks: list[tuple[int, str]], hits: Iterable[dict]) -> str:
    """The blocks without those mostly covered by the hit runs."""
    sizes = [len(text.split(" ")) for _, text in blocks]
    marks = [bytearray(n) for n in sizes]
    for hit in hits:
        stop = min(hit["start"] + RUN, sizes[hit["block"]])
        marks[hit["block"]][hit["start"]:stop] = b"\x01" * (stop - hit["start"])
    return keep_unique(blocks, [sum(m) / n for m, n in zip(marks, sizes)])


_PAGE = ("page_id bigint, url string, page bigint, row bigint, host string, declared boolean, "
         "blocks array<struct<container:int,text:string>>, content string, article string, outside string")


def read_pages(pages: DataFrame) -> DataFrame:
    """The pages with the blocks of their declared text, or their open ones; digests of all blocks and of the declared text
    (null if there is none), and the blocks outside articles, one a line."""
    names = [c.split(" ")[0] for c in _PAGE.split(", ")]
    blocks_type = pa.list_(pa.struct([("container", pa.int32()), ("text", pa.string())]))
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), blocks_type, *[pa.string()] * 3]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks_of(batches, "html", CHUNK_BYTES):
            rows = []
            for page_id, url, page, row, html in zip(*[part.column(c).to_pylist() for c in ("page_id", "url", "page", "row", "html")]):
                blocks = PageReader().read(html)
                text, left, furniture = settle(blocks)
                listed = [{"container": c, "text": t} for c, t in left]
                content = xxhash.xxh128_hexdigest("\n".join([t for _, _, t in blocks]))
                article = xxhash.xxh128_hexdigest("\n".join([t for _, t in left])) if text else None
                outside = furniture if text is not None else [*[t for _, t in left], *furniture]
                rows.append((page_id, url, page, row, host_of(url), text is not None, listed, content, article,
                             "\n".join(outside)))  # no block holds a line feed
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return pages.mapInArrow(read, _PAGE)


def page_runs(read: DataFrame) -> DataFrame:
    """(host, run, n_pages): in how many different pages of a host a run is. Pages with the same blocks count once."""
    one = read.where("outside != ''").groupBy("host", "content").agg(F.first("outside").alias("outside"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks_of(batches, "outside", CHUNK_BYTES):
            found = count_runs([(host, outside.split("\n")) for host, outside in
                                zip(part.column("host").to_pylist(), part.column("outside").to_pylist())])
            columns = list(zip(*found)) if found else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()))],
                                             ["host", "run", "n_pages"])

    counted = one.select("host", "outside").mapInArrow(count, "host string, run bigint, n_pages bigint")
    return counted.groupBy("host", "run").agg(F.sum("n_pages").alias("n_pages"))


def article_runs(articles: DataFrame) -> DataFrame:
    """(host, run): the runs of at least RUN words that most articles of a host hold in some slice of the articles."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices_of(batches, CHUNK_BYTES):
            found = most_runs(part.column("host").to_pylist(), part.column("texts"))
            columns = list(zip(*found)) if found else [[]] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64()))], ["host", "run"])

    return articles.select("host", F.col("blocks.text").alias("texts")).mapInArrow(count, "host string, run bigint").distinct()


def list_runs(pages: DataFrame, least: int = 1, digest: str = "content") -> DataFrame:
    """(page, host, the digest, block, start, run): all runs of the blocks of at least `least` words."""
    names = ["page", "host", digest, "block", "start", "run"]

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, blocks in enumerate(batch.column("blocks").to_pylist()):
                runs, block, start = [], [], []
                for b, x in enumerate(blocks):
                    words = x["text"].split(" ")
                    if len(words) >= least:
                        found = run_codes(words)
                        runs += found
                        block += [b] * len(found)
                        start += range(len(found))
                if runs:
                    same = pa.array(np.zeros(len(runs), np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [*[batch.column(c).slice(row, 1).take(same) for c in names[:3]],
                         pa.array(block, pa.int32()), pa.array(start, pa.int32()), pa.array(runs, pa.int64())], names)

    return pages.select("page", "host", digest, "blocks").mapInArrow(
        listed, f"page bigint, host string, {digest} string, block int, start int, run bigint")


def _keep(pages: DataFrame, hits: DataFrame, declared: bool) -> DataFrame:
    """(page_id, url, text): the blocks of the pages without those that the hit runs cover. A declared text that would lose most
    of its words to all hits only loses the blocks that hits which also stand outside articles cover, and one that would lose
    all of its blocks to those stays whole."""
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for blocks, hits in zip(batch.column("blocks").to_pylist(), batch.column("hits").to_pylist()):
                found = [(b["container"], b["text"]) for b in blocks]
                whole = " ".join(text for _, text in found)
                if not hits:
                    texts.append(whole)
                    continue
                kept = without(found, hits)
                if declared and 2 * len(kept.split()) < len(whole.split()):
                    kept = without(found, [hit for hit in hits if hit["outside"]]) or whole
                texts.append(kept)
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                                             ["page_id", "url", "text"])

    met = pages.join(hits, F.col("page") == F.col("hit_page"), "left").select("page_id", "url", "blocks", "hits")
    return met.mapInArrow(finish, "page_id bigint, url string, text string")


def _hits(runs: DataFrame) -> DataFrame:
    """(hit_page, hits) of runs that count as boilerplate: at most the words of one page each."""
    return runs.groupBy(F.col("page").alias("hit_page")).agg(F.collect_set(F.struct("block", "start", "outside")).alias("hits"))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
            min_pages: int = MIN_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars), one row per input row.

    Null and empty pages have the empty text. A null or unreadable url belongs to the host "". Rows of a host
    with the same blocks have a row each, and are one page where runs are counted. An empty table gives no rows.
    """
    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    rows = rows.withColumn("page", F.xxhash64("page_id", "url", "html")).withColumn("row", F.monotonically_increasing_id())
    read = materialize(read_pages(rows), "pages")
    articles, left = read.where("declared"), read.where("not declared")
    repeated = materialize(page_runs(read).where(F.col("n_pages") >= min_pages).select("host", "run"), "repeated-runs")

    # Rows alike in id, url and html are alike in all that follows, so one of them stands for all.
    one = left.select("page", "host", "content", "blocks").dropDuplicates(["page"])
    opened = _keep(left, _hits(list_runs(one).join(repeated, ["host", "run"]).withColumn("outside", F.lit(True))), False)

    # Suffix arrays go over each different article of a host once. Only their runs go on, and of these the ones that most
    # articles of the host hold.
    whole = articles.where("article is not null")
    first = materialize(whole.groupBy("host", "article").agg(F.min("row").alias("first"), F.count("*").alias("rows")), "first-articles")
    of_host = materialize(first.groupBy("host").agg(F.count("*").alias("articles")).where(F.col("articles") >= min_pages), "hosts")
    copies = whole.select("row", "host", "article").join(first.where("rows > 1"), ["host", "article"]).where("row != first")
    different = whole.join(broadcast_counted(materialize(copies.select("row"), "copies")), "row", "left_anti").join(
        broadcast_counted(of_host.select("host")), "host", "left_semi")
    candidates = materialize(article_runs(different), "article-runs")
    hosts = materialize(candidates.select("host").distinct(), "run-hosts")
    inside = materialize(list_runs(whole.join(broadcast_counted(hosts), "host", "left_semi"), RUN, "article").join(
        broadcast_counted(candidates), ["host", "run"]), "inside-runs")
    shared = inside.groupBy("host", "run").agg(F.count_distinct("article").alias("n")).where(F.col("n") >= min_pages)
    shared = shared.join(of_host, "host").where(2 * F.col("n") > F.col("articles")).select("host", "run")
    shared = shared.join(repeated.withColumn("outside", F.lit(True)), ["host", "run"], "left").fillna(False, ["outside"])
    hits = materialize(_hits(inside.join(shared, ["host", "run"])), "article-hits")
    stated = _keep(articles, broadcast_counted(hits, F.size("hits") * 3 + 2), True)
    return stated.unionByName(opened).withColumn("n_chars", F.char_length("text").cast("bigint"))
