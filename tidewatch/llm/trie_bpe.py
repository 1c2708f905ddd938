"""BPE encoding of a word vocabulary by a trie with shared prefixes, and decoding.

The distinct pieces of a slice of documents are put in a trie. Walking it depth first, each node gets one number: the
last token of the encoding of the path to it. That is enough, for an encoding is unique and any cut of it is
again an encoding: the last token t of a path is the one token that ends the path, leaves a shorter path whose
own last token p is known, and stands next to p unmerged (the merges applied to p and t together give p, t).
So a prefix shared by many pieces is worked out once, and a piece's ids are read by following last tokens
backwards. The end of a piece changes its last symbol, which is an edge of its own out of the same prefix.

Normalisation and the cutting of words into pieces are the library's; they run once per distinct word.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewatch.llm.common import chunks_of, free_name

#: Words kept per Python worker; when full, only those of the slice at hand stay.
MOST_WORDS = 400_000

#: Pairs of tokens whose merging is remembered per Python worker.
MOST_PAIRS = 500_000

#: Words longer than this many characters are not kept.
LONG_WORD = 64

#: Bytes of text encoded at a time in a Python worker.
CHUNK_BYTES = 4 << 20

#: Words of letters that have one form only, and punctuation after them, need no library to be cut into pieces.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


def default_vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


class Merges:
    """The vocabulary's tokens, as strings of symbols, and which neighbours stay apart."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.names = {i: t for t, i in self.ids.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {(a, b): r for r, (a, b) in enumerate(pairs)}
        made: dict[str, int] = {}  # the last merge that makes a token
        for (a, b), r in self.rank.items():
            made[a + b] = max(r, made.get(a + b, -1))
        #: Whether every merge comes after all that make its two parts, as in vocabularies grown merge by merge.
        self.grown = all(made.get(a, -1) < r > made.get(b, -1) for (a, b), r in self.rank.items())
        self.halves: dict[str, tuple[str, str, int]] = {}  # whole token -> the two parts it is made of, rank of that merge
        #: All ends of tokens.
        self.tails = {t[i:] for t in self.ids for i in range(len(t))}
        self.apart: dict[tuple[str, str], bool] = {}
        self.whole: dict[str, bool] = {}
        self.packed = {t: i.to_bytes(4, "little") for t, i in self.ids.items()}

    def symbols(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end) and token != self.end:
            body = token[:-len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def merged(self, symbols: list[str]) -> list[str]:
        """The merges applied to a short run of symbols: lowest rank first, leftmost first."""
        rank = self.rank
        while len(symbols) > 1:
            best = min(((rank.get(pair, 1 << 30), i) for i, pair in enumerate(zip(symbols, symbols[1:]))))
            if best[0] == 1 << 30:
                break
            i = best[1]
            symbols = [*symbols[:i], symbols[i] + symbols[i + 1], *symbols[i + 2:]]
        return symbols

    def is_whole(self, token: str) -> bool:
        """Whether the token is in the vocabulary and the encoding of its own symbols."""
        known = self.whole[token] = token in self.ids and self.merged(self.symbols(token)) == [token]
        return known

    def half(self, token: str) -> tuple[str, str, int]:
        """The two parts that the last merge of a whole token joins, and its rank; a symbol has rank -1."""
        symbols = self.symbols(token)
        found = (token, token, -1)
        for cut in range(1, len(symbols)):
            left, right = "".join(symbols[:cut]), "".join(symbols[cut:])
            rank = self.rank.get((left, right))
            if rank is not None and all(self.whole.get(t) or self.is_whole(t) for t in (left, right)) and self.side_by_side(left, right, rank):
                found = (left, right, rank)
                break
        self.halves[token] = found
        return found

    def side_by_side(self, left: str, right: str, limit: int) -> bool:
        """Whether no merge before `limit` joins the end of the whole token `left` with the beginning of `right`.

        The merges are undone from the last on: at any time one part ends at the cut and one begins there, and a
        merge joins them if it comes before both go into larger parts. Of equal merges the left one is first.
        """
        rank, halves = self.rank, self.halves
        left_until, right_until = limit, limit - 1
        while True:
            meet = rank.get((left, right))
            if meet is not None and meet < left_until and meet <= right_until:
                return False
            a, b = halves.get(left) or self.half(left), halves.get(right) or self.half(right)
            if a[2] > b[2]:
                left_until, left = a[2], a[1]
            elif b[2] >= 0:
                right_until, right = b[2], b[0]
            else:
                return True

    def stay_apart(self, left: str, right: str) -> bool:
        """Whether the merges applied to two whole tokens side by side give the two tokens."""
        if len(self.apart) > MOST_PAIRS:
            self.apart.clear()
        if self.grown:
            known = self.side_by_side(left, right, len(self.rank) + 1)
        else:
            known = self.merged([*self.symbols(left), *self.symbols(right)]) == [left, right]
        self.apart[left, right] = known
        return known


class PrefixTrie:
    """Distinct pieces as a trie; `encode` walks it depth first."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[str]] = [[]]

    def insert(self, piece: str) -> None:
        """`piece` without its last symbol is a path of inner nodes; the ended last symbol hangs on it."""
        node, children = 0, self.children
        for symbol in piece[:-1]:
            below = children[node].get(symbol)
            if below is None:
                below = children[node][symbol] = len(children)
                children.append({})
                self.ends.append([])
            node = below
        self.ends[node].append(piece[-1])

    def _last(self, path: str, depth: int, states: list[str], ended: str) -> str:
        """The last token of `path`, whose last symbol carries the text `ended` after it. `states[d]` is the last
        token of the first d symbols."""
        merges = self.merges
        ids, tails, whole, apart = merges.ids, merges.tails, merges.whole, merges.apart
        for start in range(depth - 1, -1, -1):  # one token only fits, so the order is free
            token = path[start:] + ended
            if token not in tails:
                break
            if token not in ids:
                continue
            known = whole.get(token)
            if not (merges.is_whole(token) if known is None else known):
                continue
            if not start:
                return token
            known = apart.get((states[start], token))
            if merges.stay_apart(states[start], token) if known is None else known:
                return token
        raise ValueError(f"no token for {path[-1]!r}")

    def encode(self) -> dict[str, list[str]]:
        """The tokens of every inserted piece."""
        out: dict[str, list[str]] = {}
        states = [""]
        stack = [(0, "", 0)]
        while stack:
            node, path, depth = stack.pop()
            del states[max(depth, 1):]
            if depth:
                states.append(self._last(path, depth, states, ""))
            for symbol in self.ends[node]:
                piece = path + symbol
                tokens = [self._last(piece, depth + 1, states, self.merges.end)]
                left = depth + 1 - len(tokens[0]) + len(self.merges.end)
                while left:
                    tokens.append(states[left])
                    left -= len(states[left])
                out[piece] = tokens[::-1]
            for symbol, below in self.children[node].items():
                stack.append((below, path + symbol, depth + 1))
        return out


class WordEncoder:
    """Texts to ids and decoded texts, as the library gives them; each new word passes the trie once."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = Merges(path)
        special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special_ids = special
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        if self.tokenizer.decoder is not None:
            raise ValueError("tokens are decoded by joining them with a space; this vocabulary has a decoder of its own")
        self.packed: dict[str, bytes] = {}  # word -> ids
        names = self.merges.names | {i: t for t, i in special.items()}
        self.names = pa.array([names.get(i, "") for i in range(max(names, default=-1) + 1)], pa.string())  # id -> token
        letters = [chr(c) for c in range(0xC0, 0x100)]
        self.bytes_of = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters if c.isalpha()}

    def pieces(self, word: str) -> list[str]:
        plain = _PLAIN.fullmatch(word)
        if plain:
            letters, marks = plain.groups()
            letters = letters.lower()
            if not letters.isascii():
                letters = letters.translate(self.bytes_of)
            return [letters, marks] if marks else [letters]
        normal = self.tokenizer.normalizer.normalize_str(word)
        return [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal) if p]

    def learn(self, words: set[str]) -> None:
        gc.disable()  # many small objects that hold no cycles
        try:
            cut = {w: self.pieces(w) for w in words}
            trie = PrefixTrie(self.merges)
            for piece in {p for pieces in cut.values() for p in pieces}:
                trie.insert(piece)
            tokens, packed = trie.encode(), self.merges.packed
            for word, pieces in cut.items():
                self.packed[word] = b"".join([packed[t] for p in pieces for t in tokens[p]])
        finally:
            gc.enable()

    def forget(self) -> None:
        self.packed = {}
        self.merges.apart, self.merges.whole = {}, {}

    def split(self, text: str) -> list[str]:
        """Special tokens and, between them, runs without space or line feed (no piece holds either)."""
        if self.special is None or not self.special.search(text):
            return [w for w in text.replace("\n", " ").split(" ") if w]
        out = []
        for i, part in enumerate(self.special.split(text)):
            out += [part] if i % 2 else [w for w in part.replace("\n", " ").split(" ") if w]
        return out

    def decode(self, found: list[bytes]) -> pa.StringArray:
        """The texts of packed ids: tokens joined by a space, as this vocabulary (decoder null) decodes."""
        ends = np.cumsum([0, *[len(ids) // 4 for ids in found]])
        tokens = self.names.take(pa.array(np.frombuffer(b"".join(found), "<u4")))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tokens), " ")

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cuts = [self.split(t) if t else [] for t in texts]
        here = {w for cut in cuts for w in cut}
        new = here.difference(self.packed)
        if len(self.packed) > MOST_WORDS:
            self.packed = {w: self.packed[w] for w in here.difference(new)}
        self.learn({w for w in new if w not in self.special_ids})
        for token, i in self.special_ids.items():
            self.packed[token] = i.to_bytes(4, "little")
        packed = self.packed
        found = [b"".join([packed[w] for w in cut]) for cut in cuts]
        for word in [w for w in new if len(w) > LONG_WORD]:
            del packed[word]
        return found

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, str]]:
        """(ids, text decoded from them) of each text."""
        found = self.encode_all(texts)
        return list(zip(found, self.decode(found).to_pylist()))


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def encode_documents(docs: DataFrame, text: str = "text", path: str | None = None,
                     ids: bool = False, digests: bool = True, keep_words: bool = True) -> DataFrame:
    """The rows of `docs` with `n_tokens` and, as asked, `ids` (array) and `ids_sha256`, `decoded_sha256`.

    Null and empty texts have no ids, and the digests of nothing. Each row stands for itself, so ties and
    repeated rows have no effect; an empty table gives no rows. Added columns that `docs` has already
    get underscores appended. `keep_words` leaves a Python worker its words for the next task; without it the memory
    is free for what the worker does next.
    """
    path = path or default_vocabulary()
    names = ["n_tokens", *(["ids"] if ids else []), *(["ids_sha256", "decoded_sha256"] if digests else [])]
    kinds = {"n_tokens": "bigint", "ids": "array<int>", "ids_sha256": "string", "decoded_sha256": "string"}
    names = {n: free_name(docs, n) for n in names}
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
                       + [f"`{names[n]}` {kinds[n]}" for n in names])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = word_encoder(path)
        for part in chunks_of(batches, text, CHUNK_BYTES):
            found = worker.encode_all(part.column(text).to_pylist())
            columns = [pa.array([len(i) // 4 for i in found], pa.int64())]
            if ids:
                columns.append(pa.array([np.frombuffer(i, "<u4").astype(np.int32) for i in found], pa.list_(pa.int32())))
            if digests:
                columns.append(pa.array([hashlib.sha256(i).hexdigest() for i in found], pa.string()))
                columns.append(pa.array([hashlib.sha256(t.as_buffer()).hexdigest() for t in worker.decode(found)], pa.string()))
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], [*part.schema.names, *names.values()])
        if not keep_words:
            worker.forget()

    return docs.mapInArrow(encode, schema)


def decode_documents(rows: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """`rows` with `decoded`: the text of an array of ids, tokens joined by a space as this vocabulary decodes."""
    path = path or default_vocabulary()
    out = free_name(rows, "decoded")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields] + [f"`{out}` string"])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_encoder(path).tokenizer
        for batch in batches:
            texts = [tokenizer.decode(i or [], skip_special_tokens=False) for i in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out])

    return rows.mapInArrow(decode, schema)
