"""Byte-level encoding of whole texts by the tokenizers library, with each distinct piece encoded once.

The vocabulary's pattern starts a new piece before every single space that stands between two other visible
characters, and no merge crosses pieces. So a text may be cut there, and the ids of the cuts joined. Texts
with other white space next to a space, or with the text of a special token, go to the library whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Pieces, words and other parts kept per Python worker; when full, only those of the texts at hand stay.
MOST_PIECES = 800_000

#: Pieces longer than this many characters are encoded each time and not kept.
LONG_PIECE = 64


#: Letters with marks after them, at the end of a text or before a line feed: the pattern cuts these at the ends of both.
_LETTERS, _MARKS = "[A-Za-zÀ-ÖØ-öø-ÿ]+", r"[!-&(-/:-@\[-`{-~]*"
_EVERY_LETTER = "".join(c for c in map(chr, range(0x100)) if re.fullmatch(_LETTERS, c))
_EVERY_MARK = "".join(c for c in map(chr, range(0x80)) if re.fullmatch(_MARKS, c))

_TEXT, _IDS = pa.large_string(), pa.large_binary()


def default_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


class Kept:
    """Texts and their ids as Arrow arrays, found by hash."""

    def __init__(self):
        self.texts, self.ids = pa.array([], _TEXT), pa.array([], _IDS)

    def find(self, texts: pa.Array, learn: Callable[[pa.Array], pa.Array]) -> pa.Array:
        """The ids of texts; `learn` gives those of the unknown ones, each once, of which long ones are not kept."""
        at = pc.fill_null(pc.index_in(texts, value_set=self.texts), -1).to_numpy().astype(np.int64)
        unknown = at < 0
        coded = texts.filter(pa.array(unknown)).dictionary_encode()
        new = coded.dictionary
        ids = learn(new)
        known = at[~unknown]
        at[unknown] = len(self.texts) + coded.indices.to_numpy()
        found = pa.concat_arrays([self.ids, ids]).take(pa.array(at))
        if len(self.texts) > MOST_PIECES:
            here = pa.array(np.unique(known))
            self.texts, self.ids = self.texts.take(here), self.ids.take(here)
        short = pc.less_equal(pc.utf8_length(new), LONG_PIECE)
        self.texts = pa.concat_arrays([self.texts, new.filter(short)])
        self.ids = pa.concat_arrays([self.ids, ids.filter(short)])
        return found


def _spread(ids: pa.Array, mask: pa.Array) -> pa.Array:
    """The ids at the places where `mask` is true, in order, and null elsewhere."""
    mask = mask.to_numpy(zero_copy_only=False)
    return ids.take(pa.array(np.cumsum(mask) - 1, pa.int64(), mask=~mask))


class Encoder:
    """Encodes texts to arrays of ids; keeps the ids of the pieces it has met, up to a bound.

    A kept piece stands without the space before it. Pieces that begin or end with white space have null for ids: no
    text that holds one may be cut.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.pieces, self.words, self.begins = Kept(), Kept(), Kept()
        self.parts: dict[str, bytes] = {}
        shown = [" ", "\n", *[chr(c) for c in range(0xC0, 0x100)]]
        self.merges = Tokenizer(self.tokenizer.model)
        self.bytes_of = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in shown}
        self.letters_of = {chr(c): written for c, written in self.bytes_of.items() if c != ord("\n")}
        vocabulary = self.tokenizer.get_vocab()
        self.length = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.length[list(vocabulary.values())] = [len(t) for t in vocabulary]

    def whole(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers, by the library alone."""
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def part(self, text: str) -> bytes:
        """The ids of what the pattern leaves in one part; the library's merges alone."""
        ids = self.parts.get(text)
        if ids is None:
            ids = array("I", [t.id for t in self.tokenizer.model.tokenize(text.translate(self.bytes_of))]).tobytes()
            if len(text) <= LONG_PIECE:
                self.parts[text] = ids
        return ids

    def shown(self, lines: str) -> str:
        """Lines of letters and spaces as the vocabulary writes their bytes. The letter Ã stands first: it alone is
        also part of what others are written as."""
        for c in sorted(set(lines).intersection(self.letters_of), key=lambda c: c != "Ã"):
            lines = lines.replace(c, self.letters_of[c])
        return lines

    def learn_words(self, words: pa.Array, before: str = " ") -> pa.Array:
        """The ids of words of letters, each with `before` in front; the library's merges alone, in one call."""
        if not len(words):
            return pa.array([], _IDS)
        text = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), pa.scalar("\n" + before, _TEXT))[0].as_py()
        shown = self.shown(before + text).split("\n")
        found = self.merges.encode_batch_fast([shown], is_pretokenized=True, add_special_tokens=False)[0]
        # The fast call does not tell which word an id belongs to; the lengths of the tokens do.
        ids = np.array(found.ids, "<u4")
        reached, ends = np.cumsum(self.length[ids]), np.cumsum([len(w) for w in shown])
        last = np.minimum(np.searchsorted(reached, ends), len(ids) - 1)
        if not np.array_equal(reached[last], ends):  # a byte that the vocabulary does not hold
            return pa.array([self.part(before + w) for w in words.to_pylist()], _IDS)
        bounds = np.concatenate([[0], 4 * (last + 1)]).astype(np.int64)
        return pa.Array.from_buffers(_IDS, len(shown), [None, pa.py_buffer(bounds), pa.py_buffer(ids)])

    def plain(self, texts: pa.Array, kept: Kept, before: str) -> pa.Array:
        """The ids of letters with marks after them and `before` in front, null for other texts."""
        letters = pc.ascii_rtrim(texts, _EVERY_MARK)
        plain = pc.match_substring_regex(letters, rf"\A{_LETTERS}\z")
        marks = pc.utf8_ltrim(texts.filter(plain), _EVERY_LETTER).dictionary_encode()
        first = kept.find(letters.filter(plain), lambda new: self.learn_words(new, before))
        second = pa.array([self.part(m) if m else b"" for m in marks.dictionary.to_pylist()], _IDS).take(marks.indices)
        return _spread(pc.binary_join_element_wise(first, second, pa.scalar(b"", _IDS)), plain)

    def learn(self, pieces: pa.Array) -> pa.Array:
        """The ids of pieces that stand after a space, null for those that begin or end with white space."""
        if len(self.parts) > MOST_PIECES:
            self.parts = {}
        lines = pc.split_pattern(pieces, "\n", max_splits=1)
        two = pc.equal(pc.list_value_length(lines), 2)
        ids = self.plain(pc.list_element(lines, 0), self.words, " ")
        second = self.plain(pc.list_element(lines.filter(two), 1), self.begins, "")
        both = pc.binary_join_element_wise(ids.filter(two), pa.scalar(self.part("\n"), _IDS), second, pa.scalar(b"", _IDS))
        ids = pc.if_else(two, _spread(both, two), ids)
        others = np.flatnonzero(ids.is_null().to_numpy(zero_copy_only=False))
        texts = pieces.take(pa.array(others)).to_pylist()
        cut = [bool(t) and not t[0].isspace() and not t[-1].isspace() for t in texts]
        alone = iter(self.whole([" " + t for t, c in zip(texts, cut) if c]))
        found = np.zeros(len(ids), bool)
        found[others] = True
        return pc.if_else(pa.array(found), _spread(pa.array([next(alone) if c else None for c in cut], _IDS), pa.array(found)), ids)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; null and empty texts have none."""
        special = self.special
        cuts = pc.split_pattern(pa.array([t if t and not (special and special.search(t)) else None for t in texts],
                                         _TEXT), " ")
        pieces, ends = cuts.flatten(), np.cumsum(pc.fill_null(pc.list_value_length(cuts), 0).to_numpy())
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
        cut = np.flatnonzero(ends > starts)
        after = np.ones(len(pieces), bool)
        after[starts[cut]] = False
        # The ids of pieces after the first of their text; `bounds` are those of the cut texts among them.
        joined = self.pieces.find(pieces.filter(pa.array(after)), self.learn)
        bounds = np.concatenate([[0], np.cumsum((ends - starts)[cut] - 1)]).astype(np.int64)
        n_barred = np.concatenate([[0], np.cumsum(joined.is_null().to_numpy(zero_copy_only=False))])
        at = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset:][bounds].tolist() if len(joined) else [0] * len(bounds)
        data = memoryview(joined.buffers()[2]) if len(joined) and joined.buffers()[2] else memoryview(b"")
        # First pieces, and texts that must stay whole, go to the library as they are.
        alone, rest = [t for t in texts if t], {}
        nth = np.cumsum([bool(t) for t in texts]) - 1
        for i, row, first in zip(range(len(cut)), cut.tolist(), pieces.take(pa.array(starts[cut])).to_pylist()):
            if first and not first[0].isspace() and not first[-1].isspace() and n_barred[bounds[i]] == n_barred[bounds[i + 1]]:
                alone[nth[row]] = first
                rest[row] = data[at[i]:at[i + 1]]
        firsts = iter(self.whole(alone))
        out = [b"".join((next(firsts), rest.get(row, b""))) if t else b"" for row, t in enumerate(texts)]
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
