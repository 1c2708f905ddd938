"""Words of many texts at once, as positions in one byte array, and their CRC-32 sums.

The texts of an Arrow column lie one after another in one buffer, each ended by a line feed, so words, lines and
n-grams are found by array operations over all of them.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words longer than this are summed one by one; shorter ones a byte position at a time, all words together.
LONG_WORD = 48


def byte_table(*parts: bytes | range) -> np.ndarray:
    """A mark for each of the 256 bytes: those in one of `parts`."""
    marks = np.zeros(256, dtype=bool)
    for part in parts:
        marks[list(part)] = True
    return marks


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _crc_table() -> np.ndarray:
    rows = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        rows = np.where(rows & 1, (rows >> 1) ^ np.uint32(0xEDB88320), rows >> 1)
    return rows


_CRC = _crc_table()


@dataclass
class Texts:
    """Lower-cased (A-Z) bytes of some texts, each ended by a line feed; text i ends before `ends[i]`."""

    data: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, column: pa.Array, lower: bool = True) -> Texts:
        """The texts of a string column; null is the empty text."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        nothing, stop = (pa.scalar(x, pa.large_binary()) for x in (b"", b"\n"))
        joined = pc.binary_join_element_wise(pc.fill_null(column.cast(pa.large_binary()), b""), nothing, stop)
        if len(joined) == 0:
            return cls(np.zeros(0, np.uint8), np.zeros(0, np.int64))
        ends = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset:joined.offset + len(joined) + 1]
        data = np.frombuffer(joined.buffers()[2], np.uint8)[ends[0]:ends[-1]]
        return cls(_LOWER[data] if lower else data, ends[1:] - ends[0])

    def spans(self, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, lengths) of the maximal runs of bytes marked by `in_word`, which must not mark the line feed."""
        inside = np.concatenate([[False], in_word[self.data], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        return edges[::2], edges[1::2] - edges[::2]

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        """The number of the text in which each position lies."""
        return np.searchsorted(self.ends, positions, side="right")


def take_runs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.LargeBinaryArray:
    """The runs as an Arrow array of bytes; they must be in order and apart, as `spans` gives them."""
    change = np.zeros(len(data) + 1, dtype=np.int8)
    change[starts] += 1
    change[starts + lengths] -= 1
    packed = data[np.cumsum(change[:-1], dtype=np.int8).view(bool)] if len(starts) else data[:0]
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(packed)])


def number_words(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, pa.LargeBinaryArray]:
    """(number of each word, the distinct words): equal words have equal numbers, 0 up in order of appearance."""
    coded = pc.dictionary_encode(take_runs(data, starts, lengths))
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def crc_values(values: pa.LargeBinaryArray, prefixes: tuple[int, ...] = ()) -> list[np.ndarray]:
    """`crc_words` of the values of an Arrow array."""
    if not len(values):
        return [np.zeros(0, np.uint32) for _ in (0, *prefixes)]
    ends = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
    return crc_words(np.frombuffer(values.buffers()[2], np.uint8), ends[:-1], np.diff(ends), prefixes)


def crc_words(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, prefixes: tuple[int, ...] = ()) -> list[np.ndarray]:
    """CRC-32 of every word, then for each k of `prefixes` that of its first k bytes (0 for shorter words)."""
    order = np.argsort(-np.minimum(lengths, LONG_WORD + 1), kind="stable")
    first, size = starts[order], lengths[order]
    state = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
    found = [np.zeros(len(order), dtype=np.uint32) for _ in prefixes]
    for k in range(min(int(size.max(initial=0)), LONG_WORD)):
        running = np.searchsorted(-np.minimum(size, LONG_WORD + 1), -k, side="left")  # words with more than k bytes
        part = state[:running]
        state[:running] = _CRC[(part ^ data[first[:running] + k]) & 0xFF] ^ (part >> np.uint32(8))
        for place, wanted in enumerate(prefixes):
            if wanted == k + 1:
                found[place][order[:running]] = state[:running] ^ np.uint32(0xFFFFFFFF)
    whole = np.empty(len(order), dtype=np.uint32)
    whole[order] = state ^ np.uint32(0xFFFFFFFF)
    for at in order[:np.searchsorted(-size, -LONG_WORD, side="left")] if len(size) and size[0] > LONG_WORD else []:
        whole[at] = zlib.crc32(data[starts[at]:starts[at] + lengths[at]].tobytes())
    return [whole, *found]


def _append_zero(state: np.ndarray) -> np.ndarray:
    return _CRC[state & np.uint32(0xFF)] ^ (state >> np.uint32(8))


#: A CRC followed by n more bytes is the CRC moved by n, combined with that of the bytes. Moving is linear in the bits,
#: so it is read from four tables, one for each byte of the sum: _MOVE[n] up to NEAR, then by powers of two.
NEAR = 64


def _move_tables() -> tuple[np.ndarray, list[np.ndarray]]:
    alone = np.arange(256, dtype=np.uint32)[None, :] << np.arange(0, 32, 8, dtype=np.uint32)[:, None]
    near = [alone]
    for _ in range(NEAR):
        near.append(_append_zero(near[-1]))
    far = [near[NEAR]]
    for _ in range(34):
        far.append(_look_up(far[-1][None], np.zeros(far[-1].shape, np.int64), far[-1]))
    return np.array(near), far


def _look_up(tables: np.ndarray, which: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = tables[which, 0, crc & np.uint32(0xFF)]
    for place in (1, 2, 3):
        out = out ^ tables[which, place, (crc >> np.uint32(8 * place)) & np.uint32(0xFF)]
    return out


_MOVE, _FAR = _move_tables()


def crc_moved(crc: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Each CRC as it counts when `by` more bytes follow."""
    out = _look_up(_MOVE, by % NEAR, crc)
    beyond = by // NEAR
    for power, moved in enumerate(_FAR):
        some = np.flatnonzero((beyond >> power) & 1)
        if len(some):
            out[some] = _look_up(moved[None], np.zeros(len(some), np.int64), out[some])
        elif not (beyond >> power).any():
            break
    return out


def crc_joined(left: np.ndarray, right: np.ndarray, right_length: np.ndarray) -> np.ndarray:
    """CRC-32 of left, a space, and right, from the CRC-32 of both and the length of the right one."""
    space = np.full(len(right), zlib.crc32(b" "), dtype=np.uint32)
    return crc_moved(left, right_length + 1) ^ crc_moved(space, right_length) ^ right
