"""Cutting texts into the pieces that byte-level BPE encodes one by one, a batch at a time.

A batch's texts lie in one buffer of bytes. The places where pieces begin are found for all of them at once,
from the kind of every character and of the one before it, so the pieces are an Arrow array over the same
buffer. Each distinct piece of a batch is looked up once, and only unknown ones are encoded.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Fixed value: the pattern of byte-level pre-tokenizers.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LETTER, NUMBER, OTHER, SPACE = 1, 2, 3, 4
#: Bytes that are cut at once, pieces that are remembered, and the longest of these in code points.
PART_BYTES, MOST_PIECES, LONGEST = 4_000_000, 200_000, 64


@cache
def _kinds() -> np.ndarray:
    """The kind of every code point, as the pattern sees it."""
    out = np.full(0x110000, OTHER, np.uint8)
    for begin, end in ((0, 0xD800), (0xE000, 0x110000)):
        every = "".join(map(chr, range(begin, end)))
        for kind, of in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for found in regex.finditer(of, every):
                out[begin + found.start() : begin + found.end()] = kind
    return out


def _kinds_of(data: np.ndarray) -> np.ndarray:
    """The kind of the character that each byte of UTF-8 belongs to."""
    kinds = _kinds()
    out = kinds[:256][data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        first = data[lead].astype(np.int32)
        more = 1 + (first >= 0xE0) + (first >= 0xF0)
        point = first & (0x3F >> more)
        for k in range(1, 4):
            has = more >= k
            point[has] = point[has] << 6 | data[lead[has] + k] & 0x3F
        kind = kinds[point]
        for k in range(4):
            has = more >= k
            out[lead[has] + k] = kind[has]
    return out


def piece_begins(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where the matches of BYTE_LEVEL begin in the bytes of texts that begin at the places `texts` (from 0, ascending).

    A piece begins where the kind of character changes. One blank goes with what follows it; of a longer run of
    white space the last character is a piece by itself, or that blank. An apostrophe that begins a piece
    and one of the short endings behind it are a piece.
    """
    n = len(data)
    kind = _kinds_of(data)
    first = np.zeros(n + 3, bool)
    first[texts] = True
    first[n:] = True
    begin = np.empty(n, bool)
    begin[0] = True
    np.not_equal(kind[1:], kind[:-1], out=begin[1:])
    begin |= first[:n]
    space = kind == SPACE
    last = space[:-1] & ~space[1:] & ~first[1:n]  # white space with something else behind it
    begin[:-1] |= last
    begin[1:] &= ~(last & (data[:-1] == 0x20))
    for at in np.flatnonzero(last & (data[:-1] >= 0x80)).tolist():  # the last byte of a character of several
        begin[at] = False
        while data[at] & 0xC0 == 0x80:
            at -= 1
        begin[at] = True
    quote = np.flatnonzero(data == 0x27)
    quote = quote[begin[quote]]
    if len(quote):
        padded = np.concatenate([data[-3:], np.zeros(2, np.uint8)])

        def at(k):
            place = quote + k
            return np.where(first[place], 0, np.where(place < n, data[np.minimum(place, n - 1)], padded[-1]))

        one, two = at(1), at(2)
        size = np.where(np.isin(one, list(b"stmd")), 2, 0)
        for pair in (b"re", b"ve", b"ll"):
            size = np.where((one == pair[0]) & (two == pair[1]), 3, size)
        quote, size = quote[size > 0], size[size > 0]
        begin[quote + 1] = False
        ends = quote + size
        begin[ends[ends < n]] = True
    return np.flatnonzero(begin)


def _part_end(data: np.ndarray, begin: int, ends: np.ndarray, most: int) -> int:
    """Where a part that begins there ends: with a text, or in a long one before a blank between two letters or digits."""
    n = len(data)
    if n - begin <= most:
        return n
    k = int(np.searchsorted(ends, begin + most, side="right")) - 1
    if k >= 0 and ends[k] > begin:
        return int(ends[k])
    text_end = int(ends[k + 1])
    for low in range(begin, text_end, most):
        near = data[low : min(low + most, text_end)]
        plain = ((near | 0x20) >= 0x61) & ((near | 0x20) <= 0x7A) | (near >= 0x30) & (near <= 0x39)
        found = np.flatnonzero((near[1:-1] == 0x20) & plain[:-2] & plain[2:])
        if len(found):
            return low + int(found[-1]) + 1
    return text_end


class PieceEncoder:
    """Encodes texts by their pieces. encode_pieces gives the ids of a list of pieces in one array, and how many each has."""

    def __init__(self, encode_pieces: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], pattern: str = BYTE_LEVEL, most: int = MOST_PIECES, part_bytes: int = PART_BYTES):
        self.encode_pieces, self.pattern, self.most, self.part_bytes = encode_pieces, pattern, most, part_bytes
        self.number: dict[str, int] = {}
        self.ids, self.begins, self.sizes, self.seen = np.empty(0, np.uint32), np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.int32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of an array of texts, null ones empty, and the place where each text's ids end."""
        if not len(texts):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        base = int(ends[0])
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[base : int(ends[-1])]
        ends = ends[1:] - base
        found, ended, before = [np.empty(0, np.uint32)], np.zeros(len(ends), np.int64), 0
        cutting = self._cut if self.pattern == BYTE_LEVEL else self._match
        for pieces, begin, end, upto in cutting(data, ends, texts):
            ids, sizes = self._of(pieces)
            found.append(ids)
            inside = (ends > begin) & (ends <= end)
            total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            ended[inside] = before + total[upto[inside]]
            before += len(ids)
            # texts that are empty end where the one before them does
        place = np.maximum.accumulate(ended) if len(ended) else ended
        return np.concatenate(found), place

    def _cut(self, data, ends, texts):
        """(pieces, begin, end, number of pieces up to the end of each text) of the parts of the bytes."""
        begin = 0
        while begin < len(data):
            end = _part_end(data, begin, ends, self.part_bytes)
            part = np.ascontiguousarray(data[begin:end])
            starts = np.unique(ends[(ends > begin) & (ends < end)]) - begin
            places = piece_begins(part, starts)
            offsets = np.append(places, len(part)).astype(np.int32 if len(part) < 2**31 else np.int64)
            kind = pa.StringArray if offsets.dtype == np.int32 else pa.LargeStringArray
            yield kind.from_buffers(len(places), pa.py_buffer(offsets), pa.py_buffer(part)), begin, end, np.searchsorted(places, ends - begin)
            begin = end

    def _match(self, data, ends, texts):
        find = regex.compile(self.pattern).findall
        begin = 0
        for k, text in enumerate(texts.to_pylist()):
            if text:
                pieces = pa.array(find(text), pa.string())
                yield pieces, begin, int(ends[k]), np.full(len(ends), len(pieces))
                begin = int(ends[k])

    def _of(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, and how many each of them has."""
        coded = pieces.dictionary_encode()
        codes = coded.indices.to_numpy()
        distinct = coded.dictionary.to_pylist()
        numbers = np.fromiter(map(self.number.get, distinct, repeat(-1)), np.int64, len(distinct))
        unknown = np.flatnonzero(numbers < 0)
        if len(unknown):
            numbers[unknown] = self._learn([distinct[k] for k in unknown.tolist()])
        self.seen[numbers] += np.bincount(codes, minlength=len(distinct))
        sizes = self.sizes[numbers][codes]
        upto = np.cumsum(sizes, dtype=np.int32)
        places = np.repeat(self.begins[numbers][codes] - upto + sizes, sizes)
        places += np.arange(len(places), dtype=np.int32)
        ids = self.ids[places]
        if len(self.number) > self.most:
            self._forget()
        return ids, sizes

    def _learn(self, unknown: list[str]) -> np.ndarray:
        """Encodes pieces and gives their numbers."""
        ids, sizes = self.encode_pieces(unknown)
        sizes = sizes.astype(np.int32, copy=False)
        numbers = np.arange(len(self.sizes), len(self.sizes) + len(unknown))
        self.begins = np.concatenate([self.begins, len(self.ids) + np.cumsum(sizes, dtype=np.int32) - sizes])
        self.ids, self.sizes = np.concatenate([self.ids, ids.astype(np.uint32, copy=False)]), np.concatenate([self.sizes, sizes])
        self.seen = np.concatenate([self.seen, np.zeros(len(sizes), np.int32)])
        self.number.update(zip(unknown, numbers.tolist()))
        return numbers

    def _forget(self) -> None:
        """Keeps the pieces that were seen most often since the last time, half as many as may be, and none that is long."""
        half = self.most // 2
        least = max(2, int(np.partition(self.seen, -half)[-half])) if half and len(self.seen) > half else 2
        kept = [(x, k) for x, k in self.number.items() if self.seen[k] >= least and len(x) <= LONGEST][:half]
        old = np.array([k for _, k in kept], np.int64)
        sizes = self.sizes[old]
        begins = np.cumsum(sizes, dtype=np.int32) - sizes
        self.ids = self.ids[np.repeat(self.begins[old] - begins, sizes) + np.arange(int(sizes.sum()))]
        self.begins, self.sizes, self.seen = begins, sizes, np.zeros(len(old), np.int32)
        self.number = {x: k for k, (x, _) in enumerate(kept)}


def parts_of(batch: pa.RecordBatch, column: int):
    """The batch in slices of rows whose texts have about PART_BYTES together, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        end = max(int(np.searchsorted(upto, upto[begin] - sizes[begin] + PART_BYTES, side="right")), begin + 1)
        yield batch.slice(begin, end - begin)
        begin = end


#: glibc's way to return what was freed; None with another C library.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Returns free memory to the system: workers live on and count as their executor's memory."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)
