"""Texts in short chunks, all at once in numpy: windows over long texts, code points, and a memory of chunks.

Tokenizers cut a text into chunks that they encode alone, and most chunks come again. Here a pass over
about a megabyte of text finds its chunks' bounds and looks all of them up at once; Python runs for
chunks that the memory lacks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import CHUNK_BYTES, mix, text_chunks

#: Longest chunk in bytes whose memory key holds it exactly.
KEY_BYTES = 15
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _cuts(buf: np.ndarray, limit: int, breaks: bytes) -> list[int]:
    """Bounds of a long text's windows: before one of `breaks` behind an ASCII letter or digit."""
    stop = np.zeros(256, bool)
    stop[list(breaks)] = True
    out, at = [0], 0
    while len(buf) - at > limit:
        reach, cut = limit, 0
        while not cut and at + reach < len(buf):
            part = buf[at : at + reach]
            plain = ((part >= 48) & (part < 58)) | ((part | 32) >= 97) & ((part | 32) < 123)
            places = np.flatnonzero(plain[:-1] & stop[part[1:]])
            cut = int(places[-1]) + 1 if len(places) else 0
            reach *= 2
        if not cut:
            break
        at += cut
        out.append(at)
    return [*out, len(buf)]


def text_windows(texts: pa.Array, lead: bytes = b"", limit: int = CHUNK_BYTES, breaks: bytes = b" \n") -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row of each window, its place in the text, whether it is the text's last, bytes, offsets of the windows), about `limit` bytes in a pass.

    Texts are one window each, but long ones fall into several, each a pass of its own. Nulls are empty; `lead` goes before
    every text that is not empty. Chunks must begin at each of `breaks` behind a letter or digit.
    """
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if lead:
        led = pc.binary_join_element_wise(pa.scalar(lead, pa.large_binary()), texts, pa.scalar(b"", pa.large_binary()))
        texts = pc.if_else(pc.greater(pc.binary_length(texts), 0), led, texts)
    for lo, hi, buf, offs in text_chunks(texts, limit=limit):
        if hi - lo == 1 and len(buf) > limit:
            cuts = _cuts(buf, limit, breaks)
            for a, b in zip(cuts[:-1], cuts[1:]):
                yield np.array([lo]), np.array([a]), np.array([b == len(buf)]), buf[a:b], np.array([0, b - a])
        else:
            yield np.arange(lo, hi), np.zeros(hi - lo, np.int64), np.ones(hi - lo, bool), buf, offs


def code_points(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place and code point of every character of UTF-8 bytes."""
    at = np.flatnonzero((buf & 0xC0) != 0x80)
    cp = buf[at].astype(np.int32)
    many = np.flatnonzero(cp >= 0xC0)
    if len(many):
        padded = np.concatenate([buf, np.zeros(3, np.uint8)])
        p, first = at[many], cp[many]
        b1, b2, b3 = (padded[p + k].astype(np.int32) & 0x3F for k in (1, 2, 3))
        two, three = (first & 0x1F) << 6 | b1, (first & 0x0F) << 12 | b1 << 6 | b2
        cp[many] = np.where(first < 0xE0, two, np.where(first < 0xF0, three, (first & 0x07) << 18 | b1 << 12 | b2 << 6 | b3))
    return at, cp


class CodeTable:
    """A value for every code point: a table for the first 65,536, the others are asked for when they come."""

    def __init__(self, value, dtype):
        self.value, self.low = value, np.fromiter((value(chr(i)) for i in range(1 << 16)), dtype, 1 << 16)

    @classmethod
    def of_classes(cls, patterns: list[str]) -> CodeTable:
        """Number of the first pattern that a character matches, len(patterns) for none."""
        found = [re.compile(p) for p in patterns]
        return cls(lambda c: next((i for i, f in enumerate(found) if f.match(c)), len(found)), np.uint8)

    def __getitem__(self, cp: np.ndarray) -> np.ndarray:
        out = self.low[np.minimum(cp, 0xFFFF)]
        high = np.flatnonzero(cp > 0xFFFF)
        if len(high):
            some, which = np.unique(cp[high], return_inverse=True)
            out[high] = np.array([self.value(chr(c)) for c in some], self.low.dtype)[which]
        return out


def chunk_keys(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers that hold a chunk of at most KEY_BYTES bytes and its size exactly."""
    padded = np.concatenate([buf, np.zeros(16, np.uint8)])
    words = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
    k1 = words[start] & _MASKS[np.minimum(size, 8)]
    k2 = (words[start + 8] & _MASKS[np.clip(size - 8, 0, 7)]) | (np.minimum(size, 255).astype(np.uint64) << np.uint64(56))
    return k1, k2


class KeyTable:
    """Open hash table from pairs of 64-bit numbers to numbers of at least 0, whole arrays at once."""

    def __init__(self, bits: int):
        self.bits, self.held = bits, 0
        self.k1, self.k2 = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64)
        self.value = np.full(1 << bits, -1, np.int32)

    def _slots(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        return (mix(k1 * _GOLD ^ k2) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """Value of each pair, -1 where there is none."""
        at = self._slots(k1, k2)
        out = self.value[at]
        wrong = np.flatnonzero((out >= 0) & ((self.k1[at] != k1) | (self.k2[at] != k2)))
        at = at[wrong]
        while len(wrong):
            at = (at + 1) & ((1 << self.bits) - 1)
            v = self.value[at]
            out[wrong] = v
            on = (v >= 0) & ((self.k1[at] != k1[wrong]) | (self.k2[at] != k2[wrong]))
            wrong, at = wrong[on], at[on]
        return out

    def add(self, k1: np.ndarray, k2: np.ndarray, values: np.ndarray) -> None:
        """Different pairs that the table lacks, as many as fit beside free places."""
        room = max(0, (3 << self.bits >> 2) - self.held)
        k1, k2, values = k1[:room], k2[:room], values[:room]
        self.held += len(k1)
        at = self._slots(k1, k2)
        while len(at):
            free = self.value[at] < 0
            self.value[at[free]] = values[free]  # of several at one slot the last stays
            mine = free & (self.value[at] == values)
            self.k1[at[mine]], self.k2[at[mine]] = k1[mine], k2[mine]
            k1, k2, values, at = k1[~mine], k2[~mine], values[~mine], (at[~mine] + 1) & ((1 << self.bits) - 1)


def first_of_each(k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of one representative of each different pair, and for each pair the number of its representative."""
    by = np.lexsort((k2, k1))
    new = np.ones(len(by), bool)
    new[1:] = (k1[by][1:] != k1[by][:-1]) | (k2[by][1:] != k2[by][:-1])
    which = np.empty(len(by), np.int64)
    which[by] = np.cumsum(new) - 1
    return by[new], which


class Lists:
    """Growing lists of numbers in one flat array."""

    def __init__(self):
        self.flat, self.start, self.size = np.zeros(1 << 16, np.int32), np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int32)
        self.used, self.n = 0, 0

    def extend(self, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Numbers of the new lists."""
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.n + len(sizes) > len(self.start):
            self.start, self.size = np.concatenate([self.start, np.zeros_like(self.start)]), np.concatenate([self.size, np.zeros_like(self.size)])
        new = np.arange(self.n, self.n + len(sizes))
        self.flat[self.used : self.used + len(flat)] = flat
        self.size[new] = sizes
        self.start[new] = self.used + np.cumsum(sizes) - sizes
        self.used, self.n = self.used + len(flat), self.n + len(sizes)
        return new
