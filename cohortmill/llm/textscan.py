"""Words of whole batches in numpy: runs of letters, numbers and marks of any script, in lower case."""

from __future__ import annotations

import functools
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .pretok import mixed, slice_hashes


@functools.cache
def word_bytes() -> np.ndarray:
    """Of ASCII only."""
    table = np.zeros(256, bool)
    for a, b in ("09", "az", "AZ"):
        table[ord(a) : ord(b) + 1] = True
    return table


@functools.cache
def word_codepoints() -> np.ndarray:
    return np.array([unicodedata.category(chr(cp))[0] in "LNM" for cp in range(0x110000)])


def in_words(data: np.ndarray) -> np.ndarray:
    """Whether each byte of UTF-8 belongs to a word; all bytes of a character do or none."""
    inside = word_bytes()[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        first = data[lead].astype(np.int32)
        more = 1 + (first >= 0xE0) + (first >= 0xF0)
        cp = first & (0x3F >> more)
        for k in (1, 2, 3):
            long = more >= k
            cp[long] = cp[long] << 6 | data[lead[long] + k] & 0x3F
        word = word_codepoints()[cp]
        for k in range(4):
            inside[lead[more >= k] + k] = word[more >= k]
    return inside


@dataclass(frozen=True)
class Words:
    """hashes of all words; of[i]: the first word of text i, with the total at the end; data and at: the bytes and where texts begin."""

    hashes: np.ndarray
    of: np.ndarray
    data: np.ndarray
    at: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.of) - 1), np.diff(self.of))


def scan(texts: pa.Array) -> Words:
    """Nulls count as empty texts."""
    texts = pc.utf8_lower(pc.fill_null(texts, "")).cast(pa.large_string())
    n = len(texts)
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), np.zeros(n + 1, np.int64), data, at, none, none)
    inside = in_words(data)
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    before = np.r_[False, inside[:-1]]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~np.r_[inside[1:], False] | edge[1:])) + 1
    return Words(slice_hashes(data, starts, ends), np.searchsorted(starts, at), data, at, starts, ends)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash) of every run of `size` words; a shorter text with any words is one shingle."""
    counts = np.diff(words.of)
    n = len(words.hashes)
    doc = words.doc()
    h = np.zeros(n, np.uint64)
    last = np.arange(n) - words.of[doc] + size > counts[doc]  # fewer than `size` words from here
    for k in range(size):
        factor = np.uint64((0xD6E8FEB86659FD93 * (2 * k + 1)) & (2**64 - 1))
        part = np.zeros(n, np.uint64)
        if n > k:
            part[: n - k] = words.hashes[k:]
        if k:
            part[np.arange(n) - words.of[doc] + k >= counts[doc]] = 0
        h += part * factor
    keep = ~last | ((counts[doc] < size) & (np.arange(n) == words.of[doc]))
    return doc[keep], mixed(h[keep])
