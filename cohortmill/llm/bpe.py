"""Byte-pair encoding of batches: distinct slices are merged once, all at a time, and kept; texts are gathered from them."""

from __future__ import annotations

import base64
import functools
import heapq
import json
import re
import unicodedata

import numpy as np

from .pretok import codepoints, narrowed, ragged, slice_hashes, token_starts

NONE = np.int64(2**31 - 1)
LONG, KEPT = 64, 1 << 20


class Pairs:
    """Merge rules in an open-addressed table: (left id, right id) to (rank, id)."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, new: np.ndarray):
        self.bits = max(10, int(4 * max(1, len(left))).bit_length())
        self.keys, self.rows = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64)
        self.rank, self.new = np.append(rank, NONE).astype(np.int64), np.append(new, -1).astype(np.int64)
        key = self.key(left, right)
        slot, todo = self.slot(key), np.arange(len(key))
        while len(todo):
            free = todo[self.keys[slot[todo]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]], self.rows[slot[put]] = key[put], put
            todo = todo[self.keys[slot[todo]] != key[todo]]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    @staticmethod
    def key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.int64) << 20 | right.astype(np.int64)

    def slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rule of each pair; the last row of rank and new stands for none."""
        key = self.key(left, right)
        slot = self.slot(key)
        seen = self.keys[slot]
        out = np.where(seen == key, self.rows[slot], len(self.rank) - 1)
        todo = np.flatnonzero((seen != key) & (seen >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            seen = self.keys[slot[todo]]
            hit = seen == key[todo]
            out[todo[hit]] = self.rows[slot[todo[hit]]]
            todo = todo[~hit & (seen >= 0)]
        return out


def merged_long(ids: list[int], pairs: Pairs) -> list[int]:
    """One long slice: a heap of pairs over a linked list."""
    n = len(ids)
    after, before, gone = [*range(1, n), -1], [-1, *range(n - 1)], [False] * n
    heap: list = []

    def offer(lefts: list[int]) -> None:
        rows = pairs.find(np.array([ids[i] for i in lefts]), np.array([ids[after[i]] for i in lefts]))
        for i, row, rank in zip(lefts, rows.tolist(), pairs.rank[rows].tolist()):
            if rank != NONE:
                heapq.heappush(heap, (rank, i, ids[i], ids[after[i]], int(pairs.new[row])))

    offer(list(range(n - 1)))
    while heap:
        _, i, a, b, new = heapq.heappop(heap)
        j = after[i]
        if gone[i] or j < 0 or ids[i] != a or ids[j] != b:
            continue
        ids[i], gone[j], after[i] = new, True, after[j]
        if after[j] >= 0:
            before[after[j]] = i
        near = [x for x in (before[i], i) if x >= 0 and after[x] >= 0]
        if near:
            offer(near)
    return [x for x, g in zip(ids, gone) if not g]


def merged(ids: np.ndarray, lengths: np.ndarray, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """Merges all slices side by side: in each round every slice merges its leftmost pair of least rank."""
    word = np.repeat(np.arange(len(lengths)), lengths)
    done_ids, done_words = [], []
    if (lengths > LONG).any():
        at = np.cumsum(lengths) - lengths
        for k in np.flatnonzero(lengths > LONG):
            own = merged_long(ids[at[k] : at[k] + lengths[k]].tolist(), pairs)
            done_ids.append(np.array(own, np.int64))
            done_words.append(np.full(len(own), k))
        keep = lengths[word] <= LONG
        ids, word = ids[keep], word[keep]
    ids = ids.astype(np.int64)
    row = np.full(len(ids), len(pairs.rank) - 1)
    if len(ids) > 1:
        row[:-1] = pairs.find(ids[:-1], ids[1:])
        row[:-1][word[:-1] != word[1:]] = len(pairs.rank) - 1
    while len(ids):
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        place = pairs.rank[row] << 32 | np.arange(len(ids))
        best = np.minimum.reduceat(place, starts)
        open_ = best >> 32 != NONE
        if not open_.all():
            sizes = np.diff(np.r_[starts, len(ids)])
            stay = np.repeat(open_, sizes)
            done_ids.append(ids[~stay])
            done_words.append(word[~stay])
            moved = np.cumsum(stay) - 1
            best = moved[best[open_] & 0xFFFFFFFF]
            ids, word, row = ids[stay], word[stay], row[stay]
        else:
            best = best & 0xFFFFFFFF
        if not len(ids):
            break
        ids[best] = pairs.new[row[best]]
        keep = np.ones(len(ids), bool)
        keep[best + 1] = False
        at = (np.cumsum(keep) - 1)[best]
        ids, word, row = ids[keep], word[keep], row[keep]
        for i in (at, at - 1):
            i = i[(i >= 0) & (i < len(ids))]
            right = np.minimum(i + 1, len(ids) - 1)
            found = pairs.find(ids[i], ids[right])
            found[(word[i] != word[right]) | (right == i)] = len(pairs.rank) - 1
            row[i] = found
    if not done_ids:
        return np.zeros(0, np.int64), np.zeros(len(lengths), np.int64)
    ids, word = np.concatenate(done_ids), np.concatenate(done_words)
    order = np.argsort(word, kind="stable")
    return ids[order], np.bincount(word, minlength=len(lengths))


class Encoder:
    """Encodes batches of texts. Slices that were merged before are taken from a bounded store."""

    def __init__(self, pairs: Pairs, spaces_join: bool):
        self.pairs, self.spaces_join, self.seed = pairs, spaces_join, 0
        self.forget()

    def forget(self) -> None:
        self.slots: dict[int, int] = {}
        self.store, self.starts, self.lengths, self.used = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0

    def prepared(self, texts: list[str]) -> list[str]:
        return texts

    def first_ids(self, cp: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the slices' bytes before any merge, and how many each slice has. cp: the slices' codepoints."""
        wide = 1 + (cp > 0x7F) + (cp > 0x7FF) + (cp > 0xFFFF)
        data = np.frombuffer(cp.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
        total = np.r_[0, np.cumsum(wide)]
        at = np.r_[0, np.cumsum(lengths)]
        return self.symbols(data, total[at]), total[at[1:]] - total[at[:-1]]

    def symbols(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def _add(self, hashes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        n, have = len(hashes), len(self.slots)
        while have + n > len(self.starts):
            self.starts, self.lengths = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lengths, 2 * len(self.lengths))
        while self.used + len(ids) > len(self.store):
            self.store = np.resize(self.store, 2 * len(self.store))
        self.store[self.used : self.used + len(ids)] = ids
        self.starts[have : have + n], self.lengths[have : have + n] = self.used + np.cumsum(counts) - counts, counts
        self.used += len(ids)
        self.slots.update(zip(hashes.tolist(), range(have, have + n)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's begin and the last end."""
        import pandas as pd

        cp, at = codepoints(self.prepared(texts))
        begin, kind = token_starts(cp, at, self.spaces_join)
        end = np.r_[begin[1:], len(cp)] if len(begin) else begin
        if not self.spaces_join:
            words = kind[begin] < 3
            begin, end = begin[words], end[words]
        if not len(begin):
            return np.zeros(0, np.int32), np.zeros(len(at), np.int64)
        code, distinct = pd.factorize(slice_hashes(narrowed(cp), begin, end, self.seed))
        if len(self.slots) > KEPT:
            self.forget()
        get = self.slots.get
        slot = np.array([get(h, -1) for h in distinct.tolist()], np.int64)
        new = np.flatnonzero(slot < 0)
        if len(new):
            first = np.empty(len(distinct), np.int64)
            first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
            where = first[new]
            size = end[where] - begin[where]
            symbols, counts = self.first_ids(cp[ragged(begin[where], size)], size)
            slot[new] = len(self.slots) + np.arange(len(new))
            self._add(distinct[new], *merged(symbols, counts, self.pairs))
        slot = slot[code]
        counts = self.lengths[slot]
        ids = self.store[ragged(self.starts[slot], counts)]
        total = np.r_[0, np.cumsum(counts)]
        return ids, total[np.searchsorted(begin, at)]


class ByteEncoder(Encoder):
    """From a rank file: a pair merges if its bytes together have a rank, which is also their id."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.size = max(ranks.values()) + 1
        rules = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        left, right, rank = np.array(rules, np.int64).T
        super().__init__(Pairs(left, right, rank, rank), True)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        words = [b""] * self.size
        for t, r in ranks.items():
            words[r] = t
        self.word_lengths = np.array([len(w) for w in words], np.int64)
        self.word_starts, self.word_bytes = np.cumsum(self.word_lengths) - self.word_lengths, np.frombuffer(b"".join(words), np.uint8)

    def symbols(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.byte_ids[data]

    def decode(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, and where each text's bytes begin and the last end."""
        size = self.word_lengths[ids]
        return self.word_bytes[ragged(self.word_starts[ids], size)], np.r_[0, np.cumsum(size)][at]


class WordEncoder(Encoder):
    """From a tokenizer file whose model marks the ends of words; texts are composed and lower-cased, white space is dropped.

    The file's added tokens, written out in a text, become their ids before anything else happens, as in the library.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        model, added = whole["model"], whole.get("added_tokens") or []
        if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens that take in what stands around them")
        self.added = {t["content"]: t["id"] for t in added}
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None
        vocab, mark = model["vocab"], model["end_of_word_suffix"]
        rules = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right, new = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in rules], np.int64).T
        super().__init__(Pairs(left, right, np.arange(len(rules)), new), False)
        shown = shown_bytes()
        self.inner = np.array([vocab[c] for c in shown], np.int64)
        self.final = np.array([vocab[c + mark] for c in shown], np.int64)

    def prepared(self, texts: list[str]) -> list[str]:
        return [_lower(unicodedata.normalize("NFC", t)) for t in texts]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.marks is None or not any(map(self.marks.search, texts)):
            return super().encode(texts)
        parts = [self.marks.split(t) for t in texts]  # every second part is an added token
        ids, at = super().encode([p for own in parts for p in own[::2]])
        out, ends, k = [], [0], 0
        for own in parts:
            for i, part in enumerate(own):
                if i % 2:
                    out.append(np.array([self.added[part]], ids.dtype))
                else:
                    out.append(ids[at[k] : at[k + 1]])
                    k += 1
            ends.append(ends[-1] + sum(map(len, out[len(out) - len(own) :])))
        return np.concatenate(out), np.array(ends, np.int64)

    def symbols(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        ids = self.inner[data]
        ids[at[1:] - 1] = self.final[data[at[1:] - 1]]
        return ids


#: Lower case of letters that Python may not know yet: of some, and of ranges by a distance.
NEW_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
NEW_LOWER |= {cp: cp + 0x20 for cp in range(0x10D50, 0x10D66)} | {cp: cp + 0x1B for cp in range(0x16EA0, 0x16EB9)}


def _lower(text: str) -> str:
    """Lower case letter by letter: without the special form of a final sigma."""
    if not text.isascii():
        text = text.translate(NEW_LOWER)
    return "".join(map(str.lower, text)) if "Σ" in text else text.lower()


@functools.cache
def shown_bytes() -> list[str]:
    """The printable character that stands for each byte: its own where it is visible, else the next from U+0100."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


@functools.cache
def byte_encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


@functools.cache
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)
