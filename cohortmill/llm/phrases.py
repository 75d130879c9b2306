"""Phrase collocation mining over weighted acyclic automata.

Every shard of text becomes count transducers: the n-grams of one to three words under their language, in sorted order,
as a trie whose arcs carry counts. As sorted order leaves a prefix its state is closed and registered; equal states of a
transducer are kept once. Transducers are cut by prefix range, shipped as one row a shard and range, and united there
with their weights summed. Candidates are composed with the united transducers to look up the counts of their parts.

One and two words are counted first. A phrase of three is no more frequent than its pairs, so three words are counted only
where the hashes of both pairs are among those of frequent pairs: an array of at most 2^26 bits, which is broadcast.

A prefix of two words has its place on a ring of hashes, and the words that follow it are spread over the next 1/64 of
the ring, so that no prefix, however common, stays in one range once there are many. Words are compared by their bytes;
hashes only say where a count is kept. A task counts SHARD bytes of text at a time and holds their transducers, cut
coarsely, until they come to HELD bytes; then it unites them and cuts them finely. A range has the n-grams of about
RANGE_BYTES of text. Rows shipped are at most input^2 / (HELD * RANGE_BYTES): raise both with the executors' memory.

Null texts count as empty, a null lang as `und`. Repeated rows count each time. A text of any length is cut into shards
with two words of overlap, and an n-gram counts where its last word is new. Equal scores and counts go by the phrase's
bytes. An empty table, or one without candidates, gives no rows. Columns other than lang and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .pretok import mixed, ragged, slice_hashes
from .shared import slices, stored, text_column

LEAST, TOP, SALTS = 10, 2000, 16
SHARD, HELD, RANGE_BYTES, RANGES, COARSE, MOST_BITS = 2 << 20, 32 << 20, 4 << 20, 32, 32, 26
U = np.uint64
LOW = 2**32 - 1
#: Byte classes: of a word, between words, between pieces.
WORD, BLANK, BREAK = range(3)
CLASS = np.zeros(256, np.uint8)
CLASS[[0x20, 0x09]] = BLANK
CLASS[[*b".,;:!?", *range(0x0A, 0x0E)]] = BREAK
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass(frozen=True)
class Trie:
    """Counts of n-grams in sorted order, level by level; up2 and up3 are rows of the level above. A state that is only on the way has count 0."""

    symbols: pa.LargeBinaryArray
    lang: np.ndarray
    w1: np.ndarray
    c1: np.ndarray
    up2: np.ndarray
    w2: np.ndarray
    c2: np.ndarray
    up3: np.ndarray
    w3: np.ndarray
    c3: np.ndarray


def binary(data: np.ndarray, lengths: np.ndarray) -> pa.LargeBinaryArray:
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def parts_of(symbols: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and ends of an array."""
    at = np.frombuffer(symbols.buffers()[1], np.int64)[symbols.offset : symbols.offset + len(symbols) + 1]
    return np.frombuffer(symbols.buffers()[2] or b"", np.uint8), at[:-1], at[1:]


def level(up: np.ndarray, word: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (up, word) in order with their counts summed, and where each row went."""
    key, to = np.unique(up.astype(np.int64) << 32 | word, return_inverse=True)
    return key >> 32, key & LOW, np.bincount(to, count, len(key)).astype(np.int64), to


def counted(data: np.ndarray, at: np.ndarray, skip: np.ndarray, langs: pa.Array, pairs: np.ndarray | None = None) -> Trie:
    """The n-grams of texts data[at[i]:at[i + 1]] under langs[i], without those whose last word is among a text's first skip[i].

    One and two words; or, given the bits of frequent pairs, three words of which both pairs may be frequent."""
    data = LOWER[data]
    kind = CLASS[data]
    inside = kind == WORD
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    starts = np.flatnonzero(inside & (~np.r_[False, inside[:-1]] | edge[:-1]))
    ends = np.flatnonzero(inside & (~np.r_[inside[1:], False] | edge[1:])) + 1
    text = np.searchsorted(at, starts, "right") - 1
    piece = np.cumsum(kind == BREAK)[starts] + text
    n = len(starts)
    encoded = pa.concat_arrays([binary(data[inside], ends - starts), langs.cast(pa.large_binary())]).dictionary_encode()
    ids = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    word, lang = ids[:n], ids[n:][text]
    new = np.arange(n) - np.searchsorted(starts, at[:-1])[text] >= skip[text]
    lang, w1, c1, to1 = level(lang, word, new)
    two = np.flatnonzero(piece[:-1] == piece[1:])
    up2, w2, c2, to2 = level(to1[two], word[two + 1], new[two + 1])
    none = np.zeros(0, np.int64)
    if pairs is None:
        return Trie(encoded.dictionary, lang, w1, c1, up2, w2, c2, none, none, none)
    ring = Ring.of(encoded.dictionary, 1)
    frequent = np.zeros(n, bool)  # whether a frequent pair may begin at a word
    place = np.zeros(n, np.int64)
    frequent[two], place[two] = held(pairs, ring.two(ring.one(lang, w1)[up2], w2))[to2], to2
    three = np.flatnonzero(frequent[:-1] & frequent[1:] & (np.arange(1, n) < n - 1)) if n else none
    three = three[new[three + 2]]
    up3, w3, c3, _ = level(place[three], word[three + 2], np.ones(len(three)))
    return Trie(encoded.dictionary, lang, w1, np.zeros_like(c1), up2, w2, np.zeros_like(c2), up3, w3, c3)


def held(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash's bit is set in an array of 2^k bytes of 8 bits."""
    at = hashes >> U(64 - (8 * len(bits)).bit_length() + 1)
    return (bits[(at >> U(3)).astype(np.int64)] >> (at & U(7)).astype(np.uint8) & np.uint8(1)).astype(bool)


def united(tries: list[Trie]) -> Trie:
    """The union of transducers, weights summed."""
    encoded = pa.concat_arrays([t.symbols for t in tries]).dictionary_encode()
    ids = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    symbol = np.split(ids, np.cumsum([len(t.symbols) for t in tries])[:-1])
    joined = lambda name: np.concatenate([s[getattr(t, name)] for s, t in zip(symbol, tries)])
    total = lambda name: np.concatenate([getattr(t, name) for t in tries])
    base1, base2 = (np.cumsum([0, *(len(getattr(t, name)) for t in tries)]) for name in ("c1", "c2"))
    lang, w1, c1, to1 = level(joined("lang"), joined("w1"), total("c1"))
    up2, w2, c2, to2 = level(to1[np.concatenate([t.up2 + b for t, b in zip(tries, base1)])], joined("w2"), total("c2"))
    up3, w3, c3, _ = level(to2[np.concatenate([t.up3 + b for t, b in zip(tries, base2)])], joined("w3"), total("c3"))
    return Trie(encoded.dictionary, lang, w1, c1, up2, w2, c2, up3, w3, c3)


def pruned(t: Trie, least: int) -> Trie:
    """Only n-grams counted so often, and what is on the way to them."""
    three = t.c3 >= least
    two = t.c2 >= least
    two[t.up3[three]] = True
    one = t.c1 >= least
    one[t.up2[two]] = True
    to1, to2 = np.cumsum(one) - 1, np.cumsum(two) - 1
    kept = lambda c: np.where(c >= least, c, 0)
    return Trie(t.symbols, t.lang[one], t.w1[one], kept(t.c1[one]), to1[t.up2[two]], t.w2[two], kept(t.c2[two]), to2[t.up3[three]], t.w3[three], t.c3[three])


@dataclass(frozen=True)
class Ring:
    """Where n-grams of these symbols are kept: one of `ranges` ranges."""

    symbol: np.ndarray
    ranges: int

    @staticmethod
    def of(symbols: pa.LargeBinaryArray, ranges: int) -> Ring:
        data, starts, ends = parts_of(symbols)
        return Ring(slice_hashes(data, starts, ends), ranges)

    def one(self, lang: np.ndarray, w1: np.ndarray) -> np.ndarray:
        return mixed(self.symbol[lang] * U(3) + self.symbol[w1])

    def two(self, one: np.ndarray, w2: np.ndarray) -> np.ndarray:
        return mixed(one * U(5) + self.symbol[w2])

    def three(self, two: np.ndarray, w3: np.ndarray) -> np.ndarray:
        return two + (mixed(two * U(7) + self.symbol[w3]) >> U(6))

    def range(self, place: np.ndarray) -> np.ndarray:
        return ((place >> U(32)) * U(self.ranges) >> U(32)).astype(np.int64)


def registered(up: np.ndarray, at: np.ndarray, label: np.ndarray, weight: np.ndarray, target: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Closed states by their arcs, equal ones of a range once. up: the arcs' states, in order; at: the states' ranges.

    Gives each state's number within its range (0: it has no arcs), the arcs kept and their states' sizes, by range and number."""
    number = np.zeros(n, np.int64)
    if not len(up):
        return number, np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.r_[True, up[1:] != up[:-1]])
    state, size = up[starts], np.diff(np.r_[starts, len(up)])
    arcs = [mixed(mixed(mixed(label.astype(U) + U(k)) * U(3) + weight.astype(U)) * U(5) + target.astype(U)) for k in (1, 2**63)]
    first, second = (np.add.reduceat(arc, starts) for arc in arcs)
    order = np.lexsort((second, first, at[state]))
    a, b, r = first[order], second[order], at[state][order]
    fresh = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (r[1:] != r[:-1])]
    group = np.cumsum(fresh) - 1
    ranges = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
    base = group[ranges]
    number[state[order]] = group - np.repeat(base, np.diff(np.r_[ranges, len(r)])) + 1
    kept = order[fresh]
    return number, ragged(starts[kept], size[kept]), size[kept]


def dump(columns: list[np.ndarray]) -> bytes:
    """Whole numbers in as few bytes as hold them, compressed."""
    parts = []
    for c in columns:
        most = int(c.max(initial=0))
        parts.append(c.astype(np.uint8 if most < 2**8 else np.uint16 if most < 2**16 else np.uint32 if most < 2**32 else np.uint64))
    raw = np.array([[len(p), p.itemsize] for p in parts], np.int64).tobytes() + b"".join(p.tobytes() for p in parts)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def load(blob: bytes, columns: int) -> list[np.ndarray]:
    raw = pa.decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    at, out = 16 * columns, []
    for n, size in np.frombuffer(raw, np.int64, 2 * columns).reshape(-1, 2).tolist():
        out.append(np.frombuffer(raw, f"<u{size}", n, at))
        at += n * size
    return out


def transducers(t: Trie, ring: Ring) -> Iterator[tuple[int, bytes]]:
    """(range, transducer) of a shard's n-grams, all ranges at once."""
    place1 = ring.one(t.lang, t.w1)
    place2 = ring.two(place1[t.up2], t.w2)
    r1, r2, r3 = ring.range(place1), ring.range(place2), ring.range(ring.three(place2[t.up3], t.w3))
    own = t.c2 > 0
    state2, to = np.unique(np.r_[r2[own] << 32 | np.flatnonzero(own), r3 << 32 | t.up3], return_inverse=True)
    up3 = to[own.sum() :]
    weight2 = np.zeros(len(state2), np.int64)
    weight2[to[: own.sum()]] = t.c2[own]
    at2, node2 = state2 >> 32, state2 & LOW
    own = t.c1 > 0
    state1, to = np.unique(np.r_[r1[own] << 32 | np.flatnonzero(own), at2 << 32 | t.up2[node2]], return_inverse=True)
    up2 = to[own.sum() :]
    weight1 = np.zeros(len(state1), np.int64)
    weight1[to[: own.sum()]] = t.c1[own]
    at1, node1 = state1 >> 32, state1 & LOW
    order = np.argsort(up3, kind="stable")
    label3, count3 = t.w3[order], t.c3[order]
    tail, arcs3, size3 = registered(up3[order], at2, label3, count3, np.zeros(len(order)), len(state2))
    range3 = at2[up3[order]][arcs3]
    label3, count3 = label3[arcs3], count3[arcs3]
    order = np.argsort(up2, kind="stable")
    label2, count2, target2 = t.w2[node2[order]], weight2[order], tail[order]
    head, arcs2, size2 = registered(up2[order], at1, label2, count2, target2, len(state1))
    range2 = at1[up2[order]][arcs2]
    label2, count2, target2 = label2[arcs2], count2[arcs2], target2[arcs2]
    lang1, label1 = t.lang[node1], t.w1[node1]
    used, to = np.unique(np.concatenate([at1 << 32 | lang1, at1 << 32 | label1, range2 << 32 | label2, range3 << 32 | label3]), return_inverse=True)
    range_of = used >> 32
    ids = to - np.searchsorted(range_of, np.concatenate([at1, at1, range2, range3]))
    cuts = np.cumsum([len(at1), len(at1), len(range2)])
    lang1, label1, label2, label3 = np.split(ids, cuts)
    data, starts, ends = parts_of(t.symbols)
    lengths = (ends - starts)[used & LOW]
    body, body_at = data[ragged(starts[used & LOW], lengths)], np.r_[0, np.cumsum(lengths)]
    found = np.unique(at1)
    edges = [(np.searchsorted(r, found), np.searchsorted(r, found, "right")) for r in (range_of, at1, range2, range3)]
    begins2, begins3 = (np.r_[0, np.cumsum(s)] for s in (size2, size3))
    for i, r in enumerate(found.tolist()):
        (s0, s1), (a0, a1), (b0, b1), (c0, c1) = ((int(lo[i]), int(hi[i])) for lo, hi in edges)
        z2 = size2[np.searchsorted(begins2, b0) : np.searchsorted(begins2, b1)] if b1 > b0 else size2[:0]
        z3 = size3[np.searchsorted(begins3, c0) : np.searchsorted(begins3, c1)] if c1 > c0 else size3[:0]
        yield r, dump([lengths[s0:s1], body[body_at[s0] : body_at[s1]], lang1[a0:a1], label1[a0:a1], weight1[a0:a1], head[a0:a1], z2, label2[b0:b1], count2[b0:b1], target2[b0:b1], z3, label3[c0:c1], count3[c0:c1]])


def unfolded(blob: bytes) -> Trie:
    """A transducer's n-grams, shared states written out."""
    lengths, body, lang, w1, c1, head, z2, w2, c2, tail, z3, w3, c3 = load(blob, 13)
    size2, size3 = np.r_[0, z2.astype(np.int64)], np.r_[0, z3.astype(np.int64)]
    begin2, begin3 = np.cumsum(size2) - size2, np.cumsum(size3) - size3
    arcs2 = ragged(begin2[head], size2[head])
    up2, states = np.repeat(np.arange(len(head)), size2[head]), tail[arcs2]
    arcs3 = ragged(begin3[states], size3[states])
    up3 = np.repeat(np.arange(len(states)), size3[states])
    wide = lambda x: x.astype(np.int64)
    return Trie(binary(body, wide(lengths)), wide(lang), wide(w1), wide(c1), up2, wide(w2[arcs2]), wide(c2[arcs2]), up3, wide(w3[arcs3]), wide(c3[arcs3]))


def windows(text: np.ndarray, limit: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, words to skip) of the parts of a long text: about `limit` bytes each, two words of overlap."""
    gap = CLASS[text] != WORD
    first = np.flatnonzero(~gap & np.r_[True, gap[:-1]])  # where words start
    gaps = np.flatnonzero(gap)
    start = skip = done = 0
    while True:
        wanted = max(start + limit, done + 1)
        if wanted >= len(text):
            yield start, len(text), skip
            return
        i = np.searchsorted(gaps, wanted, "right") - 1
        if i < 0 or gaps[i] <= done:
            i += 1
        end = int(gaps[i]) if i < len(gaps) else len(text)
        yield start, end, skip
        if end == len(text):
            return
        words = first[np.searchsorted(first, start) : np.searchsorted(first, end)][-2:]
        start, skip, done = (int(words[0]) if len(words) else end), len(words), end


def shards(batches: Iterator[pa.RecordBatch], limit: int, pairs: np.ndarray | None = None) -> Iterator[Trie]:
    """Texts of about `limit` bytes counted at a time."""
    for batch in slices(batches, limit=limit):
        texts, langs = batch.column("text").cast(pa.large_binary()), batch.column("lang")
        data, starts, ends = parts_of(texts)
        if batch.num_rows == 1 and ends[0] - starts[0] > limit:
            text = data[starts[0] : ends[0]]
            for a, b, skip in windows(text, limit):
                yield counted(text[a:b], np.array([0, b - a]), np.array([skip]), langs, pairs)
        else:
            yield counted(data[starts[0] : ends[-1]], np.r_[starts, ends[-1]] - starts[0], np.zeros(len(starts), np.int64), langs, pairs)


def rows(pairs: list[tuple[int, bytes]], name: str = "data") -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.binary())], ["range", name])


def asked(t: Trie, ring: Ring) -> Iterator[tuple[int, bytes]]:
    """(range of a part, candidates that ask for it): slots 1 to 4 are the first and second parts of the first cut, then of the second."""
    up, up3 = t.up2, t.up3
    two, three = np.flatnonzero(t.c2), np.arange(len(t.c3))
    mid = up3[three]
    none = np.zeros(len(two), np.int64)  # a third symbol of 0 stands for none, others are one more
    lang = np.r_[t.lang[up[two]], t.lang[up[mid]]]
    w1, w2, w3 = np.r_[t.w1[up[two]], t.w1[up[mid]]], np.r_[t.w2[two], t.w2[mid]], np.r_[none, t.w3[three] + 1]
    a, long = np.r_[t.c2[two], t.c3[three]], np.flatnonzero(w3)
    head, last = ring.one(lang, w1), np.where(w3 > 0, w3 - 1, w2)
    tail = np.where(w3 > 0, ring.two(ring.one(lang, w2), last), ring.one(lang, w2))
    every = np.arange(len(a))
    who = np.concatenate([every, every, long, long])
    slot = np.repeat([1, 2, 3, 4], [len(a), len(a), len(long), len(long)])
    place = np.concatenate([head, tail, ring.two(head[long], w2[long]), ring.one(lang[long], last[long])])
    to = ring.range(place)
    order = np.argsort(to, kind="stable")
    who, slot, to = who[order], slot[order], to[order]
    data, starts, ends = parts_of(t.symbols)
    cuts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else []
    for b, e in zip(cuts, [*cuts[1:], len(to)]):
        i = who[b:e]
        used, ids = np.unique(np.r_[lang[i], w1[i], w2[i], last[i]], return_inverse=True)
        lengths = (ends - starts)[used]
        ids = ids.reshape(4, -1)
        yield int(to[b]), dump([lengths, data[ragged(starts[used], lengths)], ids[0], ids[1], ids[2], np.where(w3[i] > 0, ids[3] + 1, 0), a[i], slot[b:e]])


ANSWER = "lang string, phrase string, a long, l1 long, r1 long, l2 long, r2 long, gone boolean"


def found(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Rows of sorted keys, -1 for none."""
    if not len(keys):
        return np.full(len(wanted), -1)
    i = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[i] == wanted, i, -1)


def answered(model: Trie, blob: bytes, share: int) -> pa.RecordBatch:
    """Composes the candidates that ask with a range's transducer: the counts of their parts, and the pairs that longer ones drop."""
    lengths, body, lang, w1, w2, w3, a, slot = load(blob, 8)
    words = binary(body, lengths.astype(np.int64))
    lang, w1, w2, w3, a = (x.astype(np.int64) for x in (lang, w1, w2, w3, a))
    to = pc.fill_null(pc.index_in(words, value_set=model.symbols), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    single = (slot == 1) | (slot == 4) | (slot == 2) & (w3 == 0)
    begin = np.where(slot == 1, w1, np.where(slot == 4, w3 - 1, np.where(slot == 2, w2, w1)))
    then = np.where(slot == 2, np.where(w3 > 0, w3 - 1, 0), w2)
    at = found(model.lang << 32 | model.w1, to[lang] << 32 | to[begin])
    pair = found(model.up2 << 32 | model.w2, at << 32 | to[then])
    lost = np.where(single, at, pair) < 0
    if lost.any() or (to[lang] < 0).any():
        raise ValueError("a part of a candidate is not counted where its hash says")
    n = np.where(single, model.c1[at] if len(model.c1) else 0, model.c2[pair] if len(model.c2) else 0)
    text = words.cast(pa.large_string())
    joined = lambda *cols: pc.binary_join_element_wise(*[text.take(pa.array(c)) for c in cols], pa.scalar(" ", pa.large_string())).cast(pa.string())
    phrase = pc.if_else(pa.array(w3 > 0), joined(w1, w2, np.maximum(w3 - 1, 0)), joined(w1, w2))
    names = text.take(pa.array(lang)).cast(pa.string())
    drops = np.flatnonzero(~single & (100 * a >= share * n))
    none = [pa.nulls(len(drops), pa.int64())] * 5
    parts = [
        [names, phrase, pa.array(a), *(pa.array(n, mask=slot != k) for k in (1, 2, 3, 4)), pa.nulls(len(a), pa.bool_())],
        [names.take(pa.array(drops)), joined(begin[drops], then[drops]), *none, pa.array(np.ones(len(drops), bool))],
    ]
    columns = [c.strip().split()[0] for c in ANSWER.split(",")]
    return pa.concat_batches([pa.RecordBatch.from_arrays(p, columns) for p in parts])


def models(documents: DataFrame, least: int, limit: int, ranges: int, most: int = HELD, bits: Broadcast | None = None) -> DataFrame:
    """range, data (the united transducer of the n-grams counted at least so often), totals (each language's words).

    One and two words; or, given the bits of frequent pairs, three words."""

    def finely(kept: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
        for blobs in kept.values():
            trie = united([unfolded(b) for b in blobs])
            yield rows(list(transducers(trie, Ring.of(trie.symbols, ranges))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list[bytes]] = {}
        size = 0
        for trie in shards(batches, limit, None if bits is None else np.frombuffer(bits.value, np.uint8)):
            for place, blob in transducers(trie, Ring.of(trie.symbols, COARSE)):
                kept.setdefault(place, []).append(blob)
                size += len(blob)
            if size > most:
                yield from finely(kept)
                kept, size = {}, 0
        yield from finely(kept)

    def unite(group: pa.Table) -> pa.Table:
        trie = united([unfolded(b) for b in group.column("data").to_pylist()])
        langs, at = np.unique(trie.lang, return_inverse=True)
        names = trie.symbols.take(pa.array(langs)).cast(pa.large_string()).to_pylist()
        totals = [(k, v) for k, v in zip(names, np.bincount(at, trie.c1, len(langs)).astype(np.int64).tolist()) if v]
        small = pruned(trie, least)
        blob = next((b for _, b in transducers(small, Ring.of(small.symbols, 1))), None)
        out = [pa.array([group.column("range")[0].as_py()], pa.int64()), pa.array([blob], pa.binary()), pa.array([totals], pa.map_(pa.string(), pa.int64()))]
        return pa.table(out, ["range", "data", "totals"])

    texts = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), text_column().alias("text")).filter("text != ''")
    return texts.mapInArrow(count, "range long, data binary").groupBy("range").applyInArrow(unite, "range long, data binary, totals map<string, long>")


def frequent_pairs(counts: DataFrame, most: int = MOST_BITS) -> bytes:
    """An array of bits, about 16 for each frequent pair and at most 2^most, with the bits of their hashes set."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("data"):
                t = unfolded(blob.as_py())
                ring = Ring.of(t.symbols, 1)
                hashes = ring.two(ring.one(t.lang, t.w1)[t.up2], t.w2)[t.c2 > 0]
                yield pa.RecordBatch.from_arrays([pa.array((hashes >> U(64 - most)).astype(np.int64))], ["h"])

    hashes = counts.filter("data is not null").select("data").mapInArrow(each, "h long")
    n = hashes.count()
    k = max(10, min(most, (16 * n).bit_length()))
    bits = hashes.selectExpr(f"shiftright(h, {most - k}) AS bit")
    words = bits.selectExpr("shiftright(bit, 6) AS word", "shiftleft(1L, cast(bit % 64 AS int)) AS b").groupBy("word").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(2**k // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("b").to_numpy()
    return out.tobytes()


def parts(counts: DataFrame, longer: DataFrame, ranges: int, share: int) -> DataFrame:
    """lang, phrase, a, the counts of the parts of both cuts, whether a longer candidate drops it: rows to be folded by phrase."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("data"):
                trie = unfolded(blob.as_py())
                if len(trie.c2):
                    yield rows(list(asked(trie, Ring.of(trie.symbols, ranges))), "asked")

    def answer(asking: pa.Table, model: pa.Table) -> pa.Table:
        trie = united([unfolded(model.column("data")[0].as_py())])
        return pa.Table.from_batches([answered(trie, b, share) for b in asking.column("asked").to_pylist()])

    model = counts.filter("data is not null").select("range", "data")
    asking = model.select("data").unionByName(longer.filter("data is not null").select("data")).mapInArrow(ask, "range long, asked binary")
    return asking.groupBy("range").cogroup(model.groupBy("range")).applyInArrow(lambda x, y: answer(x, y) if x.num_rows else empty(), ANSWER)


def empty() -> pa.Table:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ANSWER.split(","))]).empty_table()


def score(l: str, r: str) -> str:
    """floor(1000000 * a * a / (l * r)), exactly for counts below 10^14."""
    d = "cast({} as decimal(14, 0))".format
    return f"({d('a')} * {d('a')} * cast(1000000 as decimal(7, 0))) div ({d(l)} * {d(r)})"


def collocations(documents: DataFrame, least: int = LEAST, top: int = TOP, share: int = 50, limit: int = SHARD) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first `top` phrases of two or three words.

    least: of a phrase's count. share: a phrase is dropped where a longer candidate that holds it has so many hundredths of its count."""
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(RANGES, -(-size // RANGE_BYTES))
    counts = stored(models(documents, least, limit, ranges), "pairs")
    bits = documents.sparkSession.sparkContext.broadcast(frequent_pairs(counts))
    longer = stored(models(documents, least, limit, ranges, bits=bits), "phrases")
    bits.destroy()
    folded = parts(counts, longer, ranges, share).groupBy("lang", "phrase").agg(*[F.max(c).alias(c) for c in ("a", "l1", "r1", "l2", "r2", "gone")]).filter("gone is null")
    scored = folded.withColumn("s1", F.expr(score("l1", "r1"))).withColumn("s2", F.expr(f"case when l2 is not null then {score('l2', 'r2')} end"))
    first = F.col("s2").isNull() | (F.col("s1") <= F.col("s2"))
    chosen = scored.select("lang", "phrase", "a", *[F.when(first, F.col(f"{c}1")).otherwise(F.col(f"{c}2")).alias(c) for c in "lr"], F.when(first, F.col("s1")).otherwise(F.col("s2")).alias("score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    chosen = chosen.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    chosen = chosen.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    words = counts.select(F.explode("totals").alias("lang", "n")).groupBy("lang").agg(F.sum("n").alias("n"))
    return chosen.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
