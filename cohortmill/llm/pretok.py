"""Pre-tokenisation of whole batches in numpy: codepoint classes, then a scan over composed transition functions.

Every codepoint becomes a symbol, and every symbol a function from state to state. The functions that arise by
composition form a small closed set, so composing two of them is one table lookup; as composition is associative, the
state after every codepoint comes from a blocked prefix scan. No regular expression runs.
"""

from __future__ import annotations

import functools
import hashlib
import unicodedata
from dataclasses import dataclass

import numpy as np

LETTER, NUMBER, OTHER, SPACE, BLANK = range(5)
#: Letters and numbers that the tokenizers' libraries know (Unicode 16), and Python may not know yet; first and last of each range.
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEW_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]
#: The codepoints that regular expressions over Unicode call white space, without the plain space.
BLANKS = (0x9, 0xA, 0xB, 0xC, 0xD, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: What may follow an apostrophe to make a token of its own.
SUFFIXES = ("s", "t", "m", "d", "re", "ve", "ll")
#: Symbols: letter, number, other; an apostrophe with a suffix of one or two letters; the last of some white space, a
#: plain space or another; other white space. FIRST is added for the first codepoint of a text.
L, N, O, Q1, Q2, JOIN, LONE, GAP = range(8)
FIRST, BLOCK, LONG_SLICE = 8, 64, 512
#: States: anything begins a token; within letters, numbers, others; after a space that joins what follows; within white
#: space; one or two letters of a suffix to come.
FREE, IN_L, IN_N, IN_O, JOINING, IN_GAP, ONE, TWO = range(8)


@functools.cache
def classes() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind in "LN":
            table[cp] = LETTER if kind == "L" else NUMBER
    for ranges, kind in ((NEW_LETTERS, LETTER), (NEW_NUMBERS, NUMBER)):
        for first, last in ranges:
            table[first : last + 1] = kind
    table[list(BLANKS)] = BLANK
    table[32] = SPACE
    return table


@dataclass(frozen=True)
class Scanner:
    """functions: the closed set, a row of end states each; compose[f, g]: first f, then g; begins[symbol, state]."""

    functions: np.ndarray
    compose: np.ndarray
    begins: np.ndarray


@functools.cache
def scanner(spaces_join: bool) -> Scanner:
    """spaces_join: a space belongs to the token after it and numbers form runs; else white space is apart and each number stands alone."""
    step, begins = np.zeros((16, 8), np.int64), np.ones((16, 8), bool)
    for s in range(8):
        for symbol, inside in ((L, IN_L), (N, IN_N), (O, IN_O)):
            step[symbol, s] = inside
            begins[symbol, s] = not (s == JOINING or s == inside and (spaces_join or symbol != N))
        for symbol, state in ((Q1, ONE), (Q2, TWO)):
            held = s in (IN_O, JOINING)
            step[symbol, s], begins[symbol, s] = (IN_O, False) if held else (state, True)
        step[JOIN, s], step[LONE, s], step[GAP, s] = (JOINING, FREE, IN_GAP) if spaces_join else (IN_GAP,) * 3
        begins[GAP, s] = s != IN_GAP
        if not spaces_join:
            begins[JOIN, s] = begins[LONE, s] = s != IN_GAP
    step[:8, ONE], begins[:8, ONE], step[:8, TWO], begins[:8, TWO] = FREE, False, ONE, False
    step[FIRST:], begins[FIRST:] = step[:8, [FREE]], True
    functions = [tuple(range(8)), *map(tuple, step)]
    known = {f: i for i, f in reversed(list(enumerate(functions)))}
    at = 0
    while at < len(functions):
        for g in step:
            made = tuple(int(g[x]) for x in functions[at])
            if made not in known:
                known[made] = len(functions)
                functions.append(made)
        at += 1
    table = np.array(functions)
    compose = np.array([[known[tuple(int(g[x]) for x in f)] for g in table] for f in table], np.uint16)
    return Scanner(table.astype(np.uint8), compose, begins)


def prefix_scan(element: np.ndarray, compose: np.ndarray) -> np.ndarray:
    """Inclusive prefix compositions of a sequence: within blocks, over the blocks' totals, then both together."""
    n = len(element)
    if n <= BLOCK:
        out = element.copy()
        for i in range(1, n):
            out[i] = compose[out[i - 1], out[i]]
        return out
    size, flat = len(compose), compose.ravel()
    blocks = -(-n // BLOCK)
    padded = np.zeros(blocks * BLOCK, element.dtype)  # 0 is the identity
    padded[:n] = element
    inside = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T).astype(np.int32)
    for j in range(1, BLOCK):
        inside[j] = flat[inside[j - 1] * size + inside[j]]
    before = np.zeros(blocks, np.int32)
    before[1:] = prefix_scan(inside[-1].astype(element.dtype), compose)[:-1]
    return flat[before * size + inside].T.ravel()[:n]


def codepoints(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All codepoints, and where each text begins and the last ends."""
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)), out=at[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le"), "<u4"), at


def token_starts(cp: np.ndarray, at: np.ndarray, spaces_join: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Where tokens start, and the class of every codepoint. at: as from codepoints()."""
    if not len(cp):
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    kind = classes()[cp]
    blank = kind >= SPACE
    ends = at[1:][np.diff(at) > 0] - 1
    firsts = at[:-1][np.diff(at) > 0]
    follows = np.ones(len(cp), bool)  # white space or the text's end comes next
    follows[:-1] = blank[1:]
    follows[ends] = True
    symbol = kind.copy()
    symbol[blank] = np.where(follows[blank], GAP, np.where(kind[blank] == SPACE, JOIN, LONE))
    marks = np.flatnonzero(cp == 39)
    if len(marks):
        left = np.searchsorted(ends, marks)
        room = ends[left] - marks
        one, two = cp[np.minimum(marks + 1, len(cp) - 1)], cp[np.minimum(marks + 2, len(cp) - 1)]
        for suffix in SUFFIXES:
            fits = (room >= len(suffix)) & (one == ord(suffix[0]))
            if len(suffix) == 2:
                fits &= two == ord(suffix[1])
            symbol[marks[fits]] = Q1 if len(suffix) == 1 else Q2
    symbol[firsts] += FIRST
    rules = scanner(spaces_join)
    after = rules.functions[:, FREE][prefix_scan(symbol.astype(np.uint16) + 1, rules.compose)]
    before = np.empty_like(after)
    before[0], before[1:] = FREE, after[:-1]
    return np.flatnonzero(rules.begins.ravel()[symbol.astype(np.int32) * 8 + before]), kind


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def narrowed(values: np.ndarray) -> np.ndarray:
    """The same whole numbers in as few bytes each as hold them all."""
    most = int(values.max(initial=0))
    return values.astype(np.uint8 if most < 2**8 else np.uint16 if most < 2**16 else np.uint32)


def slice_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of values[start:end]: eight bytes of every slice at a time, each spread before the next come in.

    Slices of many bytes are hashed by blake2b one by one, so that the rounds are few whatever a batch holds.
    """
    size = values.itemsize
    per, long = 8 // size, LONG_SLICE // size
    data = values.tobytes() + bytes(8)
    eights = np.ndarray((len(values) + 1,), "<u8", data, strides=(size,))
    left, at = ends - starts, starts
    out = (left.astype(np.uint64) * np.uint64(8) + np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    cut = np.array([2 ** (8 * size * k) - 1 for k in range(per + 1)], np.uint64)
    for i in np.flatnonzero(left > long):
        digest = hashlib.blake2b(data[int(starts[i]) * size : int(ends[i]) * size], digest_size=8, salt=seed.to_bytes(8, "little"))
        out[i] = int.from_bytes(digest.digest(), "little")
    todo = np.flatnonzero((left > 0) & (left <= long))
    at, left = at[todo], left[todo]
    while len(todo):
        out[todo] = mixed((out[todo] ^ eights[at] & cut[np.minimum(left, per)]) * np.uint64(0xD6E8FEB86659FD93))
        more = np.flatnonzero(left > per)
        todo, at, left = todo[more], at[more] + per, left[more] - per
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of all slices, one after another."""
    total = int(lengths.sum())
    shift = starts.astype(np.int64) - (np.cumsum(lengths) - lengths)
    return np.repeat(shift, lengths) + np.arange(total)
