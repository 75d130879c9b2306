"""Pattern packing by non-negative least squares.

Documents become pieces of at most `room` tokens. Only the histogram of piece lengths, of at most `room` rows, reaches
the driver: all patterns of up to three lengths that fill a sequence exactly get repeat counts by non-negative least
squares, the counts are rounded as far as pieces last, and the rest is packed best fit decreasing, length by length.
Pieces then find their places by their rank among those of their length, so ties are settled by the order in which tasks
met them. A very long text is held whole by one task while it is encoded.

Null texts count as empty; an empty text still has its end mark, so every row gives at least one piece. Repeated rows
and null ids are packed like others; other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import word_encoder
from .shared import slices, stored, text_column
from .tokens import Groups, best_fit_decreasing, histogram, placed

ROOM, END = 2048, 0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def pieces(documents: DataFrame, path: str, room: int = ROOM) -> DataFrame:
    """One row per piece; nth counts a task's pieces of the same length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seen = word_encoder(path), TaskContext.get().partitionId(), Counter()
        for batch in slices(batches):
            rows = []
            ids, at = encoder.encode(batch.column("text").to_pylist())
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), at.tolist(), at[1:].tolist()):
                own = np.append(ids[a:b], END).astype("<u4")
                for k, start in enumerate(range(0, len(own), room)):
                    cut = own[start : start + room]
                    rows.append((doc, k, start, len(cut), zlib.crc32(cut), part, seen[len(cut)]))
                    seen[len(cut)] += 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [c.split()[0] for c in PIECES.split(", ")])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text")).mapInArrow(run, PIECES)


def exact_patterns(counts: np.ndarray, room: int) -> np.ndarray:
    """All sets of up to three lengths that occur and add up to room, 0 for none. At most room squared by 12."""
    have = np.flatnonzero(counts[1:]) + 1
    some = np.zeros(room + 1, bool)
    some[have] = some[0] = True
    lengths = np.r_[0, have].astype(np.int32)
    b, c = np.meshgrid(lengths, lengths, indexing="ij")
    a = room - b - c
    fits = (a >= b) & (b >= c)
    a, b, c = a[fits], b[fits], c[fits]
    return np.stack([a, b, c], axis=1)[some[a]]


def repeat_counts(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Non-negative least squares by accelerated projected gradients; counts: pieces by length."""
    n, room = len(patterns), len(counts)
    used = patterns > 0
    flat = np.where(used, patterns, 0).ravel()
    weight = used.ravel().astype(float)
    apply = lambda x: np.bincount(flat, np.repeat(x, 3) * weight, room)
    back = lambda r: (r[flat] * weight).reshape(n, 3).sum(axis=1)
    v = np.ones(n)
    for _ in range(20):
        v = back(apply(v))
        norm = np.linalg.norm(v)
        v /= norm
    x = y = np.zeros(n)
    t = 1.0
    for _ in range(rounds):
        nxt = np.maximum(0, y - back(apply(y) - counts) / (1.01 * norm))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = nxt + (t - 1) / t2 * (nxt - x)
        x, t = nxt, t2
    return x


def plan(counts: np.ndarray, room: int = ROOM) -> Groups:
    """(lengths of a sequence, how many such sequences); counts: pieces by length, 0 to room."""
    left = counts.astype(np.int64).copy()
    out = []
    patterns = exact_patterns(left, room)
    if len(patterns):
        fitted = repeat_counts(patterns, left.astype(float))
        for k in np.argsort(-fitted, kind="stable"):
            if fitted[k] < 0.5:
                break
            need = Counter(int(x) for x in patterns[k] if x)
            n = min(int(np.ceil(fitted[k])), *(int(left[x]) // m for x, m in need.items()))
            if n > 0:
                out.append((tuple(sorted(need.elements(), reverse=True)), n))
                for x, m in need.items():
                    left[x] -= n * m
    return out + best_fit_decreasing(left, room)


def packed(documents: DataFrame, path: str, room: int = ROOM) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    cut = stored(pieces(documents, path, room), "pieces")
    return placed(cut, plan(histogram(cut, room), room))
