"""Token-id output: best-fit-decreasing packing with a segment tree over the space left, written as id matrices.

Documents become pieces of at most `room` ids, split without loss; the last piece of a document is packed like any other.
Only the histogram of piece lengths, of at most `room` rows, reaches the driver. There all pieces are packed at once, best fit
decreasing: pieces of one length are alike, so sequences that hold the same lengths are one group with a count, and the
segment tree finds the group of least space that suffices. The result is that of packing piece by piece, however the
table is laid out. Ranks among the pieces of a length then name each piece's sequence, and one shuffle brings a sequence's
pieces together. Each sequence is one row of ids, with the cumulative lengths of its segments and the places where
positions start anew.

Null texts count as empty; a row without tokens still has its end mark. Repeated rows and null ids are packed like
others; pieces of one length take their places in the order in which tasks met them. Other columns are ignored. A very long
text is held whole by one task while it is encoded. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import byte_encoder
from .shared import slices, stored, text_column

ROOM, END, BROADCAST_ROWS = 2048, 50256, 2_000_000
SEQUENCES = "sequence long, ids binary, n_tokens int, cu_seqlens array<int>, position_resets array<int>, doc_ids array<long>, starts array<long>"
Groups = list[tuple[tuple[int, ...], int]]


class Spaces:
    """A segment tree over the space left: a leaf holds the groups of open sequences with that much; finds the least space that suffices."""

    def __init__(self, room: int):
        self.leaves = 1 << room.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.held: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(room + 1)]

    def add(self, space: int, lengths: tuple[int, ...], n: int) -> None:
        """n sequences that hold these lengths."""
        self.held[space].append((lengths, n))
        at = self.leaves + space
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, tuple[int, ...], int] | None:
        """The least space of at least `need`, and a group that has it."""
        at = self.leaves + need
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        space = at - self.leaves
        while at:
            self.count[at] -= 1
            at >>= 1
        return space, *self.held[space].pop()


def best_fit_decreasing(counts: np.ndarray, room: int) -> Groups:
    """(lengths of a sequence, how many such sequences); counts: pieces by length, 0 to room. The work follows the lengths, not the pieces."""
    spaces, done = Spaces(room), []

    def put(space: int, lengths: tuple[int, ...], n: int) -> None:
        if n and space:
            spaces.add(space, lengths, n)
        elif n:
            done.append((lengths, n))

    for length in range(room, 0, -1):
        left = int(counts[length])
        while left:
            space, lengths, n = spaces.take(length) or (room, (), left)
            each = min(space // length, left)  # what fits on top of a piece leaves the least space again
            full = min(n, left // each)
            left -= full * each
            put(space - each * length, lengths + (length,) * each, full)
            if lengths:
                put(space, lengths, n - full)
    return done + [group for own in spaces.held for group in own]


def places(made: Groups) -> dict[str, np.ndarray]:
    """For each length and range of ranks: the first sequence and the offset. Sorted by length and first rank."""
    rank, rows, first = Counter(), [], 0
    for held, n in made:
        offset = 0
        for length in held:
            rows.append((length, rank[length], first, offset))
            rank[length] += n
            offset += length
        first += n
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"key": table[:, 0] << 48 | table[:, 1], "rank": table[:, 1], "first": table[:, 2], "offset": table[:, 3]}


def histogram(pieces: DataFrame, room: int) -> np.ndarray:
    """Pieces by length, 0 to room: all that reaches the driver."""
    counts = np.zeros(room + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    return counts


def placed(pieces: DataFrame, made: Groups, wide: bool = False) -> DataFrame:
    """The pieces (with length, part, and nth among the part's pieces of that length) with sequence_id and offset in place of part and nth.

    wide: the pieces carry ids, so where the ranks of a part and length begin is broadcast while that is at most BROADCAST_ROWS rows,
    and the ids are shuffled once; beyond, twice."""
    table = pieces.sparkSession.sparkContext.broadcast(places(made))  # a row for each group of sequences and length: by the lengths, not the pieces
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    bases = sizes.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    if wide:
        bases = stored(bases, "bases")
        bases = F.broadcast(bases) if bases.count() <= BROADCAST_ROWS else bases

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        t = table.value
        at = np.searchsorted(t["key"], length.to_numpy() << 48 | rank.to_numpy(), side="right") - 1
        return pd.DataFrame({"sequence_id": t["first"][at] + rank.to_numpy() - t["rank"][at], "offset": t["offset"][at]})

    ranked = pieces.join(bases, ["part", "length"]).withColumn("place", place(F.col("length"), F.col("base") + F.col("nth")))
    return ranked.select(*(c for c in pieces.columns if c not in ("part", "nth")), "place.sequence_id", "place.offset")


def pieces(documents: DataFrame, path: str, room: int = ROOM, end: int = END) -> DataFrame:
    """doc_id, start, ids, length, part, nth of every piece; ids: little-endian, unsigned, 16 bits where they suffice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seen = byte_encoder(path), TaskContext.get().partitionId(), Counter()
        kind = "<u2" if max(encoder.size - 1, end) < 2**16 else "<u4"
        for batch in slices(batches):
            rows = []
            ids, at = encoder.encode(batch.column("text").to_pylist())
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), at.tolist(), at[1:].tolist()):
                own = np.append(ids[a:b], end).astype(kind)
                for start in range(0, len(own), room):
                    cut = own[start : start + room]
                    rows.append((doc, start, cut.tobytes(), len(cut), part, seen[len(cut)]))
                    seen[len(cut)] += 1
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "start", "ids", "length", "part", "nth"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text")).mapInArrow(run, "doc_id long, start long, ids binary, length long, part int, nth long")


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by sequence and offset; a sequence that goes on in the next batch waits for it."""
    waiting: list[tuple] = []

    def rows(held: list[tuple]) -> pa.RecordBatch:
        edges = [i for i in range(len(held)) if not i or held[i][0] != held[i - 1][0]] + [len(held)]
        out = []
        for a, b in zip(edges, edges[1:]):
            bound = np.r_[0, np.cumsum([x[3] for x in held[a:b]])].tolist()
            out.append((held[a][0], b"".join(x[2] for x in held[a:b]), bound[-1], bound, bound[:-1], [x[1] for x in held[a:b]], [x[4] for x in held[a:b]]))
        ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
        kinds = [pa.int64(), pa.binary(), pa.int32(), ints, ints, longs, longs]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], [c.split()[0] for c in SEQUENCES.split(", ")])

    for batch in batches:
        waiting += zip(*(batch.column(c).to_pylist() for c in ("sequence_id", "doc_id", "ids", "length", "start")))
        last = next((i for i in range(len(waiting) - 1, 0, -1) if waiting[i][0] != waiting[i - 1][0]), 0)
        if last:
            yield rows(waiting[:last])
            waiting = waiting[last:]
    if waiting:
        yield rows(waiting)


def sequences(documents: DataFrame, path: str, room: int = ROOM, end: int = END) -> DataFrame:
    """Packed sequences."""
    cut = stored(pieces(documents, path, room, end), "token-pieces")
    at = placed(cut, best_fit_decreasing(histogram(cut, room), room), wide=True)
    return at.repartition("sequence_id").sortWithinPartitions("sequence_id", "offset").mapInArrow(_assembled, SEQUENCES)


def positions(sequence: DataFrame) -> DataFrame:
    """Adds position_ids array<int>: they start at 0 in every segment."""
    spans = F.arrays_zip(F.col("position_resets").alias("a"), F.slice("cu_seqlens", 2, F.size("cu_seqlens")).alias("b"))
    return sequence.withColumn("position_ids", F.flatten(F.transform(spans, lambda s: F.sequence(F.lit(0), s["b"] - s["a"] - 1))))


def written(documents: DataFrame, path: str, room: int = ROOM, end: int = END) -> DataFrame:
    """Writes the sequences into the shared folder and returns the table."""
    return stored(sequences(documents, path, room, end), "packed-ids")


def digest(table: DataFrame) -> DataFrame:
    """One row per sequence with a hash in place of its ids."""
    return table.select("sequence", "n_tokens", "cu_seqlens", "position_resets", "doc_ids", "starts", F.sha2("ids", 256).alias("ids_sha256"))
