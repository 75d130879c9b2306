"""Cross-entropy difference: a target and a background bigram model over all words, and their losses for every text.

Both models come from all of their tables and hold every word and every pair of words; no vocabulary bounds them. Texts
are dealt to slices of about SLICE bytes, and stay rows of their own, as readers of Parquet hold thousands of rows at once.
A slice asks for the counts of its distinct words and pairs, keyed by hashes: its keys go to buckets by range, each bucket
sums what all slices bring, and answers every slice in the order of its keys. Slices may be read in parts, which ask apart.
The slice then scores its texts. So a common word costs one key a slice, however often it occurs, nothing is broadcast,
and what travels grows with the input. Both models are smoothed alike, by Dirichlet priors over their unigrams, which
count each word of either table once more. A text's loss is the mean over its words; the difference is target minus
background, less is closer to the target.

Null texts count as empty. A text without words has no losses: nulls, and 0 words. Repeated rows count each time, in
models and results. Empty tables leave flat models. Null ids and other columns do no harm. A text longer than a slice is a
slice of its own, read whole. Losses are not ranked, so equal ones need no order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pretok import mixed
from .shared import slices, stored, text_column
from .textscan import Words, scan

PRIOR, SLICE, BUCKETS, BUCKET_BYTES, ROW = 200.0, 2 << 20, 512, 8 << 20, 256
U = np.uint64
#: What stands for words outside a bounded vocabulary.
UNKNOWN = U(0x5851F42D4C957F2D)


def word_counts(texts: DataFrame) -> DataFrame:
    """word (a 64-bit hash), n: counted by task batch first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            word, n = np.unique(scan(batch.column("text")).hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n, pa.int64())], ["word", "n"])

    return texts.select(text_column().alias("text")).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def shared_vocabulary(counts: DataFrame, size: int) -> np.ndarray:
    """Sorted hashes of the most frequent words; ties go to the smaller hash."""
    rows = counts.orderBy(F.desc("n"), "word").limit(size).collect()
    return np.sort(np.array([r["word"] for r in rows], np.int64).view(np.uint64))


class Keyed:
    """Words and pairs of some texts: `key` holds the distinct ones, sorted, words odd and pairs even; n and last count
    them and the texts that end with them. word, pair and before point into key for every word; before is -1 at a start."""

    def __init__(self, words: Words, vocabulary: np.ndarray | None = None):
        h = words.hashes
        if vocabulary is not None:
            h = np.where(np.isin(h, vocabulary), h, UNKNOWN)
        h = h | U(1)
        firsts = words.of[:-1][np.diff(words.of) > 0]
        ends = words.of[1:][np.diff(words.of) > 0] - 1
        previous = np.r_[np.zeros(1, U), h[:-1]][: len(h)]
        previous[firsts] = 0
        self.key, at, self.n = np.unique(np.r_[h, mixed(mixed(previous) * U(3) + h) & ~U(1)], return_inverse=True, return_counts=True)
        self.word, self.pair = at[: len(h)], at[len(h) :]
        self.before = np.r_[np.full(1, -1), self.word[:-1]][: len(h)]
        self.before[firsts] = -1
        self.last = np.bincount(self.word[ends], minlength=len(self.key))


def pack(columns: list[np.ndarray]) -> bytes:
    """Columns of 64 bits, by planes of bytes, compressed."""
    planes = np.stack([c.astype(c.dtype if c.dtype == U else np.int64).view(U) for c in columns]).view(np.uint8)
    return pa.compress(np.ascontiguousarray(planes.reshape(len(columns), -1, 8).transpose(0, 2, 1)).tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, columns: int, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=columns * size * 8, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(columns, 8, size).transpose(0, 2, 1)).view(U).reshape(columns, size)


def sliced(background: DataFrame, limit: int) -> DataFrame:
    """slice, doc_id, text, n_bytes: a row for each text, dealt as they come to slices of about `limit` bytes; a row counts for ROW bytes more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            texts = batch.column("text").cast(pa.string())
            n_bytes = pc.binary_length(texts).cast(pa.int64())
            owners = np.empty(batch.num_rows, np.int64)
            for i, n in enumerate((n_bytes.to_numpy() + ROW).tolist()):
                if total and total + n > limit:
                    at, total = at + 1, 0
                total += n
                owners[i] = at
            yield pa.RecordBatch.from_arrays([pa.array(owners), batch.column("doc_id"), texts, n_bytes], ["slice", "doc_id", "text", "n_bytes"])

    rows = background.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    return rows.mapInArrow(run, "slice long, doc_id long, text string, n_bytes long")


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array]]:
    """The texts of each slice in a row, also where a batch ends within it."""
    at, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        owners = batch.column("slice").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(owners)) + 1).tolist(), len(owners)]
        for a, b in zip(cuts, cuts[1:]):
            if held and owners[a] != at:
                yield at, pa.concat_arrays(held)
                held = []
            at = int(owners[a])
            held.append(batch.column("text").slice(a, b - a))
    if held:
        yield at, pa.concat_arrays(held)


REQUEST = "slice long, bucket int, size int, data binary"


def asked(slice_id: int | None, keyed: Keyed, buckets: int) -> Iterator[pa.RecordBatch]:
    """The keys of a slice and their counts, a row for each bucket that any go to."""
    bucket = ((keyed.key >> U(32)) * U(buckets) >> U(32)).astype(np.int64)
    found, starts = np.unique(bucket, return_index=True)
    cuts = [*starts, len(bucket)]
    data = [pack([keyed.key[a:b], keyed.n[a:b], keyed.last[a:b]]) for a, b in zip(cuts, cuts[1:])]
    columns = [pa.array([slice_id] * len(found), pa.int64()), pa.array(found, pa.int32()), pa.array(np.diff(cuts), pa.int32()), pa.array(data, pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, ["slice", "bucket", "size", "data"])


def summed(bucket: pa.Table) -> pa.Table:
    """Counts of a bucket's keys in both tables, answered to every slice, once if it asked in parts; and one row of the bucket's totals."""
    owners, sizes = bucket.column("slice").to_pylist(), bucket.column("size").to_pylist()
    held = [unpack(d, 3, n) for d, n in zip(bucket.column("data").to_pylist(), sizes)]
    key, at = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
    ours = np.repeat([s is not None for s in owners], sizes)
    both = [np.concatenate([x[c] for x in held]).view(np.int64) for c in (1, 2)]
    # n of the target, n of the background, last of the target, last of the background
    counts = [np.bincount(at[side], c[side], len(key)).astype(np.int64) for c in both for side in (~ours, ours)]
    cuts = np.r_[0, np.cumsum(sizes)]
    asked_at: dict[int, list[np.ndarray]] = {}
    for s, a, b in zip(owners, cuts, cuts[1:]):
        if s is not None:
            asked_at.setdefault(s, []).append(at[a:b])
    rows = []
    for s, parts in asked_at.items():
        own = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
        rows.append((s, len(own), pack([c[own] for c in counts])))
    word = (key & U(1)).astype(bool)
    totals = [int(word.sum()), *(int(c[word].sum()) for c in counts)]
    none = [None] * len(rows)
    columns = [pa.array([r[0] for r in rows] + [None], pa.int64()), pa.array([bucket.column("bucket")[0].as_py()] * (len(rows) + 1), pa.int32()), pa.array([r[1] for r in rows] + [0], pa.int32()), pa.array([r[2] for r in rows] + [None], pa.binary())]
    return pa.table([*columns, *(pa.array([*none, t], pa.int64()) for t in totals)], ["slice", "bucket", "size", "data", *TOTALS])


TOTALS = ("n_words", "n_target", "n_background", "texts_target", "texts_background")


def bits(pair: np.ndarray, word: np.ndarray, before: np.ndarray, n: float, distinct: float, prior: float) -> np.ndarray:
    """-log2 P(word | previous) of counts: of the pair, the word, the previous word, all words, and distinct words."""
    return -np.log2((pair + prior * (word + 1) / (n + distinct)) / (before + prior))


def losses(counts: DataFrame, size: int, prior: float = PRIOR) -> np.ndarray:
    """A model as one dense table of (previous, word), flat, for few words: the last id is the start mark."""
    found = counts.toArrow()
    table = np.zeros(size * size)
    table[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    table = table.reshape(size, size)
    single = table.sum(axis=0)
    single[-1] = -1  # the start mark never follows
    with np.errstate(divide="ignore"):
        return bits(table, single, table.sum(axis=1, keepdims=True), table.sum(), size - 1, prior).astype(np.float32).ravel()


def cross_entropy_difference(target: DataFrame, background: DataFrame, vocabulary: int | None = None, prior: float = PRIOR, limit: int = SLICE) -> DataFrame:
    """For every background document: doc_id, n_words, target_loss, background_loss (bits a word), difference.

    vocabulary: where given, only so many of the most frequent words are told apart."""
    top = None
    if vocabulary is not None:
        top = shared_vocabulary(word_counts(target.select("text").unionByName(background.select("text"))), vocabulary)
    texts = stored(sliced(background, limit), "slices")
    size = sum(df.agg(F.sum(n)).first()[0] or 0 for df, n in ((texts, F.col("n_bytes")), (target, F.octet_length("text"))))
    buckets = max(BUCKETS, -(-size // BUCKET_BYTES))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for owner, own in runs(batches):
            yield from asked(owner, Keyed(scan(own), top), buckets)

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=limit):
            yield from asked(None, Keyed(scan(batch.column("text")), top), buckets)

    requests = texts.select("slice", "text").mapInArrow(ask, REQUEST).unionByName(target.select(text_column().alias("text")).mapInArrow(tell, REQUEST))
    answers = stored(requests.groupBy("bucket").applyInArrow(summed, ", ".join([REQUEST, *(f"{t} long" for t in TOTALS)])), "answers")
    distinct, *total = (x or 0 for x in answers.agg(*[F.sum(t) for t in TOTALS]).first())

    def score(mine: pa.Table, got: pa.Table) -> pa.Table:
        ids, held = mine.column("doc_id").combine_chunks(), scan(mine.column("text").combine_chunks())
        keyed, n, doc = Keyed(held, top), np.diff(held.of), held.doc()
        got = got.sort_by("bucket")
        parts = [unpack(d, 4, k).view(np.int64) for d, k in zip(got.column("data").to_pylist(), got.column("size").to_pylist())]
        counts = np.concatenate([np.zeros((4, 0), np.int64), *parts], axis=1)
        if counts.shape[1] != len(keyed.key):
            raise ValueError(f"{counts.shape[1]} answers to {len(keyed.key)} keys")
        each = []
        for m in (0, 1):
            c, last = counts[m], counts[2 + m]
            before = np.where(keyed.before < 0, total[2 + m], (c - last)[keyed.before] if len(c) else 0)
            loss = bits(c[keyed.pair], c[keyed.word], before, total[m], distinct, prior)
            each.append(pa.array(np.bincount(doc, loss, len(n)) / np.maximum(1, n), mask=n == 0))
        return pa.table([ids, pa.array(n, pa.int64()), *each], ["doc_id", "n_words", "target_loss", "background_loss"])

    asking = answers.filter("slice is not null").select("slice", "bucket", "size", "data")
    scored = texts.select("slice", "doc_id", "text").groupBy("slice").cogroup(asking.groupBy("slice")).applyInArrow(score, "doc_id long, n_words long, target_loss double, background_loss double")
    return scored.withColumn("difference", F.col("target_loss") - F.col("background_loss"))
