"""Near-duplicates by BagMinHash: weighted signatures, bands, verification of the multiset overlap, classes.

A text is the multiset of its five-word shingles. Each shingle has hierarchical Poisson processes over its weight range,
cut at 1, 2, 4, 8 and so on: those below the weight count whole, the one around it by the points that fall below.
The earliest point of each component over all shingles is the signature; two of them agree with the probability of the
weighted Jaccard likeness. Bands of equal components name candidates, whose multisets are then compared exactly.

Texts of equal multisets (by 128 bits) are one item from the start, so copies cost nothing further. A bucket of items is
not expanded into its pairs: all are compared with its most central one, and links to that join most of a group at once.
Two others can be alike only if their distances from it differ by no more than 0.2, as the weighted Jaccard distance is a
metric. So the items around one such centre that links leave apart go to blocks by their distance, a bounded number and
size to each; within a block all multisets are compared exactly, as products of matrices. No row stands for a pair
that is no link. The bands alone can miss a pair: at a likeness of 0.8 with a chance of 5 in 100,000, above it with less.

Every row gets a key of its own that is written before anything is signed; signatures, texts and classes go by it, so
repeated ids and null ids are rows like others. Null texts count as empty. All texts without words are one class; a text
of one to four words is one shingle. The first row of a class has its least doc_id, null ids last, then the least row key;
of centres that hold equally much the one with the largest key is taken. A long text is one row and is held whole: a task
has those of a batch, a chunk or a block at a time. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pretok import mixed
from .shared import slices, stored, text_column, unused
from .textscan import scan, shingles

WORDS, LEAST, BANDS, ROWS, CHUNK, BLOCK, BLOCK_BYTES, COLUMNS = 5, 0.8, 25, 5, 32, 128, 4 << 20, 4096
U = np.uint64


def bags(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted (text index, shingle, count)."""
    doc, h = shingles(scan(texts), words)
    near = doc.astype(U) << U(44) | h >> U(20)  # one key sorts faster than two; what it leaves open is rare
    order = np.argsort(near)
    same = near[order[1:]] == near[order[:-1]]
    if (h[order[1:]] != h[order[:-1]])[same].any() or len(texts) > 1 << 20:
        order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]) if len(h) else np.zeros(0, np.int64)
    return doc[first], h[first], np.diff(np.r_[first, len(h)])


def bag_min_hash(doc: np.ndarray, item: np.ndarray, weight: np.ndarray, n: int, size: int) -> np.ndarray:
    """Signatures (n, size): arrival times, inf where a text has no points."""
    out = np.full(n * size, np.inf)
    nodes = [(doc, item, np.zeros(len(doc), U), np.ones(len(doc)), np.ones(len(doc)))]
    low = 1
    while len(more := np.flatnonzero(weight > low)):
        share = np.minimum(1.0, (weight[more] - low) / low)
        nodes.append((doc[more], item[more], np.full(len(more), low, U), np.full(len(more), float(low)), share))
        low *= 2
    doc, item, node, rate, share = (np.concatenate(x) for x in zip(*nodes))
    seed = mixed(item * U(0x9E3779B97F4A7C15) + node)
    time, limit, point = np.zeros(len(doc)), np.full(n, np.inf), 0
    while len(doc):
        point += 1
        a = mixed(seed + U((0xD1B54A32D192ED03 * point) & (2**64 - 1)))
        b = a * U(0xC2B2AE3D27D4EB4F) + U(1)
        b ^= b >> U(29)
        time = time - np.log(((a >> U(11)).astype(np.float64) + 0.5) / 2**53) / rate
        live = time <= limit[doc]
        if not live.all():
            doc, seed, rate, share, time, b = (x[live] for x in (doc, seed, rate, share, time, b))
        part = share < 1
        at = doc * size + (b & U(0xFFFFFFFF)).astype(np.int64) * size // 2**32
        hit = ~part | ((b >> U(32)).astype(np.float64) / 2**32 < share) if part.any() else slice(None)
        np.minimum.at(out, at[hit], time[hit])
        limit = out.reshape(n, size).max(axis=1)
    return out.reshape(n, size)


def bag_ids(doc: np.ndarray, item: np.ndarray, count: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two times 64 bits that stand for each text's multiset."""
    at, times = np.searchsorted(doc, np.arange(n + 1)), mixed(count.astype(U))
    out = []
    for spread in (mixed(item * U(3) + times), mixed((item ^ U(0x5851F42D4C957F2D)) * U(5) + times)):
        total = np.r_[np.zeros(1, U), np.cumsum(spread, dtype=U)]
        out.append(mixed(total[at[1:]] - total[at[:-1]]).view(np.int64))
    return out[0], out[1]


def signatures(documents: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """row, doc_id, hi and lo (longs that stand for the multiset), bands array<long>; no bands without words."""
    size = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=2 << 20):
            n = batch.num_rows
            doc, item, count = bags(batch.column("text"), words)
            bits = bag_min_hash(doc, item, count, n, size).view(U).reshape(n, bands, rows)
            key = np.zeros((n, bands), U)
            for r in range(rows):
                key = mixed(key + bits[:, :, r])
            key = mixed(key + np.arange(bands, dtype=U)).view(np.int64)
            some = np.bincount(doc, minlength=n) > 0
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(some * bands)], pa.int32()), pa.array(key[some].ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), *map(pa.array, bag_ids(doc, item, count, n)), lists], ["row", "doc_id", "hi", "lo", "bands"])

    return documents.select("row", "doc_id", "text").mapInArrow(run, "row long, doc_id long, hi long, lo long, bands array<long>")


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard likeness of two (sorted shingles, counts)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    whole = int(a[1].sum()) + int(b[1].sum()) - both
    return both / whole if whole else 1.0


class Held:
    """The multisets of some texts."""

    def __init__(self, texts: pa.Array, words: int):
        self.n = len(texts)
        self.doc, self.item, self.count = bags(texts, words)
        self.at = np.searchsorted(self.doc, np.arange(self.n + 1))

    def bag(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        return self.item[self.at[k] : self.at[k + 1]], self.count[self.at[k] : self.at[k + 1]]

    def likenesses(self) -> np.ndarray:
        """(n, n), all exact. The lesser of two counts is the number of levels that both reach, so every level adds a
        product of matrices of zeros and ones, some columns (shingles) at a time."""
        seen, at, often = np.unique(self.item, return_inverse=True, return_counts=True)
        both, level = np.zeros((self.n, self.n)), 0
        for c in np.unique(self.count[often[at] > 1]):
            use = np.flatnonzero((self.count >= c) & (often[at] > 1))
            use = use[np.argsort(at[use], kind="stable")]
            column = np.cumsum(np.r_[0, np.diff(at[use]) != 0])
            for k in range(0, column[-1] + 1, COLUMNS):
                a, b = np.searchsorted(column, (k, k + COLUMNS))
                part = np.zeros((self.n, COLUMNS), np.float32)
                part[self.doc[use[a:b]], column[a:b] - k] = 1
                both += (c - level) * (part @ part.T)
            level = c
        size = np.bincount(self.doc, self.count, self.n)
        return both / np.maximum(1, size[:, None] + size - both)


def _comparison(words: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """left: the texts to compare in this chunk; right: the one they are compared with."""
        n = left.num_rows if right.num_rows else 0
        texts = [c.cast(pa.string()) for c in (*right.column("text_a").chunks, *left.column("text_b").chunks)]
        held = Held(pa.concat_arrays([pa.array([], pa.string()), *texts]), words)
        likes = [overlap(held.bag(0), held.bag(1 + k)) for k in range(n)]
        size = left.column("text_b").combine_chunks().cast(pa.binary())
        sizes = [len(x) for x in size.to_pylist()]
        return pa.table([right.column("first").take(pa.array([0] * n, pa.int64())), left.column("b").slice(0, n), pa.array(likes, pa.float64()), pa.array(sizes[:n], pa.int64())], ["a", "b", "likeness", "n_bytes"])

    return run


def _block(words: int, least: float):
    def run(block: pa.Table) -> pa.Table:
        """Links between texts of a block that none joins so far. With two sides, a pair has one of each."""
        items, sides = block.column("item").to_pylist(), block.column("side").to_numpy()
        name, roots = np.unique(block.column("root").to_numpy(), return_inverse=True)
        held = Held(pa.concat_arrays([pa.array([], pa.string()), *(c.cast(pa.string()) for c in block.column("text").chunks)]), words)
        link = np.triu((held.likenesses() >= least) & (roots[:, None] != roots), 1)
        if len(np.unique(sides)) > 1:
            link &= sides[:, None] != sides
        parent = list(range(len(name)))

        def top(r: int) -> int:
            while parent[r] != r:
                parent[r] = parent[parent[r]]
                r = parent[r]
            return r

        out: list[tuple[int, int]] = []
        for i, j in zip(*(x.tolist() for x in np.nonzero(link))):
            x, y = top(int(roots[i])), top(int(roots[j]))
            if x != y:
                parent[x] = y
                out.append((items[i], items[j]))
        return pa.table([pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.int64())], ["a", "b"])

    return run


def verified(pairs: DataFrame, documents: DataFrame, words: int) -> DataFrame:
    """(a, b, likeness, n_bytes of b), exact. Texts b go in chunks to a's text, which travels once for each chunk."""
    loads = pairs.groupBy("a").agg(F.count("*").alias("load"))
    chunked = stored(pairs.join(loads, "a").select("a", F.pmod(F.xxhash64("b"), F.greatest(F.lit(1), F.floor(F.col("load") / CHUNK))).alias("chunk"), "b"), "chunks")
    ours = chunked.join(documents.select(F.col("row").alias("b"), F.col("text").alias("text_b")), "b")
    heads = chunked.select(F.col("a").alias("first"), F.col("chunk").alias("part")).distinct().join(documents.select(F.col("row").alias("first"), F.col("text").alias("text_a")), "first")
    return ours.select("a", "chunk", "b", "text_b").groupBy("a", "chunk").cogroup(heads.groupBy("first", "part")).applyInArrow(_comparison(words), "a long, b long, likeness double, n_bytes long")


def open_links(likes: DataFrame, roots: DataFrame, documents: DataFrame, words: int, least: float) -> DataFrame:
    """(a, b): links between items around one centre that the links to it leave apart."""
    # distance 0 to 0.2 is ring 0: linked to the centre; rings further than one apart hold no links between them
    ring = F.when(F.col("likeness") >= least, 0).otherwise(F.greatest(F.lit(1), F.floor((1 - F.col("likeness")) / (1 - least) + 1e-9))).cast("int")
    named = likes.join(roots.select(F.col("item").alias("b"), "root"), "b", "left")
    around = stored(named.select("a", "b", ring.alias("ring"), "n_bytes", F.coalesce("root", "b").alias("root")), "around")
    held = lambda k: F.col("ring") == k
    blocks = lambda k: F.ceil(F.greatest(F.count(F.when(held(k), 1)) / BLOCK, F.coalesce(F.sum(F.when(held(k), F.col("n_bytes"))), F.lit(0)) / BLOCK_BYTES)).cast("int")
    rings = range(int(1 / (1 - least) + 1e-9) + 1)
    apart = around.groupBy("a").agg(F.min("root").alias("r1"), F.max("root").alias("r2"), F.array(*map(blocks, rings)).alias("parts")).filter("r1 <> r2")
    around = stored(around.join(apart.select("a", "parts"), "a"), "open")
    part = lambda r: F.coalesce(F.get("parts", r), F.lit(0))
    own, ring = F.pmod(F.xxhash64("b"), F.greatest(part(F.col("ring")), F.lit(1))).cast("int"), F.col("ring")
    code = lambda r, c: r.cast("long") * (1 << 32) + c

    def with_ring(other, skip):
        mine = code(ring, own)
        return F.when(skip | (part(other) == 0), F.array().cast("array<struct<lo: bigint, hi: bigint>>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.greatest(part(other) - 1, F.lit(0))), lambda c: F.struct(F.least(mine, code(other, c)).alias("lo"), F.greatest(mine, code(other, c)).alias("hi")))
        )

    every = F.concat(with_ring(ring, ring == 0), with_ring(ring + 1, F.lit(False)), with_ring(ring - 1, ring == 0))
    placed = around.select("a", F.col("b").alias("item"), "root", code(ring, own).alias("side"), F.explode(every).alias("block"))
    placed = placed.join(documents.select(F.col("row").alias("item"), "text"), "item").select("a", "block.lo", "block.hi", "item", "root", "side", "text")
    return placed.groupBy("a", "lo", "hi").applyInArrow(_block(words, least), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(item, root) for all items of the links, root the least item that links reach.

    Alternates two steps until every item hangs on its root alone: larger neighbours are linked to the least one, then
    smaller ones are. Each step is written, so a lost executor costs one step at most, and joins on an item of very many
    links can be split.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v"), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = stored(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        edges = stored(small.select("x.*").filter("u <> v").distinct(), "small-star")
        ends = edges.select(F.explode(F.array(F.struct("u", F.lit(1).alias("out"), F.lit(0).alias("into")), F.struct(F.col("v").alias("u"), F.lit(0).alias("out"), F.lit(1).alias("into")))).alias("x")).select("x.*")
        if ends.groupBy("u").agg(F.sum("out").alias("out"), F.max("into").alias("into")).filter("out > 1 or (out = 1 and into = 1)").isEmpty():
            break
    return edges.select(F.explode(F.array(F.struct(F.col("u").alias("item"), F.col("v").alias("root")), F.struct(F.col("v").alias("item"), F.col("v").alias("root")))).alias("x")).select("x.*").distinct()


def shared_keys(keys: DataFrame) -> DataFrame:
    """Rows (item, key, n) of keys that n items have, several at least."""
    return keys.join(keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "key")


def led(members: DataFrame) -> DataFrame:
    """(a, b) for every other item b of a bucket, a its most central one: the one whose buckets hold most items in all."""
    weights = members.groupBy("item").agg(F.sum("n").alias("weight"))
    weighed = stored(members.join(weights, "item").select("key", "item", "weight"), "weighed")
    firsts = weighed.groupBy("key").agg(F.max(F.struct("weight", "item")).alias("x")).select("key", F.col("x.item").alias("a"))
    return weighed.join(firsts, "key").filter("item <> a").select("a", F.col("item").alias("b")).distinct()


def keyed(documents: DataFrame, name: str) -> DataFrame:
    """The documents, written, with a number for every row."""
    return stored(documents.withColumn(name, F.monotonically_increasing_id()), "rows")


def classes(docs: DataFrame, words: int = WORDS, least: float = LEAST, bands: int = BANDS, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """docs: row, doc_id, text. (row, doc_id, hi, lo) of all, and (hi, lo, item, root, head): an item is named by the least row
    of its multiset; head has the doc_id and row of the item's class that come first."""
    signed = stored(signatures(docs, words, bands, rows), "signatures")
    texts = docs.select("row", "text")
    head = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    items = stored(signed.groupBy("hi", "lo").agg(F.min("row").alias("item"), F.min(head).alias("head")), "items")
    keys = stored(signed.select(F.col("row").alias("item"), "bands").join(items.select("item"), "item").select("item", F.explode("bands").alias("key")), "keys")
    likes = stored(verified(stored(led(stored(shared_keys(keys), "buckets")), "pairs"), texts, words), "likeness")
    links = likes.filter(F.col("likeness") >= least).select("a", "b")
    roots = stored(components(links), "roots")
    more = stored(open_links(likes, roots, texts, words, least), "links")
    if not more.isEmpty():
        roots = stored(components(links.unionByName(more)), "roots")
    named = stored(items.join(roots, "item", "left").withColumn("root", F.coalesce("root", "item")), "classes")
    return signed.select("row", "doc_id", "hi", "lo"), named.drop("head").join(named.groupBy("root").agg(F.min("head").alias("head")), "root")


def near_duplicates(documents: DataFrame, **settings) -> DataFrame:
    """doc_id, class_id (the least doc_id of the class), is_first (it is the row of the class that is kept)."""
    docs = keyed(documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text")), "row")
    signed, named = classes(docs, **settings)
    named = named.select("hi", "lo", F.col("head.doc_id").alias("class_id"), F.col("head.row").alias("first"))
    return signed.join(named, ["hi", "lo"]).select("doc_id", "class_id", (F.col("row") == F.col("first")).alias("is_first"))


def deduplicated(documents: DataFrame, **settings) -> DataFrame:
    """The documents, exactly one row of each class: one of the least doc_id, of a null id only where the class has no other."""
    key = unused(documents, "row")
    held = keyed(documents, key)
    docs = held.select(F.col(key).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    kept = classes(docs, **settings)[1].select(F.col("head.row").alias(key)).distinct()
    return held.join(kept, key, "left_semi").select(*documents.columns)
