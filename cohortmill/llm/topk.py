"""Exact top-k inner-product search: a ball tree for each shard, searched best bound first.

Vectors near each other come to the same shards: each goes to the nearest of a bounded number of pivots (PIVOTS of
the rows, the first by a hash of their keys), and a pivot's vectors are dealt to as many shards as their number needs, so
one direction that holds a third of all rows is many shards. Shards hold a bounded number of vectors and travel as packed
rows; queries travel in packed blocks that are made the same way. A pilot round over one near shard gives each query a
first k-th score. The shards' root balls, packed too, are then held against each block: only a shard whose
inner-product bound reaches some query's k-th score meets that block, best bound first, and the k-th scores rise from shard
to shard.

Every row has a key of its own, so a query is every row but itself against: rows of equal id are candidates for each other
and answered one by one. Null vectors and those holding null or non-finite components take no part. Vectors of different lengths are not
compared. Equal scores go to the smaller id, then the smaller row key. An empty table gives no rows. Scores outside 64
bits are clamped to that range. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

PACKED = "part int, piece int, cluster int, dim int, n int, ids binary, keys binary, data binary, bounds binary, nodes binary"
EXACT, PIVOTS, ROOTS = float(2**53), 256, 4096


def quantised(matrix: np.ndarray, scale: float) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.floor(matrix.astype(np.float64) * scale)


def ball_tree(points: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Returns the order of the points, (first, end, left child, right child) of each node, and radius plus centre."""
    order, nodes, balls, todo = np.arange(len(points)), [], [], [(0, len(points), -1, 0)]
    while todo:
        lo, hi, parent, side = todo.pop()
        own = points[order[lo:hi]]
        centre = own.mean(axis=0)
        away = np.sqrt(((own - centre) ** 2).sum(axis=1))
        k = len(nodes)
        nodes.append([lo, hi, -1, -1])
        balls.append(np.concatenate([[away.max()], centre]))
        if parent >= 0:
            nodes[parent][2 + side] = k
        if hi - lo > leaf and away.max() > 0:
            a = own[away.argmax()]
            b = own[((own - a) ** 2).sum(axis=1).argmax()]
            middle = (hi - lo) // 2
            order[lo:hi] = order[lo:hi][np.argpartition(own @ (b - a), middle)]
            todo += [(lo, lo + middle, k, 0), (lo + middle, hi, k, 1)]
    return order, np.array(nodes, np.int32), np.array(balls, np.float64)


def margins(queries: np.ndarray, centres: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """(queries, balls): no point of the ball has a larger inner product, with room for rounding."""
    reach = np.sqrt((queries**2).sum(axis=1))
    bound = queries @ centres.T + reach[:, None] * radius
    return bound + 1e-9 * reach[:, None] * (radius + np.sqrt((centres**2).sum(axis=1))) + 1e-6


class Found:
    """The best k of each query so far: scores, with ids and row keys."""

    def __init__(self, n: int, k: int):
        self.scores = np.full((n, k), -np.inf)
        self.ids, self.keys = np.full((n, k), -1, np.int64), np.full((n, k), -1, np.int64)

    def add(self, live: np.ndarray, got: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> None:
        k = self.scores.shape[1]
        s = np.concatenate([self.scores[live], got], axis=1)
        i, r = (np.concatenate([old[live], np.broadcast_to(new, got.shape)], axis=1) for old, new in ((self.ids, ids), (self.keys, keys)))
        best = np.lexsort((r, i, -s), axis=1)[:, :k]
        self.scores[live], self.ids[live], self.keys[live] = (np.take_along_axis(x, best, 1) for x in (s, i, r))


def search(queries: np.ndarray, own: np.ndarray, found: Found, floor: np.ndarray, shard: dict) -> np.ndarray:
    """Adds the shard's best rows to `found` and returns the raised k-th scores. own: the queries' row keys."""
    nodes = shard["nodes"]
    bound = margins(queries, shard["balls"][:, 1:], shard["balls"][:, 0])
    heap = [(-bound[:, 0].max(), 0)]
    while heap:
        _, at = heapq.heappop(heap)
        live = np.flatnonzero(bound[:, at] >= floor)
        if not len(live):
            continue
        lo, hi, left, right = nodes[at]
        if left >= 0:
            for child in (left, right):
                heapq.heappush(heap, (-bound[live, child].max(), child))
            continue
        got = queries[live] @ shard["points"][lo:hi].T
        got[own[live, None] == shard["keys"][lo:hi]] = -np.inf
        use = (got >= floor[live, None]).any(axis=1) & (got.max(axis=1) > -np.inf)
        live, got = live[use], got[use]
        if len(live):
            found.add(live, got, shard["ids"][lo:hi], shard["keys"][lo:hi])
            floor[live] = np.maximum(floor[live], found.scores[live, -1])
    return floor


def search_large(queries: np.ndarray, own: np.ndarray, found: Found, shard: dict) -> None:
    """The same for components so large that sums of products leave the exact range of doubles: whole numbers of any size."""
    k, low, high = found.scores.shape[1], -(2**63), 2**63 - 1
    exact = [[int(x) for x in p] for p in shard["points"]]
    for row, q in enumerate(queries):
        q = [int(x) for x in q]
        rows = [(-min(max(sum(a * b for a, b in zip(q, p)), low), high), int(i), int(r)) for p, i, r in zip(exact, shard["ids"], shard["keys"]) if r != own[row]]
        rows += [(-int(s), int(i), int(r)) for s, i, r in zip(found.scores[row], found.ids[row], found.keys[row]) if s != -np.inf]
        for c, (s, i, r) in enumerate(sorted(rows)[:k]):
            found.scores[row, c], found.ids[row, c], found.keys[row, c] = -s, i, r


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = batch.column("vector").value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes):
        yield int(dim), batch.filter(pa.array(sizes == dim))


def _pack(rows: int, leaf: int, scale: float, trees: bool):
    columns = [c.split() for c in PACKED.split(", ")]
    schema = pa.schema([(name, {"int": pa.int32(), "binary": pa.binary()}[kind]) for name, kind in columns])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, waiting, made = TaskContext.get().partitionId(), {}, 0

        def packed(cluster: int, dim: int, ids: np.ndarray, keys: np.ndarray, matrix: np.ndarray) -> pa.RecordBatch:
            nonlocal made
            points = quantised(matrix, scale)
            nodes, balls = np.zeros((0, 4), np.int32), np.zeros((0, dim + 1))
            if trees:
                order, nodes, balls = ball_tree(points, leaf)
                ids, keys, points = ids[order], keys[order], points[order]
            kind = "<i2" if not points.size or np.abs(points).max() < 2**15 else "<f8"
            row = (part, made, cluster, dim, len(ids), ids.tobytes(), keys.tobytes(), kind.encode() + points.astype(kind).tobytes(), balls.tobytes(), nodes.tobytes())
            made += 1
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, row))], schema)

        for batch in batches:
            for dim, own in _by_length(batch):
                clusters = own.column("cluster").to_numpy()
                ids, keys, matrix = own.column("id").to_numpy(), own.column("key").to_numpy(), _matrix(own.column("vector"), dim)
                for c in np.unique(clusters):
                    held = waiting.setdefault((int(c), dim), [[], 0])
                    held[0].append([x[clusters == c] for x in (ids, keys, matrix)])
                    held[1] += len(held[0][-1][0])
                    if held[1] >= rows:
                        whole = [np.concatenate(x) for x in zip(*held[0])]
                        cut = held[1] // rows * rows
                        for k in range(0, cut, rows):
                            yield packed(int(c), dim, *(x[k : k + rows] for x in whole))
                        waiting[int(c), dim] = [[[x[cut:] for x in whole]], held[1] - cut]
        for (c, dim), (held, n) in waiting.items():
            if n:
                yield packed(c, dim, *(np.concatenate(x) for x in zip(*held)))

    return pack


def _points(row, prefix: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, n, dim = row[prefix + "data"], row[prefix + "n"], row[prefix + "dim"]
    ids, keys = (np.frombuffer(row[prefix + c], np.int64) for c in ("ids", "keys"))
    return ids, keys, np.frombuffer(data[3:], data[:3].decode()).astype(np.float64).reshape(n, dim)


def _searched(k: int, floors_only: bool):
    """Rows come sorted by query block, best bound first; a block's results and k-th scores are carried from shard to shard."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, ids, own, queries, found, floor, large = None, None, None, None, None, None, False

        def done() -> pd.DataFrame:
            if floors_only:
                return pd.DataFrame({"block": [block], "floor": [floor.tobytes()]})
            r, c = np.nonzero(found.scores != -np.inf)
            return pd.DataFrame({"query_key": own[r], "query_id": ids[r], "vec_id": found.ids[r, c], "vec_key": found.keys[r, c], "score": found.scores[r, c].astype(np.int64)})

        for batch in batches:
            for row in batch.to_dict("records"):
                if row["block"] != block:
                    if block is not None:
                        yield done()
                    block = row["block"]
                    ids, own, queries = _points(row, "q_")
                    found = Found(len(own), k)
                    floor, large = np.full(len(own), -np.inf), False
                    if row.get("floor") is not None:
                        floor = np.frombuffer(row["floor"], np.float64).copy()
                if row["q_dim"] != row["dim"]:
                    continue
                theirs, keys, points = _points(row)
                shard = {"ids": theirs, "keys": keys, "points": points, "nodes": np.frombuffer(row["nodes"], np.int32).reshape(-1, 4), "balls": np.frombuffer(row["bounds"], np.float64).reshape(-1, row["dim"] + 1)}
                most = float(np.abs(queries).max(initial=0)) * float(np.abs(points).max(initial=0)) * max(1, row["dim"])
                if most >= EXACT or large:
                    if not large:
                        large, found.scores = True, found.scores.astype(object)
                    search_large(queries, own, found, shard)
                else:
                    floor = search(queries, own, found, floor, shard)
        if block is not None:
            yield done()

    return run


def _reached(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(block, shard, bound) of the shards whose root balls may hold a k-th score of a query in the block."""
    for batch in batches:
        for row in batch.to_dict("records"):
            _, _, queries = _points(row, "q_")
            roots = np.frombuffer(row["roots"], np.float64).reshape(-1, row["q_dim"] + 1)
            shards = np.frombuffer(row["shards"], np.int64)
            floor = np.full(len(queries), -np.inf) if row["floor"] is None else np.frombuffer(row["floor"], np.float64)
            bound = margins(queries, roots[:, 1:], roots[:, 0])
            hit = np.flatnonzero((bound >= floor[:, None]).any(axis=0) | ~np.isfinite(bound).all(axis=0))
            yield pd.DataFrame({"block": row["block"], "shard": shards[hit], "bound": bound[:, hit].max(axis=0, initial=-np.inf)})


def _roots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Root balls of the shards, ROOTS to a row."""
    held: dict[int, list] = {}

    def row(dim: int) -> pd.DataFrame:
        own = held.pop(dim)
        return pd.DataFrame({"dim": [dim], "shards": [np.array([s for s, _ in own], np.int64).tobytes()], "roots": [b"".join(b for _, b in own)]})

    for batch in batches:
        for shard, dim, root in zip(batch["shard"], batch["dim"], batch["root"]):
            held.setdefault(dim, []).append((shard, root))
            if len(held[dim]) == ROOTS:
                yield row(dim)
    for dim in list(held):
        yield row(dim)


def clustered(rows: DataFrame, size: int) -> DataFrame:
    """Adds cluster: the nearest of some rows of the same length, one for each `size` rows, PIVOTS at most. They alone reach the driver."""
    some = min(PIVOTS, -(-rows.count() // size))
    chosen = rows.select("key", "vector").orderBy(F.xxhash64("key"), "key").limit(some).toArrow()
    pivots = {}
    for vector in chosen.column("vector").to_pylist():
        pivots.setdefault(len(vector), []).append(vector)
    pivots = {dim: np.array(own, np.float64).reshape(len(own), dim) for dim, own in pivots.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, own in _by_length(batch):
                cluster = np.zeros(own.num_rows, np.int32)
                if dim in pivots:
                    with np.errstate(over="ignore", invalid="ignore"):
                        away = (pivots[dim] ** 2).sum(axis=1) - 2 * _matrix(own.column("vector"), dim) @ pivots[dim].T
                    cluster = np.nan_to_num(away).argmin(axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(cluster)], [*own.schema.names, "cluster"])

    return rows.mapInArrow(run, "key long, id long, vector array<double>, asks boolean, cluster int")


def exact_topk(vectors: DataFrame, chosen: Column, k: int = 20, scale: float = 64.0, shard_rows: int = 8192, leaf_rows: int = 128, block_rows: int = 1024) -> DataFrame:
    """vectors: (id long, vector array<float>); chosen: which of the rows are queries too. Returns query_id, rank from 1, vec_id, score,
    and the row keys query_key and vec_key that tell rows of one id apart."""
    rows = vectors.select(F.monotonically_increasing_id().alias("key"), F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"), F.coalesce(chosen, F.lit(False)).alias("asks"))
    usable = F.col("id").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = stored(clustered(stored(rows.filter(usable), "vectors"), shard_rows), "clusters")

    def packs(own: DataFrame, size: int, trees: bool, name: str) -> DataFrame:
        """Packed rows of one cluster and length each; a cluster is dealt to as many tasks as it has packs."""
        counts = {r["cluster"]: r["n"] for r in own.groupBy("cluster").agg(F.count("*").alias("n")).collect()}  # at most PIVOTS rows
        salts = [max(1, -(-counts.get(c, 0) // size)) for c in range(PIVOTS)]
        salt = F.pmod(F.xxhash64("key"), F.get(F.array(*map(F.lit, salts)), F.col("cluster")))
        dealt = own.drop("asks").repartition(max(1, sum(s for c, s in enumerate(salts) if c in counts)), "cluster", salt)
        return stored(dealt.mapInArrow(_pack(size, leaf_rows, scale, trees), PACKED), name)

    number = (F.shiftleft(F.col("part").cast("long"), 32) + F.col("piece")).alias
    shards = packs(rows, shard_rows, True, "ball-trees").select(number("shard"), "cluster", "dim", "n", "ids", "keys", "data", "bounds", "nodes")
    blocks = packs(rows.filter("asks"), block_rows, False, "query-blocks").select(number("block"), "cluster", *[F.col(c).alias(f"q_{c}") for c in ("dim", "n", "ids", "keys", "data")])
    near = shards.groupBy("cluster", F.col("dim").alias("q_dim")).agg(F.min("shard").alias("shard"))
    pilot = blocks.join(near, ["cluster", "q_dim"]).drop("cluster").join(shards.drop("cluster"), "shard")
    floors = stored(pilot.repartition("block").sortWithinPartitions("block").mapInPandas(_searched(k, True), "block long, floor binary"), "first-scores")
    blocks = blocks.drop("cluster").join(floors, "block", "left")
    root = F.substring(F.col("bounds"), F.lit(1), ((F.col("dim") + 1) * 8).cast("int")).alias("root")
    roots = stored(shards.select("shard", "dim", root).mapInPandas(_roots, "dim int, shards binary, roots binary"), "root-balls")
    pairs = stored(blocks.join(roots, F.col("q_dim") == F.col("dim")).mapInPandas(_reached, "block long, shard long, bound double"), "block-shards")
    every = pairs.join(blocks, "block").join(shards.drop("cluster"), "shard")
    found = every.sortWithinPartitions("block", F.desc("bound")).drop("bound").mapInPandas(_searched(k, False), "query_key long, query_id long, vec_id long, vec_key long, score long")
    best = Window.partitionBy("query_key").orderBy(F.desc("score"), "vec_id", "vec_key")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", "query_key", "vec_key")
