"""Least squares from sums that Spark gathers, and a bootstrap over groups of bounded summaries."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cross_products(rows: DataFrame, by: list[str], y: str, xs: list[str]) -> DataFrame:
    """n, and the sums of products of every pair of (1, xs, y), as columns s_i_j."""
    cols = [F.lit(1.0), *[F.col(x).cast("double") for x in xs], F.col(y).cast("double")]
    sums = [F.sum(cols[i] * cols[j]).alias(f"s_{i}_{j}") for i in range(len(cols)) for j in range(i, len(cols))]
    return rows.dropna(subset=[y, *xs]).groupBy(*by).agg(F.count("*").alias("n"), *sums)


def least_squares(rows: DataFrame, by: list[str], y: str, xs: list[str]) -> DataFrame:
    """(by, term, estimate, se, r2, n) by group; a column that depends on others gets its pseudo-inverse share."""
    names, k = ["intercept", *xs], len(xs) + 2
    schema = ", ".join([*(f"{b} {rows.schema[b].dataType.simpleString()}" for b in by), "term string", "estimate double", "se double", "r2 double", "n long"])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in pdf.to_dict("records"):
            m = np.array([[row[f"s_{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])
            a, b, n = m[:-1, :-1], m[:-1, -1], row["n"]
            scale = np.sqrt(np.maximum(np.diag(a), 1e-300))
            inverse = np.linalg.pinv(a / np.outer(scale, scale), rcond=1e-10, hermitian=True) / np.outer(scale, scale)
            beta = inverse @ b
            rss, tss = max(0.0, m[-1, -1] - beta @ b), m[-1, -1] - m[0, -1] ** 2 / n
            se = np.sqrt(np.maximum(0, np.diag(inverse) * rss / max(1, n - len(names))))
            out += [{**{g: row[g] for g in by}, "term": t, "estimate": e, "se": s, "r2": 1 - rss / tss if tss > 0 else None, "n": n} for t, e, s in zip(names, beta, se)]
        return pd.DataFrame(out, columns=[*by, "term", "estimate", "se", "r2", "n"])

    sums = cross_products(rows, by, y, xs)
    return sums.groupBy(*by).applyInPandas(solve, schema)  # one row of sums for each group


def contrasts(rows: DataFrame, bucket: str, reference: str, y: str, xs: list[str], least: int = 50) -> DataFrame:
    """Each bucket against the reference by ordinary least squares over xs: n, beta of the bucket, its 95 % interval, z and normal p.

    Sums of products by bucket are all that is needed: a contrast adds the bucket's sums to the reference's, and its indicator's
    products are the bucket's own sums. Regressors that do not vary drop out; under `least` rows there is no contrast."""
    k = len(xs) + 2
    names = [f"s_{i}_{j}" for i in range(k) for j in range(i, k)]
    sums = cross_products(rows, [bucket], y, xs)
    other = sums.filter(F.col(bucket) == reference).select(F.col("n").alias("o_n"), *[F.col(c).alias(f"o_{c}") for c in names])
    both = sums.filter(F.col(bucket) != reference).join(F.broadcast(other))  # one row
    schema = f"{bucket} string, n long, beta double, lo double, hi double, z double, p double"

    def solve(batches):
        from math import erfc, sqrt

        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                n = int(row["n"] + row["o_n"])
                if n < least:
                    continue
                own, ref = ([[row[f"{o}s_{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)] for o in ("", "o_"))
                own, ref = np.array(own), np.array(ref)
                m = np.zeros((k + 1, k + 1))  # the indicator first, then 1, xs, y
                m[1:, 1:], m[0, 1:], m[1:, 0], m[0, 0] = own + ref, own[0], own[0], row["n"]
                a, b = m[:-1, :-1], m[:-1, -1]
                scale = np.sqrt(np.maximum(np.diag(a), 1e-300))
                values, vectors = np.linalg.eigh(a / np.outer(scale, scale))
                keep = values > 1e-10 * values.max()
                inverse = (vectors[:, keep] / values[keep]) @ vectors[:, keep].T / np.outer(scale, scale)
                beta = inverse @ b
                rss = max(0.0, m[-1, -1] - beta @ b)
                se = sqrt(max(0.0, inverse[0, 0]) * rss / max(1, n - int(keep.sum())))
                z = beta[0] / se if se > 0 else 0.0
                out.append((row[bucket], n, beta[0], beta[0] - 1.96 * se, beta[0] + 1.96 * se, z, erfc(abs(z) / sqrt(2))))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    return both.mapInPandas(solve, schema)


def fit_quality(rows: DataFrame, y: str, xs: list[str]) -> DataFrame:
    """n, r2 and adjusted r2 of one pooled fit; columns that depend on others do not count as regressors in the solution, but in k."""
    one = least_squares(rows.withColumn("_all", F.lit("all")), ["_all"], y, xs).filter("term = 'intercept'")
    return one.select("n", "r2", (1 - F.try_divide((1 - F.col("r2")) * (F.col("n") - 1), F.col("n") - len(xs) - 1)).alias("adj_r2"))


def poisson_weights(keys: np.ndarray, resamples: int) -> np.ndarray:
    """(keys, resamples): Poisson counts of mean 1, each from a hash of its key and the resample's number alone."""
    with np.errstate(over="ignore"):
        h = keys[:, None] + np.arange(1, resamples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
    chance, below = np.exp(-1.0), []
    total = 0.0
    for k in range(20):
        total += chance
        chance /= k + 1
        below.append(total)
    return np.searchsorted(np.array(below), (h >> np.uint64(11)).astype(np.float64) / 2**53, side="right").astype(np.float64)


def bootstrap_mean(rows: DataFrame, by: str, value: str, weight: str, key: str, resamples: int = 2000, floor: int = 1) -> DataFrame:
    """Mean and weighted mean of each group, each with a 95 % percentile interval over resamples; groups under the floor have only n.

    Every row gets a Poisson count in each resample from a hash of its key alone, so neither partitions nor batches matter; tasks
    sum counts and values by group for themselves, so no group meets in one task."""
    names = ["c", "cv", "w", "wv"]
    sums = f"{by} {rows.schema[by].dataType.simpleString()}, draw int, " + ", ".join(f"{x} double" for x in names)

    def draw(batches):
        held: dict = {}

        def flush():
            for g, own in held.items():
                yield pd.DataFrame({by: g, "draw": np.arange(resamples, dtype=np.int32), **dict(zip(names, own))})
            held.clear()

        for batch in batches:
            for g, part in batch.groupby(by, dropna=False):
                own = held.setdefault(g, np.zeros((4, resamples)))
                for i in range(0, len(part), 500):
                    cut = part.iloc[i : i + 500]
                    v, w = cut[value].to_numpy(), cut[weight].to_numpy()
                    own += np.stack([np.ones(len(cut)), v, w, w * v]) @ poisson_weights(cut["_k"].to_numpy().view(np.uint64), resamples)
            if len(held) > 500:
                yield from flush()
        yield from flush()

    keyed = rows.filter(F.col(value).isNotNull() & F.col(weight).isNotNull()).select(F.col(by), F.col(value).cast("double").alias(value), F.col(weight).cast("double").alias(weight), F.xxhash64(key).alias("_k"))
    means = keyed.mapInPandas(draw, sums).groupBy(by, "draw").agg(F.try_divide(F.sum("cv"), F.sum("c")).alias("m"), F.try_divide(F.sum("wv"), F.sum("w")).alias("wm"))
    ends = [F.round(F.percentile(c, F.lit(q)), 6).alias(name) for c, q, name in (("m", 0.025, "low"), ("m", 0.975, "high"), ("wm", 0.025, "weighted_low"), ("wm", 0.975, "weighted_high"))]
    interval = means.groupBy(by).agg(*ends)
    plain = rows.filter(F.col(value).isNotNull()).groupBy(by).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(weight)).alias("weighted_mean"))
    shown = lambda c: F.when(F.col("n") >= floor, F.col(c)).alias(c)
    return plain.join(interval, by, "left").select(by, "n", *map(shown, ["mean", "low", "high", "weighted_mean", "weighted_low", "weighted_high"]))
