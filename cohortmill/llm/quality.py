"""Quality by hierarchical empirical Bayes: a document's own evidence, with posteriors of its path and host as priors.

A linear classifier over binned text statistics is fitted to a bounded sample of labelled documents (SAMPLE ids, the
first by a hash of their ids) and gives every document a probability. Grouped sums of these give each host a posterior
that is shrunk towards the global mean, and each path one that is shrunk towards its host's; the strength of shrinking
follows from the variance between groups. A document's posterior odds are its own odds times its path's odds over the
global ones, the path's and the host's taken without the document itself, so that nothing counts twice.

Null texts count as empty. A null host or path is a group of its own. Labels that repeat an id are combined by their
maximum, null labels are left out; without labels, or with one class only, every probability is one half and nothing is
rejected. Rows are scored one by one: repeated rows, null ids and other columns do no harm; ties do not arise. A very long text
makes a batch of its own. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .linear import Linear, fit
from .shared import slices, stored, text_column
from .textscan import scan
from .toxicity import fitted

SAMPLE, BINS, THRESHOLD = 8192, 16, 0.5
#: Marks whose share of a text is a feature of its own.
MARKS = "|!#%&$*.,;:?\"'()<>{}[]=/\\_-"


@dataclass(frozen=True)
class Evidence:
    """edges: (features, BINS - 1) bin limits; the model's columns are the features' bins."""

    edges: np.ndarray
    model: Linear

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        row, col = binned(statistics(texts), self.edges)
        return self.model.predict(row, col, np.ones(len(row)), len(texts))


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of text statistics for each text; all but the size are shares or means."""
    words = scan(texts)
    n, doc = len(texts), words.doc()
    raw = texts.cast(pa.large_string()).fill_null("")
    at = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + n + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[at[0] : at[-1]] if n else np.zeros(0, np.uint8)
    at = at - at[0] if n else at
    size = np.diff(at)

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(mask)]
        return (total[at[1:]] - total[at[:-1]]) / np.maximum(1, size)

    counts = np.diff(words.of)
    some = np.maximum(1, counts)
    distinct = np.unique(words.hashes ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
    again = np.r_[False, (words.hashes[1:] == words.hashes[:-1]) & (doc[1:] == doc[:-1])] if len(doc) else np.zeros(0, bool)
    letters = (data >= 0x80) | ((data | 0x20) >= ord("a")) & ((data | 0x20) <= ord("z"))
    columns = [
        np.log1p(counts),
        np.bincount(doc[distinct], minlength=n) / some,
        np.bincount(doc, words.ends - words.starts, n) / some,
        np.bincount(doc, again, n) / some,
        share(letters),
        share((data >= ord("A")) & (data <= ord("Z"))),
        share((data >= ord("0")) & (data <= ord("9"))),
        share(data == 10),
        *[share(data == ord(m)) for m in MARKS],
    ]
    return np.stack(columns, axis=1)


def binned(table: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n, k = table.shape
    at = np.stack([np.searchsorted(edges[j], table[:, j], side="right") for j in range(k)], axis=1) + np.arange(k) * BINS
    return np.repeat(np.arange(n), k), at.ravel()


def train_evidence(table: np.ndarray, good: np.ndarray, penalty: float = 2.0) -> Evidence:
    """table: statistics of labelled texts."""
    if not len(table) or good.min() == good.max():
        width = statistics(pa.array([], pa.string())).shape[1]
        return Evidence(np.zeros((width, BINS - 1)), Linear(np.zeros(width * BINS), 0.0))
    # half the limits from each class, so that a rare class's range is resolved as well
    cuts = np.linspace(0, 1, BINS // 2 + 2)[1:-1]
    parts = [np.quantile(table[good == g], cuts, axis=0) for g in (0, 1) if (good == g).any()]
    edges = np.sort(np.concatenate(parts), axis=0)[: BINS - 1].T
    edges = np.pad(edges, ((0, 0), (0, BINS - 1 - edges.shape[1])), constant_values=np.inf)
    row, col = binned(table, edges)
    return Evidence(edges, fit(row, col, np.ones(len(row)), good.astype(float), table.shape[1] * BINS, penalty))


def evidence_model(documents: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Evidence:
    def train(ids: np.ndarray, held: pa.ListArray, y: np.ndarray) -> Evidence:
        return train_evidence(held.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1) if len(ids) else np.zeros((0, 0)), y[:, 0])

    rows = lambda texts: pa.array(statistics(texts).tolist(), pa.list_(pa.float64()))
    return fitted(documents, labels, ["quality"], rows, "array<double>", train, limit)


def probability(model: Evidence, text: Column) -> Column:
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        parts = [model.probabilities(b.column(0)) for b in slices(iter([pa.RecordBatch.from_arrays([texts], ["text"])]))]
        return pa.array(np.concatenate([np.zeros(0), *parts]))

    return score(text)


def _strength(mean: Column) -> Column:
    """How many documents a prior weighs: from the variance of group means beyond what documents alone would make."""
    n, m = F.col("n"), F.col("s") / F.col("n")
    within = F.sum(F.col("ss") - F.col("s") * m) / F.greatest(F.sum(n) - F.count("*"), F.lit(1))
    between = (F.sum(n * (m - mean) ** 2) - within * (F.count("*") - 1)) / F.greatest(F.sum(n) - F.sum(n * n) / F.sum(n), F.lit(1e-9))
    return F.least(F.greatest(within / F.greatest(between, F.lit(1e-9)), F.lit(1.0)), F.lit(1e6))


def posteriors(scored: DataFrame) -> DataFrame:
    """host, path, n, s (sum of p), host_posterior, path_posterior, host_n, host_s, host_weight, path_weight, global_mean, of
    (host, path, p). Sums by path come first, the rest follows from them."""
    paths = stored(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("ss")), "path-sums")
    sums = [F.sum(c).alias(c) for c in ("n", "s", "ss")]
    hosts = paths.groupBy("host").agg(*sums)
    total = hosts.agg(*sums).first()
    mean = (total["s"] or 0.0) / (total["n"] or 1)
    host_weight = hosts.agg(_strength(F.lit(mean)).alias("k")).first()["k"] or 1.0
    hosts = hosts.select(F.col("host").alias("h"), F.col("n").alias("host_n"), F.col("s").alias("host_s"), ((host_weight * mean + F.col("s")) / (host_weight + F.col("n"))).alias("host_posterior"))
    paths = paths.join(hosts, F.col("host").eqNullSafe(F.col("h"))).drop("h")
    path_weight = paths.agg(_strength(F.col("host_posterior")).alias("k")).first()["k"] or 1.0
    path = (path_weight * F.col("host_posterior") + F.col("s")) / (path_weight + F.col("n"))
    weights = F.lit(float(host_weight)).alias("host_weight"), F.lit(float(path_weight)).alias("path_weight"), F.lit(float(mean)).alias("global_mean")
    return paths.select("host", "path", "n", "s", "host_n", "host_s", "host_posterior", path.alias("path_posterior"), *weights)


def combined(p: Column, path: Column, mean: Column) -> Column:
    def odds(x: Column) -> Column:
        x = F.least(F.greatest(x, F.lit(1e-9)), F.lit(1 - 1e-9))
        return x / (1 - x)

    whole = odds(p) * odds(path) / odds(mean)
    return whole / (1 + whole)


def _with_posterior(scored: DataFrame) -> DataFrame:
    groups = posteriors(scored.select("host", "path", "p")).withColumnsRenamed({"host": "h", "path": "q"})
    joined = scored.join(groups, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("q"))).drop("h", "q")
    p, k, j = F.col("p"), F.col("host_weight"), F.col("path_weight")
    host = (k * F.col("global_mean") + F.col("host_s") - p) / (k + F.col("host_n") - 1)
    path = (j * host + F.col("s") - p) / (j + F.col("n") - 1)
    return joined.withColumn("posterior", combined(p, path, F.col("global_mean")))


def classified(documents: DataFrame, labels: DataFrame, host: str, path: str, threshold: float = THRESHOLD, limit: int = SAMPLE) -> DataFrame:
    """doc_id, p (its own evidence), host_posterior, path_posterior, posterior, is_good."""
    model = evidence_model(documents, labels, limit)
    scored = stored(documents.select("doc_id", F.col(host).alias("host"), F.col(path).alias("path"), probability(model, text_column()).alias("p")), "evidence")
    return _with_posterior(scored).select("doc_id", "p", "host_posterior", "path_posterior", "posterior", (F.col("posterior") >= threshold).alias("is_good"))


def accepted(documents: DataFrame, labels: DataFrame, host: str, path: str, threshold: float = THRESHOLD, limit: int = SAMPLE) -> DataFrame:
    """The documents that reach the threshold, as they are."""
    model = evidence_model(documents, labels, limit)
    row = F.struct(*documents.columns).alias("row")
    scored = stored(documents.select(row, F.col(host).alias("host"), F.col(path).alias("path"), probability(model, text_column()).alias("p")), "evidence")
    return _with_posterior(scored).filter(F.col("posterior") >= threshold).select("row.*")
