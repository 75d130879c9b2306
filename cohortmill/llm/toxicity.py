"""Toxicity by a classifier chain: each category's linear model sees the words and the earlier categories' probabilities.

While training, the earlier probabilities are out-of-fold predictions, so that no model learns from a prediction that
has seen its own row; folds go by a hash of the document id. One task fits the models to the words of a bounded sample of
labelled documents (SAMPLE ids, the first by a hash of their ids), in the order of their ids, so that the layout of the
table changes nothing; they then score every whole text.

Null texts count as empty; a text without known words gets the categories' base rates. Labels that repeat an id are
combined by their maximum, null labels are left out; of several texts of one id the sample takes the one of least hash. All
words whose rate of a category is TELLING standard deviations off are features, so no ties between words arise. Without
labels, or with one class only, the rate is constant and nothing is rejected. Rows are scored one by one: repeated rows, null
ids and other columns do no harm; a very long text makes a batch of its own. An empty table gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .linear import Linear, fit
from .pretok import mixed
from .shared import slices, text_column, unused
from .textscan import scan

SAMPLE, TELLING, MIN_DOCS, FOLDS, THRESHOLD = 8192, 3.0, 2, 5, 0.15


@dataclass(frozen=True)
class Chain:
    """vocabulary: sorted word hashes; a model's columns are the words, then the earlier categories in order."""

    categories: tuple[str, ...]
    vocabulary: np.ndarray
    models: tuple[Linear, ...]

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        """(texts, categories), each fed the ones before it."""
        row, col = present(texts, self.vocabulary)
        out = np.zeros((len(texts), len(self.categories)))
        for k, model in enumerate(self.models):
            r, c, v = extended(row, col, out[:, :k], len(self.vocabulary))
            out[:, k] = model.predict(r, c, v, len(texts))
        return out


def distinct_words(texts: pa.Array) -> pa.ListArray:
    """The hashes of each text's words, once each."""
    words = scan(texts)
    once = np.sort(np.unique(words.hashes ^ mixed(words.doc().astype(np.uint64)), return_index=True)[1])
    counts = np.bincount(words.doc()[once], minlength=len(texts))
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pa.array(words.hashes[once].view(np.int64)))


def flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(word, text index) of all entries."""
    sizes = np.diff(lists.offsets.to_numpy())
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), np.repeat(np.arange(len(lists)), sizes)


def known(word: np.ndarray, doc: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, vocabulary index) of the words that the vocabulary has."""
    if not len(vocabulary):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(vocabulary, word), len(vocabulary) - 1)
    hit = vocabulary[at] == word
    return doc[hit], at[hit]


def present(texts: pa.Array, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, word) index of each known word that a text holds, once."""
    words = scan(texts)
    doc, at = known(words.hashes, words.doc(), vocabulary)
    key = np.unique(doc * max(1, len(vocabulary)) + at)
    return key // max(1, len(vocabulary)), key % max(1, len(vocabulary))


def extended(row: np.ndarray, col: np.ndarray, earlier: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, k = earlier.shape
    more_rows, more_cols = np.repeat(np.arange(n), k), np.tile(width + np.arange(k), n)
    return np.r_[row, more_rows], np.r_[col, more_cols], np.r_[np.ones(len(row)), earlier.ravel()]


def train_chain(ids: np.ndarray, held: pa.ListArray, labels: np.ndarray, categories: tuple[str, ...], telling: float = TELLING, min_docs: int = MIN_DOCS, folds: int = FOLDS, penalty: float = 0.1) -> Chain:
    """held: each text's distinct words; labels: (texts, categories) of 0 and 1. Words are chosen by how far their rate of any category is from the rest's."""
    n = len(labels)
    if not n:
        return Chain(categories, np.zeros(0, np.uint64), tuple(Linear(np.zeros(1 + k), -20.0) for k in range(len(categories))))
    word, doc = flat(held)
    seen, at, df = np.unique(word, return_inverse=True, return_counts=True)
    away = np.zeros(len(seen))
    for k in range(len(categories)):
        rate = labels[:, k].mean()
        hits = np.bincount(at, labels[doc, k], len(seen))
        away = np.maximum(away, np.abs(hits - df * rate) / np.sqrt(df * rate * (1 - rate) + 1e-9))
    vocabulary = seen[(away >= telling) & (df >= min_docs)]
    row, col = known(word, doc, vocabulary)
    fold = (mixed(ids.astype(np.int64).view(np.uint64)) % np.uint64(folds)).astype(np.int64)
    out_of_fold, models = np.zeros((n, len(categories))), []
    for k in range(len(categories)):
        r, c, v = extended(row, col, out_of_fold[:, :k], len(vocabulary))
        y = labels[:, k].astype(float)
        if y.min() == y.max():  # one class says nothing about the other
            models.append(Linear(np.zeros(len(vocabulary) + k + 1), -20.0))
            continue
        models.append(fit(r, c, v, y, len(vocabulary) + k, penalty))
        for f in range(folds if k + 1 < len(categories) else 0):
            train = fold[r] != f
            number = np.cumsum(fold != f) - 1
            part = fit(number[r[train]], c[train], v[train], y[fold != f], len(vocabulary) + k, penalty)
            out_of_fold[fold == f, k] = part.predict(r, c, v, n)[fold == f]
    return Chain(categories, vocabulary, tuple(models))


def fitted(documents: DataFrame, labels: DataFrame, columns: list[str], features: Callable[[pa.Array], pa.Array], kind: str, train: Callable[[np.ndarray, pa.ListArray, np.ndarray], object], limit: int = SAMPLE) -> object:
    """What train(ids, features, labels) makes of at most `limit` labelled documents. Texts become features where they are;
    one task gets those of the sample, and only its model goes to the driver."""
    rows = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*[F.max(F.col(c)).cast("int").alias(c) for c in columns]).dropna()
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(batch.column(c) for c in columns), features(batch.column("text"))], ["doc_id", *columns, "features"])

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).sort_by("doc_id").combine_chunks()
        y = np.array([table.column(c).to_numpy() for c in columns]).T
        model = train(table.column("doc_id").to_numpy(), table.column("features").combine_chunks(), y)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    held = texts.join(F.broadcast(rows), "doc_id").groupBy("doc_id", *columns).agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    found = held.mapInArrow(featured, ", ".join(["doc_id long", *(f"{c} int" for c in columns), f"features {kind}"]))
    model = found.repartition(1).mapInArrow(trained, "model binary").first()
    if model is None:
        return train(np.zeros(0, np.int64), None, np.zeros((0, len(columns)), int))
    return pickle.loads(model["model"])


def with_severity(held: pa.ListArray, toxic: np.ndarray, terms: int = 3) -> np.ndarray:
    """(toxic, severe): severe are toxic texts with at least `terms` different words that hardly occur in others."""
    word, doc = flat(held)
    seen, at, df = np.unique(word, return_inverse=True, return_counts=True)
    hits = np.bincount(at, toxic[doc], len(seen))
    telling = (df >= MIN_DOCS) & (hits > 0.9 * df)
    severe = toxic.astype(bool) & (np.bincount(doc, telling[at], len(held)) >= terms)
    return np.stack([toxic, severe.astype(int)], axis=1)


def toxicity_chain(documents: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Chain:
    """The labels hold one category; the second, severe, is derived from it and the words."""

    def train(ids: np.ndarray, held: pa.ListArray, y: np.ndarray) -> Chain:
        return train_chain(ids, held, with_severity(held, y[:, 0]) if len(ids) else np.zeros((0, 2), int), ("toxic", "severe"))

    return fitted(documents, labels, ["toxic"], distinct_words, "array<long>", train, limit)


def probability(chain: Chain, text: Column) -> Column:
    """A struct with a probability for each category."""
    kinds = ", ".join(f"{c}: double" for c in chain.categories)

    @F.arrow_udf(f"struct<{kinds}>")
    def score(texts: pa.Array) -> pa.Array:
        parts = [chain.probabilities(b.column(0)) for b in slices(iter([pa.RecordBatch.from_arrays([texts], ["text"])]))]
        found = np.concatenate([np.zeros((0, len(chain.categories))), *parts])
        return pa.StructArray.from_arrays([pa.array(found[:, k]) for k in range(len(chain.categories))], list(chain.categories))

    return score(text)


def rejected(chain: Chain, p: str, threshold: float) -> Column:
    """Any category of the chain reaches the threshold."""
    return F.greatest(F.lit(0.0), *[F.col(f"{p}.{c}") for c in chain.categories]) >= threshold


def classified(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, limit: int = SAMPLE) -> DataFrame:
    """doc_id, a probability for each category, and is_toxic: any of them reaches the threshold."""
    chain = toxicity_chain(documents, labels, limit)
    scored = documents.select("doc_id", probability(chain, text_column()).alias("p"))
    return scored.select("doc_id", *[F.col(f"p.{c}").alias(f"p_{c}") for c in chain.categories], rejected(chain, "p", threshold).alias("is_toxic"))


def accepted(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, limit: int = SAMPLE) -> DataFrame:
    """The documents that no category rejects, as they are."""
    chain = toxicity_chain(documents, labels, limit)
    p = unused(documents, "p")
    return documents.withColumn(p, probability(chain, text_column())).filter(~rejected(chain, p, threshold)).drop(p)
