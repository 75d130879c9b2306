"""Byte-level BPE over documents, there and back.

Null texts count as empty and give no ids. Every row stands for itself: repeated rows, null ids and other columns do no
harm. An empty table gives no rows. A text of any length is encoded whole; one beyond a slice's 2 MB is a slice of its own. Of
pairs of equal rank the leftmost is merged first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import ByteEncoder, byte_encoder
from .pretok import ragged
from .shared import slices, text_column


def checked(encoder: ByteEncoder, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids with offsets, decoded bytes with offsets. Should two slices ever share a hash, the bytes differ and another seed is tried."""
    whole = "".join(texts).encode()
    for _ in range(9):
        ids, at = encoder.encode(texts)
        data, bounds = encoder.decode(ids, at)
        if data.tobytes() == whole:
            return ids, at, data, bounds
        encoder.seed += 1
        encoder.forget()
    raise ValueError("the decoded bytes differ from the text")


def encoded(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and, for each id, where its bytes end in the text (offsets array<int>), so that any span of ids decodes alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(path)
        for batch in slices(batches):
            ids, at, _, bounds = checked(encoder, batch.column("text").to_pylist())
            ends = np.cumsum(encoder.word_lengths[ids]) - np.repeat(bounds[:-1], np.diff(at))
            lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x, pa.int32())) for x in (ids, ends)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], ["doc_id", "ids", "offsets"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text")).mapInArrow(run, "doc_id long, ids array<int>, offsets array<int>")


def decoded(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id and text of (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(path)
        for batch in batches:
            lists = batch.column("ids").to_pylist()
            at = np.r_[0, np.cumsum([len(x) for x in lists])].astype(np.int64)
            data, bounds = encoder.decode(np.array([i for x in lists for i in x], np.int64), at)
            texts = [data[a:b].tobytes().decode(errors="replace") for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 of the decimal ids joined by spaces, decoded_sha256 of the decoded bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(path)
        decimals = [b"%d " % i for i in range(encoder.size)]
        widths = np.array([len(d) for d in decimals], np.int64)
        starts, digits = np.cumsum(widths) - widths, np.frombuffer(b"".join(decimals), np.uint8)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in slices(batches):
            ids, at, data, bounds = checked(encoder, batch.column("text").to_pylist())
            size = widths[ids]
            text, ends = digits[ragged(starts[ids], size)], np.r_[0, np.cumsum(size)][at]
            columns = [
                batch.column("doc_id"),
                pa.array(np.diff(at), pa.int64()),
                pa.array([sha(text[a : max(a, b - 1)]) for a, b in zip(ends, ends[1:])], pa.string()),
                pa.array([sha(data[a:b]) for a, b in zip(bounds, bounds[1:])], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
