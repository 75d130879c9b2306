"""Spelling variants by permuterm rotations.

Each word gets an end mark, and every rotation of the marked word stands beside its forms that skip one character. A
replaced character leaves two words with equal rotations after the skip; a character more leaves the longer word, after
the skip, with a whole rotation of the shorter. So near words lie together once all rotations are sorted, as a range with
one common prefix, and a scan of the ranges tells each word how many near words it has there and which is the most
frequent. A range holds one word for each character of the alphabet at most, and one more. No pair is written out.

Null texts hold no words; a null id counts as an empty one. Repeated rows count each time. Words are numbered by
code-point order, which settles ties. An empty table gives no rows. Columns other than doc_id and text are ignored. Texts
and words of any length are whole: rotations over KEY characters are sorted by their SHA-256, and a word's rotations are
made one at a time (that work, not memory, grows with the square of its length).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored, text_column

LENGTH, LEAST, RATIO, DAMAGE, KEY = 6, 5, 5, 199, 64
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Not a character of any word.
MARK = "$"
#: A whole rotation; one that skips a character; one that skips the first of a run of equal characters.
WHOLE, SKIP, FIRST = range(3)


def word_counts(documents: DataFrame, length: int = LENGTH, least: int = LEAST, damage: int = DAMAGE) -> DataFrame:
    """word, n: runs of letters in lower case, of which one in `damage` occurrences lost a character; words so long and so frequent."""
    runs = F.regexp_extract_all(F.translate(text_column(), UPPER, SMALL), F.lit(f"([a-zÀ-ÿ]{{{length},}})"), F.lit(1))
    found = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    found = found.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    size = F.char_length("run")
    at = F.pmod("h", size).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, size))
    words = found.select(F.when(F.col("h") % damage == 0, cut).otherwise(F.col("run")).alias("word")).filter(F.char_length("word") >= length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def rotations(words: DataFrame) -> DataFrame:
    """wid, n, key, kind: all rotations of marked words, whole and with their first character skipped."""
    size = F.char_length("word")
    at, skip = F.floor(F.col("k") / 2).cast("int"), (F.col("k") % 2).cast("int")
    marked = F.concat("word", F.lit(MARK))
    key = F.concat(F.substring(marked, at + skip + 1, size + 1), F.substring("word", F.lit(1), at))
    opens = (at == 0) | (F.substring("word", at, F.lit(1)) != F.substring("word", at + 1, F.lit(1)))
    kind = F.when(skip == 0, F.lit(WHOLE)).when(opens, F.lit(FIRST)).otherwise(F.lit(SKIP))
    each = words.select("wid", "n", "word", F.explode(F.sequence(F.lit(0), 2 * size)).alias("k"))
    return each.select("wid", "n", F.when(size <= KEY, key).otherwise(F.sha2(key.cast("binary"), 256)).alias("key"), kind.cast("int").alias("kind"))


def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """wid, near, best_n, best: of each range that holds near words. Rows come sorted by key, then the most frequent word first."""
    rest = None
    for batch in batches:
        rest = batch if rest is None else pa.concat_batches([rest, batch])
        if not rest.num_rows:
            continue
        key = rest.column("key")
        last = pc.index(pc.not_equal(key[1:], key[:-1])[::-1], True).as_py() if len(key) > 1 else -1
        if last >= 0:  # the last range may go on in the next batch
            whole = len(key) - 1 - last
            yield ranges(rest.slice(0, whole))
            rest = rest.slice(whole)
    if rest is not None and rest.num_rows:
        yield ranges(rest)


def ranges(batch: pa.RecordBatch) -> pa.RecordBatch:
    key = batch.column("key")
    wid, n, kind = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("wid", "n", "kind"))
    new = np.r_[True, pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)]
    starts, of = np.flatnonzero(new), np.cumsum(new) - 1
    row, none = np.arange(len(wid)), len(wid)
    least = lambda held: np.minimum.reduceat(np.where(held, row, none), starts)[of]
    count = lambda held: np.add.reduceat(held.astype(np.int64), starts)[of]
    skips, firsts, whole = kind != WHOLE, kind == FIRST, least(kind == WHOLE)
    top = least(skips)
    other = np.where(row == top, least(skips & (row != top)), top)  # the best of the words with another character there
    shorter = np.where(firsts, whole, none)
    near = np.where(skips, count(skips) - 1 + (shorter < none), count(firsts))
    best = np.where(skips, np.minimum(other, shorter), least(firsts))
    kept = np.flatnonzero(near > 0)
    best = best[kept]
    return pa.RecordBatch.from_arrays([pa.array(wid[kept]), pa.array(near[kept]), pa.array(n[best]), pa.array(wid[best])], ["wid", "near", "best_n", "best"])


def near_words(words: DataFrame) -> DataFrame:
    """wid, n_near, best_n, best: each word's number of near words, and the most frequent of them."""
    ordered = rotations(words).repartitionByRange("key").sortWithinPartitions("key", F.desc("n"), "wid")
    found = ordered.mapInArrow(scanned, "wid long, near long, best_n long, best long")
    return found.groupBy("wid").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("b")).select("wid", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best"))


def grouped(documents: DataFrame, length: int = LENGTH, least: int = LEAST, ratio: int = RATIO, damage: int = DAMAGE) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word. ratio, above 1: how much more frequent a form must be."""
    if ratio <= 1:
        raise ValueError("forms must be more frequent than their words")
    words = word_counts(documents, length, least, damage).orderBy("word").select(F.monotonically_increasing_id().alias("wid"), "word", "n")
    words = stored(words, "words")
    near = stored(near_words(words).join(words.select("wid", "n"), "wid").select("wid", "n_near", F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best")).alias("form"), "best_n"), "near")
    edges = near.filter("form is not null").select("wid", "form", F.col("form").alias("root"))
    most, depth, reach = words.agg(F.max("n")).first()[0] or 0, 0, 1
    while least * ratio ** (depth + 1) <= most:  # each form is `ratio` times as frequent as the word before it
        depth += 1
    while reach < depth:  # every step doubles how far a root lies
        edges = stored(edges, "roots")
        on = edges.select(F.col("wid").alias("root"), F.col("root").alias("further"))
        edges = edges.join(on, "root", "left").select("wid", "form", F.coalesce("further", "root").alias("root"))
        reach *= 2
    name = lambda c: words.select(F.col("wid").alias(c), F.col("word").alias(f"{c}_word"), F.col("n").alias(f"{c}_n"))
    edges = edges.join(name("form"), "form").join(name("root"), "root").select("wid", "form_word", "root_word", "form_n")
    return (
        words.join(near.select("wid", "n_near"), "wid", "left")
        .join(edges, "wid", "left")
        .select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n")
    )
