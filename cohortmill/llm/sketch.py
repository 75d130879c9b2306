"""Threshold-scaled document fingerprints, with Spark's own functions only.

A fingerprint keeps every hash of five-word shingles that falls below a fixed fraction of the hash range. Sketches of
any two documents compare, however unequal their lengths, and the sketch of a union is the union of sketches.

Null texts count as empty. A text of one to four words is one shingle; one without words hashes as it stands. Where no
hash falls below the fraction, the smallest is kept, so no fingerprint is empty. Documents follow one another by
descending doc_id, then by their texts' hashes; null ids come last; the last is followed by the first. Repeated rows are
kept. An empty table gives no rows. Other columns are ignored. Texts of any length are read whole: a sketch grows with the
distinct shingles, by an eighth of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import text_column

WORDS, FRACTION, BUCKET_ROWS, CELLS, BUCKETS = 5, 1 / 8, 1000, 256, 1 << 17


def with_sketch(df: DataFrame, text: str, to: str, fraction: float = FRACTION, words: int = WORDS) -> DataFrame:
    """Adds array<long> `to`: sorted distinct shingle hashes below the fraction."""
    least = -(2**63) + int(fraction * 2**64)
    w, g, kept = f"{to}_w", f"{to}_g", f"{to}_k"
    return (
        df.withColumn(w, F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}\p{M}]+"), lambda x: x != ""))
        .withColumn(
            g,
            F.when(F.size(w) >= words, F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (words - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(F.col(w), i, words))))
            .when(F.size(w) > 0, F.array(F.xxhash64(F.col(w))))
            .otherwise(F.array(F.xxhash64(F.col(text)))),
        )
        .withColumn(kept, F.filter(g, lambda h: h < F.lit(least)))
        .withColumn(to, F.array_sort(F.array_distinct(F.when(F.size(kept) > 0, F.col(kept)).otherwise(F.array(F.array_min(g))))))
        .drop(w, g, kept)
    )


def merged(a: Column, b: Column) -> Column:
    """The sketch of two documents put together."""
    return F.array_sort(F.array_union(a, b))


def resemblance(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def containment(a: Column, b: Column) -> Column:
    """The share of a's shingles that b holds."""
    return F.size(F.array_intersect(a, b)) / F.size(a)


def printed(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def with_next(df: DataFrame, carried: list[str], derive: Callable[[DataFrame], DataFrame] = lambda df: df, key: str = "doc_id", tie: str = "text") -> DataFrame:
    """Adds `next`, a struct of the carried columns of the row that follows by descending key.

    Rows go to buckets by the key's quantiles, about BUCKET_ROWS to each. Within a bucket a window finds the next row; the
    last row gets the first one of the next bucket that has any. The first rows' keys, one a bucket, find their rows by a
    broadcast while there are at most BUCKETS of them, else by a shuffle. derive adds columns, for the rows moved only.
    """
    stats = df.agg(F.count(key).alias("n"), F.min(key).alias("least"), F.percentile_approx(key, [i / CELLS for i in range(CELLS + 1)], 10000).alias("at")).first()
    lows = sorted(set(stats["at"] or [0]))
    per = max(1, -(-stats["n"] // (len(lows) * BUCKET_ROWS)))
    widths = [max(1, -(-(b - a) // per)) for a, b in zip(lows, [*lows[1:], lows[-1] + 1])]
    low, width = (F.array(*[F.lit(x).cast("long") for x in xs]) for xs in (lows, widths))
    placed = df.withColumn("at", F.coalesce(F.col(key), F.lit((stats["least"] or 0) - 1)))
    placed = placed.withColumn("cell", F.greatest(F.size(F.filter(low, lambda x: x <= F.col("at"))) - 1, F.lit(0)))
    placed = placed.withColumn("sub", F.floor((F.col("at") - F.get(low, F.col("cell"))) / F.get(width, F.col("cell"))))
    tops = placed.groupBy("cell", "sub").agg(F.max("at").alias("at"))
    first = Window.partitionBy("cell", "sub").orderBy("h")
    few = F.broadcast(tops) if per * len(lows) <= BUCKETS else tops
    heads = placed.join(few, ["cell", "sub", "at"]).withColumn("h", F.xxhash64(tie)).withColumn("nth", F.row_number().over(first)).filter("nth = 1")
    heads = derive(heads).select(F.col("cell").alias("c2"), F.col("sub").alias("s2"), F.struct(*carried).alias("head"))
    cells = tops.groupBy("cell").agg(F.max("sub").alias("top"))
    down = Window.orderBy(F.desc("cell"))  # over the cells, CELLS + 1 rows at most
    whole = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cells = cells.select("cell", F.coalesce(F.lead("cell").over(down), F.first("cell").over(whole)).alias("n_cell"), F.coalesce(F.lead("top").over(down), F.first("top").over(whole)).alias("n_top"))
    links = tops.select("cell", "sub", F.lead("sub").over(Window.partitionBy("cell").orderBy(F.desc("sub"))).alias("below")).join(cells, "cell")
    links = links.select("cell", "sub", F.when(F.col("below").isNotNull(), F.col("cell")).otherwise(F.col("n_cell")).alias("c2"), F.coalesce("below", "n_top").alias("s2"))
    following = heads.join(links, ["c2", "s2"]).select("cell", "sub", "head")
    inside = Window.partitionBy("cell", "sub").orderBy(F.desc("at"), "h")
    seen = derive(placed).withColumn("h", F.xxhash64(tie)).withColumn("next", F.lead(F.struct(*carried)).over(inside))
    return seen.join(following, ["cell", "sub"]).withColumn("next", F.coalesce("next", "head")).drop("cell", "sub", "at", "h", "head")


def fingerprints(documents: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each document and its edited text."""
    docs = documents.select("doc_id", text_column().alias("text"))
    docs = with_next(docs, ["text", "sketch"], lambda df: with_sketch(df, "text", "sketch", fraction)).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    docs = docs.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring(F.col("next.text"), F.lit(1), half)))
    docs = with_sketch(docs.select("doc_id", "n_chars", "sketch", F.col("next.sketch").alias("next_sketch"), "edited"), "edited", "edited_sketch", fraction)
    return docs.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        printed(F.col("sketch")).alias("fingerprint"),
        printed(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
