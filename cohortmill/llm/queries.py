"""The queries of this folder: each applies an operator, with production parameters, to its whole table."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytebpe, lm, minhash, packing, phrases, quality, rollup, sketch, tokens, topk, toxicity, urltree, variants
from .shared import shared_dir, stored
from .sql import PHRASES, URLS

#: The documents table has no addresses: its source stands for the host, a language within it for the path.
HOST, PATH = "source", "lang"
#: What the filter of addresses is told.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_balltree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return topk.exact_topk(vectors, F.col("id") % 20 == 0, k=20, scale=64.0)


def op2_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.digest(tokens.written(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken")))


def op3_bagminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_threshold_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.fingerprints(table(spark, sf_dir, "documents"))


def op6_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserts all documents, takes revised counts (white space squeezed), then deletes those labelled toxic; the first batch is sent twice."""
    squeezed = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " "))
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.lit("byte_bpe_50k").alias("version"), F.col("text").alias("n_tokens"), squeezed.alias("n_squeezed"))
    counted = stored(rollup.with_counts(docs, ["n_tokens", "n_squeezed"], public_tokenizers.path("byte_bpe_50k.tiktoken")), "token-counts")
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id").distinct()
    store = rollup.Rollup(spark, f"{shared_dir(spark)}/rollup-{uuid.uuid4().hex}")
    store.commit("1-insert", rollup.inserts(counted))
    store.commit("2-revise", rollup.revisions(counted, "n_tokens", "n_squeezed"))
    gone = counted.join(toxic, "doc_id", "left_semi")
    store.commit("3-delete", rollup.deletes(gone.withColumn("n_tokens", F.col("n_squeezed"))))
    store.commit("1-insert", rollup.inserts(counted))
    return store.totals()


def op7_hierarchical_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), HOST, PATH)


def op8_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the conversations; background: the documents."""
    return lm.cross_entropy_difference(table(spark, sf_dir, "conversations"), table(spark, sf_dir, "documents"))


def op9_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op11_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_permuterm_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.grouped(table(spark, sf_dir, "documents"))


def op13_path_template_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urltree.verdicts(table(spark, sf_dir, "pages"), URL_RULES)


QUERIES = {f.__name__: f for f in (op1_balltree_topk, op2_token_packing, op3_bagminhash_dedup, op4_pattern_packing, op5_threshold_sketch, op6_token_rollup, op7_hierarchical_quality, op8_cross_entropy_difference, op9_toxicity_chain, op10_byte_bpe, op11_phrase_automata, op12_permuterm_variants, op13_path_template_filter)}
ORACLES: dict[str, str] = {"op11_phrase_automata": PHRASES, "op13_path_template_filter": URLS}
