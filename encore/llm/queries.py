"""Registered queries of the training-data operators, ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (hnsw, line_rules, minhash, mixing, pii, pivots, preference, prefix_free, prefix_trie, repair,
               sentencepiece, site_lines, substring)
from .common import table
from .oracle import ORACLE  # noqa: F401


def piece_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def held_out(doc_id: str) -> Column:
    """Rows whose labels are never learnt from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


def training_labels(labels: DataFrame) -> DataFrame:
    return labels.filter(~held_out("doc_id")).select("doc_id", "quality")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded; token counts and digests."""
    return sentencepiece.encode_texts(table(spark, sf_dir, "documents"), piece_model(), keep=["doc_id"],
                                      outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data: base spans, their digest, and the spans that bootstrapped contexts add."""
    return pii.annotate(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op3_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base quality rules and the verdict of cross-document line frequency."""
    rows = line_rules.apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return rows.select("doc_id", *line_rules.RESULTS)


def op4_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores by pairwise ranking, learnt from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranking = preference.train(docs, training_labels(table(spark, sf_dir, "labels")))
    return preference.score_texts(docs, ranking).select(
        "doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", "predicted")


def op5_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boilerplate lines of each source removed; counts and the digest of the rest."""
    rows = site_lines.drop_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of 35-word windows that occur anywhere else are removed."""
    return substring.remove_repeats(table(spark, sf_dir, "documents"), width=35, keep=["doc_id"], digest=True)


def op7_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every 20th vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return hnsw.nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


def op8_prefix_free(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of 400-byte strings that occur anywhere else are removed."""
    return prefix_free.remove_repeated_strings(table(spark, sf_dir, "documents"), width=400,
                                               keep=["doc_id"], digest=True)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's block and place in the mixture of sources."""
    return mixing.mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near duplicates at three-word shingles and 0.85."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def op11_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest integer inner products of every 20th vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return pivots.top_k(vectors, vectors.filter("vec_id % 20 = 0"), k=20, scale=64)


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations: their faults and the cheapest repair."""
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")), gone="gone")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of conversations rebuilt with shared beginnings, aggregated over subtrees."""
    talks = table(spark, sf_dir, "conversations")
    ids = talks.select(F.col("conv_id").cast("long").alias("c")).filter("c is not null").distinct()
    return prefix_trie.prefix_trie(*prefix_trie.rebuilt_turns(prefix_trie.numbered_turns(talks), ids))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline's result."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_sentencepiece, op2_pii, op3_line_rules, op4_preference, op5_site_lines, op6_substring_dedup, op7_hnsw,
    op8_prefix_free, op9_mixing, op10_minhash, op11_pivots, op12_repair, op13_prefix_trie, pipeline)}
