"""The corpus pipeline: from raw documents to token ids.

Null and empty texts, texts of any length, repeated rows and extra columns pass the
stages as their operators state; an empty table gives an empty result.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes each result as Parquet under the shared checkpoint folder and hands the
reread table on. All stages but the last return the columns of ``documents``.

A reread table has no row order. The mixture is the order of the rows in the
files of its stage, so the last stage takes it from there as ``position``.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from encore.llm import mixing, minhash, preference, sentencepiece, site_lines
from encore.llm.common import table
from encore.llm.queries import piece_model, training_labels
from encore.session import scratch_path, ship_package


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the preference ranking places below its threshold go."""
    ship_package(spark)
    ranking = preference.train(docs, training_labels(table(spark, sf_dir, "labels")))
    return preference.score_texts(docs, ranking).filter("predicted = 1").select(*docs.columns)


def drop_site_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on too many of their source's distinct pages go; lengths follow.

    Copies of a page count once, so they reach the next stage with their text."""
    ship_package(spark)
    left = site_lines.drop_boilerplate(docs, distinct=True).select(*docs.columns)
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 0.8) stays."""
    ship_package(spark)
    return minhash.drop_near_duplicates(docs, size=5, percent=80)


def mix_by_source(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixture; small sources are lifted (square-root weights)."""
    ship_package(spark)
    return mixing.mix_sources(docs).orderBy("position").select(*docs.columns)


def in_written_order(docs: DataFrame) -> DataFrame:
    """``docs`` with ``position``, the row's number (from 0) in the order it was written in.

    Of Parquet files: rows before the file, in order of file names, and the row's
    number in it. Of any other table: increasing in the order of its partitions.
    """
    try:
        rows = docs.select(*docs.columns, F.col("_metadata.file_name").alias("_file"),
                           F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        return docs.withColumn("position", F.monotonically_increasing_id())
    # one row per file; a part number outgrows its five digits
    before = (Window.orderBy(F.regexp_extract("_file", "^part-([0-9]+)", 1).try_cast("long"), "_file")
                    .rowsBetween(Window.unboundedPreceding, -1))
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return (rows.join(F.broadcast(files), "_file").withColumn("position", F.col("_start") + F.col("_row"))
                .select(*docs.columns, "position"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place in the mixture, token ids of every text, their number and the digest of the decoded text."""
    ship_package(spark)
    return sentencepiece.encode_texts(in_written_order(docs), piece_model(), keep=["doc_id", "source", "position"],
                                      outputs=("n_tokens", "ids", "decoded_sha256"))


STAGES = [
    ("quality_classifier", reject_low_quality),
    ("line_dedup", drop_site_boilerplate),
    ("minhash_near_dedup", drop_near_duplicates),
    ("source_mixing", mix_by_source),
    ("sentencepiece", encode),
]

# The fitted ranking and the merge order of a vocabulary have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sort the result by ``position`` for the mixture."""
    folder = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = os.path.join(folder, f"{number}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
