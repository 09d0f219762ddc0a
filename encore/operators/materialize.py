"""Materialize an expensive intermediate once, in the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import remove_path, scratch_path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing the
    joins) and lets several consumers share one computation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"table-{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a table that ``materialize`` wrote, after its last reader."""
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        remove_path(df.sparkSession, folder)
