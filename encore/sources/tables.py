"""Readers for the raw Parquet tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..schemas import TABLES

# Lazy scans are immutable plans; one per (session, path) saves the driver-side
# file listing and footer read when many pipelines use the same table.
_SCANS: dict[tuple[int, str], DataFrame] = {}


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read one table ``<root>/<name>.parquet`` (file or folder).

    The tables of ``schemas.TABLES`` have declared columns; others take theirs from
    the files. Only a lazy scan is created; Catalyst prunes columns and pushes filters
    into it, so callers select what they need afterwards.
    """
    path = os.path.join(root, f"{name}.parquet")
    key = (id(spark), path)
    df = _SCANS.get(key)
    if df is None or df.sparkSession is not spark:
        reader = spark.read.schema(TABLES[name]) if name in TABLES else spark.read
        df = reader.parquet(path)
        _SCANS[key] = df
    return df
