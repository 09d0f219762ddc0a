"""Entity records stored as files (JSON lines or Parquet), read with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas


def read_entity(spark: SparkSession, path: str, entity: str, fmt: str = "json") -> DataFrame:
    """Read one entity (``customer``, ``ticket``, ...) with its schema — never inferred."""
    schema = schemas.ENTITIES[entity]
    reader = spark.read.schema(schema)
    if fmt == "json":
        return reader.option("mode", "PERMISSIVE").json(path)
    return reader.format(fmt).load(path)


def with_position(records: DataFrame) -> DataFrame:
    """Records of Parquet files with where each is stored: its file (``partition``) and row in it (``offset``).

    ``records`` is the frame that reads the files.
    """
    return records.select(*records.columns, F.col("_metadata.file_name").alias("partition"),
                          F.col("_metadata.row_index").alias("offset"))


def typed_records(records: DataFrame, entity: str, value_col: str = "value") -> DataFrame:
    """``(key, value)`` records as entity rows with a ``status``.

    ``ok``: a JSON object, its fields in the entity's columns. ``deleted``: a null
    value, the tombstone of its key. ``malformed``: anything else; the entity's
    columns are null and the text is kept as ``raw``. Other columns stay.
    """
    schema = schemas.ENTITIES[entity]
    corrupt = "_corrupt"
    with_corrupt = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    parsed = F.from_json(F.col(value_col).cast("string"), with_corrupt,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    rows = records.withColumn("_r", parsed)
    bad = F.col(f"_r.{corrupt}").isNotNull() | (F.col(value_col).isNotNull() & F.col("_r").isNull())
    status = F.when(F.col(value_col).isNull(), "deleted").when(bad, "malformed").otherwise("ok")
    return rows.select(
        *[c for c in records.columns if c != value_col], status.alias("status"),
        *[F.when(status == "ok", F.col("_r")[f.name]).alias(f.name) for f in schema.fields],
        F.when(status == "malformed", F.col(value_col)).alias("raw"))


def parse_records(records: DataFrame, entity: str, value_col: str = "value") -> DataFrame:
    """Typed entity rows from ``(key, value)`` records whose value is a JSON object."""
    schema = schemas.ENTITIES[entity]
    return records.select(F.from_json(F.col(value_col).cast("string"), schema).alias("_r")).select("_r.*")


def write_keyed(df: DataFrame, path: str, key: str, value: list[str] | str, mode: str = "overwrite") -> None:
    """Write ``(key, value)`` records as JSON lines: a scalar value as text, several as JSON."""
    from ..streaming.sinks import keyed_records
    keyed_records(df, key, value).write.mode(mode).json(path)
