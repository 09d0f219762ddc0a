"""Streaming sources: file streams with fixed schemas, Kafka by option."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.domain import Domain
from ..sources.tables import read_table

# Tables that arrive as record streams (``supplier`` through ``_venue_feed``: its row count is
# also read as a number); ``nation`` only names cities and is joined as a static table.
STREAMED = {"events", "part", "customer"}


def _glob(path: str) -> str:
    """A file stream source needs a folder or a glob; turn a single file into a glob."""
    if os.path.isdir(path):
        return path
    head, tail = os.path.split(path)
    return os.path.join(head, tail[:-1] + f"[{tail[-1]}]")


def stream_table(spark: SparkSession, root: str, name: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream over ``<root>/<name>.parquet`` with the table's schema (no inference)."""
    schema: StructType = read_table(spark, root, name).schema
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(_glob(os.path.join(root, f"{name}.parquet")))


def kafka_records(spark: SparkSession, servers: str, topic: str, schema: StructType,
                  starting_offsets: str = "earliest") -> DataFrame:
    """Typed records of one topic: JSON value parsed with a fixed schema.

    Needs the Kafka connector on the classpath (not bundled here).
    """
    raw = (spark.readStream.format("kafka")
           .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
           .option("startingOffsets", starting_offsets).load())
    return raw.select(F.col("key").cast("string").alias("key"),
                      F.from_json(F.col("value").cast("string"), schema).alias("v"),
                      "topic", "partition", "offset", "timestamp").select("key", "v.*", "topic",
                                                                          "partition", "offset", "timestamp")


def raw_records(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Records as they are on the topic: key, value, partition, offset."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", "earliest").load()
            .select(F.col("key").cast("string"), F.col("value").cast("string"), "partition", "offset"))


class StreamDomain(Domain):
    """The entity views of ``Domain`` with record tables read as streams."""

    def __init__(self, spark: SparkSession, root: str, max_files_per_trigger: int | None = None):
        super().__init__(spark, root)
        self.max_files_per_trigger = max_files_per_trigger

    def table(self, name: str) -> DataFrame:
        if name in STREAMED:
            return stream_table(self.spark, self.root, name, self.max_files_per_trigger)
        return read_table(self.spark, self.root, name)

    def _venue_feed(self) -> DataFrame:
        """Venues and their addresses arrive as records too."""
        return stream_table(self.spark, self.root, "supplier", self.max_files_per_trigger)
