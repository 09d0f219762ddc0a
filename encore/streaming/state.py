"""Keyed state tables that are updated, not rewritten, and batches that commit at once.

A state table is a list of segments, oldest first: Parquet folders with the rows
that one micro-batch (or a merge of several) changed, in one folder per bucket of
the lookup key. The newest row of a key counts; a tombstone hides the key. A
batch reads the buckets its own keys fall into and writes only the rows it
changes. When the last ``FAN`` segments are of one size class they are merged
into one, so a row is written again a number of times that grows with the
logarithm of the table over the batch, and a large old segment stays untouched.

Everything a batch writes goes to folders named by batch and attempt. Its commit
is one small file, moved into place last, that names the output folders and the
live segments of every state table. Readers go through the commits, so they see
all outputs and state of a batch or none. A batch replayed after a failure either
finds its commit and does nothing, or starts from the commit before it.

The move is atomic on HDFS and local folders. Segments that no recent commit
names are removed; the last ``KEPT`` commits stay replayable. What a failed
attempt wrote is named by no commit and read by nobody.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import remove_path

FAN = 4                 # segments of a size class that are merged
CLASS_ROWS = 1000       # rows of the smallest size class
BUCKETS = 16            # default of encore.state.buckets
KEPT = 3
GONE = "_gone"          # column of a change: the key is deleted
_SEQ, _BUCKET = "_seq", "_bucket"


@dataclass(frozen=True)
class Table:
    """A state table: columns as DDL, its key, and the part of the key that lookups name."""

    schema: str
    keys: tuple[str, ...]
    by: tuple[str, ...] = ()

    @property
    def lookup(self) -> tuple[str, ...]:
        return self.by or self.keys


@dataclass
class Commit:
    """What is published after a batch: output folders and live segments, each ``[folder, rows]``."""

    batch: int = -1
    outputs: dict[str, str] = field(default_factory=dict)
    state: dict[str, list[list]] = field(default_factory=dict)


# ---- files -----------------------------------------------------------------------
def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _publish(spark: SparkSession, path: str, text: str) -> None:
    """A file that appears whole or not at all."""
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    fs, target = _fs(spark, path)
    _, source = _fs(spark, draft)
    out = fs.create(source, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(source, target):
        fs.delete(source, False)
        raise RuntimeError(f"another run has committed {path}")


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def committed(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the published batches, ascending."""
    fs, p = _fs(spark, f"{base}/commits")
    if not fs.exists(p):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(p)]
    return sorted(int(n) for n in names if n.isdigit())


def read_commit(spark: SparkSession, base: str, batch: int) -> Commit:
    if batch < 0:
        return Commit()
    return Commit(**json.loads(_read_text(spark, f"{base}/commits/{batch}")))


# ---- one batch -------------------------------------------------------------------
class Batch:
    """One micro-batch over the state of a job: lookups, then changes and outputs, then the commit."""

    def __init__(self, spark: SparkSession, base: str, batch: int, tables: dict[str, Table]):
        self.spark, self.base, self.batch, self.tables = spark, base, batch, tables
        self.before = read_commit(spark, base, batch - 1)
        self.after = Commit(batch, {}, {name: list(s) for name, s in self.before.state.items()})
        self.attempt = uuid.uuid4().hex[:8]
        self.buckets = int(spark.conf.get("encore.state.buckets", str(BUCKETS)))

    def lookup(self, name: str, wanted: DataFrame) -> DataFrame:
        """The table's rows for the keys in ``wanted`` (named as the table's lookup columns)."""
        table = self.tables[name]
        by = list(table.lookup)
        keys = wanted.select(*by).distinct().withColumn(_BUCKET, self._bucket(table))
        rows = _segments(self.spark, table, self.before.state.get(name, []))
        if not self.before.state.get(name):
            return rows.drop(_SEQ, _BUCKET, GONE)
        touched = [row[0] for row in keys.select(_BUCKET).distinct().collect()]     # at most ``buckets`` numbers
        rows = rows.filter(F.col(_BUCKET).isin(touched)).join(keys.drop(_BUCKET), by, "left_semi")
        return _newest(rows, table).filter(~F.col(GONE)).drop(_SEQ, GONE)

    def _bucket(self, table: Table):
        return F.pmod(F.xxhash64(*table.lookup), F.lit(self.buckets)).cast("int")

    def write(self, name: str, rows: DataFrame) -> None:
        """One output of the batch."""
        path = f"{self.base}/{name}/batch={self.batch}-{self.attempt}"
        rows.write.parquet(path)
        self.after.outputs[name] = path

    def change(self, name: str, rows: DataFrame) -> None:
        """New values of the keys that the batch touched, one row per key."""
        table = self.tables[name]
        if GONE not in rows.columns:
            rows = rows.withColumn(GONE, F.lit(False))
        rows = (rows.select(*_names(table), GONE).withColumn(_SEQ, F.lit(self.batch).cast("long"))
                    .withColumn(_BUCKET, self._bucket(table)))
        self._add(name, rows)
        live = self.after.state.setdefault(name, [])
        while len(live) >= FAN and len({_size_class(s[1]) for s in live[-FAN:]}) == 1:
            last = live[-FAN:]
            merged = _newest(_segments(self.spark, table, last), table).withColumn(_BUCKET, self._bucket(table))
            if len(live) == FAN:            # nothing older: tombstones have done their work
                merged = merged.filter(~F.col(GONE))
            del live[-FAN:]
            self._add(name, merged)
            for path, _ in last:            # no commit names what this batch wrote and merged itself
                if f"/segment={self.batch}-{self.attempt}" in path:
                    remove_path(self.spark, path)

    def _add(self, name: str, rows: DataFrame) -> None:
        path = f"{self.base}/state/{name}/segment={self.batch}-{self.attempt}-{uuid.uuid4().hex[:4]}"
        rows.repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(path)
        count = _segments(self.spark, self.tables[name], [[path, 1]]).count()
        if count:
            self.after.state.setdefault(name, []).append([path, count])
        else:
            remove_path(self.spark, path)

    def commit(self) -> None:
        _publish(self.spark, f"{self.base}/commits/{self.batch}", json.dumps(vars(self.after)))
        old = self.batch - KEPT
        if old >= 0:
            live = {s[0] for b in range(old + 1, self.batch + 1)
                    for segments in read_commit(self.spark, self.base, b).state.values() for s in segments}
            for segments in read_commit(self.spark, self.base, old).state.values():
                for path, _ in segments:
                    if path not in live:
                        remove_path(self.spark, path)


def _size_class(rows: int) -> int:
    return max(0, math.floor(math.log(max(rows, 1) / CLASS_ROWS, FAN)))


def _names(table: Table) -> list[str]:
    return StructType.fromDDL(table.schema).fieldNames()


def _segments(spark: SparkSession, table: Table, segments: list[list]) -> DataFrame:
    schema = f"{table.schema}, {GONE} boolean, {_SEQ} long, {_BUCKET} int"
    if not segments:
        return spark.createDataFrame([], schema)
    paths = [s[0] for s in segments]
    return (spark.read.schema(f"{schema}, segment string").option("basePath", paths[0].rsplit("/", 1)[0])
                 .parquet(*paths).drop("segment"))


def _newest(rows: DataFrame, table: Table) -> DataFrame:
    rest = [c for c in _names(table) if c not in table.keys]
    return (rows.groupBy(*table.keys).agg(F.max(F.struct(_SEQ, GONE, *rest)).alias("_v"))
                .select(*table.keys, *[f"_v.{c}" for c in (*rest, GONE, _SEQ)]))


# ---- readers ---------------------------------------------------------------------
def outputs(spark: SparkSession, base: str, name: str, schema: str) -> DataFrame:
    """All rows that committed batches put out under ``name``."""
    paths = [read_commit(spark, base, b).outputs.get(name) for b in committed(spark, base)]
    paths = [p for p in paths if p]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def whole(spark: SparkSession, base: str, name: str, table: Table) -> DataFrame:
    """A state table as the newest commit has it."""
    batches = committed(spark, base)
    segments = read_commit(spark, base, batches[-1]).state.get(name, []) if batches else []
    return _newest(_segments(spark, table, segments), table).filter(~F.col(GONE)).select(*_names(table))
