"""Mixing sources to target weights by proportionate-fair (Pfair) scheduling.

Every source is cut into blocks of ``block_rows`` documents. With target weight
``w`` its block ``k`` (from 0) may be released at slot ``floor(k / w)`` and is due
by ``ceil((k + 1) / w)``; one block runs per slot, always the released block with
the earliest deadline (ties: source order). Until a source runs out, what each
has received at any slot differs from ``w * slot`` by less than one block.

Weights are integers ``p`` out of ``P`` (``integer_weights``): the given ones
where they have a common denominator below 10^17, else in units of less than
10^-16 of the total (doubles hold no more). Releases and deadlines are exact
quotients of these integers, whatever the number of sources or slots.

Weights, block windows and the schedule are Spark tables joined by source; no
number of sources is refused. Earliest deadline first is one pass over the
blocks in release order, so it is one task: Spark sorts (and spills) the blocks
by release, the task streams them and holds only the released ones that wait, at
most two per source. Documents do not go through it. Documents are numbered in
their source without gathering a source anywhere: by hash bucket (about the
square root of the row count), a prefix sum over the bucket counts, and a row
number inside each bucket.

Results: all rows stay, in the order of ``position``; a source that has run out
leaves its slots empty, the others keep their proportions. The order inside a
source is that of a hash, so copies and neighbours spread out; rows with equal
ids are ordered by their content, fully equal rows are interchangeable. A null
source is a source of its own. Sources without a weight raise an error, weights
of absent sources only take part in the proportions (their slots stay empty). An
empty table stays empty. Texts of any length are only passed on.
Input columns named like the added ones (``block``, ``release``, ``deadline``,
``slot``, ``position``) are replaced.
"""

from __future__ import annotations

import heapq
import itertools
import math
from array import array
from collections.abc import Iterable, Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, hashable

ADDED = ("block", "release", "deadline", "slot", "position")
UNITS = 10 ** 17            # integer weights sum up to about this at most
BATCH = 10_000              # blocks listed or handed back at a time


def earliest_deadline_first(blocks: Iterable[tuple[int, int, int, int]]) -> Iterator[tuple]:
    """Blocks ``(release, deadline, source, number)``, sorted: each as
    ``(source, number, release, deadline, slot)``.

    Blocks of one release wait as a flat array; the heap holds the head of each.
    """
    ready: list[tuple] = []

    def pop() -> tuple:
        deadline, s, k, release, run, at = ready[0]
        if at < len(run):
            heapq.heapreplace(ready, (*run[at:at + 3], release, run, at + 3))
        else:
            heapq.heappop(ready)
        return s, k, release, deadline

    slot = 0
    for release, group in itertools.groupby(blocks, lambda x: x[0]):
        while ready and slot < release:
            yield *pop(), slot
            slot += 1
        slot = max(slot, release)
        run = array("q", itertools.chain.from_iterable(x[1:] for x in group))
        heapq.heappush(ready, (*run[:3], release, run, 3))
    while ready:
        yield *pop(), slot
        slot += 1


def integer_weights(weights: dict[str, float]) -> dict[str, int]:
    """Weights as integers of the same proportions, decimal fractions taken as written."""
    if any(w <= 0 for w in weights.values()) or not all(math.isfinite(w) for w in weights.values()):
        raise ValueError("weights must be positive")
    exact = {s: Fraction(repr(float(w))) for s, w in weights.items()}
    total, unit = sum(exact.values()), 1
    for w in exact.values():
        unit = math.lcm(unit, w.denominator)
        if total * unit > UNITS:
            unit = Fraction(UNITS) / total
            break
    return {s: max(1, round(w * unit)) for s, w in exact.items()}


def _root_weights(sizes: DataFrame) -> DataFrame:
    """Square roots of the row counts in units of a power of two: exact for square counts."""
    root = F.sqrt("_rows")
    total = sizes.agg(F.sum(root)).first()[0] or 1.0
    unit = 2.0 ** math.floor(math.log2(UNITS / total))
    return sizes.withColumn("_p", F.greatest(F.lit(1), F.round(root * unit)).cast("long"))


def _windows(blocks: DataFrame, total: int) -> DataFrame:
    """Release and deadline of block ``_k`` at ``_p`` of ``total``, in exact integers."""
    whole = F.lit(str(total)).cast("decimal(19,0)")
    part = F.col("_p").cast("decimal(19,0)")

    def quotient(k: Column, up: Column) -> Column:
        scaled = k.cast("decimal(18,0)") * whole + up
        return F.call_function("div", scaled.cast("decimal(38,0)"), part).cast("long")
    return (blocks.withColumn("release", quotient(F.col("_k"), F.lit(0).cast("decimal(19,0)")))
                  .withColumn("deadline", quotient(F.col("_k") + 1, part - 1)))


def _scheduled(blocks: DataFrame) -> DataFrame:
    """``(_i, _k, release, deadline, slot)`` of all blocks: one streaming task over small rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("_i", "_k", "release", "deadline", "slot")

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=list(names))
        waiting = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        out = []
        for row in earliest_deadline_first(waiting):
            out.append(row)
            if len(out) == BATCH:
                yield batch(out)
                out = []
        if out:
            yield batch(out)
    ordered = (blocks.select("release", "deadline", "_i", "_k").repartition(1)
                     .sortWithinPartitions("release", "deadline", "_i", "_k"))
    return ordered.mapInArrow(run, "_i long, _k long, release long, deadline long, slot long")


def _source(name: str):
    return F.when(F.col(name).isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col(name).cast("string")))


def numbered(df: DataFrame, source: str, doc_id: str) -> DataFrame:
    """Add ``_s`` (source key) and ``_n``, the row's number (from 0) in its source."""
    rows = df.select(*df.columns, _source(source).alias("_s"), F.xxhash64(doc_id).alias("_h"),
                     F.xxhash64(*[hashable(df, c) for c in df.columns]).alias("_r"))
    counts = rows.groupBy("_s").count()
    buckets = max(1, math.isqrt(counts.agg(F.sum("count")).first()[0] or 0))
    rows = rows.withColumn("_b", F.pmod("_h", F.lit(buckets)).cast("int"))
    before = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy("_s", "_b").agg(F.count(F.lit(1)).alias("_c"))
                  .select("_s", "_b", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_start")))
    inside = Window.partitionBy("_s", "_b").orderBy("_h", doc_id, "_r")
    return (rows.withColumn("_i", F.row_number().over(inside) - 1).join(starts, ["_s", "_b"])
                .withColumn("_n", F.col("_start") + F.col("_i")).drop("_h", "_r", "_b", "_i", "_start"))


def mix_sources(df: DataFrame, weights: dict[str | None, float] | None = None, source: str = "source",
                doc_id: str = "doc_id", block_rows: int = 16) -> DataFrame:
    """Add block, release, deadline, slot and position. Sort by ``position`` for the mixture.

    ``weights``: target weight per source value (None: null). Without them the
    square roots of the row counts are the targets, which lifts small sources.
    """
    df = df.drop(*ADDED)
    sizes = df.groupBy(_source(source).alias("_s")).agg(F.count(F.lit(1)).alias("_rows"))
    # numbered in source order, which breaks ties
    sizes = checkpointed(sizes.orderBy("_s").withColumn("_i", F.monotonically_increasing_id()))
    if weights is None:
        sizes = _root_weights(sizes)
        total = sizes.agg(F.sum("_p")).first()[0] or 1
    else:
        target = integer_weights({"-" if s is None else f"={s}": w for s, w in weights.items()})
        given = df.sparkSession.createDataFrame(list(target.items()), "_s string, _p long")
        sizes = sizes.join(given, "_s", "left")
        total = sum(target.values())
        missing = [r["_s"] for r in sizes.filter("_p IS NULL").orderBy("_s").limit(20).collect()]
        if missing:
            raise ValueError(f"no weight for {missing}")
    blocks = (sizes.withColumn("_last", F.floor((F.col("_rows") - 1) / block_rows).cast("long"))
                   .withColumn("_first", F.explode(F.sequence(F.lit(0).cast("long"), "_last", F.lit(BATCH).cast("long"))))
                   .select("_i", "_p", F.explode(F.sequence(
                       "_first", F.least("_last", F.col("_first") + BATCH - 1))).alias("_k")))
    plan = (_scheduled(_windows(blocks, total)).join(sizes.select("_i", "_s"), "_i")
            .select("_s", F.col("_k").alias("block"), "release", "deadline", "slot"))
    rows = numbered(df, source, doc_id).withColumn("block", F.floor(F.col("_n") / block_rows))
    return (rows.join(plan, ["_s", "block"])
                .withColumn("position", F.col("slot") * block_rows + F.col("_n") % block_rows)
                .select(*df.columns, *ADDED))
