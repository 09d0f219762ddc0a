"""Exact search for repeated windows: shared engine of the two substring operators.

A *cutter* turns a run of texts into windows and groups the windows of a text
into blocks (consecutive window starts), each with a gram: a 64-bit value that
equal windows agree on. The engine finds all windows whose content starts
anywhere else:

1. blocks whose gram occurs once are passed over, by a count-min sketch of the
   grams that never undercounts;
2. blocks are grouped by their whole content (128-bit hash): a content seen
   twice settles all windows of the block with one row per block;
3. where a gram has several contents, the windows of those blocks are grouped
   one by one, one representative standing for each content. Blocks without a
   gram (``free``) go here directly.

Groups are hash aggregates joined back, so a passage in a third of all
documents is summed before the shuffle and its join partition can be split.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import materialize
from .common import PrimeRolling, Rolling, mix, ranges, signed, text_chunks

ROWS = 2
CELLS = 1 << 27
ROWS_OUT = 100_000          # window rows handed to Spark at a time
_SPLIT = 1 << 20            # cells per shard of the merged sketch


class Cut:
    """Windows of a run of texts.

    ``first``: index of each text's first unit (word or byte), one more at the
    end. Per block: ``at`` (unit index of its first window), ``size`` (windows),
    ``doc``, ``gram`` and ``free`` (no gram). ``a``: rolling hash of the units;
    ``units_b`` makes their values for a second one, modulo a prime.
    """

    first: np.ndarray
    at: np.ndarray
    size: np.ndarray
    doc: np.ndarray
    gram: np.ndarray
    free: np.ndarray
    a: Rolling
    units_b: Callable[[], np.ndarray]
    _b: PrimeRolling | None = None

    def hashes(self, start: np.ndarray, end: np.ndarray):
        size = (end - start).astype(np.uint64)
        if self._b is None:                     # only where contents are compared
            self._b = PrimeRolling(self.units_b())
        return mix(self.a.slices(start, end) + size, 21), mix(self._b.slices(start, end) + size, 22)


def _cells(gram: np.ndarray, rows: int, cells: int) -> Iterator[np.ndarray]:
    for r in range(rows):
        yield (mix(gram, 31 + r) % np.uint64(cells)).astype(np.int64) + r * cells


def sketch(docs: DataFrame, text: str, cutter, rows: int, cells: int) -> DataFrame:
    """Count-min sketch of the blocks' grams, merged over all partitions: ``(cell, n)``.

    Each task's sketch is sparse (the cells it touched); Spark adds them up.
    """
    def run(batches):
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                w = cutter.cut(data, offsets)
                cell, n = np.unique(np.concatenate(list(_cells(w.gram[~w.free], rows, cells))),
                                    return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n)], names=["cell", "n"])

    return (docs.select(text).mapInArrow(run, "cell long, n long")
                .groupBy("cell").agg(F.sum("n").alias("n")))


def repeated_cells(merged: DataFrame, rows: int, cells: int) -> list[np.ndarray]:
    """Bitmaps, one per sketch row, of the cells with a count of two or more.

    Each shard of the sketch becomes one packed string; what reaches the driver
    is the bitmaps, ``rows * cells / 8`` bytes whatever the corpus.
    """
    if cells % 8:
        raise ValueError("the number of cells is a multiple of 8")

    def pack(batches):
        bits: dict[int, np.ndarray] = {}
        for batch in batches:
            cell = batch.column(0).to_numpy(zero_copy_only=False)
            for shard in np.unique(cell // _SPLIT):
                own = cell[cell // _SPLIT == shard] - shard * _SPLIT
                got = bits.setdefault(int(shard), np.zeros(_SPLIT, bool))
                got[own] = True
        if bits:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(bits)), pa.array([np.packbits(b).tobytes() for b in bits.values()])],
                names=["shard", "bits"])

    shards = -(-rows * cells // _SPLIT)
    hot = merged.filter("n >= 2").select("cell")
    parts = min(shards, 64)
    packed = (hot.repartition(parts, F.expr(f"cell div {_SPLIT}"))
                 .mapInArrow(pack, "shard long, bits binary"))
    out = np.zeros(shards * _SPLIT // 8, np.uint8)
    for row in packed.toLocalIterator():
        at = row.shard * _SPLIT // 8
        out[at:at + _SPLIT // 8] |= np.frombuffer(row.bits, np.uint8)
    return [out[r * cells // 8:(r + 1) * cells // 8] for r in range(rows)]


def _passes(gram: np.ndarray, bitmaps: list[np.ndarray], cells: int) -> np.ndarray:
    ok = np.ones(len(gram), bool)
    for r, cell in enumerate(_cells(gram, len(bitmaps), cells)):
        cell = cell - r * cells
        ok &= (bitmaps[r][cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
    return ok


def _blocks(docs: DataFrame, text: str, cutter, shared: Broadcast, cells: int) -> DataFrame:
    """Blocks estimated repeated: gram, 128-bit content, row key, first window and their number.

    ``shared``: the bitmaps' bytes, one per sketch row.
    """
    names = ["g", "k1", "k2", "r1", "r2", "s", "n", "free"]

    def run(batches):
        maps = [np.frombuffer(b, np.uint8) for b in shared.value]
        for batch in batches:
            r1, r2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            for lo, _, data, offsets in text_chunks(batch.column(0)):
                w = cutter.cut(data, offsets)
                take = np.flatnonzero(w.free | _passes(w.gram, maps, cells))
                at, size, doc = w.at[take], w.size[take], w.doc[take]
                k1, k2 = map(signed, w.hashes(at, at + size + cutter.width - 1))
                s, free = at - w.first[doc], w.free[take]
                # blocks without a gram are not met by content: their copies are dealt out
                k1 = np.where(free, r1[lo + doc] + s, k1)
                yield pa.RecordBatch.from_arrays([
                    pa.array(signed(w.gram[take])), pa.array(k1), pa.array(k2),
                    pa.array(r1[lo + doc]), pa.array(r2[lo + doc]),
                    pa.array(s.astype(np.int32)), pa.array(size.astype(np.int32)),
                    pa.array(free)], names=names)

    return docs.select(text, "r1", "r2").mapInArrow(
        run, "g long, k1 long, k2 long, r1 long, r2 long, s int, n int, free boolean")


def _window_rows(docs: DataFrame, text: str, cutter) -> DataFrame:
    """Windows of the blocks listed in ``open``: 128-bit content, place, times, whether to report."""
    schema = "h1 long, h2 long, r1 long, r2 long, s int, times int, ask boolean"
    rest = [c for c in docs.columns if c not in (text, "r1", "r2", "open")]

    def run(batches):
        for batch in batches:
            r1, r2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            todo = batch.column(3)
            for lo, hi, data, offsets in text_chunks(batch.column(0)):
                w = cutter.cut(data, offsets)
                some = todo.slice(lo, hi - lo)
                each = some.flatten()
                docs_of = np.repeat(np.arange(hi - lo), some.value_lengths().to_numpy(zero_copy_only=False))
                starts, sizes, copies = (each.field(i).to_numpy(zero_copy_only=False).astype(np.int64)
                                         for i in range(3))
                # a bounded number of windows goes out at a time
                pieces = np.cumsum(sizes) // ROWS_OUT
                for piece in np.unique(pieces):
                    of = pieces == piece
                    n = sizes[of]
                    doc, times = np.repeat(docs_of[of], n), np.repeat(copies[of], n)
                    at = ranges(w.first[docs_of[of]] + starts[of], n)
                    h1, h2 = w.hashes(at, at + cutter.width)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(signed(h1)), pa.array(signed(h2)), pa.array(r1[lo + doc]), pa.array(r2[lo + doc]),
                        pa.array((at - w.first[doc]).astype(np.int32)), pa.array(times.astype(np.int32)),
                        pa.array(times < 2)], names=["h1", "h2", "r1", "r2", "s", "times", "ask"])

    # all columns are taken, so that Spark reads the shuffle of the final join here too
    return docs.select(text, "r1", "r2", "open", *rest).mapInArrow(run, schema)


def repeated_windows(docs: DataFrame, text: str, cutter, rows: int = ROWS, cells: int = CELLS) -> DataFrame:
    """Runs of repeated windows per document: ``(r1, r2, runs)``.

    ``docs`` carries the row key ``r1, r2``; ``runs`` is an array of (s, n,
    bits): ``n`` windows from ``s`` on, or those of 64 whose bit is set.
    """
    bitmaps = repeated_cells(sketch(docs, text, cutter, rows, cells), rows, cells)
    shared = docs.sparkSession.sparkContext.broadcast([b.tobytes() for b in bitmaps])
    every = _blocks(docs, text, cutter, shared, cells)
    # with the nulls named, Spark finds the same filter in both uses of ``kinds``
    blocks = every.filter("not free and g is not null and k1 is not null and k2 is not null")
    # content of blocks: how often, and a row that stands for it
    kinds = blocks.groupBy("g", "k1", "k2").agg(F.count(F.lit(1)).alias("c"), F.min("r1").alias("m1"))
    # grams with several contents: windows of different blocks may be equal. The
    # filter reads c and m1 so that both uses of ``kinds`` share one shuffle.
    several = (kinds.groupBy("g").agg(F.count(F.lit(1)).alias("kinds"), F.max("c").alias("most"),
                                      F.max("m1").alias("last"))
                    .filter("most > 1 or (kinds > 1 and last is not null)").select("g", "kinds"))
    kinds = kinds.join(several, "g").filter("c > 1 or kinds > 1")
    # a content's blocks in the row that stands for it are compared for all copies;
    # how often matters only up to twice. Free blocks pass, and meet no kind.
    met = every.join(kinds.drop("g"), ["k1", "k2"], "left").filter("free or kinds is not null")
    stands = (F.col("kinds") > 1) & ((F.col("c") == 1) | (F.col("r1") == F.col("m1")))
    found = materialize(met.select(
        "r1", "r2", "s", "n", F.when(F.col("free"), 1).otherwise(F.least("c", F.lit(2))).cast("int").alias("c"),
        (F.col("free") | stands).alias("open")).filter("c > 1 or open"), "repeats")
    shared.destroy()            # every executor holds the bitmaps as a file; nothing below reads them
    settled = found.filter("c > 1").select("r1", "r2", "s", "n")
    todo = (found.filter("open").groupBy("r1", "r2")
                 .agg(F.collect_list(F.struct("s", "n", "c")).alias("open")))
    windows = _window_rows(docs.join(todo.hint("shuffle_hash"), ["r1", "r2"]), text, cutter)
    counts = windows.groupBy("h1", "h2").agg(F.sum("times").alias("c")).filter("c > 1").drop("c")
    # single windows as bits of 64-window words: short lists, however many repeat
    equal = (windows.filter("ask").join(counts, ["h1", "h2"])
                    .select("r1", "r2", F.expr("s div 64 * 64").cast("int").alias("s"),
                            F.call_function("shiftleft", F.lit(1).cast("long"), F.col("s") % 64).alias("bit"))
                    .groupBy("r1", "r2", "s").agg(F.bit_or("bit").alias("bits"))
                    .select("r1", "r2", "s", F.lit(0).alias("n"), "bits"))
    return (settled.withColumn("bits", F.lit(0).cast("long")).unionByName(equal).groupBy("r1", "r2")
                   .agg(F.collect_list(F.struct("s", "n", "bits")).alias("runs")))


def covered(runs: pa.Array, first: np.ndarray, units: int, width: int) -> np.ndarray:
    """Which units (words, bytes) the repeated windows of a run of texts cover."""
    lengths = np.nan_to_num(runs.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    each = runs.flatten()
    s, n, bits = (each.field(i).to_numpy(zero_copy_only=False) for i in range(3))
    begin = np.repeat(first[:-1], lengths) + s
    words = np.flatnonzero(bits)
    set_bits = np.unpackbits(bits[words].astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, bit = np.nonzero(set_bits)
    begin = np.concatenate([begin[n > 0], begin[words][row] + bit])
    n = np.concatenate([n[n > 0], np.ones(len(row), n.dtype)]).astype(np.int64)
    change = np.zeros(units + 1, np.int32)
    np.add.at(change, begin, 1)
    np.add.at(change, begin + n + width - 1, -1)
    return np.cumsum(change)[:-1] > 0
