"""Ranked lists after every change, by folds over slices.

The input is a changelog: one row per change, carrying an item's value from then
on. Asked for is, after every change, the first ``n`` items of the key. Rows are
folded in order inside each (key, slice); what a slice starts with is made from
one row per (key, slice, item), so rows are shuffled once per (key, slice) and
their number stays linear in the input. Two ways to the start of a slice:

``seeds_growing`` — items only ever improve (counts under "most first"). What
  beats an item at its last change beats it for good, so the first ``n`` of each
  slice's changed items are enough, and lists merge: a key's slices are passed
  in order, carrying ``n`` items.

``seeds_of_untouched`` — any values. In a slice, only the items changed in it
  and the first ``n`` of the others matter. Slices of a key are passed in order
  with a heap of its items; a key's items are dealt to groups of about
  ``GROUP_ITEMS``, so a task holds one group, and the groups' first ``n`` are
  ranked per slice.

The folds run in Arrow batches and hold one list, group or slice; Spark sorts
and spreads the rows.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import SLICE_SECONDS, conf_int
from .materialize import materialize
from .ranking import rank_within
from .running import SLICE, slice_of

GROUP_ITEMS = 50_000
BEFORE = -(1 << 62)         # slice number of what was known before the first row
_VALUE = ["_i", "_n", "_o"]
_VALUE_DDL = "_i long, _n long, _o array<long>"


def lists_after(changes: DataFrame, key: str, item: str, value: str, order: list[Column], n: int, *,
                growing: bool, stored: DataFrame | None = None, ts: str = "ts", row: str = "id",
                rank_col: str = "rnk") -> DataFrame:
    """``(row, key, rank, item, value)``: the first ``n`` items of the key after every change.

    ``order``: bigint columns of a change, least first, a total order of the
    key's items at any time. ``growing``: an item's place only improves.
    ``stored``: changes (key, item, value, ts, id) made before all of ``changes``;
    for ``growing`` the first ``n`` per key are enough. Keys are not null.
    """
    seconds = conf_int(changes.sparkSession, SLICE_SECONDS)

    def entries(df, slice_no):
        return df.select(F.col(key).cast("long").alias("_key"), F.col(item).cast("long").alias("_i"),
                         F.col(value).cast("long").alias("_n"), F.array(*[o.cast("long") for o in order]).alias("_o"),
                         F.col(ts).alias("_t"), F.col(row).cast("long").alias("_row"), slice_no.alias(SLICE))

    rows = materialize(entries(changes, slice_of(F.col(ts), seconds)), "changes")
    ends = (rows.groupBy("_key", SLICE, "_i").agg(F.max(F.struct("_t", "_row", "_n", "_o")).alias("_e"))
                .select("_key", SLICE, "_i", "_e._n", "_e._o"))
    if stored is not None:
        ends = ends.unionByName(entries(stored, F.lit(BEFORE).cast("long")).select("_key", SLICE, *_VALUE))
    seeds = (seeds_growing if growing else seeds_of_untouched)(ends, n)
    fold = rows.select("_key", SLICE, F.col("_row"), F.col("_t"), *_VALUE).unionByName(
        seeds.select("_key", SLICE, F.lit(None).cast("long").alias("_row"),
                     F.lit(None).cast("timestamp").alias("_t"), *_VALUE))
    out = (fold.repartition("_key", SLICE).sortWithinPartitions("_key", SLICE, "_t", "_row")   # seeds (null) first
               .select("_key", SLICE, "_row", *_VALUE)
               .mapInArrow(_fold(n, growing), "_row long, _key long, _r long, _i long, _n long"))
    return out.select(F.col("_row").alias(row), F.col("_key").alias(key), F.col("_r").alias(rank_col),
                      F.col("_i").alias(item), F.col("_n").alias(value))


def _columns(batch: pa.RecordBatch, *names: str):
    return zip(*(batch.column(name).to_pylist() for name in names))


def seeds_growing(ends: DataFrame, n: int) -> DataFrame:
    """The first ``n`` items at the start of every (key, slice)."""
    best = rank_within(ends, ["_key", SLICE], [F.col("_o")], n).select("_key", SLICE, *_VALUE)

    def run(batches):
        key, slice_no, held = None, None, {}
        for batch in batches:
            out = []
            for k, s, *value in _columns(batch, "_key", SLICE, *_VALUE):
                if k != key:
                    key, slice_no, held = k, None, {}
                if s != slice_no:
                    held = dict(sorted(held.items(), key=lambda e: e[1][1])[:n])
                    out += [(k, s, i, *v) for i, v in held.items()]
                    slice_no = s
                held[value[0]] = (value[1], value[2])
            yield _batch(out, _SEEDS)

    return (best.repartition("_key").sortWithinPartitions("_key", SLICE)
                .mapInArrow(run, f"_key long, {SLICE} long, {_VALUE_DDL}"))


def seeds_of_untouched(ends: DataFrame, n: int) -> DataFrame:
    """Per (key, slice): the changed items' values before it and the first ``n`` of the other items."""
    sizes = (ends.groupBy("_key").agg(F.approx_count_distinct("_i").alias("_items"))
                 .select("_key", (F.expr(f"_items div {GROUP_ITEMS}") + 1).alias("_groups")))
    ticks = (ends.select("_key", SLICE).distinct().join(sizes, "_key")
                 .select("_key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_groups") - 1)).alias("_g"), SLICE,
                         *[F.lit(None).cast(t).alias(c) for c, t in zip(_VALUE, ("long", "long", "array<long>"))],
                         F.lit(True).alias("_tick")))
    dealt = ends.join(sizes, "_key").select(
        "_key", F.pmod(F.xxhash64("_i"), F.col("_groups")).alias("_g"), SLICE, *_VALUE, F.lit(False).alias("_tick"))

    def run(batches):
        group = None
        now, heap, changed, slice_no = {}, [], [], None

        def close(out):
            """The slice is complete: what it started with, then its changes."""
            if slice_no is None:
                return
            touched = {i for i, _, _ in changed}
            if slice_no != BEFORE:
                for i in touched & now.keys():
                    out.append((*group, slice_no, i, *now[i], True))
                passed, least = [], 0
                while heap and least < n:
                    entry = heapq.heappop(heap)
                    if entry[1] in now and now[entry[1]][1] == entry[0]:
                        passed.append(entry)
                        if entry[1] not in touched:
                            least += 1
                            out.append((*group, slice_no, entry[1], *now[entry[1]], False))
                for entry in passed:
                    if entry[1] not in touched:
                        heapq.heappush(heap, entry)
            for i, value, o in changed:
                now[i] = (value, o)
                heapq.heappush(heap, (o, i))

        for batch in batches:
            out = []
            for k, g, s, tick, *value in _columns(batch, "_key", "_g", SLICE, "_tick", *_VALUE):
                if (k, g) != group:
                    close(out)
                    group, now, heap, changed, slice_no = (k, g), {}, [], [], None
                if s != slice_no:
                    close(out)
                    changed, slice_no = [], s
                if not tick:
                    changed.append(tuple(value))
            if len(out):
                yield _batch([(r[0], r[2], *r[3:]) for r in out], _TOUCHED)
        out = []
        close(out)
        yield _batch([(r[0], r[2], *r[3:]) for r in out], _TOUCHED)

    swept = (dealt.unionByName(ticks).repartition("_key", "_g").sortWithinPartitions("_key", "_g", SLICE)
                  .mapInArrow(run, f"_key long, {SLICE} long, {_VALUE_DDL}, _changed boolean"))
    # changed items all, others the first n of all groups
    return rank_within(swept, ["_key", SLICE, "_changed"], [F.col("_o")], None, "_r").filter(
        F.col("_changed") | (F.col("_r") <= n)).select("_key", SLICE, *_VALUE)


_SEEDS = [("_key", pa.int64()), (SLICE, pa.int64()), ("_i", pa.int64()), ("_n", pa.int64()),
          ("_o", pa.list_(pa.int64()))]
_TOUCHED = [*_SEEDS, ("_changed", pa.bool_())]
_LISTS = [(name, pa.int64()) for name in ("_row", "_key", "_r", "_i", "_n")]


def _batch(rows: list[tuple], fields) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)],
                                      names=[name for name, _ in fields])


def _fold(n: int, growing: bool):
    """Rows of a (key, slice) in order, its start first: the list after every row."""
    def run(batches):
        at, now, heap = None, {}, []
        for batch in batches:
            out = []
            for k, s, row, *value in _columns(batch, "_key", SLICE, "_row", *_VALUE):
                if (k, s) != at:
                    at, now, heap = (k, s), {}, []
                i, count, o = value
                now[i] = (count, o)
                if growing:
                    if row is None:
                        continue
                    best = sorted(((v[1], j) for j, v in now.items()))[:n]
                    now = {j: now[j] for _, j in best}
                else:
                    heapq.heappush(heap, (o, i))
                    if row is None:
                        continue
                    best = []
                    while heap and len(best) < n:
                        entry = heapq.heappop(heap)
                        if now[entry[1]][1] == entry[0]:
                            best.append(entry)
                    for entry in best:
                        heapq.heappush(heap, entry)
                out += [(row, k, r, j, now[j][0]) for r, (_, j) in enumerate(best, 1)]
            yield _batch(out, _LISTS)
    return run
