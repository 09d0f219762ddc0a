"""Exact running folds per key that stay balanced when one key is hot.

A changelog ("every input row emits the key's updated result") is a running
aggregate ordered by ``(ts, id)``. Written as one window partitioned by the
key, a key that holds a third of all rows would be sorted in a single task.
Instead the time line of every key is cut into slices of
``encore.slice.seconds``:

1. a partial aggregate per ``(key, slice)`` straight from the input — a
   narrow re-read of the input, and only one row per slice is shuffled;
2. a prefix over the slices of each key: a window over that small table;
3. the rows are shuffled once by ``(key, slice)``, joined to their slice's
   prefix there (only the small table moves), and finished by a window over
   ``(key, slice)``.

The big side crosses the network once, the largest sorted group is one key's
records of one slice, and results are exact (no sampling, no cap).

The input is read twice: by the narrow partial aggregate of step 1 and by
step 3. Spark cannot share one exchange between the two (each is pruned to
its own columns), so when the input is itself the product of a shuffle join
over large tables, materialize it first (``DataFrame.checkpoint()`` or a table
under ``spark.checkpoint.dir``) instead of recomputing that join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import SLICE_SECONDS, conf_int

SLICE = "_slice"


def slice_of(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("bigint")


def _prefix(slices: DataFrame, keys: Sequence[str], totals: Sequence[str],
            firsts: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Per (key, slice): sums of ``totals`` over earlier slices, ``firsts`` of the first slice."""
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    return slices.select(
        *keys, SLICE, *extra,
        *[F.coalesce(F.sum(t).over(before), F.lit(0)).alias(f"_before{t}") for t in totals],
        *[F.first(f).over(whole).alias(f"_head{f}") for f in firsts],
    )


def running(df: DataFrame, keys: Sequence[str], *, ts: str = "ts", tiebreak: str = "id",
            counts: Sequence[str] = (), sums: dict[str, str] | None = None,
            firsts: dict[str, str] | None = None, since: DataFrame | None = None,
            per_key: Callable[[DataFrame], DataFrame] | None = None,
            slice_seconds: int | None = None) -> DataFrame:
    """Add running aggregates per key in ``(ts, tiebreak)`` order.

    ``counts``: names of columns receiving the running row count (1, 2, ...).
    ``sums``:   ``{out: col}`` running sum of ``col`` (bigint for integers).
    ``firsts``: ``{out: col}`` value of ``col`` on the key's first row. Its
    ``min_by`` over ``(ts, id)`` has a struct buffer, which Spark aggregates by
    sorting; meant for small inputs (one row per event), not record streams.
    ``since``: small table ``(keys..., since)``; rows before their key's time,
    and rows of keys without one, are dropped. It meets the slices, not the
    rows: only rows of the slice in which a key begins are looked at one by one.
    ``per_key``: gets the small table ``(keys..., first_ts)`` (time of each
    key's first row, from hash aggregates) and returns ``(keys..., extra...)``;
    the extra columns reach every row through the slice join, so per-key
    facts cost no extra pass over the rows.
    """
    sums, firsts = dict(sums or {}), dict(firsts or {})
    seconds = slice_seconds or conf_int(df.sparkSession, SLICE_SECONDS)
    d = df.withColumn(SLICE, slice_of(F.col(ts), seconds))
    order = F.struct(F.col(ts), F.col(tiebreak))

    def totals_of(rows):
        return rows.groupBy(*keys, SLICE).agg(
            F.count(F.lit(1)).alias("_tot_c"),
            F.min(ts).alias("_min_ts"),
            *[F.sum(c).alias(f"_tot_{o}") for o, c in sums.items()],
            *[F.min_by(c, order).alias(f"_fst_{o}") for o, c in firsts.items()])

    slices = totals_of(d)
    if since is not None:
        begun = slices.join(since.select(*keys, F.col("since").alias("_since")), list(keys))
        mixed = (slice_of(F.col("_since"), seconds) == F.col(SLICE)) & (F.col("_min_ts") < F.col("_since"))
        split = (d.join(begun.filter(mixed).select(*keys, SLICE, "_since"), [*keys, SLICE])
                  .filter(F.col(ts) >= F.col("_since")))
        slices = (begun.filter(F.col("_min_ts") >= F.col("_since"))
                       .unionByName(totals_of(split).join(
                           since.select(*keys, F.col("since").alias("_since")), list(keys))))
    totals = ["_tot_c", *[f"_tot_{o}" for o in sums]]
    heads = [f"_fst_{o}" for o in firsts]
    pre = _prefix(slices, keys, totals, heads, ["_since"] if since is not None else [])
    if per_key is not None:
        first = slices.groupBy(*keys).agg(F.min("_min_ts").alias("first_ts"))
        pre = pre.join(per_key(first), list(keys))
    d = d.join(pre, [*keys, SLICE])
    if since is not None:
        d = d.filter(F.col(ts) >= F.col("_since")).drop("_since")

    upto = (Window.partitionBy(*keys, SLICE).orderBy(F.col(ts), F.col(tiebreak))
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = {}
    for name in counts:
        out[name] = F.count(F.lit(1)).over(upto) + F.col("_before_tot_c")
    for o, c in sums.items():
        out[o] = F.sum(c).over(upto) + F.col(f"_before_tot_{o}")
    for o in firsts:
        out[o] = F.col(f"_head_fst_{o}")
    helper = [c for c in d.columns if c.startswith(("_before", "_head"))]
    return d.withColumns(out).drop(SLICE, *helper)


def asof_sum(probes: DataFrame, rows: DataFrame, keys: Sequence[str], *, value: Column | None = None,
             out: str = "n", probe_ts: str = "ts", row_ts: str = "ts",
             slice_seconds: int | None = None) -> DataFrame:
    """For every probe, the sum of ``value`` (default: the count) of its key's
    ``rows`` with ``ts <= probe_ts``.

    A left temporal lookup into a running sum, without a running sum per row.
    Probes and rows are shuffled together once by ``(key, slice)``, where a
    window sums the rows up to each probe (rows first at equal time: the table
    side is seen first). What came before the slice is a prefix over one row
    per (key, slice), summed before its shuffle and joined back by equality on
    (key, slice). Probes without rows get 0; null keys never count.
    """
    seconds = slice_seconds or conf_int(probes.sparkSession, SLICE_SECONDS)
    pcols = probes.columns
    value = F.lit(1) if value is None else value
    r = rows.select(*keys, F.col(row_ts).alias("_t"), F.lit(0).alias("_side"),
                    value.cast("bigint").alias("_w"))
    for k in keys:
        r = r.filter(F.col(k).isNotNull())
    p = probes.select(*keys, F.col(probe_ts).alias("_t"), F.lit(1).alias("_side"),
                      F.lit(0).cast("bigint").alias("_w"), F.struct(*pcols).alias("_p"))
    u = p.unionByName(r.withColumn("_p", F.lit(None).cast(p.schema["_p"].dataType)))
    u = u.withColumn(SLICE, slice_of(F.col("_t"), seconds))

    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    before = (u.groupBy(*keys, SLICE).agg(F.sum("_w").alias("_w"))
               .select(*keys, SLICE, F.coalesce(F.sum("_w").over(earlier), F.lit(0)).alias("_before")))
    upto = (Window.partitionBy(*keys, SLICE).orderBy("_t", "_side")
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    probed = (u.withColumn("_in", F.sum("_w").over(upto)).filter(F.col("_side") == 1)
               .join(before, [*keys, SLICE], "left"))
    # a probe with a null key meets nothing and keeps 0
    return probed.select("_p.*", F.when(F.col("_before").isNull(), F.lit(0))
                         .otherwise(F.col("_before") + F.col("_in")).cast("bigint").alias(out))


def asof_count(probes: DataFrame, rows: DataFrame, keys: Sequence[str], **settings) -> DataFrame:
    """For every probe, how many ``rows`` of its key have ``ts <= probe_ts``."""
    return asof_sum(probes, rows, keys, **settings)
