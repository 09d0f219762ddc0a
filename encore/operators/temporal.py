"""Tables over time and the temporal (as-of) lookup join.

A *table* here is a set of versions ``(key..., ts, payload...)``: the value a
key had from ``ts`` on (last write wins). A stream row at time ``t`` sees, for
its key, the newest version with ``version.ts <= t``; versions written later
never reach it. Ties at equal ``ts`` are broken by the record id, and a version
written at the same moment as the stream row is visible to it.

A version whose ``deleted`` column is true is a tombstone: it ends the value
before it, and rows that arrive until the next version find nothing.

Two plans, same result:

``strategy="interval"`` — for dimension tables with few versions per key.
  Versions become validity intervals ``[ts, valid_to)`` (one ``lead`` per key
  on the table side) and the stream is joined on the key plus
  ``ts <= t < valid_to``; at most one version matches, nothing fans out.
  Spark broadcasts the interval table when its size check allows (planner
  estimate, re-checked by AQE from measured sizes) and the stream is not
  shuffled at all; otherwise it is a shuffle join whose hot keys AQE splits.
  Each stream row is checked against the versions of its key, so this plan is
  for keys with a handful of versions.

``strategy="sliced"`` (default) — for tables that grow with the data (customer
  addresses). Stream rows and versions are shuffled together once by
  ``(key, time slice)``; a window there carries the last version seen to every
  stream row. The version current at the start of a slice comes from one row
  per (key, slice): the slice's last version, carried over the key's slices by
  a window on that small table and joined back by equality on (key, slice),
  the partitioning the rows already have. A hot key is spread over its slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VALID_TO = "valid_to"


def arrival(ts: str = "ts", tiebreak: str = "id") -> Column:
    """``(ts, bigint id)`` as one fixed-width number of the same order.

    Spark keeps it in a hash-aggregate buffer, where a struct of the two would
    make the aggregate sort its input.
    """
    wide = "decimal(38,0)"
    micros = F.unix_micros(F.col(ts).cast("timestamp")).cast("decimal(18,0)")
    return (micros * F.lit("20000000000000000000").cast("decimal(20,0)")
            + F.col(tiebreak).cast("decimal(20,0)")).cast(wide)


def _is_deleted(deleted: str) -> Column:
    return F.coalesce(F.col(deleted), F.lit(False))


def latest_by_key(df: DataFrame, keys: Sequence[str], ts: str = "ts",
                  tiebreak: str = "id", deleted: str | None = None) -> DataFrame:
    """Current value of every key: the row with the greatest ``(ts, tiebreak)``.

    Keys whose last row is a tombstone are left out. ``max_by`` is a partial aggregate, so a hot key is reduced map-side before
    the shuffle and never gathered into one task. Its buffer holds the payload,
    so Spark sorts each task's rows by key; meant for dimension tables. Record
    streams use ``arrival`` with a hash aggregate.
    """
    rest = [c for c in df.columns if c not in keys]
    out = (df.groupBy(*keys)
             .agg(F.max_by(F.struct(*rest), F.struct(ts, tiebreak)).alias("_v"))
             .select(*keys, "_v.*"))
    return out if deleted is None else out.filter(~_is_deleted(deleted)).drop(deleted)


def versions_by_key(df: DataFrame, keys: Sequence[str], ts: str = "ts",
                    tiebreak: str = "id", deleted: str | None = None,
                    slice_seconds: int | None = None) -> DataFrame:
    """All versions of a table with their validity end ``valid_to`` (null = open).

    A tombstone ends the version before it and is no version itself. Rows with a
    null key are dropped: they can never be looked up. With ``slice_seconds`` (for
    tables that grow with the data) a key's versions are spread over its slices of
    time: the last one of a slice ends where the next slice begins, which comes
    from one row per (key, slice).
    """
    clean = df
    for k in keys:
        clean = clean.filter(F.col(k).isNotNull())
    if slice_seconds is None:
        w = Window.partitionBy(*keys).orderBy(F.col(ts), F.col(tiebreak))
        out = clean.withColumn(VALID_TO, F.lead(ts).over(w))
    else:
        from .running import SLICE, slice_of
        rows = clean.withColumn(SLICE, slice_of(F.col(ts), slice_seconds))
        inside = Window.partitionBy(*keys, SLICE).orderBy(F.col(ts), F.col(tiebreak))
        begins = rows.groupBy(*keys, SLICE).agg(F.min(ts).alias("_begin"))
        after = begins.select(*keys, SLICE, F.lead("_begin").over(Window.partitionBy(*keys).orderBy(SLICE)).alias("_next"))
        out = (rows.withColumn(VALID_TO, F.lead(ts).over(inside)).join(after, [*keys, SLICE])
                   .withColumn(VALID_TO, F.coalesce(VALID_TO, "_next")).select(*df.columns, VALID_TO))
    return out if deleted is None else out.filter(~_is_deleted(deleted)).drop(deleted)


def temporal_join(left: DataFrame, table: DataFrame, on: dict[str, str] | Sequence[str],
                  *, left_ts: str = "ts", table_ts: str = "ts", tiebreak: str = "id",
                  payload: Sequence[str] | dict[str, str] | None = None,
                  how: str = "inner", strategy: str = "sliced",
                  slice_seconds: int | None = None, deleted: str | None = None) -> DataFrame:
    """Join every ``left`` row to the ``table`` version current at ``left_ts``.

    ``on`` maps left columns to table key columns (a list means equal names).
    ``payload`` are the table columns to bring along (dict: name -> alias);
    by default every non-key column except the version time.
    ``how`` is ``inner`` (rows without a version are dropped) or ``left``.
    ``deleted`` names the table's tombstone column.
    ``strategy``: ``sliced`` (default, any table size) or ``interval``
    (dimension tables; see the module doc).
    Whether an interval table is broadcast is left to Spark's size checks.
    """
    if how not in ("inner", "left"):
        raise ValueError("temporal_join supports inner and left")
    pairs = list(on.items()) if isinstance(on, dict) else [(k, k) for k in on]
    rkeys = [r for _, r in pairs]
    if payload is None:
        payload = {c: c for c in table.columns if c not in rkeys and c not in (table_ts, tiebreak, deleted)}
    elif not isinstance(payload, dict):
        payload = {c: c for c in payload}
    if strategy == "interval":
        return _interval_join(left, table, pairs, left_ts, table_ts, tiebreak, payload, how, deleted)
    if strategy == "sliced":
        return _sliced_join(left, table, pairs, left_ts, table_ts, tiebreak, payload, how, slice_seconds, deleted)
    raise ValueError(f"unknown strategy {strategy!r}")


def _interval_join(left, table, pairs, left_ts, table_ts, tiebreak, payload, how, deleted):
    rkeys = [r for _, r in pairs]
    needed = list(dict.fromkeys([*rkeys, table_ts, tiebreak, *payload.keys(), *([deleted] if deleted else [])]))
    iv = versions_by_key(table.select(*needed), rkeys, table_ts, tiebreak, deleted)
    iv = iv.select(
        *[F.col(r).alias(f"_tk{i}") for i, r in enumerate(rkeys)],
        F.col(table_ts).alias("_tfrom"), F.col(VALID_TO).alias("_tto"),
        *[F.col(src).alias(dst) for src, dst in payload.items()],
    )
    t = F.col(left_ts)
    cond: Column = (F.col("_tfrom") <= t) & (F.col("_tto").isNull() | (t < F.col("_tto")))
    for i, (lk, _) in enumerate(pairs):
        cond = cond & (left[lk] == F.col(f"_tk{i}"))
    out = left.join(iv, cond, how)
    return out.drop(*[f"_tk{i}" for i in range(len(pairs))], "_tfrom", "_tto")


def _sliced_join(left, table, pairs, left_ts, table_ts, tiebreak, payload, how, slice_seconds, deleted):
    from ..session import SLICE_SECONDS, conf_int
    from .running import SLICE, slice_of
    seconds = slice_seconds or conf_int(left.sparkSession, SLICE_SECONDS)
    keys = [f"_k{i}" for i in range(len(pairs))]
    lcols = left.columns
    gone = _is_deleted(deleted) if deleted else F.lit(False)
    vstruct = F.struct(*[F.col(src).alias(dst) for src, dst in payload.items()], gone.alias("_gone"))

    has_key = F.lit(True)
    for lk, _ in pairs:
        has_key = has_key & F.col(lk).isNotNull()

    V = table.select(*[F.col(rk).alias(k) for (_, rk), k in zip(pairs, keys)],
                     F.col(table_ts).alias("_t"), F.lit(0).alias("_side"),
                     F.col(tiebreak).alias("_tb"), vstruct.alias("_v"))
    for k in keys:
        V = V.filter(F.col(k).isNotNull())
    V = V.withColumn(SLICE, slice_of(F.col("_t"), seconds))
    L = left.filter(has_key).select(
        *[F.col(lk).alias(k) for (lk, _), k in zip(pairs, keys)],
        F.col(left_ts).alias("_t"), F.lit(1).alias("_side"),
        F.lit(None).cast(V.schema["_tb"].dataType).alias("_tb"),
        F.lit(None).cast(V.schema["_v"].dataType).alias("_v"), F.struct(*lcols).alias("_l"))
    L = L.withColumn(SLICE, slice_of(F.col("_t"), seconds))
    V = V.withColumn("_l", F.lit(None).cast(L.schema["_l"].dataType))

    # stream rows and versions meet once, by (key, slice)
    inside = Window.partitionBy(*keys, SLICE).orderBy("_t", "_side", "_tb")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    met = L.unionByName(V).withColumn("_cur", F.last("_v", ignorenulls=True).over(upto))
    # one row per (key, slice): its last version, then the last one before it
    ends = (met.withColumn("_after", F.lead("_t").over(inside)).filter(F.col("_after").isNull())
               .select(*keys, SLICE, "_cur"))
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carry = (ends.withColumn("_carry", F.last("_cur", ignorenulls=True).over(earlier)).drop("_cur")
                 .filter(F.col("_carry").isNotNull()))
    rows = (met.filter(F.col("_side") == 1).join(carry, [*keys, SLICE], "left")
               .select("_l", F.coalesce("_cur", "_carry").alias("_v"))
               .select("_l", F.when(~F.col("_v._gone"), F.col("_v")).alias("_v")))
    if how == "inner":
        rows = rows.filter(F.col("_v").isNotNull())
    out = rows.select("_l.*", *[F.col(f"_v.{dst}").alias(dst) for dst in payload.values()])
    if how == "left":
        nulls = left.filter(~has_key).select(
            *lcols, *[F.lit(None).cast(V.schema["_v"].dataType[dst].dataType).alias(dst)
                      for dst in payload.values()])
        out = out.unionByName(nulls)
    return out


def temporal_semi_join(left: DataFrame, table: DataFrame, on: Sequence[str],
                       *, left_ts: str = "ts", table_ts: str = "ts") -> DataFrame:
    """Keep ``left`` rows whose key already existed in ``table`` at ``left_ts``.

    Only the first appearance of a key matters, so the table collapses to one
    row per key with a partial ``min`` before the (skew-splittable) join.
    """
    first = table.groupBy(*on).agg(F.min(table_ts).alias("_since"))
    return (left.join(first, list(on), "inner")
                .filter(F.col(left_ts) >= F.col("_since"))
                .drop("_since"))
