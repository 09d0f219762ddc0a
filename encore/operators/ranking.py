"""Ranked top-N / bottom-N per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_within(df: DataFrame, partition: Sequence[str], order: Sequence[Column],
                n: int | None, rank_col: str = "rnk") -> DataFrame:
    """Keep the first ``n`` rows of each partition in ``order`` (row_number).

    ``row_number() <= n`` lets Spark insert a partial WindowGroupLimit before
    the shuffle, so a partition with many candidates sends only ``n`` rows per
    map task. ``order`` must be total (end it with a unique column).
    """
    w = Window.partitionBy(*partition).orderBy(*order)
    out = df.withColumn(rank_col, F.row_number().over(w).cast("bigint"))
    return out if n is None else out.filter(F.col(rank_col) <= n)


def top_n(df: DataFrame, partition: Sequence[str], by: str, n: int,
          then: Sequence[Column] = (), rank_col: str = "rnk") -> DataFrame:
    return rank_within(df, partition, [F.col(by).desc(), *then], n, rank_col)


def bottom_n(df: DataFrame, partition: Sequence[str], by: str, n: int,
             then: Sequence[Column] = (), rank_col: str = "rnk") -> DataFrame:
    return rank_within(df, partition, [F.col(by).asc(), *then], n, rank_col)


def _nodes(begin: Column, end: Column) -> Column:
    """Dyadic pieces ``(level, node)`` of the index range ``[begin, end)``, two per level at most."""
    def level(l):
        size = F.call_function("shiftleft", F.lit(1).cast("bigint"), l)
        s, e = _shifted(begin + size - 1, l), _shifted(end, l)
        odd_s, odd_e = s % 2 == 1, e % 2 == 1
        first = F.when((s < e) & odd_s, s)
        last = F.when(odd_e & (e - 1 >= s + F.when(odd_s, 1).otherwise(0)), e - 1)
        return F.transform(F.array_compact(F.array(first, last)),
                           lambda node: F.struct(l.alias("level"), node.alias("node")))
    return F.flatten(F.transform(_levels(end - begin), level))


def _shifted(index: Column, level: Column) -> Column:
    return F.call_function("shiftright", index, level)


def _levels(size: Column) -> Column:
    return F.sequence(F.lit(0), F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double"))).cast("int") + 1)


def ranked_at(spans: DataFrame, probes: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
              begin: str = "begin", end: str = "end", at: str = "at", rank_col: str = "rnk") -> DataFrame:
    """For every probe, the first ``n`` spans of its key that hold its index.

    A span ``[begin, end)`` is an item's value between two of its changes,
    numbered like the probes (0, 1, ... per key). ``order`` uses span columns
    and must be total. Spans are cut into dyadic pieces; per piece only the
    first ``n`` matter, and a probe meets the pieces that hold it by equality
    on (key, level, node): rows grow by the logarithm of a key's length, no
    probe is compared with all spans of its key, and a hot key spreads over
    its pieces. Returns the probe columns, the span columns and ``rnk``.
    """
    payload = [c for c in spans.columns if c not in (*keys, begin, end)]
    pieces = (spans.select(*keys, *payload, F.explode(_nodes(F.col(begin), F.col(end))).alias("_p"))
                   .select(*keys, *payload, "_p.level", "_p.node"))
    best = rank_within(pieces, [*keys, "level", "node"], order, n, "_r").drop("_r")
    longest = probes.groupBy(*keys).agg((F.max(at) + 1).alias("_size"))
    places = (probes.select(*keys, at).distinct().join(longest, list(keys))
                    .withColumn("level", F.explode(_levels(F.col("_size"))))
                    .withColumn("node", _shifted(F.col(at), F.col("level"))).drop("_size"))
    # Spark takes an exploded table to be as small as the one before, and would broadcast it
    found = places.join(best.hint("merge"), [*keys, "level", "node"]).drop("level", "node")
    top = rank_within(found, [*keys, at], order, n, rank_col)
    return (probes.join(top.drop(*[c for c in payload if c in probes.columns]).hint("merge"), [*keys, at])
                  .select(*probes.columns, *[c for c in payload if c not in probes.columns], rank_col))


def nest_ranked(df: DataFrame, partition: Sequence[str], rank_col: str,
                fields: Sequence[str], out: str) -> DataFrame:
    """Turn ranked rows into one ordered ``array<struct<fields>>`` per key.

    Only used after ``rank_within`` with a small ``n``, so each list is bounded.
    """
    agg = F.array_sort(F.collect_list(F.struct(F.col(rank_col).alias("_r"), *fields)))
    return (df.groupBy(*partition).agg(agg.alias("_l"))
              .select(*partition, F.transform("_l", lambda s: F.struct(*[s[f].alias(f) for f in fields])).alias(out)))
