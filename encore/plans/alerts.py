"""Alerts on event creation: the artist's top streamers at that moment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import rank_within, ranked_at, temporal_join

TOP_STREAMERS = 3
_MIRROR_US = 2 * 4_102_444_800_000_000   # 2 x 2100-01-01 in microseconds


def _mirrored(ts: str):
    """Time run backwards, so "the next event at or after t" is an as-of lookup."""
    return F.timestamp_micros(F.lit(_MIRROR_US) - F.unix_micros(F.col(ts).cast("timestamp")))


def top_streamers_at_events(listen: DataFrame, event: DataFrame, n: int = TOP_STREAMERS) -> DataFrame:
    """For every event, the artist's ``n`` customers with most listens up to its announcement.

    Ties: fewer listens never beat more; equal counts go to the lower customer id.
    1. Each listen is assigned to the artist's next event at or after it (a
       sliced as-of lookup on mirrored time; equal times count for the event).
    2. Listens are counted per (artist, customer, event), a partial aggregate,
       and accumulated per (artist, customer) over the artist's events. An
       accumulated count holds from its event to the customer's next one.
    3. Counts only grow, so who is among an event's top ``n`` was among the
       ``n`` best of the customers counted anew at the event of their last
       count: only those ``n`` rows per event go on.
    4. Every event ranks the counts that hold at it.
    """
    ev = event.select(F.col("id").alias("eid"), "artistid", F.col("ts").alias("ets"))
    l = listen.filter(F.col("customerid").isNotNull() & F.col("artistid").isNotNull()) \
        .select("id", "customerid", "artistid", _mirrored("ts").alias("mts"))
    per_artist = Window.partitionBy("artistid").orderBy("ets", "eid")
    numbered = ev.withColumn("at", (F.row_number().over(per_artist) - 1).cast("bigint"))
    versions = numbered.select("artistid", "at", _mirrored("ets").alias("mts"), (-F.col("at")).alias("neg_at"))
    assigned = temporal_join(l, versions, ["artistid"], left_ts="mts", table_ts="mts",
                             tiebreak="neg_at", payload={"at": "at"})
    per = assigned.groupBy("artistid", "customerid", "at").agg(F.count(F.lit(1)).alias("c"))
    own = Window.partitionBy("artistid", "customerid").orderBy("at")
    size = ev.groupBy("artistid").agg(F.count(F.lit(1)).alias("_size"))
    spans = (per.withColumn("n", F.sum("c").over(own.rowsBetween(Window.unboundedPreceding, 0)))
                .withColumn("end", F.lead("at").over(own)).join(size, "artistid")
                .select("artistid", "customerid", "n", F.col("at").alias("begin"),
                        F.coalesce("end", "_size").alias("end")))
    order = [F.col("n").desc(), F.col("customerid").asc()]
    best = rank_within(spans, ["artistid", "begin"], order, n).drop("rnk")
    top = ranked_at(best, numbered.select("artistid", F.col("eid").alias("eventid"), "at"), ["artistid"], order, n)
    return top.select("eventid", "artistid", "rnk", "customerid", "n")


def alert_top_streamers_of_new_event(listen: DataFrame, event: DataFrame) -> DataFrame:
    return top_streamers_at_events(listen, event)


def alert_top_streamers_with_email(listen: DataFrame, event: DataFrame, email: DataFrame) -> DataFrame:
    t = top_streamers_at_events(listen, event)
    # file sizes say little about the built text: no broadcast by that estimate
    return t.join(email.select("customerid", "email").hint("merge"), "customerid", "left") \
        .select("eventid", "artistid", "rnk", "customerid", "n", "email")
