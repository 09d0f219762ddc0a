"""Event suggestions from listening taste."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import asof_count, asof_sum, rank_within, running
from .tickets import NEAR_CAPACITY_PCT, ticket_outcomes

_LAST = "9999-12-31 00:00:00"       # the open end of an interval


def taste_over_time(listen: DataFrame, artist: DataFrame) -> DataFrame:
    """When each customer's most streamed genre was which: ``(customerid, genre, ts, until)``.

    Ties go to the genre that reached the count first, so the favourite after a
    customer's first listen that makes any genre's count ``k`` is that listen's
    genre, until some genre reaches ``k + 1``. ``until`` is null for the last.
    """
    g = listen.filter(F.col("customerid").isNotNull()).join(
        artist.select(F.col("id").alias("artistid"), "genre"), "artistid").select("id", "customerid", "genre", "ts")
    counted = running(g, ["customerid", "genre"], counts=["k"])
    firsts = rank_within(counted, ["customerid", "k"], [F.col("ts"), F.col("id")], 1).drop("rnk", "id")
    after = firsts.select("customerid", (F.col("k") - 1).alias("k"), F.col("ts").alias("until"))
    return firsts.join(after, ["customerid", "k"], "left").select("customerid", "genre", "ts", "until")


def _with_genre(event: DataFrame, artist: DataFrame) -> DataFrame:
    return event.select(F.col("id").alias("eventid"), "artistid", "ts").join(
        artist.select(F.col("id").alias("artistid"), "genre"), "artistid")


def suggest_event_by_genre(listen: DataFrame, artist: DataFrame, event: DataFrame) -> DataFrame:
    """For every event, how many customers it is suggested to when it is created:
    those whose most streamed genre is then the event's."""
    t = taste_over_time(listen, artist)
    change = t.select("genre", "ts", F.lit(1).alias("w")).unionByName(
        t.filter(F.col("until").isNotNull()).select("genre", F.col("until").alias("ts"), F.lit(-1).alias("w")))
    audience = asof_sum(_with_genre(event, artist), change, ["genre"], value=F.col("w"), out="num_customers")
    return audience.select("eventid", "genre", "num_customers")


def suggest_popular_event_by_genre(listen: DataFrame, artist: DataFrame, event: DataFrame,
                                   ticket: DataFrame, pct: float = NEAR_CAPACITY_PCT) -> DataFrame:
    """The customers to whom events with at most ``pct`` % left are suggested, by
    their most streamed genre when the event was created."""
    o = ticket_outcomes(ticket, event)
    popular = (o.filter((F.col("confirmationstatus") == "CONFIRMED") & (F.col("remainingpct") <= pct))
                .select("eventid").distinct())
    return events_within(taste_over_time(listen, artist),
                         _with_genre(event, artist).join(popular, "eventid", "left_semi")).select(
        "eventid", "customerid", "genre")


def events_within(taste: DataFrame, events: DataFrame) -> DataFrame:
    """Pairs of a taste interval ``[ts, until)`` and an event of its genre created in it.

    Events are numbered per genre in order of time. An interval covers a run of
    these numbers, which follows from how many events lie before its ends; the
    numbers are the join keys, so only pairs of the result are ever made.
    """
    key, moment = ["genre"], F.expr("INTERVAL 1 MICROSECOND")
    numbered = running(events.withColumnRenamed("eventid", "id"), key, counts=["_k"]).select(
        F.col("id").alias("eventid"), "genre", "_k")
    ends = taste.select("customerid", "genre", (F.col("ts") - moment).alias("_from"),
                        F.coalesce(F.col("until") - moment, F.lit(_LAST).cast("timestamp")).alias("_to"))
    rows = events.select("genre", "ts")
    ends = asof_count(ends, rows, key, out="_before", probe_ts="_from")
    ends = asof_count(ends, rows, key, out="_upto", probe_ts="_to")
    covered = (ends.filter(F.col("_upto") > F.col("_before"))
                   .select("customerid", "genre", F.explode(F.sequence(F.col("_before") + 1, "_upto")).alias("_k")))
    return covered.join(numbered, ["genre", "_k"]).drop("_k")
