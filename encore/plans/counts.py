"""Counts per key, as final tables and as changelogs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import parse_day
from ..operators import running, temporal_join

FEEDS = ("customers", "streams", "events", "tickets")


def customer_stream_count(listen: DataFrame) -> DataFrame:
    """Listens per customer (partial + final aggregate)."""
    return (listen.filter(F.col("customerid").isNotNull())
                  .groupBy("customerid").agg(F.count(F.lit(1)).alias("n")))


def customer_stream_count_changelog(listen: DataFrame) -> DataFrame:
    """One row per listen: the customer's count after it."""
    l = listen.filter(F.col("customerid").isNotNull()).select("id", "customerid", "ts")
    return running(l, ["customerid"], counts=["n"]).select("id", "customerid", "n")


def tickets_with_artist(ticket: DataFrame, event: DataFrame) -> DataFrame:
    """Tickets joined to the event as known when the ticket arrived (inner)."""
    return temporal_join(ticket, event.select("id", "artistid", "ts"), {"eventid": "id"},
                         payload={"artistid": "artistid"}, strategy="interval")


def artist_ticket_count(ticket: DataFrame, event: DataFrame) -> DataFrame:
    return (tickets_with_artist(ticket, event)
            .filter(F.col("artistid").isNotNull())
            .groupBy("artistid").agg(F.count(F.lit(1)).alias("n")))


def artist_ticket_count_changelog(ticket: DataFrame, event: DataFrame) -> DataFrame:
    t = (tickets_with_artist(ticket.select("id", "eventid", "ts"), event)
         .filter(F.col("artistid").isNotNull()))
    return running(t, ["artistid"], counts=["n"]).select("id", "artistid", "n")


def totals(customer: DataFrame, listen: DataFrame, event: DataFrame, ticket: DataFrame) -> DataFrame:
    """Global totals in one pass over a tagged union (no join of 1-row results)."""
    tagged = (customer.select(F.lit("c").alias("k"))
              .unionByName(listen.select(F.lit("s").alias("k")))
              .unionByName(event.select(F.lit("e").alias("k")))
              .unionByName(ticket.select(F.lit("t").alias("k"))))
    cnt = lambda tag: F.count(F.when(F.col("k") == tag, F.lit(1)))
    return tagged.agg(cnt("c").alias("total_customers"), cnt("s").alias("total_streams"),
                      cnt("e").alias("total_events"), cnt("t").alias("total_tickets"))


def totals_running(customer: DataFrame, listen: DataFrame, event: DataFrame, ticket: DataFrame) -> DataFrame:
    """Totals so far at the end of every day on which anything arrived.

    Each feed is reduced to one row per day before the prefix sum, so the window
    sorts days, whatever the number of records.
    """
    feeds = dict(zip(FEEDS, (customer, listen, event, ticket)))
    days = None
    for name, df in feeds.items():
        per = df.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("c")).select(
            "day", *[(F.col("c") if other == name else F.lit(0)).cast("bigint").alias(other) for other in feeds])
        days = per if days is None else days.unionByName(per)
    return _so_far(days.groupBy("day").agg(*[F.sum(f).alias(f) for f in feeds]))


def totals_of_days(parts: DataFrame) -> DataFrame:
    """``totals_running`` from rows ``(day, kind, n)``, any number of them per day and kind."""
    return _so_far(parts.groupBy("day").agg(*[
        F.sum(F.when(F.col("kind") == f, F.col("n")).otherwise(0)).alias(f) for f in FEEDS]))


def _so_far(daily: DataFrame) -> DataFrame:
    so_far = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select(F.date_format("day", "yyyy-MM-dd").alias("day"),
                        *[F.sum(f).over(so_far).alias(f"total_{f}") for f in FEEDS])


def total_past_events(event: DataFrame, as_of: str) -> DataFrame:
    """Events whose date lies before ``as_of`` (``yyyy-MM-dd``)."""
    past = parse_day(F.col("eventdate")) < parse_day(F.lit(as_of))
    return event.agg(F.count(F.when(past, F.lit(1))).alias("total_past_events"))
