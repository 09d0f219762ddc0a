"""Ranked lists: top artists per customer, least streaming ticket holders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import (arrival, lists_after, nest_ranked, rank_within, running, temporal_join,
                         temporal_semi_join)

TOP_ARTISTS = 3
BOTTOM_HOLDERS = 2
UNKNOWN_ARTIST = "unknown"


def _counts(df: DataFrame, keys: list[str], n: str) -> DataFrame:
    """Count per key plus the arrival of the key's latest row (its ``last``)."""
    return (df.groupBy(*keys)
              .agg(F.count(F.lit(1)).alias(n),
                   F.max(arrival()).alias("last")))


def top_customer_artists(listen: DataFrame, n: int = TOP_ARTISTS) -> DataFrame:
    """Each customer's ``n`` most streamed artists, one row per rank.

    Ties on the count go to the artist that reached that count first, i.e. the
    smaller arrival of its latest listen.
    """
    c = _counts(listen.filter(F.col("customerid").isNotNull()), ["customerid", "artistid"], "n")
    r = rank_within(c, ["customerid"],
                    [F.col("n").desc(), F.col("last").asc()], n)
    return r.select("customerid", "rnk", "artistid", "n")


def top_customer_artists_nested(listen: DataFrame, n: int = TOP_ARTISTS) -> DataFrame:
    """Same as ``top_customer_artists`` as one ordered list per customer."""
    return nest_ranked(top_customer_artists(listen, n), ["customerid"], "rnk",
                       ["artistid", "n"], "top")


def ticket_holder_listens(ticket: DataFrame, event: DataFrame, listen: DataFrame) -> DataFrame:
    """Listens of an artist by a customer who already held a ticket to one of its events.

    Tickets see the event as known at purchase time; a listen counts from the
    customer's first such ticket on (earlier listens and non-holders drop out).
    """
    held = temporal_join(ticket.select("id", "customerid", "eventid", "ts"),
                         event.select("id", "artistid", "ts"), {"eventid": "id"},
                         payload={"artistid": "artistid"}, strategy="interval")
    held = held.select("customerid", "artistid", "ts")
    return temporal_semi_join(listen.select("id", "customerid", "artistid", "ts"),
                              held, ["customerid", "artistid"])


def least_streaming_ticket_holders(ticket: DataFrame, event: DataFrame, listen: DataFrame,
                                   n: int = BOTTOM_HOLDERS) -> DataFrame:
    """Per artist, the ``n`` ticket holders who stream the artist least.

    Order: fewest listens first; among customers with one listen the earlier
    one first; among customers with more, the one whose count rose last first.
    """
    c = _counts(ticket_holder_listens(ticket, event, listen), ["artistid", "customerid"],
                "streamamount")
    r = rank_within(c, ["artistid"], least_order(), n)
    return r.select("artistid", "rnk", "customerid", "streamamount")


def least_order():
    one = F.col("streamamount") == 1
    return [F.col("streamamount").asc(), F.when(one, F.col("last")).otherwise(-F.col("last")).asc()]


def counted(rows: DataFrame, keys: list[str], n: str, stored: DataFrame | None = None) -> DataFrame:
    """Rows with the running count ``n`` of their keys; ``stored`` counts (keys, n) come before."""
    out = running(rows, keys, counts=[n])
    if stored is None:
        return out
    before = stored.select(*keys, F.col(n).alias("_before"))
    return out.join(before, keys, "left").withColumn(n, F.col(n) + F.coalesce("_before", F.lit(0))).drop("_before")


def most_first() -> list[Column]:
    """Count descending, then the earlier arrival of the latest listen."""
    return [-F.col("n"), F.unix_micros("ts"), F.col("id")]


def least_first() -> list[Column]:
    """``least_order`` over a listen's time and id."""
    one = F.col("streamamount") == 1
    return [F.col("streamamount"), *[F.when(one, c).otherwise(-c) for c in (F.unix_micros("ts"), F.col("id"))]]


def top_customer_artists_changelog(listen: DataFrame, n: int = TOP_ARTISTS, stored: DataFrame | None = None,
                                   lists: DataFrame | None = None) -> DataFrame:
    """The customer's top list after every listen, one row per (listen, rank).

    ``stored``, ``lists``: counts per pair and lists (customerid, artistid, n, ts, id) from before.
    """
    rows = listen.filter(F.col("customerid").isNotNull()).select("id", "customerid", "artistid", "ts")
    return lists_after(counted(rows, ["customerid", "artistid"], "n", stored), "customerid", "artistid", "n",
                       most_first(), n, growing=True, stored=lists)


def least_streaming_ticket_holders_changelog(ticket: DataFrame, event: DataFrame, listen: DataFrame,
                                             n: int = BOTTOM_HOLDERS) -> DataFrame:
    """The artist's least streaming holders after every counted listen, one row per (listen, rank)."""
    rows = ticket_holder_listens(ticket, event, listen).select("id", "customerid", "artistid", "ts")
    return least_lists(rows, n)


def least_lists(rows: DataFrame, n: int = BOTTOM_HOLDERS, stored: DataFrame | None = None) -> DataFrame:
    """``stored``: counts (customerid, artistid, streamamount, ts, id) from before."""
    return lists_after(counted(rows, ["customerid", "artistid"], "streamamount", stored), "artistid", "customerid",
                       "streamamount", least_first(), n, growing=False, stored=stored)


def least_streaming_ticket_holders_nested(ticket, event, listen, n: int = BOTTOM_HOLDERS) -> DataFrame:
    """One list per artist, as a message: the artist as text, ``unknown`` where it has none."""
    lists = nest_ranked(least_streaming_ticket_holders(ticket, event, listen, n), ["artistid"],
                        "rnk", ["customerid", "streamamount"], "customers")
    return lists.withColumn("artistid", F.coalesce(F.col("artistid").cast("string"), F.lit(UNKNOWN_ARTIST)))


def global_top_artists(listen: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` most streamed artists overall (top-k: partial sort per partition)."""
    c = listen.groupBy("artistid").agg(F.count(F.lit(1)).alias("n"))
    top = c.orderBy(F.col("n").desc(), F.col("artistid").asc()).limit(n)
    return rank_within(top, [], [F.col("n").desc(), F.col("artistid").asc()], None) \
        .select("rnk", "artistid", "n")


def customers_by_top_artist(listen: DataFrame) -> DataFrame:
    """Customers grouped by their number-one artist, with the group's size."""
    first = top_customer_artists(listen, 1).select("customerid", "artistid")
    size = first.groupBy("artistid").agg(F.count(F.lit(1)).alias("group_size"))
    return first.join(size, "artistid").select("artistid", "customerid", "group_size")
