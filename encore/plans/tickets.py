"""Ticket requests against event capacity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (confirmation_status, notification_columns, remaining_pct,
                         ticket_tier)
from ..functions.tickets import CONFIRMED
from ..operators import running, temporal_join

NEAR_CAPACITY_PCT = 10.0    # alert once at most 10 % of the capacity is left


def ticket_outcomes(ticket: DataFrame, event: DataFrame, deleted: str | None = None) -> DataFrame:
    """Every ticket request with the event's remaining capacity after it.

    Requests for an event not yet announced are lost: the announcement meets the
    per-slice counts, not the requests, which are shuffled once, by (event,
    slice). Per event, requests are numbered in
    arrival order and ``remaining = capacity - number``, where the capacity is
    the one of the event version seen by the event's first request: it depends
    only on that request's time, so it is a lookup of the event at
    ``min(ts)`` per event (hash aggregate + one row per event). Requests keep
    counting after a sell-out (-1, -2, ...). Numbering is the sliced running
    count, so a sold-out blockbuster does not sit in one task.

    ``deleted`` names the tombstone column of events that may be withdrawn: requests
    that arrive while an event is withdrawn are lost, so every request is looked up.
    """
    ev = event.select("id", "capacity", "ts")
    announced = ev.groupBy(F.col("id").alias("eventid")).agg(F.min("ts").alias("since"))

    def frozen_capacity(first):   # one row per event: the version seen by its first request
        return temporal_join(first, ev, {"eventid": "id"}, left_ts="first_ts",
                             payload={"capacity": "capacity"}, strategy="interval") \
            .select("eventid", "capacity")

    asked = ticket.select("id", "customerid", "eventid", "ts")
    if deleted is None:
        t = running(asked, ["eventid"], counts=["_rn"], since=announced, per_key=frozen_capacity)
    else:
        seen = temporal_join(asked, event.select("id", "capacity", "ts", deleted), {"eventid": "id"},
                             payload={"capacity": "_now"}, strategy="interval", deleted=deleted)
        t = running(seen, ["eventid"], counts=["_rn"], firsts={"capacity": "_now"})
    remaining = (F.col("capacity") - F.col("_rn")).cast("double")
    return t.select(
        F.col("id").alias("ticketid"), "eventid", "customerid", "ts", "capacity",
        remaining.alias("remainingtickets"),
        confirmation_status(remaining).alias("confirmationstatus"),
        ticket_tier(remaining, F.col("capacity")).alias("tier"),
        remaining_pct(remaining, F.col("capacity")).alias("remainingpct"),
        F.concat(F.lit("CONF-"), F.col("id").cast("string")).alias("confirmationid"),
    )


def purchase_event_ticket(ticket: DataFrame, event: DataFrame, deleted: str | None = None) -> DataFrame:
    o = ticket_outcomes(ticket, event, deleted)
    # ``tier`` is null only when no branch matches; such rows are not emitted.
    return (o.filter(F.col("tier").isNotNull())
             .select("ticketid", "eventid", "customerid", "remainingtickets",
                     "confirmationstatus", "tier", "confirmationid"))


def ticket_tiers(ticket: DataFrame, event: DataFrame) -> DataFrame:
    return ticket_outcomes(ticket, event).select("ticketid", "eventid", "tier")


def alert_near_capacity(ticket: DataFrame, event: DataFrame,
                        pct: float = NEAR_CAPACITY_PCT) -> DataFrame:
    """The confirmed request after which at most ``pct`` % of an event is left.

    Remaining tickets fall by exactly one per request, starting from the frozen
    capacity (100 %), so the first such request is the only row where the share
    crosses the threshold: a per-row filter, no aggregation or shuffle.
    """
    o = ticket_outcomes(ticket, event)
    before = remaining_pct(F.col("remainingtickets") + 1, F.col("capacity"))
    hit = ((F.col("confirmationstatus") == CONFIRMED) & (F.col("remainingpct") <= pct)
           & (before > pct))
    return o.filter(hit).select("eventid", "ticketid", "remainingtickets",
                                F.lit("NEAR_CAPACITY").alias("alert"))


def alert_sold_out(ticket: DataFrame, event: DataFrame) -> DataFrame:
    """The request that took the last ticket of an event (remaining hits 0 once)."""
    o = ticket_outcomes(ticket, event)
    return o.filter(F.col("remainingtickets") == 0).select(
        "eventid", "ticketid", "remainingtickets", F.lit("SOLD_OUT").alias("alert"))


def ticket_notifications(ticket: DataFrame, event: DataFrame) -> DataFrame:
    """The confirmation message of every answered request (transport not included)."""
    o = purchase_event_ticket(ticket, event)
    return o.select("ticketid", *notification_columns(
        F.col("customerid"), F.col("confirmationid"), F.col("eventid"), F.col("confirmationstatus")))
