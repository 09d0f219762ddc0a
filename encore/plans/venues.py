"""Where customers and venues are: state-based pipelines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parse_day
from ..operators import asof_count, latest_by_key, running, temporal_join
from .tickets import ticket_outcomes

HIGH_ATTENDANCE_SHARE = 0.80
ZIP_GROUP = 10_000          # residents of a zip code that one join key holds


# ---- lookups (J3-J9) --------------------------------------------------------
def join_venue_address(venue: DataFrame, address: DataFrame) -> DataFrame:
    """Each venue row with its address as known when the venue row arrived."""
    return temporal_join(venue.select("id", "addressid", "ts"),
                         address.select("id", "state", "ts"), {"addressid": "id"},
                         payload={"state": "state"}, strategy="interval").withColumnRenamed("id", "venueid")


def join_event_venue_address(event: DataFrame, venue: DataFrame, address: DataFrame) -> DataFrame:
    """Each event row with the stored venue/address pair current at its arrival.

    The pair was resolved when the venue arrived, so a later address change of
    the venue does not reach it (frozen chain).
    """
    va = join_venue_address(venue, address).select(
        F.col("venueid").alias("vid"), "addressid", "state", "ts", F.col("venueid").alias("id"))
    return temporal_join(event.select("id", "artistid", "venueid", "capacity", "eventdate", "ts"),
                         va, {"venueid": "vid"}, payload={"state": "eventstate"}, strategy="interval")


def join_event_venue(event: DataFrame, venue: DataFrame) -> DataFrame:
    return temporal_join(event.select("id", "artistid", "venueid", "capacity", "ts"),
                         venue.select("id", "addressid", "ts"), {"venueid": "id"},
                         payload={"addressid": "addressid"}, strategy="interval")


def join_event_venue_state(event: DataFrame, venue: DataFrame, address: DataFrame) -> DataFrame:
    """Event -> venue -> venue address, both looked up at the event's arrival."""
    ev = join_event_venue(event, venue)
    venue_addr = address.filter(F.col("customerid").isNull()).select("id", "state", "ts")
    return temporal_join(ev, venue_addr, {"addressid": "id"}, payload={"state": "state"},
                         strategy="interval")


def join_ticket_customer_address(ticket: DataFrame, address: DataFrame) -> DataFrame:
    """Each ticket with the buyer's address current at purchase time (inner)."""
    cust_addr = address.filter(F.col("customerid").isNotNull()).select(
        "customerid", "id", "state", "zip5", "ts")
    return temporal_join(ticket.select("id", "customerid", "eventid", "ts"), cust_addr,
                         ["customerid"],
                         payload={"id": "addressid", "state": "customerstate", "zip5": "zip5"})


def join_ticket_event_venue_address(ticket: DataFrame, event: DataFrame, venue: DataFrame,
                                    address: DataFrame) -> DataFrame:
    eva = join_event_venue_address(event, venue, address).select(
        F.col("id").alias("eid"), "eventstate", "ts", "id")
    return temporal_join(ticket.select("id", "customerid", "eventid", "ts"), eva,
                         {"eventid": "eid"}, payload={"eventstate": "eventstate"}, strategy="interval")


def join_stream_customer_address(listen: DataFrame, address: DataFrame) -> DataFrame:
    cust_addr = address.filter(F.col("customerid").isNotNull()).select("customerid", "id", "state", "ts")
    return temporal_join(listen.select("id", "customerid", "artistid", "ts"), cust_addr,
                         ["customerid"], payload={"state": "state"})


# ---- P8 ---------------------------------------------------------------------
def out_of_state_ticket_holders(ticket: DataFrame, event: DataFrame, venue: DataFrame,
                                address: DataFrame) -> DataFrame:
    """Tickets whose buyer (as of purchase) lives in another state than the venue."""
    ta = join_ticket_customer_address(ticket, address)
    eva = join_event_venue_address(event, venue, address).select(
        F.col("id").alias("eid"), "eventstate", "ts", "id")
    t = temporal_join(ta, eva, {"eventid": "eid"}, payload={"eventstate": "eventstate"},
                      strategy="interval")
    return (t.filter(F.col("customerstate") != F.col("eventstate"))
             .select(F.col("id").alias("ticketid"), "eventid", "customerid", "addressid",
                     "customerstate", "eventstate"))


# ---- P9 ---------------------------------------------------------------------
def stream_count_by_artist_state(listen: DataFrame, address: DataFrame) -> DataFrame:
    """Listens per (artist, listener's state at listening time)."""
    ls = join_stream_customer_address(listen, address)
    return ls.groupBy("artistid", "state").agg(F.count(F.lit(1)).alias("streamcount"))


def _events_with_instate_listens(listen, event, venue, address) -> DataFrame:
    ls = join_stream_customer_address(listen, address).select("artistid", "state", "ts")
    ev = join_event_venue_state(event, venue, address).select(
        "id", "artistid", "state", "capacity", "ts")
    # in-state listens up to each event's arrival; events without any get 0
    return asof_count(ev, ls, ["artistid", "state"], out="n")


def left_join_event_stream_counts(listen, event, venue, address) -> DataFrame:
    return _events_with_instate_listens(listen, event, venue, address).select(
        F.col("id").alias("eventid"), "artistid", "state", "capacity", F.col("n").alias("streamcount"))


def instate_streamers_vs_capacity_changelog(listen, event, venue, address) -> DataFrame:
    """One row per event: in-state listens of the artist vs. event capacity so far.

    Per (artist, state) the listen count is the one seen by the first event;
    every later event only adds its capacity (a running sum).
    """
    e = _events_with_instate_listens(listen, event, venue, address)
    r = running(e, ["artistid", "state"], sums={"capacity_sum": "capacity"},
                firsts={"streamcount": "n"})
    return r.select(F.col("id").alias("eventid"), "artistid", "state", "streamcount",
                    F.col("capacity_sum").cast("bigint").alias("capacity"))


def instate_streamers_vs_capacity(listen, event, venue, address) -> DataFrame:
    """Final table of the changelog: one row per (artist, state)."""
    e = _events_with_instate_listens(listen, event, venue, address)
    return (e.groupBy("artistid", "state")
             .agg(F.min_by("n", F.struct("ts", "id")).alias("streamcount"),
                  F.sum("capacity").cast("bigint").alias("capacity")))


# ---- P10 / P11 (relational, no time) ------------------------------------------
def _venue_state(event: DataFrame, venue: DataFrame, address: DataFrame) -> DataFrame:
    """Event id -> venue state rows (a fan-out if dimensions repeat an id)."""
    v = venue.select(F.col("id").alias("venueid"), "addressid")
    a = address.select(F.col("id").alias("addressid"), F.col("state").alias("venuestate"))
    return event.select(F.col("id").alias("eventid"), "venueid", "capacity", "eventdate") \
        .join(v, "venueid").join(a, "addressid")


def out_of_state_tickets_by_event(ticket: DataFrame, event: DataFrame, venue: DataFrame,
                                  address: DataFrame) -> DataFrame:
    """Per event, (ticket, buyer address) pairs whose state differs from the venue's.

    Every address a customer ever had counts (no time), as in the SQL report.
    Instead of materialising tickets x addresses, addresses are pre-counted per
    (customer, state): pairs = all addresses - addresses in the venue state.
    """
    ca = address.filter(F.col("customerid").isNotNull())
    per_state = ca.groupBy("customerid", F.col("state").alias("venuestate")) \
        .agg(F.count(F.lit(1)).alias("same"))
    total = ca.groupBy("customerid").agg(F.count(F.lit(1)).alias("all_addr"),
                                         F.count("state").alias("with_state"))
    # per event and buyer: how many tickets (partial aggregate before any join)
    tk = ticket.groupBy("eventid", "customerid").agg(F.count(F.lit(1)).alias("tickets"))
    vs = _venue_state(event, venue, address).select("eventid", "venuestate") \
        .filter(F.col("venuestate").isNotNull())
    t = (tk.join(vs, "eventid")
           .join(total, "customerid")
           .join(per_state, ["customerid", "venuestate"], "left"))
    # ``!=`` is never true for a null state, so addresses without one never count
    pairs = F.col("tickets") * (F.col("with_state") - F.coalesce(F.col("same"), F.lit(0)))
    out = t.groupBy("eventid").agg(F.sum(pairs).cast("bigint").alias("num_out_of_state_tickets"))
    return (out.filter(F.col("num_out_of_state_tickets") > 0)
               .orderBy(F.col("num_out_of_state_tickets").desc(), F.col("eventid")))


def high_attendance_events_by_state(ticket: DataFrame, event: DataFrame, venue: DataFrame,
                                    address: DataFrame, date_from: str, date_to: str,
                                    share: float = HIGH_ATTENDANCE_SHARE) -> DataFrame:
    """Per venue state, events dated in (date_from, date_to) with tickets > share x capacity."""
    d = parse_day(F.col("eventdate"))
    ev = event.filter((d > parse_day(F.lit(date_from))) & (d < parse_day(F.lit(date_to))))
    sold = ticket.groupBy("eventid").agg(F.count("id").alias("sold"))
    g = (_venue_state(ev, venue, address).join(sold, "eventid")
         .groupBy("eventid", "capacity", "venuestate", "eventdate")
         .agg(F.sum("sold").alias("sold")))
    # exact decimal threshold: exactly ``share`` of the capacity does not qualify
    hi = g.filter(F.col("sold") > F.lit(str(share)).cast("decimal(10,4)") * F.col("capacity"))
    return hi.groupBy(F.col("venuestate").alias("state")) \
        .agg(F.count(F.lit(1)).alias("num_high_attendance_events"))


# ---- scenario reports ---------------------------------------------------------
def venue_most_events(event: DataFrame) -> DataFrame:
    c = event.filter(F.col("venueid").isNotNull()).groupBy("venueid") \
        .agg(F.count(F.lit(1)).alias("num_events"))
    return c.orderBy(F.col("num_events").desc(), F.col("venueid")).limit(1)


def venue_most_customers(ticket: DataFrame, event: DataFrame) -> DataFrame:
    t = temporal_join(ticket.select("id", "customerid", "eventid", "ts"),
                      event.select("id", "venueid", "ts"), {"eventid": "id"},
                      payload={"venueid": "venueid"}, strategy="interval")
    # distinct (venue, customer) first: two partial aggregates, no per-venue set
    pairs = t.groupBy("venueid", "customerid").agg(F.lit(1).alias("_one"))
    c = pairs.groupBy("venueid").agg(F.count(F.lit(1)).alias("num_customers"))
    return c.orderBy(F.col("num_customers").desc(), F.col("venueid")).limit(1)


def tickets_by_zip(ticket: DataFrame, address: DataFrame) -> DataFrame:
    t = join_ticket_customer_address(ticket, address)
    return t.groupBy("zip5").agg(F.count(F.lit(1)).alias("num_tickets"))


def alert_popular_event_in_zip(ticket: DataFrame, event: DataFrame, address: DataFrame,
                               near_pct: float = 10.0) -> DataFrame:
    """Customers told that others in their zip code bought tickets to a popular event.

    Popular = the event reached at most ``near_pct`` % remaining capacity. Buyers
    count in the zip code they lived in when they bought; told is who lives there
    by the latest address, with the number of other buyers. A zip code's residents
    are dealt to groups of about ``ZIP_GROUP``, each of which meets the zip code's
    events, so a large zip code is many join keys.
    """
    o = ticket_outcomes(ticket, event)
    popular = (o.filter((F.col("confirmationstatus") == "CONFIRMED") & (F.col("remainingpct") <= near_pct))
                .select("eventid").distinct())
    t = join_ticket_customer_address(ticket, address).join(popular, "eventid", "left_semi")
    buyers = t.select("eventid", "zip5", "customerid").distinct()
    per = buyers.groupBy("eventid", "zip5").agg(F.count(F.lit(1)).alias("buyers"))
    lives = latest_by_key(address.filter(F.col("customerid").isNotNull())
                          .select("customerid", "zip5", "id", "ts"), ["customerid"]).select("customerid", "zip5")
    groups = lives.groupBy("zip5").agg((F.expr(f"count(1) div {ZIP_GROUP}") + 1).alias("_groups"))
    dealt = lives.join(groups, "zip5").withColumn("_group", F.pmod(F.xxhash64("customerid"), F.col("_groups")))
    spread = per.join(groups, "zip5").withColumn(
        "_group", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_groups") - 1)))
    told = dealt.drop("_groups").join(spread.drop("_groups"), ["zip5", "_group"]).drop("_group").join(buyers.withColumn("own", F.lit(1)),
                                        ["eventid", "zip5", "customerid"], "left")
    return (told.withColumn("num_customers", F.col("buyers") - F.coalesce("own", F.lit(0)))
                .filter(F.col("num_customers") > 0)
                .select("eventid", "zip5", "customerid", "num_customers"))
