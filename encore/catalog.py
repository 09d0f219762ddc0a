"""Named queries over one data folder: ``QUERIES[name](spark, root) -> DataFrame``.

Each entry runs the pipeline over the whole tables of ``root`` and keeps only
plain columns (no timestamps, arrays or structs), so results can be compared
with the SQL formulations in ``encore.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import bottom_n, latest_by_key, materialize, temporal_join, top_n, versions_by_key
from .plans import alerts, counts, ranking, sql_reports, stateless, suggestions, tickets, venues
from .session import SLICE_SECONDS, conf_int
from .sources import Domain
from .sources.files import typed_records, with_position
from .streaming.sinks import keyed_records

# Parameters of the registered reports (fixed values of this data mapping).
ATTENDANCE_FROM, ATTENDANCE_TO = "2024-02-01", "2024-02-20"
PAST_EVENTS_AS_OF = "2024-02-15"
TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Domain], DataFrame]) -> Callable[[Domain], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, root: fn(Domain.of(spark, root))
    return fn


# ---- P1, P2, U1, B6 ----------------------------------------------------------
@query
def target_customer_filter(d: Domain):
    return stateless.target_customer_filter(*d.customer_feeds)


@query
def merge_customers(d: Domain):
    return stateless.merge_customers(*d.customer_feeds).select("id", "fullname", "birthdt", "feed")


@query
def address_stringify(d: Domain):
    return stateless.address_stringify(d.address)


@query
def address_split_priority(d: Domain):
    return stateless.address_split_priority(d.address)


@query
def address_split_default(d: Domain):
    return stateless.address_split_default(d.address)


@query
def split_addresses_by_owner(d: Domain):
    return stateless.split_addresses_by_owner(d.address)


# ---- P3, P4, G3, S11, S12, A2, A3, A5 ----------------------------------------
@query
def customer_stream_count(d: Domain):
    return counts.customer_stream_count(d.listen)


@query
def customer_stream_count_changelog(d: Domain):
    return counts.customer_stream_count_changelog(d.listen)


@query
def artist_ticket_count(d: Domain):
    return counts.artist_ticket_count(d.ticket, d.event)


@query
def artist_ticket_count_changelog(d: Domain):
    return counts.artist_ticket_count_changelog(d.ticket, d.event)


@query
def stream_count_by_artist_state(d: Domain):
    return venues.stream_count_by_artist_state(d.listen, d.address)


@query
def totals(d: Domain):
    return counts.totals(d.customer, d.listen, d.event, d.ticket)


@query
def total_past_events(d: Domain):
    return counts.total_past_events(d.event, PAST_EVENTS_AS_OF)


@query
def latest_by_key_address(d: Domain):
    a = d.customer_address.select("customerid", "id", "state", "ts")
    return latest_by_key(a, ["customerid"]).select("customerid", "id", "state")


@query
def versions_by_key_address(d: Domain):
    a = d.customer_address.select("customerid", "id", "state", "ts")
    v = versions_by_key(a, ["customerid"], slice_seconds=conf_int(d.spark, SLICE_SECONDS))
    return v.select("customerid", "id", "state",
                    F.date_format("ts", TS_TEXT).alias("valid_from"),
                    F.date_format("valid_to", TS_TEXT).alias("valid_to"))


# ---- tombstones: null values delete ---------------------------------------------
@query
def latest_by_key_address_deletes(d: Domain):
    """Addresses of the accounts that are open at the end."""
    return latest_by_key(d.customer_address_log, ["customerid"], deleted="deleted").select("customerid", "id", "state")


@query
def versions_by_key_address_deletes(d: Domain):
    """Address versions; a closed account ends the version before it."""
    return versions_by_key(d.customer_address_log, ["customerid"], deleted="deleted",
                           slice_seconds=conf_int(d.spark, SLICE_SECONDS)).select(
        "customerid", "id", "state", F.date_format("ts", TS_TEXT).alias("valid_from"),
        F.date_format("valid_to", TS_TEXT).alias("valid_to"))


@query
def join_ticket_customer_address_deletes(d: Domain):
    """Tickets with the buyer's address, if the account was open at the purchase."""
    t = d.ticket.select("id", "customerid", "eventid", "ts")
    return temporal_join(t, d.customer_address_log, ["customerid"], deleted="deleted",
                         payload={"id": "addressid", "state": "customerstate"}).drop("ts")


@query
def join_ticket_event_deletes(d: Domain):
    """Tickets with their event, if it was announced and not withdrawn at the purchase."""
    t = d.ticket.select("id", "customerid", "eventid", "ts")
    return temporal_join(t, d.event_log, {"eventid": "id"}, payload=["artistid"], strategy="interval",
                         deleted="deleted").drop("ts")


@query
def purchase_event_ticket_deletes(d: Domain):
    """P5 over events that may be withdrawn."""
    return tickets.purchase_event_ticket(d.ticket, d.event_log, deleted="deleted")


# ---- records as stored: positions, typed values, what cannot be parsed --------------
@query
def typed_ticket_records(d: Domain):
    """Ticket records written as keyed JSON and read back typed. Some are tombstones and some cut
    off, as a topic may hold them; these are told apart, not turned into empty tickets."""
    line = F.to_json(F.struct("id", "customerid", "eventid"))
    kind = F.col("id") % 10
    stored = materialize(d.ticket.select(
        F.col("id").cast("string").alias("key"),
        F.when(kind == 0, None).when(kind == 1, F.left(line, F.length(line) - 1)).otherwise(line).alias("value")),
        "records")
    typed = typed_records(with_position(stored), "ticket")
    return typed.select("key", "status", "customerid", "eventid", F.col("raw").alias("unparsed"))


@query
def write_keyed(d: Domain):
    """The key/value record form a sink receives (here: listens per customer)."""
    return keyed_records(counts.customer_stream_count(d.listen), "customerid", "n")


@query
def write_keyed_text(d: Domain):
    """Keyed records with a text value: each address line under its id."""
    return keyed_records(stateless.address_stringify(d.address), "id", "address")


@query
def write_keyed_json(d: Domain):
    """Keyed records with a JSON object: each customer's ranked artists."""
    return keyed_records(ranking.top_customer_artists(d.listen), "customerid", ["rnk", "artistid", "n"])


@query
def totals_running(d: Domain):
    """Running totals of customers, listens, events and tickets per day of arrival."""
    return counts.totals_running(d.customer, d.listen, d.event, d.ticket)


# ---- P5, B7, S3, S4, P12 -------------------------------------------------------
@query
def purchase_event_ticket(d: Domain):
    return tickets.purchase_event_ticket(d.ticket, d.event)


@query
def purchase_event_ticket_orders(d: Domain):
    """P5 at volume: every order line is a ticket request for its part.

    The order-line tickets come from a shuffle join that the running fold reads
    twice, so they are written once to the shared folder.
    """
    o = tickets.ticket_outcomes(materialize(d.order_ticket, "order-ticket"), d.event_catalog)
    return o.select(F.col("ticketid.l_orderkey").alias("l_orderkey"),
                    F.col("ticketid.l_linenumber").alias("l_linenumber"),
                    "eventid", "customerid", "remainingtickets", "confirmationstatus", "tier")


@query
def ticket_tiers(d: Domain):
    return tickets.ticket_tiers(d.ticket, d.event)


@query
def alert_near_capacity(d: Domain):
    return tickets.alert_near_capacity(d.ticket, d.event)


@query
def alert_sold_out(d: Domain):
    return tickets.alert_sold_out(d.ticket, d.event)


@query
def ticket_notifications(d: Domain):
    return tickets.ticket_notifications(d.ticket, d.event)


# ---- P6, P7, S1, S2 --------------------------------------------------------------
@query
def top_customer_artists(d: Domain):
    return ranking.top_customer_artists(d.listen)


@query
def least_streaming_ticket_holders(d: Domain):
    return ranking.least_streaming_ticket_holders(d.ticket, d.event, d.listen)


@query
def top_customer_artists_changelog(d: Domain):
    """P6 after every listen: one row per (listen, rank)."""
    return ranking.top_customer_artists_changelog(d.listen)


@query
def least_streaming_ticket_holders_changelog(d: Domain):
    """P7 after every counted listen: one row per (listen, rank)."""
    return ranking.least_streaming_ticket_holders_changelog(d.ticket, d.event, d.listen)


@query
def global_top_artists(d: Domain):
    return ranking.global_top_artists(d.listen)


@query
def customers_by_top_artist(d: Domain):
    return ranking.customers_by_top_artist(d.listen)


@query
def top_n_per_key(d: Domain):
    """Generic top-N per key: each artist's 2 most frequent listeners (ties: lower id)."""
    c = d.listen.groupBy("artistid", "customerid").agg(F.count(F.lit(1)).alias("n"))
    return top_n(c, ["artistid"], "n", 2, then=[F.col("customerid").asc()]) \
        .select("artistid", "rnk", "customerid", "n")


@query
def bottom_n_per_key(d: Domain):
    """Generic bottom-N per key: each customer's 2 least played artists (ties: lower id)."""
    c = d.listen.groupBy("customerid", "artistid").agg(F.count(F.lit(1)).alias("n"))
    return bottom_n(c, ["customerid"], "n", 2, then=[F.col("artistid").asc()]) \
        .select("customerid", "rnk", "artistid", "n")


# ---- J1-J10 ------------------------------------------------------------------------
@query
def join_ticket_event(d: Domain):
    return counts.tickets_with_artist(d.ticket, d.event).select("id", "customerid", "eventid", "artistid")


@query
def join_stream_ticket_holder(d: Domain):
    return ranking.ticket_holder_listens(d.ticket, d.event, d.listen).select("id", "customerid", "artistid")


@query
def join_ticket_customer_address(d: Domain):
    return venues.join_ticket_customer_address(d.ticket, d.address).select(
        "id", "customerid", "eventid", "addressid", "customerstate", "zip5")


@query
def join_ticket_event_venue_address(d: Domain):
    return venues.join_ticket_event_venue_address(d.ticket, d.event, d.venue, d.address).select(
        "id", "customerid", "eventid", "eventstate")


@query
def join_venue_address(d: Domain):
    return venues.join_venue_address(d.venue, d.address).select("venueid", "addressid", "state")


@query
def join_event_venue_address(d: Domain):
    return venues.join_event_venue_address(d.event, d.venue, d.address).select(
        "id", "artistid", "venueid", "capacity", "eventdate", "eventstate")


@query
def join_stream_customer_address(d: Domain):
    return venues.join_stream_customer_address(d.listen, d.address).select(
        "id", "customerid", "artistid", "state")


@query
def join_event_venue(d: Domain):
    return venues.join_event_venue(d.event, d.venue).select(
        "id", "artistid", "venueid", "capacity", "addressid")


@query
def join_event_venue_state(d: Domain):
    return venues.join_event_venue_state(d.event, d.venue, d.address).select(
        "id", "artistid", "venueid", "capacity", "addressid", "state")


@query
def left_join_event_stream_counts(d: Domain):
    return venues.left_join_event_stream_counts(d.listen, d.event, d.venue, d.address)


# ---- P8-P11 ------------------------------------------------------------------------
@query
def out_of_state_ticket_holders(d: Domain):
    return venues.out_of_state_ticket_holders(d.ticket, d.event, d.venue, d.address)


@query
def instate_streamers_vs_capacity(d: Domain):
    return venues.instate_streamers_vs_capacity(d.listen, d.event, d.venue, d.address)


@query
def instate_streamers_vs_capacity_changelog(d: Domain):
    return venues.instate_streamers_vs_capacity_changelog(d.listen, d.event, d.venue, d.address)


@query
def out_of_state_tickets_by_event(d: Domain):
    return venues.out_of_state_tickets_by_event(d.ticket, d.event, d.venue, d.address)


@query
def high_attendance_events_by_state(d: Domain):
    return venues.high_attendance_events_by_state(d.ticket, d.event, d.venue, d.address,
                                                  ATTENDANCE_FROM, ATTENDANCE_TO)


@query
def high_attendance_events_by_state_sql(d: Domain):
    return sql_reports.high_attendance_events_by_state_sql(d, ATTENDANCE_FROM, ATTENDANCE_TO)


# ---- scenario reports ----------------------------------------------------------------
@query
def venue_most_events(d: Domain):
    return venues.venue_most_events(d.event)


@query
def venue_most_customers(d: Domain):
    return venues.venue_most_customers(d.ticket, d.event)


@query
def tickets_by_zip(d: Domain):
    return venues.tickets_by_zip(d.ticket, d.address)


@query
def alert_popular_event_in_zip(d: Domain):
    return venues.alert_popular_event_in_zip(d.ticket, d.event, d.address)


@query
def alert_top_streamers_of_new_event(d: Domain):
    return alerts.alert_top_streamers_of_new_event(d.listen, d.event)


@query
def alert_top_streamers_with_email(d: Domain):
    return alerts.alert_top_streamers_with_email(d.listen, d.event, d.email)


@query
def suggest_event_by_genre(d: Domain):
    return suggestions.suggest_event_by_genre(d.listen, d.artist, d.event)


@query
def suggest_popular_event_by_genre(d: Domain):
    return suggestions.suggest_popular_event_by_genre(d.listen, d.artist, d.event, d.ticket)


# ---- streaming twins (file streams run to completion; same results as batch) ----------
STREAMING: set[str] = set()


def _streamed(name: str, fn: Query) -> None:
    QUERIES[name] = fn
    STREAMING.add(name)


def _stream_address_split(branch: int) -> Query:
    def run(spark, root):
        from .streaming import replay
        return replay.address_split(spark, root)[branch]
    return run


def _lazy(attr: str) -> Query:
    def run(spark, root):
        from .streaming import replay
        return getattr(replay, attr)(spark, root)
    return run


_streamed("stream_purchase_event_ticket", _lazy("purchase_event_ticket"))
_streamed("stream_customer_stream_count_changelog", _lazy("customer_stream_count_changelog"))
_streamed("stream_customer_stream_count", _lazy("customer_stream_count"))
_streamed("stream_top_customer_artists", _lazy("top_customer_artists"))
_streamed("stream_target_customer_filter", _lazy("target_customer_filter"))
_streamed("stream_artist_ticket_count", _lazy("artist_ticket_count"))
_streamed("stream_out_of_state_ticket_holders", _lazy("out_of_state_ticket_holders"))
_streamed("stream_instate_streamers_vs_capacity_changelog", _lazy("instate_streamers_vs_capacity_changelog"))
_streamed("stream_least_streaming_ticket_holders", _lazy("least_streaming_ticket_holders"))
_streamed("stream_purchase_event_ticket_tables", _lazy("purchase_event_ticket"))
_streamed("stream_purchase_event_ticket_deletes", _lazy("purchase_event_ticket_deletes"))
_streamed("stream_venue_most_customers", _lazy("venue_most_customers"))
_streamed("stream_totals_running", _lazy("totals_running"))
_streamed("stream_top_customer_artists_changelog", _lazy("top_customer_artists_changelog"))
_streamed("stream_least_streaming_ticket_holders_changelog", _lazy("least_streaming_ticket_holders_changelog"))


def _stream_alert(kind: str) -> Query:
    def run(spark, root):
        from .streaming import replay
        return replay.capacity_alerts(spark, root, kind)
    return run


_streamed("stream_alert_near_capacity", _stream_alert("NEAR_CAPACITY"))
_streamed("stream_alert_sold_out", _stream_alert("SOLD_OUT"))
_streamed("stream_address_split_priority", _stream_address_split(0))
_streamed("stream_address_split_default", _stream_address_split(1))
