"""Stateful streaming without Python state: ``foreachBatch`` over keyed state tables.

A job reads one tagged union of its record streams, so all its records keep one
arrival order across restarts. Its state is a set of keyed tables (``state.py``).
Every micro-batch looks up the rows of the keys it holds, runs the batch plan on
its own records, and writes its outputs and the rows it changed; one commit
publishes them together. What is read and written follows the keys of the batch,
not the size of the state.

Arrival order decides across batches: what earlier batches stored is known to
all records of a batch, and a record that arrives before the table version it
needs is lost. An error while reading state ends the query.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import confirmation_status, remaining_pct, ticket_tier
from ..functions.tickets import CONFIRMED
from ..operators import asof_count, latest_by_key, rank_within, running, temporal_join, temporal_semi_join
from ..plans.ranking import BOTTOM_HOLDERS, TOP_ARTISTS, least_lists, most_first, top_customer_artists_changelog
from ..plans.tickets import NEAR_CAPACITY_PCT
from ..session import scratch_scope
from .sinks import run_available_now, start_every
from .state import GONE, Batch, Table, committed, outputs, whole

Frames = dict[str, DataFrame]
Lookup = Callable[[str, DataFrame], DataFrame]
_BEGIN = "1970-01-01 00:00:00"


@dataclass(frozen=True)
class Job:
    """``feed``: tagged union stream. ``state``: tables by name; ``outputs``: schemas by name.

    ``step(records, lookup)`` gives the batch's outputs and the changed rows of its tables;
    ``lookup(name, keys)`` reads a table's rows for some keys.
    """

    feed: DataFrame
    state: dict[str, Table]
    outputs: dict[str, str]
    step: Callable[[DataFrame, Lookup], tuple[Frames, Frames]]


def each_batch(job: Job, base: str):
    """The ``foreachBatch`` function of a job whose tables live under ``base``."""
    def run(records: DataFrame, batch_id: int) -> None:
        spark = records.sparkSession
        if batch_id in committed(spark, base):      # published before a failure of the stream's own log
            return
        batch = Batch(spark, base, batch_id, job.state)
        records = records.persist()
        try:
            with scratch_scope(spark):
                out, changes = job.step(records, batch.lookup)
                for name, df in out.items():
                    batch.write(name, df)
                for name, df in changes.items():
                    batch.change(name, df)
                batch.commit()
        finally:
            records.unpersist()
    return run


def run_job(job: Job, base: str) -> None:
    """Process everything available, then stop; a second call goes on where the first ended."""
    run_available_now(job.feed, checkpoint=f"{base}/checkpoint", foreach_batch=each_batch(job, base))


def start_job(job: Job, base: str, interval: str = "10 seconds", name: str = "records") -> StreamingQuery:
    """Run on, with a micro-batch and a commit every ``interval``. Records are counted
    as the observation ``name`` (see ``Progress``)."""
    return start_every(job.feed.observe(name, F.count(F.lit(1)).alias("rows")), checkpoint=f"{base}/checkpoint", interval=interval,
                       foreach_batch=each_batch(job, base))


def output(spark: SparkSession, job: Job, base: str, name: str) -> DataFrame:
    """All rows that the batches put out under ``name``."""
    return outputs(spark, base, name, job.outputs[name])


def final_state(spark: SparkSession, job: Job, base: str, name: str) -> DataFrame:
    """A state table as the newest batch left it."""
    return whole(spark, base, name, job.state[name])


def _tagged(**feeds: DataFrame) -> DataFrame:
    out = None
    for kind, df in feeds.items():
        df = df.withColumn("kind", F.lit(kind))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def _of(records: DataFrame, kind: str, *cols: str) -> DataFrame:
    return records.filter(F.col("kind") == kind).select(*cols)


def _known(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Versions for this batch's lookups: the stored ones, known from the beginning, and the new."""
    return stored.withColumn("ts", F.lit(_BEGIN).cast("timestamp")).unionByName(new, allowMissingColumns=True)


def _last(new: DataFrame, keys: list[str], tiebreak: str = "id") -> DataFrame:
    """The newest of the new versions per key; a tombstone stays one."""
    out = latest_by_key(new.filter(F.col(keys[0]).isNotNull()), keys, tiebreak=tiebreak)
    return out.withColumn(GONE, F.coalesce("deleted", F.lit(False))) if "deleted" in new.columns else out


def _deletable(df: DataFrame, *cols: str) -> DataFrame:
    """``cols`` and ``deleted`` (false where the feed has no tombstones)."""
    return df.select(*cols, F.col("deleted") if "deleted" in df.columns else F.lit(False).alias("deleted"))


def _summed(stored: DataFrame, new: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    return stored.select(*keys, n).unionByName(new.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))).groupBy(*keys).agg(
        F.sum(n).alias(n))


# ---- P3, P4 --------------------------------------------------------------------
def customer_stream_count_job(listen: DataFrame) -> Job:
    """Output ``log``: each listen with its customer's count; state ``counts``: the counts."""
    def step(records, lookup):
        rows = _of(records, "listen", "id", "customerid", "ts").filter(F.col("customerid").isNotNull())
        stored = lookup("counts", rows)
        counted = running(rows, ["customerid"], counts=["c"]).join(stored, "customerid", "left")
        log = counted.select("id", "customerid", (F.col("c") + F.coalesce("n", F.lit(0))).alias("n"))
        return {"log": log}, {"counts": _summed(stored, rows, ["customerid"])}

    return Job(_tagged(listen=listen.select("id", "customerid", "ts")),
               {"counts": Table("customerid long, n long", ("customerid",))},
               {"log": "id long, customerid long, n long"}, step)


def _tickets_with_artist(records: DataFrame, lookup: Lookup) -> tuple[DataFrame, DataFrame]:
    """(this batch's tickets with the event as known at the purchase, new event versions)."""
    new = _of(records, "event", "id", "artistid", "ts", "deleted")
    tickets = _of(records, "ticket", "id", "customerid", "eventid", "ts")
    events = _known(lookup("events", tickets.select(F.col("eventid").alias("id"))), new)
    sold = temporal_join(tickets, events, {"eventid": "id"}, payload={"artistid": "artistid"}, strategy="interval",
                         deleted="deleted")
    return sold.filter(F.col("artistid").isNotNull()), new


_EVENTS = Table("id long, artistid long", ("id",))


def artist_ticket_count_job(ticket: DataFrame, event: DataFrame) -> Job:
    """State ``counts``: tickets per artist, the event being as known at the purchase."""
    def step(records, lookup):
        sold, new = _tickets_with_artist(records, lookup)
        return {}, {"events": _last(new, ["id"], "ts"),
                    "counts": _summed(lookup("counts", sold), sold, ["artistid"])}

    return Job(_tagged(event=_deletable(event, "id", "artistid", "ts"),
                       ticket=ticket.select("id", "customerid", "eventid", "ts")),
               {"events": _EVENTS, "counts": Table("artistid long, n long", ("artistid",))}, {}, step)


# ---- P5, S3, S4 ------------------------------------------------------------------
def ticket_countdown_job(ticket: DataFrame, event: DataFrame) -> Job:
    """Outputs ``answers`` (P5) and ``alerts`` (each a per-row threshold crossing).

    State: event versions, and per event the capacity frozen at its first
    request with the number of requests so far.
    """
    def step(records, lookup):
        new = _of(records, "event", "id", "capacity", "ts", "deleted")
        asked = _of(records, "ticket", "id", "customerid", "eventid", "ts")
        events = _known(lookup("events", asked.select(F.col("eventid").alias("id"))), new)
        seen = temporal_join(asked, events, {"eventid": "id"}, payload={"capacity": "now"}, strategy="interval",
                             deleted="deleted")
        stored = lookup("folds", seen)
        r = (running(seen, ["eventid"], counts=["c"], firsts={"first": "now"}).join(stored, "eventid", "left")
             .withColumn("cap", F.when(F.col("n").isNull(), F.col("first")).otherwise(F.col("capacity")))
             .withColumn("rn", F.col("c") + F.coalesce("n", F.lit(0))))
        left = (F.col("cap") - F.col("rn")).cast("double")
        answers = r.select(F.col("id").alias("ticketid"), "eventid", "customerid", left.alias("remainingtickets"),
                           confirmation_status(left).alias("confirmationstatus"),
                           ticket_tier(left, F.col("cap")).alias("tier"),
                           F.concat(F.lit("CONF-"), F.col("id").cast("string")).alias("confirmationid"))
        crossed = ((confirmation_status(left) == CONFIRMED)
                   & (remaining_pct(left, F.col("cap")) <= NEAR_CAPACITY_PCT)
                   & (remaining_pct(left + 1, F.col("cap")) > NEAR_CAPACITY_PCT))
        alerts = r.select("eventid", F.col("id").alias("ticketid"), left.alias("remainingtickets"),
                          F.explode(F.array_compact(F.array(
                              F.when(crossed, F.lit("NEAR_CAPACITY")),
                              F.when(left == 0, F.lit("SOLD_OUT"))))).alias("alert"))
        folds = r.groupBy("eventid").agg(F.max("cap").alias("capacity"), F.max("rn").alias("n"))
        return ({"answers": answers.filter(F.col("tier").isNotNull()), "alerts": alerts},
                {"events": _last(new, ["id"], "ts"), "folds": folds})

    return Job(_tagged(event=_deletable(event, "id", F.col("capacity").cast("int").alias("capacity"), "ts"),
                       ticket=ticket.select("id", "customerid", "eventid", "ts")),
               {"events": Table("id long, capacity int", ("id",)),
                "folds": Table("eventid long, capacity int, n long", ("eventid",))},
               {"answers": "ticketid long, eventid long, customerid long, remainingtickets double, "
                           "confirmationstatus string, tier string, confirmationid string",
                "alerts": "eventid long, ticketid long, remainingtickets double, alert string"}, step)


# ---- P6, P7 ------------------------------------------------------------------------
def top_customer_artists_job(listen: DataFrame, n: int = TOP_ARTISTS) -> Job:
    """Output ``log``: the customer's top artists after every listen.

    State: ``counts`` per pair, and ``lists``, each customer's first ``n``: counts
    only grow, so the next list is made of the stored one and the touched pairs.
    """
    pair, item = ["customerid", "artistid"], ["artistid", "n", "ts", "id"]

    def step(records, lookup):
        rows = _of(records, "listen", "id", "customerid", "artistid", "ts").filter(F.col("customerid").isNotNull())
        counts = lookup("counts", rows)
        lists = lookup("lists", rows).select("customerid", F.inline("top"))
        log = top_customer_artists_changelog(rows, n, counts, lists)
        after = _summed(counts, rows, pair)
        touched = (rows.groupBy(*pair).agg(F.max(F.struct("ts", "id")).alias("l")).join(after, pair)
                       .select("customerid", "artistid", "n", "l.ts", "l.id"))
        merged = (lists.join(touched.select(*pair), pair, "left_anti").select("customerid", *item)
                       .unionByName(touched))
        best = rank_within(merged, ["customerid"], most_first(), n)
        top = best.groupBy("customerid").agg(F.array_sort(F.collect_list(F.struct("rnk", *item))).alias("top"))
        return {"log": log}, {"counts": after, "lists": top.select("customerid", F.transform(
            "top", lambda t: F.struct(*[t[c].alias(c) for c in item])).alias("top"))}

    return Job(_tagged(listen=listen.select("id", "customerid", "artistid", "ts")),
               {"counts": Table("customerid long, artistid long, n long", tuple(pair)),
                "lists": Table("customerid long, top array<struct<artistid:long,n:long,ts:timestamp,id:long>>",
                               ("customerid",))},
               {"log": "id long, customerid long, rnk long, artistid long, n long"}, step)


def least_streaming_job(ticket: DataFrame, event: DataFrame, listen: DataFrame, n: int = BOTTOM_HOLDERS) -> Job:
    """Output ``log``: the artist's least streaming holders after every counted listen.

    State: events, who holds a ticket of which artist, and counts per pair, looked
    up by artist: any of an artist's holders may become one of its least.
    """
    pair = ["customerid", "artistid"]

    def step(records, lookup):
        sold, new = _tickets_with_artist(records, lookup)
        heard = _of(records, "listen", "id", "customerid", "artistid", "ts")
        held = _known(lookup("holders", heard), sold.select("customerid", "artistid", "ts"))
        rows = temporal_semi_join(heard, held, pair).select("id", "customerid", "artistid", "ts")
        stored = lookup("counts", rows)
        log = least_lists(rows, n, stored).select("id", "artistid", "rnk", "customerid", "streamamount")
        touched = rows.groupBy(*pair).agg(F.count(F.lit(1)).alias("c"), F.max(F.struct("ts", "id")).alias("l"))
        after = touched.join(stored.select(*pair, "streamamount"), pair, "left").select(
            *pair, (F.col("c") + F.coalesce("streamamount", F.lit(0))).alias("streamamount"), "l.ts", "l.id")
        return {"log": log}, {"events": _last(new, ["id"], "ts"), "holders": sold.select(*pair).distinct(),
                              "counts": after}

    return Job(_tagged(event=_deletable(event, "id", "artistid", "ts"),
                       ticket=ticket.select("id", "customerid", "eventid", "ts"),
                       listen=listen.select("id", "customerid", "artistid", "ts")),
               {"events": _EVENTS, "holders": Table("customerid long, artistid long", tuple(pair)),
                "counts": Table("artistid long, customerid long, streamamount long, ts timestamp, id long",
                                ("artistid", "customerid"), ("artistid",))},
               {"log": "id long, artistid long, rnk long, customerid long, streamamount long"}, step)


# ---- P8, P9 --------------------------------------------------------------------------
_HOMES = Table("customerid long, id string, state string", ("customerid",))
_PLACES = Table("id string, state string", ("id",))


def _address_feed(address: DataFrame) -> DataFrame:
    return _deletable(address, F.col("id").alias("address"), "customerid", "state", "ts")


def _addresses(records: DataFrame) -> DataFrame:
    return _of(records, "address", F.col("address").alias("id"), "customerid", "state", "ts", "deleted")


def _with_home(rows: DataFrame, new: DataFrame, lookup: Lookup, payload: dict[str, str]) -> DataFrame:
    """Rows with the customer's address as known at their arrival."""
    homes = _known(lookup("homes", rows), new.filter(F.col("customerid").isNotNull()))
    return temporal_join(rows, homes, ["customerid"], payload=payload, deleted="deleted")


def out_of_state_job(ticket: DataFrame, event: DataFrame, address: DataFrame, venue: DataFrame) -> Job:
    """Output ``found``: tickets of buyers from another state than the venue's.

    All four streams arrive as records. A venue keeps the address that is known
    when it arrives, an event the venue's state at its own arrival; what comes
    later reaches neither.
    """
    def step(records, lookup):
        new = _addresses(records)
        halls = _of(records, "venue", "id", "addressid", "ts")
        shows = _of(records, "event", "id", "venueid", "ts", "deleted")
        places = _known(lookup("places", halls.select(F.col("addressid").alias("id"))), new)
        placed = temporal_join(halls, places, {"addressid": "id"}, payload={"state": "state"}, strategy="interval",
                               tiebreak="ts", deleted="deleted").select(F.col("id").alias("venueid"), "state", "ts")
        venues = _known(lookup("venues", shows), placed)
        dated = temporal_join(shows, venues, ["venueid"], payload={"state": "eventstate"}, strategy="interval",
                              tiebreak="ts", how="left").filter(
            F.col("eventstate").isNotNull() | F.col("deleted")).select("id", "eventstate", "ts", "deleted")
        tickets = _of(records, "ticket", "id", "customerid", "eventid", "ts")
        events = _known(lookup("events", tickets.select(F.col("eventid").alias("id"))), dated)
        rows = _with_home(tickets, new, lookup, {"id": "addressid", "state": "customerstate"})
        rows = temporal_join(rows, events, {"eventid": "id"}, payload={"eventstate": "eventstate"},
                             strategy="interval", deleted="deleted")
        found = rows.filter(F.col("customerstate") != F.col("eventstate")).select(
            F.col("id").alias("ticketid"), "eventid", "customerid", "addressid", "customerstate", "eventstate")
        return {"found": found}, {
            "places": _last(new.drop("customerid"), ["id"], "ts"), "venues": _last(placed, ["venueid"], "ts"),
            "events": _last(dated, ["id"], "ts"), "homes": _last(new, ["customerid"])}

    return Job(_tagged(event=_deletable(event, "id", "venueid", "ts"),
                       ticket=ticket.select("id", "customerid", "eventid", "ts"),
                       venue=venue.select("id", "addressid", "ts"), address=_address_feed(address)),
               {"places": _PLACES, "venues": Table("venueid long, state string", ("venueid",)),
                "events": Table("id long, eventstate string", ("id",)), "homes": _HOMES},
               {"found": "ticketid long, eventid long, customerid long, addressid string, customerstate string, "
                         "eventstate string"}, step)


def instate_streamers_job(listen: DataFrame, event: DataFrame, address: DataFrame, venue: DataFrame) -> Job:
    """Output ``log``: per event the in-state listens of its artist (as of the first event
    of that artist and state) and the running capacity. Venues and their addresses arrive
    as records; an event sees both as known at its own arrival."""
    keys = ["artistid", "state"]

    def step(records, lookup):
        new = _addresses(records)
        heard = _with_home(_of(records, "listen", "id", "customerid", "artistid", "ts"), new, lookup,
                           {"state": "state"}).select(*keys, "ts")
        heard = heard.filter(F.col("artistid").isNotNull() & F.col("state").isNotNull())
        halls = _of(records, "venue", F.col("id").alias("venueid"), "addressid", "ts")
        shows = _of(records, "event", "id", "artistid", "venueid", "capacity", "ts")
        shows = temporal_join(shows, _known(lookup("venues", shows), halls), ["venueid"],
                              payload={"addressid": "addressid"}, strategy="interval", tiebreak="ts")
        own = new.filter(F.col("customerid").isNull())
        places = _known(lookup("places", shows.select(F.col("addressid").alias("id"))), own)
        events = temporal_join(shows, places, {"addressid": "id"}, payload={"state": "state"}, strategy="interval",
                               tiebreak="ts", deleted="deleted")
        counts, begun = lookup("counts", heard.select(*keys).unionByName(events.select(*keys))), lookup("begun", events)
        seen = (asof_count(events, heard, keys, out="c").join(counts, keys, "left")
                .withColumn("heard", F.col("c") + F.coalesce("n", F.lit(0))).drop("c", "n"))
        r = (running(seen, keys, sums={"sum": "capacity"}, firsts={"first": "heard"})
             .join(begun.withColumnRenamed("capacity", "earlier"), keys, "left"))
        log = r.select(F.col("id").alias("eventid"), *keys,
                       F.coalesce("streamcount", "first").cast("long").alias("streamcount"),
                       (F.col("sum") + F.coalesce("earlier", F.lit(0))).cast("long").alias("capacity"))
        # capacities only add up, so the largest is the newest
        totals = log.groupBy(*keys).agg(F.max("streamcount").alias("streamcount"),
                                        F.max("capacity").alias("capacity"))
        touched = counts.join(heard.select(*keys).distinct(), keys, "left_semi")
        return {"log": log}, {
            "homes": _last(new, ["customerid"]), "places": _last(own.drop("customerid"), ["id"], "ts"),
            "venues": _last(halls, ["venueid"], "ts"), "counts": _summed(touched, heard, keys), "begun": totals}

    return Job(_tagged(event=event.select("id", "artistid", "venueid", "capacity", "ts"),
                       listen=listen.select("id", "customerid", "artistid", "ts"),
                       venue=venue.select("id", "addressid", "ts"), address=_address_feed(address)),
               {"homes": _HOMES, "places": _PLACES, "venues": Table("venueid long, addressid string", ("venueid",)),
                "counts": Table("artistid long, state string, n long", tuple(keys)),
                "begun": Table("artistid long, state string, streamcount long, capacity long", tuple(keys))},
               {"log": "eventid long, artistid long, state string, streamcount long, capacity long"}, step)


# ---- S8, S11 -------------------------------------------------------------------------
SKETCH_LG_K = 14            # 2^14 registers: one standard error is 0.65 %


def venue_customers_job(ticket: DataFrame, event: DataFrame) -> Job:
    """State ``sketches``: per venue a mergeable sketch of the customers who hold a ticket there."""
    def step(records, lookup):
        new = _of(records, "event", "id", "venueid", "ts", "deleted")
        tickets = _of(records, "ticket", "id", "customerid", "eventid", "ts")
        events = _known(lookup("events", tickets.select(F.col("eventid").alias("id"))), new)
        sold = temporal_join(tickets, events, {"eventid": "id"}, payload={"venueid": "venueid"}, strategy="interval",
                             deleted="deleted").filter(F.col("venueid").isNotNull())
        fresh = sold.groupBy("venueid").agg(F.hll_sketch_agg("customerid", SKETCH_LG_K).alias("sketch"))
        merged = fresh.unionByName(lookup("sketches", sold)).groupBy("venueid").agg(
            F.hll_union_agg("sketch").alias("sketch"))
        return {}, {"events": _last(new, ["id"], "ts"), "sketches": merged}

    return Job(_tagged(event=_deletable(event, "id", "venueid", "ts"),
                       ticket=ticket.select("id", "customerid", "eventid", "ts")),
               {"events": Table("id long, venueid long", ("id",)),
                "sketches": Table("venueid long, sketch binary", ("venueid",))}, {}, step)


PARTS = 16                  # rows that share a day's total of one feed


def totals_job(customer: DataFrame, listen: DataFrame, event: DataFrame, ticket: DataFrame) -> Job:
    """State ``parts``: per day, feed and part of the ids how many records arrived. No row takes
    all updates of a day; readers add the parts up."""
    keys = ["day", "kind", "part"]

    def step(records, lookup):
        rows = records.select(F.to_date("ts").alias("day"), "kind",
                              F.pmod(F.xxhash64("id"), F.lit(PARTS)).cast("int").alias("part"))
        return {}, {"parts": _summed(lookup("parts", rows), rows, keys)}

    feeds = {"customers": customer, "streams": listen, "events": event, "tickets": ticket}
    return Job(_tagged(**{kind: df.select("id", "ts") for kind, df in feeds.items()}),
               {"parts": Table("day date, kind string, part int, n long", tuple(keys))}, {}, step)
