"""Streaming jobs over several micro-batches, with restarts, equal the batch pipelines."""

import datetime as dt
import os
import random
import tempfile
import time

import pytest
from feed import BASE, Feed, rows
from pyspark.sql import functions as F

from encore import schemas
from encore.operators import temporal_join
from encore.plans import counts, ranking, tickets, venues
from encore.streaming import Progress, final_state, jobs, output, run_job, start_job
from encore.streaming import state as states
from encore.streaming.state import Batch, committed

ENTITIES = ("event", "ticket", "listen", "address", "venue")


def _write(df, folder, part, low, high):
    """The rows of one time range as one file; each micro-batch takes one range."""
    part_df = df.filter((F.col("ts") > F.lit(low)) & (F.col("ts") <= F.lit(high)))
    part_df.coalesce(1).write.mode("overwrite").parquet(os.path.join(folder, f"{part:03d}"))


def _stream(spark, folder, entity):
    return (spark.readStream.schema(schemas.ENTITIES[entity]).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(f"{folder}/{entity}"))


def _random_feed(seed, offset=0):
    """``offset`` is added to all numeric ids."""
    feed, rnd = Feed(), random.Random(seed)
    feed.ids = offset
    states = ["MN", "WI", "NV"]
    for v in range(3):
        feed.add("address", id=f"va{v}", customerid=None, state=states[v])
        feed.add("venue", id=v, addressid=f"va{v}", name=f"v{v}", maxcapacity=10)
    for step in range(170):
        r = rnd.random()
        if r < 0.1 or step < 3:
            feed.add("event", id=offset + 1 + 2 * rnd.randrange(5), artistid=offset + 1 + 2 * rnd.randrange(3),
                     venueid=rnd.randrange(4), capacity=rnd.randrange(0, 8))
        elif r < 0.13:          # a venue moves, or its address changes: earlier events keep what they saw
            feed.add("venue", id=rnd.randrange(4), addressid=f"va{rnd.randrange(4)}", name="v", maxcapacity=10)
        elif r < 0.16:
            feed.add("address", id=f"va{rnd.randrange(4)}", customerid=None, state=rnd.choice(states))
        elif r < 0.25:
            feed.add("address", id=f"a{step}", customerid=offset + 1 + 2 * rnd.randrange(5), state=rnd.choice(states))
        elif r < 0.55:
            feed.add("ticket", customerid=offset + 1 + 2 * rnd.randrange(5), eventid=offset + 1 + 2 * rnd.randrange(6))
        else:
            feed.add("listen", customerid=offset + 1 + 2 * rnd.randrange(5), artistid=offset + 1 + 2 * rnd.randrange(3))
    return feed


_WORLDS = {}


def _world(spark, offset):
    if offset not in _WORLDS:
        feed = _random_feed(5, offset)
        cuts = [BASE + dt.timedelta(seconds=feed.seq * k // 4) for k in range(5)]
        batch = {e: feed.df(spark, e).cache() for e in ENTITIES}
        _WORLDS[offset] = batch, cuts, tempfile.mkdtemp(prefix="encore-stream-test-")
    return _WORLDS[offset]


def _jobs(stream):
    return {
        "count": jobs.customer_stream_count_job(stream["listen"]),
        "artist": jobs.artist_ticket_count_job(stream["ticket"], stream["event"]),
        "tickets": jobs.ticket_countdown_job(stream["ticket"], stream["event"]),
        "top": jobs.top_customer_artists_job(stream["listen"]),
        "least": jobs.least_streaming_job(stream["ticket"], stream["event"], stream["listen"]),
        "outside": jobs.out_of_state_job(stream["ticket"], stream["event"], stream["address"], stream["venue"]),
        "instate": jobs.instate_streamers_job(stream["listen"], stream["event"], stream["address"], stream["venue"]),
        "sketch": jobs.venue_customers_job(stream["ticket"], stream["event"]),
        "totals": jobs.totals_job(stream["venue"], stream["listen"], stream["event"], stream["ticket"]),
    }


def _expected(b):
    home = b["address"]
    t, e, l = b["ticket"], b["event"], b["listen"]
    return {
        "count": ("log", counts.customer_stream_count_changelog(l), ["id", "customerid", "n"]),
        "artist": (None, counts.artist_ticket_count(t, e), ["artistid", "n"]),
        "tickets": ("answers", tickets.purchase_event_ticket(t, e),
                    ["ticketid", "eventid", "customerid", "remainingtickets", "confirmationstatus", "tier"]),
        "top": ("log", ranking.top_customer_artists_changelog(l), ["id", "customerid", "rnk", "artistid", "n"]),
        "least": ("log", ranking.least_streaming_ticket_holders_changelog(t, e, l),
                  ["id", "artistid", "rnk", "customerid", "streamamount"]),
        "outside": ("found", venues.out_of_state_ticket_holders(t, e, b["venue"], home),
                    ["ticketid", "eventid", "customerid", "addressid", "customerstate", "eventstate"]),
        "instate": ("log", venues.instate_streamers_vs_capacity_changelog(l, e, b["venue"], home),
                    ["eventid", "artistid", "state", "streamcount", "capacity"]),
    }


CASES = [(name, 2**53) for name in ("count", "artist", "tickets", "top", "least", "outside", "instate", "sketch",
                                    "totals")]


@pytest.mark.parametrize("name,offset", CASES + [("tickets", 2**62), ("least", 2**62)])
def test_job_equals_batch_over_micro_batches(spark, name, offset):
    """Two ranges, a stop, then two more from the kept checkpoint; ids beyond 2**53."""
    batch, cuts, base = _world(spark, offset)
    folder = f"{base}/in-{name}"
    job = None
    for half in (0, 2):
        for part in (half, half + 1):
            low = cuts[part] - dt.timedelta(days=99999) if part == 0 else cuts[part]
            for e in ENTITIES:
                _write(batch[e], f"{folder}/{e}", part, low, cuts[part + 1])
        job = _jobs({e: _stream(spark, folder, e) for e in ENTITIES})[name]
        run_job(job, f"{base}/{name}")
    assert len(committed(spark, f"{base}/{name}")) >= 4     # several batches
    if name == "sketch":
        got = final_state(spark, job, f"{base}/{name}", "sketches").select(
            "venueid", F.hll_sketch_estimate("sketch").alias("n"))
        t = temporal_join(batch["ticket"], batch["event"].select("id", "venueid", "ts"), {"eventid": "id"},
                          payload={"venueid": "venueid"}, strategy="interval")
        assert rows(got, "venueid", "n") == rows(t.groupBy("venueid").agg(F.count_distinct("customerid").alias("n")),
                                                 "venueid", "n")
        return
    if name == "totals":
        got = counts.totals_of_days(final_state(spark, job, f"{base}/{name}", "parts"))
        want = counts.totals_running(batch["venue"], batch["listen"], batch["event"], batch["ticket"])
        assert rows(got, *got.columns) == rows(want, *got.columns)
        return
    where, want, cols = _expected(batch)[name]
    got = output(spark, job, f"{base}/{name}", where) if where else final_state(spark, job, f"{base}/{name}", "counts")
    assert rows(got, *cols) == rows(want, *cols)
    if name == "top":
        lists = final_state(spark, job, f"{base}/{name}", "lists").select(
            "customerid", F.posexplode("top").alias("at", "t")).select(
            "customerid", (F.col("at") + 1).alias("rnk"), "t.artistid", "t.n")
        cols = ["customerid", "rnk", "artistid", "n"]
        assert rows(lists, *cols) == rows(ranking.top_customer_artists(batch["listen"]), *cols)
    if name == "tickets":
        t, e = batch["ticket"], batch["event"]
        want = tickets.alert_near_capacity(t, e).unionByName(tickets.alert_sold_out(t, e))
        cols = ["eventid", "ticketid", "remainingtickets", "alert"]
        assert rows(output(spark, job, f"{base}/{name}", "alerts"), *cols) == rows(want, *cols)


def test_replayed_batch_counts_once(spark):
    feed = _random_feed(9)
    base = tempfile.mkdtemp(prefix="encore-replay-")
    l = feed.df(spark, "listen")
    job = jobs.customer_stream_count_job(l)
    write = jobs.each_batch(job, base)
    cut = F.lit(BASE + dt.timedelta(seconds=feed.seq // 2))
    first, second = job.feed.filter(F.col("ts") <= cut), job.feed.filter(F.col("ts") > cut)
    for number, part in ((0, first), (1, second), (1, second)):     # batch 1 again after a failure
        write(part, number)
    want = counts.customer_stream_count_changelog(l)
    assert rows(output(spark, job, base, "log"), "id", "n") == rows(want, "id", "n")


def test_scratch_tables_of_a_batch_go_with_it(spark):
    from encore.session import ensure_checkpoint_dir
    feed = _random_feed(9)
    left = lambda: {n for n in os.listdir(ensure_checkpoint_dir(spark)) if n.startswith("table-")}
    before, base = left(), tempfile.mkdtemp(prefix="encore-scratch-")
    job = jobs.top_customer_artists_job(feed.df(spark, "listen"))
    jobs.each_batch(job, base)(job.feed, 0)
    assert left() == before
    cols = ["id", "customerid", "rnk", "artistid", "n"]
    assert rows(output(spark, job, base, "log"), *cols) == rows(
        ranking.top_customer_artists_changelog(feed.df(spark, "listen")), *cols)


def test_state_read_errors_end_the_query(spark):
    feed = _random_feed(9)
    job = jobs.customer_stream_count_job(feed.df(spark, "listen"))
    with pytest.raises(Exception):
        jobs.each_batch(job, tempfile.mkdtemp(prefix="encore-lost-"))(job.feed, 5)


def _bytes_of(base, batch):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(f"{base}/state") for f in files
               if f"segment={batch}-" in d and f.endswith(".parquet"))


def test_written_bytes_follow_the_touched_keys(spark):
    """A state of a hundred batches: what a batch writes follows its own keys."""
    base = tempfile.mkdtemp(prefix="encore-volume-")
    many, few = 200_000, 2_000
    make = lambda low, high, batch: spark.range(low, high).select(
        F.col("id"), (F.col("id") % many).alias("customerid"), F.lit(BASE).cast("timestamp").alias("ts"))
    job = jobs.customer_stream_count_job(make(0, many, 0))
    write = jobs.each_batch(job, base)
    spark.conf.set("encore.state.buckets", "4")
    try:
        write(job.feed, 0)
        first, sizes = _bytes_of(base, 0), []
        for batch in range(1, 11):
            write(make(many + few * batch, many + few * (batch + 1), batch).withColumn("kind", F.lit("listen")), batch)
            sizes.append(_bytes_of(base, batch))
    finally:
        spark.conf.unset("encore.state.buckets")
    assert sum(sizes) < first, (first, sizes)           # ten rewrites would be ten times ``first``
    assert max(sizes) < first / 5, (first, sizes)
    want = spark.range(many).select(F.col("id").alias("customerid"), F.when(
        (F.col("id") >= few) & (F.col("id") < 11 * few), 2).otherwise(1).alias("n"))
    got = final_state(spark, job, base, "counts")
    assert got.exceptAll(want.select("customerid", F.col("n").cast("long"))).isEmpty() and got.count() == many
    live = {s[0] for s in states.read_commit(spark, base, 10).state["counts"]}
    assert 1 < len(live) < 10                           # merged, but not into one


def test_readers_see_whole_batches_only(spark, monkeypatch):
    """A failure between the two outputs of a batch, and one after the commit."""
    feed = _random_feed(9)
    base = tempfile.mkdtemp(prefix="encore-commit-")
    t, e = feed.df(spark, "ticket"), feed.df(spark, "event")
    job = jobs.ticket_countdown_job(t, e)
    write = jobs.each_batch(job, base)
    cut = F.lit(BASE + dt.timedelta(seconds=feed.seq // 2))
    write(job.feed.filter(F.col("ts") <= cut), 0)
    seen = lambda: (rows(output(spark, job, base, "answers"), "ticketid", "remainingtickets"),
                    rows(output(spark, job, base, "alerts"), "ticketid", "alert"),
                    rows(final_state(spark, job, base, "folds"), "eventid", "n"))
    before = seen()
    real, calls = Batch.write, []

    def failing(self, name, df):
        calls.append(name)
        if len(calls) > 1:
            raise RuntimeError("lost")
        real(self, name, df)
    monkeypatch.setattr(Batch, "write", failing)
    with pytest.raises(RuntimeError):
        write(job.feed.filter(F.col("ts") > cut), 1)
    assert calls == ["answers", "alerts"] and seen() == before
    monkeypatch.setattr(Batch, "write", real)
    for _ in range(2):                                  # the replay, and one more after its commit
        write(job.feed.filter(F.col("ts") > cut), 1)
        assert seen()[0] == rows(tickets.purchase_event_ticket(t, e), "ticketid", "remainingtickets")
        want = tickets.alert_near_capacity(t, e).unionByName(tickets.alert_sold_out(t, e))
        assert seen()[1] == rows(want, "ticketid", "alert")


def test_segments_merge_and_tombstones_go(spark, monkeypatch):
    monkeypatch.setattr(states, "CLASS_ROWS", 2)
    base, rnd, want = tempfile.mkdtemp(prefix="encore-segments-"), random.Random(3), {}
    table = {"t": states.Table("k long, v long", ("k",))}
    for number in range(25):
        changes = {rnd.randrange(12): (rnd.random() < 0.3, number) for _ in range(rnd.randrange(0, 6))}
        batch = Batch(spark, base, number, table)
        keys = spark.createDataFrame([(k,) for k in changes] or [(-1,)], "k long")
        assert rows(batch.lookup("t", keys), "k", "v") == sorted((k, want[k]) for k in changes if k in want)
        batch.change("t", spark.createDataFrame([(k, v, gone) for k, (gone, v) in changes.items()],
                                                f"k long, v long, {states.GONE} boolean"))
        batch.commit()
        for k, (gone, v) in changes.items():
            want.pop(k, None)
            if not gone:
                want[k] = v
        assert rows(states.whole(spark, base, "t", table["t"]), "k", "v") == sorted(want.items())
    named = {s[0] for b in (22, 23, 24) for s in states.read_commit(spark, base, b).state["t"]}
    kept = {f"{base}/state/t/{n}" for n in os.listdir(f"{base}/state/t")}
    assert kept == named                                # nothing else stays on disk


def test_venue_that_comes_late_reaches_nothing_earlier(spark):
    """Tickets, then event, venue and addresses, one batch each: no rows. Then all again, in order."""
    feed = Feed()
    feed.add("ticket", customerid=1, eventid=7)
    feed.add("event", id=7, artistid=1, venueid=3, capacity=5)
    feed.add("venue", id=3, addressid="va", name="v", maxcapacity=10)
    feed.add("address", id="va", customerid=None, state="MN")
    feed.add("address", id="home", customerid=1, state="WI")
    late = feed.seq
    feed.add("venue", id=3, addressid="va", name="v", maxcapacity=10)
    feed.add("event", id=7, artistid=1, venueid=3, capacity=5)
    wanted = feed.add("ticket", customerid=1, eventid=7)
    feed.add("address", id="va", customerid=None, state="WI")       # the stored venue keeps MN
    also = feed.add("ticket", customerid=1, eventid=7)
    job = jobs.out_of_state_job(*(feed.df(spark, x) for x in ("ticket", "event", "address", "venue")))
    base = tempfile.mkdtemp(prefix="encore-late-")
    write = jobs.each_batch(job, base)
    for number in range(feed.seq):
        now = F.lit(BASE + dt.timedelta(seconds=number + 1))
        write(job.feed.filter(F.col("ts") == now), number)
        if number + 1 == late:
            assert output(spark, job, base, "found").count() == 0
    assert rows(output(spark, job, base, "found"), "ticketid", "customerstate", "eventstate") == sorted(
        [(wanted, "WI", "MN"), (also, "WI", "MN")])


def test_deleted_events_and_addresses_over_batches(spark):
    """A ticket after its event's deletion is lost; a new announcement brings the event back."""
    at = lambda n: BASE + dt.timedelta(seconds=n)
    events = spark.createDataFrame(
        [(1, 10, 3, at(1), False), (2, 20, 9, at(2), None), (1, None, None, at(5), True), (1, 10, 4, at(8), False)],
        "id long, artistid long, capacity int, ts timestamp, deleted boolean")
    asked = spark.createDataFrame([(100 + n, 5, e, at(n)) for n, e in
                                   ((3, 1), (4, 2), (6, 1), (7, 2), (9, 1), (10, 1))],
                                  "id long, customerid long, eventid long, ts timestamp")
    want = [(103, 1, 2.0), (104, 2, 8.0), (107, 2, 7.0), (109, 1, 1.0), (110, 1, 0.0)]
    cols = ["ticketid", "eventid", "remainingtickets"]
    assert rows(tickets.purchase_event_ticket(asked, events, deleted="deleted"), *cols) == want
    job = jobs.ticket_countdown_job(asked, events)
    for cuts in ([0, 20], [0, 3, 5, 6, 8, 9, 20], list(range(12))):
        base = tempfile.mkdtemp(prefix="encore-gone-")
        write = jobs.each_batch(job, base)
        for number, (low, high) in enumerate(zip(cuts, cuts[1:])):
            write(job.feed.filter((F.col("ts") > at(low)) & (F.col("ts") <= at(high))), number)
        assert rows(output(spark, job, base, "answers"), *cols) == want


def test_sketches_stay_within_their_error(spark):
    base = tempfile.mkdtemp(prefix="encore-sketch-")
    event = spark.createDataFrame([(1, 7, BASE)], "id long, venueid long, ts timestamp")
    sold = spark.range(90_000).select("id", (F.col("id") % 40_000).alias("customerid"), F.lit(1).cast("long")
                                      .alias("eventid"), F.lit(BASE).cast("timestamp").alias("ts"))
    job = jobs.venue_customers_job(sold, event)
    write = jobs.each_batch(job, base)
    for number in range(3):
        write(job.feed.filter((F.col("kind") == "event") | (F.col("id") % 3 == number)), number)
    row = final_state(spark, job, base, "sketches").select(F.hll_sketch_estimate("sketch").alias("n")).first()
    assert abs(row.n - 40_000) < 40_000 * 0.02          # three standard errors


def test_processing_time_trigger_counts_while_it_runs(spark):
    base = tempfile.mkdtemp(prefix="encore-trigger-")
    feed = _random_feed(9)
    _write(feed.df(spark, "listen"), f"{base}/listen", 0, BASE, BASE + dt.timedelta(days=1))
    progress = Progress()
    spark.streams.addListener(progress)
    job = jobs.customer_stream_count_job(_stream(spark, base, "listen"))
    q = start_job(job, f"{base}/job", interval="1 seconds", name="heard")
    try:
        q.processAllAvailable()
        deadline = time.time() + 30
        while "heard" not in progress.totals and time.time() < deadline:
            time.sleep(0.2)
    finally:
        q.stop()
        spark.streams.removeListener(progress)
    assert progress.batches >= 1 and progress.totals["heard"]["rows"] == len(feed.rows["listen"])
    assert rows(output(spark, job, f"{base}/job", "log"), "id", "n") == rows(
        counts.customer_stream_count_changelog(feed.df(spark, "listen")), "id", "n")
