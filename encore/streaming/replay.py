"""Run a streaming twin over a data folder to completion and read its result.

Used by the registry and the tests: the record tables are consumed as file
streams (``availableNow``), tables and checkpoint live in a fresh folder under
the cluster's shared ``spark.checkpoint.dir``. Stateful twins are the jobs of
``jobs.py``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rank_within
from ..plans import counts, stateless
from ..plans.ranking import BOTTOM_HOLDERS, least_first
from ..session import scratch_path
from . import jobs
from .sinks import run_available_now, write_each_batch
from .sources import StreamDomain


def _folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"stream-{name}-{uuid.uuid4().hex[:12]}")


def _ran(spark: SparkSession, job: jobs.Job, name: str) -> str:
    base = _folder(spark, name)
    jobs.run_job(job, base)
    return base


def target_customer_filter(spark: SparkSession, root: str) -> DataFrame:
    d = StreamDomain(spark, root)
    df = stateless.target_customer_filter(*d.customer_feeds)
    base = _folder(spark, "target-customers")
    run_available_now(df, checkpoint=f"{base}/checkpoint", path=f"{base}/out")
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def address_split(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Both branches of the address split written by one ``foreachBatch`` sink."""
    d = StreamDomain(spark, root)
    base = _folder(spark, "address-split")
    outs = {"priority": (stateless.address_split_priority, f"{base}/priority"),
            "default": (stateless.address_split_default, f"{base}/default")}
    run_available_now(d.address, checkpoint=f"{base}/checkpoint", foreach_batch=write_each_batch(outs))
    schema = "id string, state string, address string"
    read = lambda p: spark.read.schema(schema).parquet(f"{p}/batch=*")
    return read(f"{base}/priority"), read(f"{base}/default")


def customer_stream_count_changelog(spark: SparkSession, root: str) -> DataFrame:
    job = jobs.customer_stream_count_job(StreamDomain(spark, root).listen)
    return jobs.output(spark, job, _ran(spark, job, "listen-count"), "log")


def customer_stream_count(spark: SparkSession, root: str) -> DataFrame:
    job = jobs.customer_stream_count_job(StreamDomain(spark, root).listen)
    return jobs.final_state(spark, job, _ran(spark, job, "listen-count"), "counts")


def artist_ticket_count(spark: SparkSession, root: str) -> DataFrame:
    d = StreamDomain(spark, root)
    job = jobs.artist_ticket_count_job(d.ticket, d.event)
    return jobs.final_state(spark, job, _ran(spark, job, "artist-tickets"), "counts")


_COUNTDOWNS: dict[tuple, tuple[jobs.Job, str]] = {}


def _countdown(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One output of the countdown; a data folder's countdown runs once per Spark application."""
    key = (spark.sparkContext.applicationId, root)
    if key not in _COUNTDOWNS:
        d = StreamDomain(spark, root)
        job = jobs.ticket_countdown_job(d.ticket, d.event)
        _COUNTDOWNS[key] = job, _ran(spark, job, "tickets")
    job, base = _COUNTDOWNS[key]
    return jobs.output(spark, job, base, name)


def purchase_event_ticket(spark: SparkSession, root: str) -> DataFrame:
    return _countdown(spark, root, "answers")


def purchase_event_ticket_deletes(spark: SparkSession, root: str) -> DataFrame:
    d = StreamDomain(spark, root)
    job = jobs.ticket_countdown_job(d.ticket, d.event_log)
    return jobs.output(spark, job, _ran(spark, job, "tickets-deletes"), "answers")


def capacity_alerts(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """Alerts raised by the streamed countdown, one kind (NEAR_CAPACITY / SOLD_OUT)."""
    return _countdown(spark, root, "alerts").filter(F.col("alert") == kind)


def top_customer_artists_changelog(spark: SparkSession, root: str) -> DataFrame:
    job = jobs.top_customer_artists_job(StreamDomain(spark, root).listen)
    return jobs.output(spark, job, _ran(spark, job, "top-artists"), "log")


def top_customer_artists(spark: SparkSession, root: str) -> DataFrame:
    """The stored lists after the last listen."""
    job = jobs.top_customer_artists_job(StreamDomain(spark, root).listen)
    lists = jobs.final_state(spark, job, _ran(spark, job, "top-artists"), "lists")
    return lists.select("customerid", F.posexplode("top").alias("at", "t")).select(
        "customerid", (F.col("at") + 1).cast("long").alias("rnk"), "t.artistid", "t.n")


def _least(spark: SparkSession, root: str) -> tuple[jobs.Job, str]:
    d = StreamDomain(spark, root)
    job = jobs.least_streaming_job(d.ticket, d.event, d.listen)
    return job, _ran(spark, job, "holders")


def least_streaming_ticket_holders_changelog(spark: SparkSession, root: str) -> DataFrame:
    job, base = _least(spark, root)
    return jobs.output(spark, job, base, "log")


def least_streaming_ticket_holders(spark: SparkSession, root: str, n: int = BOTTOM_HOLDERS) -> DataFrame:
    """The lists after the last listen, ranked from the stored counts."""
    job, base = _least(spark, root)
    pairs = jobs.final_state(spark, job, base, "counts")
    return rank_within(pairs, ["artistid"], least_first(), n).select(
        "artistid", "rnk", "customerid", "streamamount")


def out_of_state_ticket_holders(spark: SparkSession, root: str) -> DataFrame:
    d = StreamDomain(spark, root)
    job = jobs.out_of_state_job(d.ticket, d.event, d.address, d.venue)
    return jobs.output(spark, job, _ran(spark, job, "out-of-state"), "found")


def instate_streamers_vs_capacity_changelog(spark: SparkSession, root: str) -> DataFrame:
    d = StreamDomain(spark, root)
    job = jobs.instate_streamers_job(d.listen, d.event, d.address, d.venue)
    return jobs.output(spark, job, _ran(spark, job, "instate"), "log")


def venue_most_customers(spark: SparkSession, root: str) -> DataFrame:
    """The venue with most customers, estimated from the stored sketches (standard error
    0.65 %; exact while a venue has few customers, see ``jobs.SKETCH_LG_K``)."""
    d = StreamDomain(spark, root)
    job = jobs.venue_customers_job(d.ticket, d.event)
    sketches = jobs.final_state(spark, job, _ran(spark, job, "venue-customers"), "sketches")
    sizes = sketches.select("venueid", F.hll_sketch_estimate("sketch").alias("num_customers"))
    return sizes.orderBy(F.desc("num_customers"), "venueid").limit(1)


def totals_running(spark: SparkSession, root: str) -> DataFrame:
    """The totals at the end of every day, from the stored parts."""
    d = StreamDomain(spark, root)
    job = jobs.totals_job(d.customer, d.listen, d.event, d.ticket)
    return counts.totals_of_days(jobs.final_state(spark, job, _ran(spark, job, "totals"), "parts"))
