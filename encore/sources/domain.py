"""Music / live-event entities derived from the driver's tables.

The business entities (listens, tickets, events, venues, addresses, ...) are
views over the TPC-H-like tables plus the ``events`` activity log:

* ``events`` rows are the arrival-ordered record stream: ``view``/``click`` are
  listens, ``purchase`` are ticket requests, ``signup`` are (re)registrations of
  a customer's address (a later signup is a move).
* ``part`` rows are the concerts (artist = brand number, capacity = size),
  ``supplier`` rows are the venues, ``nation`` names the venue's city,
  ``customer`` rows are the customer feed.

Every view is lazy and column-pruned, so a pipeline only scans what it uses.
The DuckDB oracle in ``encore.oracle`` defines the same views in SQL.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# ---- fixed values of the data mapping (must match encore.oracle) -----------
# State codes, indexed by (number % 25).
STATE_CODES = [
    "MN", "WI", "NV", "WV", "NY", "CA", "TX", "FL", "IL", "OH", "GA", "NC", "MI",
    "NJ", "VA", "WA", "AZ", "MA", "TN", "IN", "MO", "MD", "CO", "OR", "IA",
]
N_ARTISTS = 25                      # listens name artist (k % 25) + 1
LISTEN_TYPES = ("view", "click")
TICKET_TYPE = "purchase"
ADDRESS_TYPE = "signup"
CLOSING_TYPE = "error"              # closes the customer's account: the address is deleted
WITHDRAWN_EVERY = 3                 # every third event is withdrawn ...
WITHDRAWN_AFTER_HOURS = 120         # ... this long after it was announced
EPOCH = "1970-01-01 00:00:00"       # dimension rows valid from the start
EVENT_ANNOUNCE_START = "2024-01-01 00:00:00"
EVENT_SPACING_HOURS = 7             # event p is announced at hour (7 p) % 720
EVENT_WINDOW_HOURS = 720
EVENT_LEAD_DAYS = 30                # concert date = announcement + 30 days
VENUE_MAXCAPACITY = 100
LEGACY_SEGMENT = "AUTOMOBILE"       # customers of this segment come from the legacy feed
UNPARSABLE_BIRTHDT = "unknown"      # birth date text of customers with a negative balance
EMAIL_DOMAIN = "@mail.test"
# -----------------------------------------------------------------------------


def state_code(idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in STATE_CODES]),
                        (idx % len(STATE_CODES) + 1).cast("int"))


def _epoch() -> Column:
    return F.lit(EPOCH).cast("timestamp")


class Domain:
    """Lazy entity views over one data folder (``root``).

    ``Domain.of(spark, root)`` returns a shared instance; views are built once
    per instance (they are lazy plans, nothing is computed or cached in memory).
    """

    _shared: dict[tuple[int, str], "Domain"] = {}

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    @classmethod
    def of(cls, spark: SparkSession, root: str) -> "Domain":
        key = (id(spark), root)
        d = cls._shared.get(key)
        if d is None or d.spark is not spark:
            d = cls._shared[key] = cls(spark, root)
        return d

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.root, name)

    # -- the activity log ---------------------------------------------------
    def _log(self, types) -> DataFrame:
        ev = self.table("events").filter(F.col("event_type").isin(*types))
        return ev.select(
            "event_id", "user_id", "value",
            F.get_json_object("props", "$.k").cast("int").alias("k"),
            F.col("ts").cast("timestamp").alias("ts"),
        )

    @cached_property
    def listen(self) -> DataFrame:
        return self._log(LISTEN_TYPES).select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("customerid"),
            (F.col("k") % N_ARTISTS + 1).cast("bigint").alias("artistid"),
            "ts",
        )

    @cached_property
    def ticket(self) -> DataFrame:
        return self._log([TICKET_TYPE]).select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("customerid"),
            F.col("k").cast("bigint").alias("eventid"),
            F.col("value").alias("price"),
            "ts",
        )

    @cached_property
    def customer_address(self) -> DataFrame:
        k = F.col("k")
        return self._log([ADDRESS_TYPE]).select(
            F.concat(F.lit("A"), F.col("event_id").cast("string")).alias("id"),
            F.col("user_id").alias("customerid"),
            F.concat((k + 100).cast("string"), F.lit(" 1st St")).alias("line1"),
            F.when(k % 4 == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("Apt "), (k % 9 + 1).cast("string"))).alias("line2"),
            F.concat(F.lit("Town "), k.cast("string")).alias("citynm"),
            state_code(k).alias("state"),
            F.lpad(k.cast("string"), 5, "0").alias("zip5"),
            F.lpad((F.col("user_id") % 10000).cast("string"), 4, "0").alias("zip4"),
            F.lit("USA").alias("countrycd"),
            "ts",
        )

    @cached_property
    def customer_address_log(self) -> DataFrame:
        """Customer addresses with tombstones: a closed account has none until the next signup."""
        a = self.customer_address.select("id", "customerid", "state", "ts", F.lit(False).alias("deleted"))
        closed = self._log([CLOSING_TYPE]).select(
            F.concat(F.lit("A"), F.col("event_id").cast("string")).alias("id"), F.col("user_id").alias("customerid"),
            F.lit(None).cast("string").alias("state"), "ts", F.lit(True).alias("deleted"))
        return a.unionByName(closed)

    def _venue_feed(self) -> DataFrame:
        return self.table("supplier")

    @cached_property
    def venue_address(self) -> DataFrame:
        sup = self._venue_feed().select("s_suppkey", "s_nationkey")
        nat = self.table("nation").select("n_nationkey", "n_name")
        j = sup.join(nat, sup.s_nationkey == nat.n_nationkey)
        return j.select(
            F.concat(F.lit("V"), F.col("s_suppkey").cast("string")).alias("id"),
            F.lit(None).cast("bigint").alias("customerid"),
            F.concat(F.col("s_suppkey").cast("string"), F.lit(" Arena Way")).alias("line1"),
            F.lit(None).cast("string").alias("line2"),
            F.col("n_name").alias("citynm"),
            state_code(F.col("s_nationkey")).alias("state"),
            F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("zip5"),
            F.lit("0000").alias("zip4"),
            F.lit("USA").alias("countrycd"),
            _epoch().alias("ts"),
        )

    @cached_property
    def address(self) -> DataFrame:
        """The whole address stream: customer addresses and venue addresses."""
        return self.customer_address.unionByName(self.venue_address)

    @cached_property
    def venue(self) -> DataFrame:
        return self._venue_feed().select(
            F.col("s_suppkey").alias("id"),
            F.concat(F.lit("V"), F.col("s_suppkey").cast("string")).alias("addressid"),
            F.col("s_name").alias("name"),
            F.lit(VENUE_MAXCAPACITY).alias("maxcapacity"),
            _epoch().alias("ts"),
        )

    @cached_property
    def event(self) -> DataFrame:
        n_venues = self.table("supplier").select(F.count("*")).scalar()
        p = self.table("part").select("p_partkey", "p_brand", "p_size")
        ts = F.timestamp_add(
            "HOUR", (F.col("p_partkey") * EVENT_SPACING_HOURS) % EVENT_WINDOW_HOURS,
            F.lit(EVENT_ANNOUNCE_START).cast("timestamp"))
        return p.select(
            F.col("p_partkey").alias("id"),
            F.substring("p_brand", 7, 10).cast("bigint").alias("artistid"),
            (F.col("p_partkey") % n_venues).alias("venueid"),
            F.col("p_size").alias("capacity"),
            F.date_format(F.date_add(ts, EVENT_LEAD_DAYS), "yyyy-MM-dd").alias("eventdate"),
            ts.alias("ts"),
        )

    @cached_property
    def event_log(self) -> DataFrame:
        """Events with tombstones: some are withdrawn a while after their announcement."""
        e = self.event.withColumn("deleted", F.lit(False))
        gone = self.event.filter(F.col("id") % WITHDRAWN_EVERY == 0).select(
            "id", F.lit(None).cast("bigint").alias("artistid"), F.lit(None).cast("bigint").alias("venueid"),
            F.lit(None).cast("int").alias("capacity"), F.lit(None).cast("string").alias("eventdate"),
            F.timestamp_add("HOUR", F.lit(WITHDRAWN_AFTER_HOURS), "ts").alias("ts"), F.lit(True).alias("deleted"))
        return e.unionByName(gone)

    @cached_property
    def order_ticket(self) -> DataFrame:
        """High-volume ticket requests: every order line asks for one ticket of part
        ``l_partkey``, at its ship date. No column is unique, so ``id`` is the struct
        of the line's columns (the whole row is unique), which orders rows totally."""
        li = self.table("lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
        o = self.table("orders").select("o_orderkey", "o_custkey")
        j = li.join(o, li.l_orderkey == o.o_orderkey)
        return j.select(
            F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                     "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus").alias("id"),
            F.col("o_custkey").alias("customerid"),
            F.col("l_partkey").alias("eventid"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_shipdate").cast("timestamp").alias("ts"),
        )

    @cached_property
    def event_catalog(self) -> DataFrame:
        """Every part as an event on sale from the start (for ``order_ticket``)."""
        p = self.table("part").select("p_partkey", "p_brand", "p_size")
        return p.select(
            F.col("p_partkey").alias("id"),
            F.substring("p_brand", 7, 10).cast("bigint").alias("artistid"),
            F.col("p_size").alias("capacity"),
            _epoch().alias("ts"),
        )

    @cached_property
    def artist(self) -> DataFrame:
        p = self.table("part").select("p_partkey", "p_brand", "p_type")
        return (p.groupBy(F.substring("p_brand", 7, 10).cast("bigint").alias("id"))
                 .agg(F.min("p_brand").alias("name"),
                      F.min_by("p_type", "p_partkey").alias("genre")))

    @cached_property
    def customer(self) -> DataFrame:
        c = self.table("customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
        key = F.col("c_custkey")
        born = F.concat(
            (1980 + key % 30).cast("string"), F.lit("-"),
            F.lpad((1 + key % 12).cast("string"), 2, "0"), F.lit("-"),
            F.lpad((1 + key % 28).cast("string"), 2, "0"))
        return c.select(
            key.alias("id"),
            F.col("c_name").alias("fullname"),
            F.when(F.col("c_acctbal") < 0, F.lit(UNPARSABLE_BIRTHDT)).otherwise(born).alias("birthdt"),
            F.when(F.col("c_mktsegment") == LEGACY_SEGMENT, F.lit("legacy"))
             .otherwise(F.lit("current")).alias("feed"),
            _epoch().alias("ts"),
        )

    @cached_property
    def customer_feeds(self) -> tuple[DataFrame, DataFrame]:
        """(current feed, legacy feed) — the two customer sources of P1."""
        c = self.customer
        return c.filter(F.col("feed") == "current"), c.filter(F.col("feed") == "legacy")

    @cached_property
    def email(self) -> DataFrame:
        c = self.table("customer").select("c_custkey")
        return c.select(
            F.concat(F.lit("E"), F.col("c_custkey").cast("string")).alias("id"),
            F.col("c_custkey").alias("customerid"),
            F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit(EMAIL_DOMAIN)).alias("email"),
        )
