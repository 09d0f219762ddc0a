"""Entity schemas of the music / live-event data model.

Ids are kept as the native ``bigint`` of the source tables (strings only where
an id mixes two kinds, as address ids do). Every record carries ``ts``, the
moment it arrived; with the record id it forms the total order that decides
which table version a row sees.
"""

from pyspark.sql import types as T

S, L, I, D, TS = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.TimestampType()


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CUSTOMER = _st(("id", L), ("fullname", S), ("birthdt", S), ("feed", S), ("ts", TS))
ADDRESS = _st(("id", S), ("customerid", L), ("line1", S), ("line2", S), ("citynm", S),
              ("state", S), ("zip5", S), ("zip4", S), ("countrycd", S), ("ts", TS))
EMAIL = _st(("id", S), ("customerid", L), ("email", S))
ARTIST = _st(("id", L), ("name", S), ("genre", S))
VENUE = _st(("id", L), ("addressid", S), ("name", S), ("maxcapacity", I), ("ts", TS))
EVENT = _st(("id", L), ("artistid", L), ("venueid", L), ("capacity", I), ("eventdate", S), ("ts", TS))
TICKET = _st(("id", L), ("customerid", L), ("eventid", L), ("price", D), ("ts", TS))
LISTEN = _st(("id", L), ("customerid", L), ("artistid", L), ("ts", TS))

ENTITIES = {
    "customer": CUSTOMER, "address": ADDRESS, "email": EMAIL, "artist": ARTIST,
    "venue": VENUE, "event": EVENT, "ticket": TICKET, "listen": LISTEN,
}

# The record tables of a data folder, as scans declare them (no footer is read to plan a query).
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
