"""Records as stored: declared columns, positions, typed values; tombstones in tables."""

import datetime as dt
import json
import os
import random
import tempfile

import pytest
from feed import BASE, rows
from pyspark.sql import functions as F

from encore.operators import latest_by_key, temporal_join, versions_by_key
from encore.schemas import TABLES
from encore.sources import Domain
from encore.sources.files import typed_records, with_position

ROOT = "/root/testdata/sf0.001"


def test_declared_tables_equal_the_files(spark):
    for name in TABLES:
        files = spark.read.parquet(f"{ROOT}/{name}.parquet")
        assert Domain(spark, ROOT).table(name).schema.simpleString() == files.schema.simpleString()


def test_positions_name_every_record_once(spark):
    path = tempfile.mkdtemp(prefix="encore-records-") + "/t"
    spark.range(1000).select(F.col("id").cast("string").alias("key"), F.lit("{}").alias("value")).repartition(
        3).write.parquet(path)
    placed = with_position(spark.read.parquet(path)).collect()
    files = {f for f in os.listdir(path) if f.endswith(".parquet")}
    assert {r.partition for r in placed} == files
    for f in files:                     # offsets run from 0 without gaps, in the order of the file
        own = sorted((r.offset, r.key) for r in placed if r.partition == f)
        assert [o for o, _ in own] == list(range(len(own)))
        stored = [r.key for r in spark.read.parquet(f"{path}/{f}").collect()]
        assert [k for _, k in own] == stored


def test_typed_records_tell_what_cannot_be_parsed(spark):
    ok = {"id": 1, "customerid": 2, "eventid": 3, "price": 1.5}
    values = [("a", json.dumps(ok)), ("b", None), ("c", json.dumps(ok)[:-1]), ("d", ""), ("e", "[1]"), ("f", "{}"),
              ("g", '{"id": "x"}'), ("h", '{"id": 7, "more": 1}'), ("i", "null"), ("j", "12")]
    df = spark.createDataFrame(values, "key string, value string").withColumn("offset", F.lit(5))
    got = {r.key: r for r in typed_records(df, "ticket").collect()}
    assert {k: r.status for k, r in got.items()} == {
        "a": "ok", "b": "deleted", "c": "malformed", "d": "malformed", "e": "malformed", "f": "ok", "g": "malformed",
        "h": "ok", "i": "malformed", "j": "malformed"}
    assert (got["a"].id, got["a"].customerid, got["a"].price, got["a"].raw, got["a"].offset) == (1, 2, 1.5, None, 5)
    assert got["h"].id == 7 and got["g"].id is None and got["g"].raw == '{"id": "x"}' and got["b"].raw is None


def _brute(table, at, key):
    seen = [v for v in table if key is not None and v[0] == key and v[1] <= at]
    last = max(seen, key=lambda v: (v[1], v[2]), default=None)
    return None if last is None or last[4] else last[3]


@pytest.mark.parametrize("seed", [1, 2])
def test_tombstones_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    when = lambda: BASE + dt.timedelta(seconds=rnd.randrange(0, 20_000))
    table = [(rnd.randrange(6), when(), i, f"v{i}", rnd.choice([True, False, False, None])) for i in range(80)]
    table += [(7, BASE, 900, "only", True), (None, BASE, 901, "no key", False)]
    probes = [(i, rnd.choice([*range(8), None]), when()) for i in range(150)]
    t = spark.createDataFrame(table, "k long, ts timestamp, id long, v string, deleted boolean")
    p = spark.createDataFrame(probes, "pid long, k long, ts timestamp")
    for strategy in ("sliced", "interval"):
        for how in ("inner", "left"):
            got = temporal_join(p, t, ["k"], payload=["v"], strategy=strategy, how=how, deleted="deleted",
                                slice_seconds=3600)
            want = [(i, _brute(table, at, k)) for i, k, at in probes]
            want = [(i, v) for i, v in want if how == "left" or v is not None]
            assert sorted(((r.pid, r.v) for r in got.collect()), key=str) == sorted(want, key=str), (strategy, how)
    end = BASE + dt.timedelta(days=1)
    want = [(k, _brute(table, end, k)) for k in range(8) if _brute(table, end, k) is not None]
    assert rows(latest_by_key(t.filter("k is not null"), ["k"], deleted="deleted"), "k", "v") == want
    for seconds in (None, 10, 3600):
        kept = versions_by_key(t, ["k"], deleted="deleted", slice_seconds=seconds).collect()
        assert sorted(r.id for r in kept) == sorted(v[2] for v in table if v[0] is not None and not v[4])
        for r in kept:                  # the next version of the key, tombstones included, ends it
            later = [(v[1], v[2]) for v in table if v[0] == r.k and (v[1], v[2]) > (r.ts, r.id)]
            assert r.valid_to == (min(later)[0] if later else None)


def test_no_driver_local_scratch_on_a_cluster():
    from encore.session import ensure_checkpoint_dir

    class Session:                      # what ``ensure_checkpoint_dir`` reads of a session
        def __init__(self, **conf):
            self.conf = self
            self.values = {k.replace("_", "."): v for k, v in conf.items()}
            self.sparkContext = type("C", (), {"getCheckpointDir": lambda s: None, "setCheckpointDir": lambda s, d: None})()

        def get(self, key, default=None):
            return self.values.get(key, default)

        def set(self, key, value):
            self.values[key] = value

    for warehouse in ("file:/home/x/spark-warehouse", "/home/x/spark-warehouse"):
        with pytest.raises(ValueError):
            ensure_checkpoint_dir(Session(spark_master="yarn", spark_sql_warehouse_dir=warehouse))
        assert ensure_checkpoint_dir(Session(spark_master="local[4]", spark_sql_warehouse_dir=warehouse)).startswith(warehouse)
    shared = Session(spark_master="yarn", spark_sql_warehouse_dir="hdfs://n/w")
    assert ensure_checkpoint_dir(shared) == "hdfs://n/w/_encore_scratch"
    named = Session(spark_master="yarn", spark_sql_warehouse_dir="/w", spark_checkpoint_dir="hdfs://n/c")
    assert ensure_checkpoint_dir(named) == "hdfs://n/c"
