import datetime as dt
import random

import pytest

from encore.plans.alerts import top_streamers_at_events

BASE = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("seed", [1, 3])
def test_top_streamers_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    listens = [(i, rnd.randrange(8), rnd.randrange(2), BASE + dt.timedelta(seconds=rnd.randrange(300)))
               for i in range(400)]
    events = [(1000 + j, rnd.randrange(2), BASE + dt.timedelta(seconds=rnd.randrange(320)))
              for j in range(12)]
    # an event at exactly a listen's time counts that listen
    events.append((2000, listens[0][2], listens[0][3]))
    l = spark.createDataFrame(listens, "id long, customerid long, artistid long, ts timestamp")
    e = spark.createDataFrame(events, "id long, artistid long, ts timestamp")
    got = sorted(tuple(r) for r in top_streamers_at_events(l, e)
                 .select("eventid", "rnk", "customerid", "n").collect())
    exp = []
    for eid, a, t in events:
        cnt = {}
        for _, c, la, lt in listens:
            if la == a and lt <= t:
                cnt[c] = cnt.get(c, 0) + 1
        top = sorted(cnt.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
        exp += [(eid, i + 1, c, k) for i, (c, k) in enumerate(top)]
    assert got == sorted(exp)


@pytest.mark.parametrize("base", [2**53, 2**62])
def test_large_ids_stay_exact(spark, base):
    l = spark.createDataFrame([(i, base + 1 + 2 * (i % 2), 1, BASE) for i in range(5)],
                              "id long, customerid long, artistid long, ts timestamp")
    e = spark.createDataFrame([(base + 7, 1, BASE), (base + 9, 1, BASE + dt.timedelta(1))],
                              "id long, artistid long, ts timestamp")
    got = sorted(tuple(r) for r in top_streamers_at_events(l, e).select("eventid", "rnk", "customerid", "n").collect())
    assert got == [(x, r, c, n) for x in (base + 7, base + 9) for r, c, n in ((1, base + 1, 3), (2, base + 3, 2))]


def _tables(spark, tmp_path):
    """Tables read from files: their sizes make Spark broadcast what it takes to be small."""
    spark.range(200).selectExpr("id", "id % 7 as customerid", "id % 2 as artistid",
                                "timestamp_seconds(1704067200 + id) as ts").write.parquet(f"{tmp_path}/l")
    spark.range(20).selectExpr("id", "id % 2 as artistid",
                               "timestamp_seconds(1704067200 + 9 * id) as ts").write.parquet(f"{tmp_path}/e")
    spark.range(5).selectExpr("id as customerid", "concat('c', id) as email").write.parquet(f"{tmp_path}/m")
    return [spark.read.parquet(f"{tmp_path}/{t}") for t in "lem"]


def _joins(df):
    return [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Join [" in x]


def test_exploded_events_are_not_broadcast(spark, tmp_path):
    listen, event, _ = _tables(spark, tmp_path)
    pieces = [j for j in _joins(top_streamers_at_events(listen, event)) if "node#" in j]
    assert pieces and all("SortMergeJoin" in j for j in pieces)


def test_emails_are_not_broadcast(spark, tmp_path):
    from encore.plans.alerts import alert_top_streamers_with_email
    listen, event, email = _tables(spark, tmp_path)
    out = alert_top_streamers_with_email(listen, event, email)
    by_customer = [j for j in _joins(out) if "Join [customerid#" in j]
    assert by_customer and all("SortMergeJoin" in j for j in by_customer)
    assert {(r.customerid, r.email) for r in out.collect()} == {
        (r.customerid, f"c{r.customerid}" if r.customerid < 5 else None) for r in out.collect()}
