"""Ranked lists after every change, and taste intervals, against brute force."""

import datetime as dt
import random

import pytest
from feed import BASE, rows
from pyspark.sql import functions as F

from encore.operators import lists
from encore.plans import ranking, suggestions


def _listens(seed, n, customers, artists, span):
    rnd = random.Random(seed)
    return [(i * 7 % 1000 + 1000 * i, rnd.randrange(customers), rnd.randrange(artists),
             BASE + dt.timedelta(seconds=rnd.randrange(span))) for i in range(n)]


def _after(listens, key, item, order, n, counts=()):
    """Lists after every listen; ``counts``: {(key, item): (count, ts, id)} from before."""
    counts, out = dict(counts), []
    for row in sorted(listens, key=lambda r: (r[3], r[0])):
        k, i = row[key], row[item]
        counts[k, i] = (counts.get((k, i), (0,))[0] + 1, row[3], row[0])
        best = sorted(((order(*v), j, v[0]) for (kk, j), v in counts.items() if kk == k))[:n]
        out += [(row[0], k, r, j, c) for r, (_, j, c) in enumerate(best, 1)]
    return sorted(out), counts


MOST = lambda n, ts, i: (-n, ts, i)
LEAST = lambda n, ts, i: (n, ts.timestamp() if n == 1 else -ts.timestamp(), i if n == 1 else -i)


@pytest.mark.parametrize("span", [50, 3000, 500_000])
def test_growing_lists(spark, span):
    listens = _listens(span, 400, 6, 9, span)
    df = spark.createDataFrame(listens, "id long, customerid long, artistid long, ts timestamp")
    got = rows(ranking.top_customer_artists_changelog(df), "id", "customerid", "rnk", "artistid", "n")
    assert got == _after(listens, 1, 2, MOST, 3)[0]


@pytest.mark.parametrize("span,group", [(50, 50_000), (3000, 3), (500_000, 2)])
def test_lists_of_the_least(spark, monkeypatch, span, group):
    """Also with a key's items in many groups."""
    monkeypatch.setattr(lists, "GROUP_ITEMS", group)
    listens = _listens(span, 400, 30, 3, span)
    df = spark.createDataFrame(listens, "id long, customerid long, artistid long, ts timestamp")
    got = rows(ranking.least_lists(df), "id", "artistid", "rnk", "customerid", "streamamount")
    assert got == _after(listens, 2, 1, LEAST, 2)[0]


def test_lists_go_on_from_stored_counts(spark):
    listens = _listens(5, 500, 12, 4, 40_000)
    listens.sort(key=lambda r: (r[3], r[0]))
    old, new = listens[:300], listens[300:]
    df = spark.createDataFrame(new, "id long, customerid long, artistid long, ts timestamp")
    _, counts = _after(old, 2, 1, LEAST, 2)
    stored = spark.createDataFrame([(a, c, *v) for (a, c), v in counts.items()],
                                   "artistid long, customerid long, streamamount long, ts timestamp, id long")
    got = rows(ranking.least_lists(df, 2, stored), "id", "artistid", "rnk", "customerid", "streamamount")
    assert got == _after(new, 2, 1, LEAST, 2, counts)[0]
    _, counts = _after(old, 1, 2, MOST, 3)
    stored = spark.createDataFrame([(c, a, *v) for (c, a), v in counts.items()],
                                   "customerid long, artistid long, n long, ts timestamp, id long")
    lists_of = ranking.rank_within(stored, ["customerid"], ranking.most_first(), 3)
    got = rows(ranking.top_customer_artists_changelog(df, 3, stored, lists_of), "id", "customerid", "rnk", "artistid",
               "n")
    assert got == _after(new, 1, 2, MOST, 3, counts)[0]


def test_intervals_meet_events_by_number(spark):
    rnd = random.Random(3)
    at = lambda: BASE + dt.timedelta(seconds=rnd.randrange(20_000))
    taste = []
    for c in range(60):
        a, b = sorted((at(), at()))
        taste.append((c, f"g{rnd.randrange(3)}", a, rnd.choice([b, None, a])))
    events = [(e, 0, at(), f"g{rnd.randrange(4)}") for e in range(40)] + [(99, 0, taste[0][2], taste[0][1])]
    t = spark.createDataFrame(taste, "customerid long, genre string, ts timestamp, until timestamp")
    e = spark.createDataFrame(events, "eventid long, artistid long, ts timestamp, genre string")
    got = suggestions.events_within(t, e)
    want = sorted((ev, c) for c, g, a, b in taste for ev, _, ts, eg in events if eg == g and a <= ts and (b is None or ts < b))
    assert rows(got, "eventid", "customerid") == want
    # equality joins only: no pair of the plan is dropped by a range
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = got._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and not any("<" in line.split("Join", 1)[1] for line in joins), joins
