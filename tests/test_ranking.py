import datetime as dt

from feed import BASE, rows
from pyspark.sql import functions as F

from encore.plans import ranking


def _upto(df, seq):
    return df.filter(F.col("ts") <= F.lit(BASE + dt.timedelta(seconds=seq)))


def _top(listen):
    return [(r.artistid, r.n) for r in sorted(ranking.top_customer_artists(listen).collect(),
                                              key=lambda r: r.rnk)]


def test_top_customer_artists_checkpoints(spark, feed):
    for a in [2, 2, 3, 4, 4, 4]:
        feed.add("listen", customerid=1, artistid=a)
    s1 = feed.seq
    for a in [5, 5]:
        feed.add("listen", customerid=1, artistid=a)
    s2 = feed.seq
    for a in [3, 3]:
        feed.add("listen", customerid=1, artistid=a)
    l = feed.df(spark, "listen")
    assert _top(_upto(l, s1)) == [(4, 3), (2, 2), (3, 1)]
    assert _top(_upto(l, s2)) == [(4, 3), (2, 2), (5, 2)]
    assert _top(l) == [(4, 3), (3, 3), (2, 2)]
    nested = ranking.top_customer_artists_nested(l).collect()[0]
    assert [(x.artistid, x.n) for x in nested.top] == [(4, 3), (3, 3), (2, 2)]


def _bottom(t, e, l, artist):
    out = ranking.least_streaming_ticket_holders(t, e, l).filter(F.col("artistid") == artist)
    return {r.customerid for r in out.collect()}


def test_least_streaming_ticket_holders(spark, feed):
    A = 7
    feed.add("event", id=1, artistid=A, venueid=1, capacity=5)
    for c in (1, 2, 3):
        feed.add("ticket", customerid=c, eventid=1)
    for c in (1, 1, 2, 3):
        feed.add("listen", customerid=c, artistid=A)
    s1 = feed.seq
    for c in (4, 5):                       # listeners without a ticket
        feed.add("listen", customerid=c, artistid=A)
    s2 = feed.seq
    for c in (2, 3, 3, 2, 2):
        feed.add("listen", customerid=c, artistid=A)
    t, e, l = feed.df(spark, "ticket"), feed.df(spark, "event"), feed.df(spark, "listen")
    assert _bottom(t, e, _upto(l, s1), A) == {2, 3}
    assert _bottom(t, e, _upto(l, s2), A) == {2, 3}
    assert _bottom(t, e, l, A) == {3, 1}


def test_least_streaming_two_artists_and_late_ticket(spark, feed):
    A1, A2 = 11, 22
    feed.add("event", id=1, artistid=A1, venueid=1, capacity=5)
    feed.add("event", id=2, artistid=A2, venueid=1, capacity=5)
    for c in (1, 2, 3):
        feed.add("ticket", customerid=c, eventid=1)
    for c in (1, 1, 2, 3):
        feed.add("listen", customerid=c, artistid=A1)
    for c in (1, 2, 4):
        feed.add("ticket", customerid=c, eventid=2)
    for c in (1, 2, 2, 3, 2, 4):
        feed.add("listen", customerid=c, artistid=A2)
    for c in (2, 2, 2):
        feed.add("listen", customerid=c, artistid=A1)
    feed.add("listen", customerid=4, artistid=A1)   # before customer 4's ticket: not counted
    feed.add("ticket", customerid=4, eventid=1)
    feed.add("listen", customerid=4, artistid=A1)
    t, e, l = feed.df(spark, "ticket"), feed.df(spark, "event"), feed.df(spark, "listen")
    assert _bottom(t, e, l, A2) == {1, 4}
    assert _bottom(t, e, l, A1) == {3, 4}
    amounts = rows(ranking.least_streaming_ticket_holders(t, e, l).filter(F.col("artistid") == A1),
                   "customerid", "streamamount")
    assert amounts == [(3, 1), (4, 1)]


def test_bottom_tie_order(spark, feed):
    # count 1: earlier listen first; count >= 2: the customer whose count rose last first
    A = 3
    feed.add("event", id=1, artistid=A, venueid=1, capacity=5)
    for c in (1, 2, 3, 4):
        feed.add("ticket", customerid=c, eventid=1)
    for c in (1, 2, 1, 2, 3, 4):
        feed.add("listen", customerid=c, artistid=A)
    t, e, l = feed.df(spark, "ticket"), feed.df(spark, "event"), feed.df(spark, "listen")
    out = ranking.least_streaming_ticket_holders(t, e, l, n=4).collect()
    assert [r.customerid for r in sorted(out, key=lambda r: r.rnk)] == [3, 4, 2, 1]


def test_global_top_and_groups(spark, feed):
    for c, a in [(1, 1), (1, 1), (2, 2), (2, 2), (2, 1), (3, 3)]:
        feed.add("listen", customerid=c, artistid=a)
    l = feed.df(spark, "listen")
    assert rows(ranking.global_top_artists(l), "rnk", "artistid", "n") == [(1, 1, 3), (2, 2, 2), (3, 3, 1)]
    assert rows(ranking.customers_by_top_artist(l), "artistid", "customerid", "group_size") == [
        (1, 1, 1), (2, 2, 1), (3, 3, 1)]


def test_changelogs_list_every_step(spark, feed):
    for a in [2, 2, 3, 4, 4, 4, 5, 5, 3, 3]:
        feed.add("listen", customerid=1, artistid=a)
    l = feed.df(spark, "listen")
    log = ranking.top_customer_artists_changelog(l)
    for r in l.collect():
        now = ranking.top_customer_artists(l.filter(F.col("ts") <= F.lit(r.ts)))
        assert rows(log.filter(F.col("id") == r.id), "rnk", "artistid", "n") == rows(now, "rnk", "artistid", "n")


def test_least_streaming_changelog(spark, feed):
    feed.add("event", id=1, artistid=7, venueid=1, capacity=5)
    for c in (1, 2, 3):
        feed.add("ticket", customerid=c, eventid=1)
    for c in (1, 1, 2, 3, 4, 2, 3, 3, 2, 2):
        feed.add("listen", customerid=c, artistid=7)
    t, e, l = feed.df(spark, "ticket"), feed.df(spark, "event"), feed.df(spark, "listen")
    log = ranking.least_streaming_ticket_holders_changelog(t, e, l)
    counted = l.filter("customerid < 4").collect()
    assert log.select("id").distinct().count() == len(counted) == 9
    for r in counted:
        now = ranking.least_streaming_ticket_holders(t, e, l.filter(F.col("ts") <= F.lit(r.ts)))
        cols = ["rnk", "customerid", "streamamount"]
        assert rows(log.filter(F.col("id") == r.id), *cols) == rows(now, *cols)
