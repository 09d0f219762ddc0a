from feed import rows

from encore.plans import counts


def test_customer_stream_count_changelog(spark, feed):
    for c, a in [(1, 2), (1, 3), (1, 4), (2, 3)]:
        feed.add("listen", customerid=c, artistid=a)
    ch = counts.customer_stream_count_changelog(feed.df(spark, "listen"))
    got = sorted((r.id, r.customerid, r.n) for r in ch.collect())
    assert [(c, n) for _, c, n in got] == [(1, 1), (1, 2), (1, 3), (2, 1)]
    assert rows(counts.customer_stream_count(feed.df(spark, "listen")), "customerid", "n") == [(1, 3), (2, 1)]


def test_artist_ticket_count(spark, feed):
    feed.add("event", id=1, artistid=1, venueid=1, capacity=10)
    feed.add("event", id=2, artistid=2, venueid=1, capacity=10)
    feed.add("ticket", customerid=1, eventid=1)
    for _ in range(4):
        feed.add("ticket", customerid=2, eventid=2)
    t, e = feed.df(spark, "ticket"), feed.df(spark, "event")
    assert rows(counts.artist_ticket_count(t, e), "artistid", "n") == [(1, 1), (2, 4)]
    ch = counts.artist_ticket_count_changelog(t, e)
    assert sorted((r.artistid, r.n) for r in ch.collect()) == [(1, 1), (2, 1), (2, 2), (2, 3), (2, 4)]


def test_ticket_before_event_is_lost(spark, feed):
    feed.add("ticket", customerid=1, eventid=1)
    feed.add("event", id=1, artistid=1, venueid=1, capacity=10)
    feed.add("ticket", customerid=1, eventid=1)
    assert rows(counts.artist_ticket_count(feed.df(spark, "ticket"), feed.df(spark, "event")),
                "artistid", "n") == [(1, 1)]


def test_totals(spark, feed):
    feed.add("customer", id=1)
    feed.add("listen", customerid=1, artistid=1)
    feed.add("listen", customerid=1, artistid=1)
    feed.add("event", id=1, artistid=1, venueid=1, capacity=1, eventdate="2024-01-10")
    feed.add("event", id=2, artistid=1, venueid=1, capacity=1, eventdate="2024-03-10")
    out = counts.totals(feed.df(spark, "customer"), feed.df(spark, "listen"),
                        feed.df(spark, "event"), feed.df(spark, "ticket")).collect()[0]
    assert tuple(out) == (1, 2, 2, 0)
    assert counts.total_past_events(feed.df(spark, "event"), "2024-02-01").collect()[0][0] == 1
