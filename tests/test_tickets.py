from encore.plans import tickets


def test_capacity_countdown_and_rejections(spark, feed):
    feed.add("event", id=1, artistid=1, venueid=1, capacity=5, eventdate="today")
    for _ in range(8):
        feed.add("ticket", customerid=9, eventid=1)
    out = tickets.purchase_event_ticket(feed.df(spark, "ticket"), feed.df(spark, "event"))
    got = sorted((r.ticketid, r.remainingtickets, r.confirmationstatus, r.tier) for r in out.collect())
    assert [g[1] for g in got] == [4.0, 3.0, 2.0, 1.0, 0.0, -1.0, -2.0, -3.0]
    assert [g[2] for g in got] == ["CONFIRMED"] * 5 + ["REJECTED"] * 3
    # 4/5 = 80 % left -> open; 20 % or less -> limited; oversold -> sold out
    assert [g[3] for g in got] == ["OPEN", "OPEN", "OPEN", "LIMITED", "LIMITED"] + ["SOLD_OUT"] * 3


def test_capacity_taken_from_first_request_and_zero_capacity(spark, feed):
    feed.add("event", id=1, artistid=1, venueid=1, capacity=2)
    feed.add("event", id=2, artistid=1, venueid=1, capacity=0)
    feed.add("ticket", customerid=1, eventid=1)
    feed.add("event", id=1, artistid=1, venueid=1, capacity=10)   # re-announced: not refreshed
    feed.add("ticket", customerid=1, eventid=1)
    feed.add("ticket", customerid=1, eventid=1)
    feed.add("ticket", customerid=1, eventid=2)
    out = tickets.purchase_event_ticket(feed.df(spark, "ticket"), feed.df(spark, "event"))
    got = sorted((r.eventid, r.ticketid, r.remainingtickets, r.confirmationstatus) for r in out.collect())
    assert [(g[0], g[2], g[3]) for g in got] == [
        (1, 1.0, "CONFIRMED"), (1, 0.0, "CONFIRMED"), (1, -1.0, "REJECTED"), (2, -1.0, "REJECTED")]


def test_alerts_and_notifications(spark, feed):
    feed.add("event", id=1, artistid=1, venueid=1, capacity=10)
    ids = [feed.add("ticket", customerid=c, eventid=1) for c in range(11)]
    t, e = feed.df(spark, "ticket"), feed.df(spark, "event")
    near = tickets.alert_near_capacity(t, e).collect()
    assert [(r.ticketid, r.remainingtickets) for r in near] == [(ids[8], 1.0)]
    sold = tickets.alert_sold_out(t, e).collect()
    assert [(r.ticketid, r.remainingtickets) for r in sold] == [(ids[9], 0.0)]
    msg = {r.ticketid: r for r in tickets.ticket_notifications(t, e).collect()}
    m = msg[ids[10]]
    assert m.recipient == "10@email.com"
    assert m.subject == f"Ticket Confirmation (CONF-{ids[10]}) - Event 1"
    assert m.body == "Your ticket has been REJECTED!"


def test_observed_counts(spark, feed):
    from pyspark.sql import functions as F

    from encore.functions import observed
    feed.add("event", id=1, artistid=1, venueid=1, capacity=2)
    for _ in range(3):
        feed.add("ticket", customerid=1, eventid=1)
    out = tickets.purchase_event_ticket(feed.df(spark, "ticket"), feed.df(spark, "event"))
    out, obs = observed(out, "tickets", rejected=F.col("confirmationstatus") == "REJECTED")
    out.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows": 3, "rejected": 1}


def test_ticket_at_the_same_moment_as_its_event(spark):
    import datetime as dt

    from encore import schemas
    t0 = dt.datetime(2024, 1, 1, 12)
    ev = spark.createDataFrame([(5, 1, 1, 3, "x", t0)], schemas.EVENT)
    tk = spark.createDataFrame([(9, 1, 5, 1.0, t0), (8, 1, 5, 1.0, t0 - dt.timedelta(seconds=1))],
                               schemas.TICKET)
    out = tickets.purchase_event_ticket(tk, ev).collect()
    # the earlier request is lost (event unknown); the simultaneous one sees the event
    assert [(r.ticketid, r.remainingtickets) for r in out] == [(9, 2.0)]
