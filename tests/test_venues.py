from feed import rows

from encore.plans import venues


def _addr(feed, aid, cust, state, line2="Apt 5"):
    feed.add("address", id=aid, customerid=cust, line1="1 Main", line2=line2, citynm="X", state=state,
             zip5="55555", zip4="1234", countrycd="USA")


def _frames(feed, spark):
    return [feed.df(spark, n) for n in ("ticket", "event", "venue", "address")]


def test_out_of_state_single_match(spark, feed):
    _addr(feed, "va1", None, "MN")
    feed.add("venue", id=1, addressid="va1", name="v", maxcapacity=5)
    feed.add("event", id=123, artistid=1, venueid=1, capacity=5, eventdate="today")
    _addr(feed, "ca1", 1, "MN")
    feed.add("ticket", customerid=1, eventid=123)
    _addr(feed, "ca2", 2, "NV", line2=None)
    feed.add("ticket", customerid=2, eventid=123)
    out = venues.out_of_state_ticket_holders(*_frames(feed, spark))
    assert rows(out, "customerid", "customerstate", "eventstate") == [(2, "NV", "MN")]


def test_out_of_state_early_inputs_are_lost(spark, feed):
    feed.add("ticket", customerid=2, eventid=123)
    feed.add("event", id=123, artistid=1, venueid=1, capacity=5)
    _addr(feed, "va1", None, "MN")
    feed.add("venue", id=1, addressid="va1", name="v", maxcapacity=5)
    _addr(feed, "ca2", 2, "NV")
    assert venues.out_of_state_ticket_holders(*_frames(feed, spark)).count() == 0


def test_out_of_state_in_state_only(spark, feed):
    _addr(feed, "va1", None, "MN")
    feed.add("venue", id=1, addressid="va1", name="v", maxcapacity=5)
    feed.add("event", id=123, artistid=1, venueid=1, capacity=5)
    _addr(feed, "ca1", 1, "MN")
    feed.add("ticket", customerid=1, eventid=123)
    assert venues.out_of_state_ticket_holders(*_frames(feed, spark)).count() == 0


def test_out_of_state_many_customers(spark, feed):
    _addr(feed, "va1", None, "MN")
    _addr(feed, "va2", None, "WI")
    feed.add("venue", id=1, addressid="va1", name="v1", maxcapacity=5)
    feed.add("venue", id=2, addressid="va2", name="v2", maxcapacity=5)
    events = {"MN-1": 11, "MN-2": 12, "MN-3": 13, "WI-1": 21}
    for name, eid in events.items():
        feed.add("event", id=eid, artistid=1, venueid=1 if name.startswith("MN") else 2, capacity=5)
    customers = [(1, "MN", ["MN-1", "MN-2", "MN-3", "WI-1"]), (2, "MN", ["MN-2"]), (3, "WI", ["WI-1"]),
                 (4, "FL", ["MN-1", "MN-2", "WI-1"]), (5, "WI", ["MN-1", "MN-2", "MN-3", "WI-1"]),
                 (6, "MN", ["MN-1", "MN-2", "MN-3", "WI-1"]), (7, "IA", [])]
    expected = []
    for cid, state, evs in customers:
        _addr(feed, f"c{cid}-address", cid, state)
        for name in evs:
            feed.add("ticket", customerid=cid, eventid=events[name])
            if not name.startswith(state):
                expected.append((cid, events[name]))
    out = venues.out_of_state_ticket_holders(*_frames(feed, spark))
    assert rows(out, "customerid", "eventid") == sorted(expected)
    assert len(expected) == 8


def test_instate_streamers_vs_capacity(spark, feed):
    venue_states = {1: "MN", 2: "WV", 3: "NY", 4: "WI", 5: "MN"}
    for vid, st in venue_states.items():
        _addr(feed, f"va{vid}", None, st)
        feed.add("venue", id=vid, addressid=f"va{vid}", name=f"v{vid}", maxcapacity=100 * vid)
    a1, a2, a3, a4 = 123456, 234561, 345612, 456123

    def listen(c, a, k):
        for _ in range(k):
            feed.add("listen", customerid=c, artistid=a)

    _addr(feed, "ca1", 1, "MN")
    listen(1, a1, 5); listen(1, a2, 2); listen(1, a3, 3)  # noqa: E702
    _addr(feed, "ca2", 2, "AK")
    listen(2, a2, 5); listen(2, a1, 2); listen(2, a3, 3)  # noqa: E702
    _addr(feed, "ca3", 3, "WV")
    listen(3, a1, 4); listen(3, a3, 2); listen(3, a2, 3)  # noqa: E702
    _addr(feed, "ca4", 3, "KS")                       # customer 3 moves
    listen(3, a2, 2)
    feed.add("event", id=1, artistid=a1, venueid=1, capacity=2000)
    feed.add("event", id=2, artistid=a2, venueid=2, capacity=50)
    feed.add("event", id=3, artistid=a4, venueid=3, capacity=50000)
    feed.add("event", id=4, artistid=a1, venueid=4, capacity=30000)
    feed.add("event", id=5, artistid=a1, venueid=2, capacity=50)
    listen(3, a1, 5)                                  # after the events: no new row
    feed.add("event", id=6, artistid=a1, venueid=5, capacity=4000)
    args = [feed.df(spark, n) for n in ("listen", "event", "venue", "address")]
    ch = venues.instate_streamers_vs_capacity_changelog(*args)
    assert rows(ch, "eventid", "artistid", "state", "streamcount", "capacity") == [
        (1, a1, "MN", 5, 2000), (2, a2, "WV", 3, 50), (3, a4, "NY", 0, 50000),
        (4, a1, "WI", 0, 30000), (5, a1, "WV", 4, 50), (6, a1, "MN", 5, 6000)]
    final = venues.instate_streamers_vs_capacity(*args)
    assert rows(final, "artistid", "state", "streamcount", "capacity") == sorted([
        (a1, "MN", 5, 6000), (a2, "WV", 3, 50), (a4, "NY", 0, 50000), (a1, "WI", 0, 30000),
        (a1, "WV", 4, 50)])


def test_sql_reports(spark, feed):
    _addr(feed, "va1", None, "MN")
    feed.add("venue", id=1, addressid="va1", name="v", maxcapacity=5)
    feed.add("event", id=1, artistid=1, venueid=1, capacity=5, eventdate="2024-02-10")
    feed.add("event", id=2, artistid=1, venueid=1, capacity=5, eventdate="2024-02-10")
    _addr(feed, "a1", 1, "WI")
    _addr(feed, "a2", 1, "MN")
    _addr(feed, "a3", 1, "IA")
    for _ in range(4):                      # exactly 80 %: not high attendance
        feed.add("ticket", customerid=1, eventid=1)
    for _ in range(5):
        feed.add("ticket", customerid=1, eventid=2)
    t, e, v, a = _frames(feed, spark)
    # every (ticket, other-state address) pair counts: 2 other-state addresses per ticket
    assert rows(venues.out_of_state_tickets_by_event(t, e, v, a), "eventid", "num_out_of_state_tickets") == [
        (1, 8), (2, 10)]
    hi = venues.high_attendance_events_by_state(t, e, v, a, "2024-02-01", "2024-02-20")
    assert rows(hi, "state", "num_high_attendance_events") == [("MN", 1)]
    # range ends are excluded
    assert venues.high_attendance_events_by_state(t, e, v, a, "2024-02-10", "2024-02-20").count() == 0


def test_sql_text_report_equals_dataframe_and_null_states(spark, feed):
    from encore.plans import sql_reports
    from encore.sources import Domain

    _addr(feed, "va1", None, "MN")
    feed.add("venue", id=1, addressid="va1", name="v", maxcapacity=5)
    feed.add("event", id=1, artistid=1, venueid=1, capacity=2, eventdate="2024-02-10")
    _addr(feed, "a1", 1, None)              # no state: never "another state"
    _addr(feed, "a2", 1, "WI")
    for _ in range(3):
        feed.add("ticket", customerid=1, eventid=1)
    t, e, v, a = _frames(feed, spark)
    assert rows(venues.out_of_state_tickets_by_event(t, e, v, a), "eventid", "num_out_of_state_tickets") == [
        (1, 3)]

    class Fixture(Domain):                  # the SQL text runs over these entity frames
        pass
    d = Fixture(spark, "/unused")
    for name, df in (("event", e), ("ticket", t), ("venue", v), ("address", a),
                     ("listen", feed.df(spark, "listen")), ("customer", feed.df(spark, "customer"))):
        d.__dict__[name] = df
    sql = sql_reports.high_attendance_events_by_state_sql(d, "2024-02-01", "2024-02-20")
    df = venues.high_attendance_events_by_state(t, e, v, a, "2024-02-01", "2024-02-20")
    assert rows(sql, "state", "num_high_attendance_events") == rows(df, "state", "num_high_attendance_events") \
        == [("MN", 1)]


def test_zip_alert_with_residents_in_groups(spark, feed, monkeypatch):
    """A zip code whose residents are many join keys, against the rule itself."""
    event = feed.add("event", artistid=1, venueid=1, capacity=6)
    home = {c: f"{c % 2:05d}" for c in range(1, 31)}
    for c, zip5 in home.items():
        feed.add("address", customerid=c, state="MN", zip5=zip5)
    buyers = [2, 4, 4, 7, 6, 2]
    for c in buyers:
        feed.add("ticket", customerid=c, eventid=event)
    want = sorted((event, z, c, len({b for b in buyers if home[b] == z and b != c})) for c, z in home.items()
                  if any(home[b] == z and b != c for b in buyers))
    for size in (10_000, 4, 1):
        monkeypatch.setattr(venues, "ZIP_GROUP", size)
        got = venues.alert_popular_event_in_zip(*(feed.df(spark, e) for e in ("ticket", "event", "address")))
        assert rows(got, "eventid", "zip5", "customerid", "num_customers") == want
