from feed import rows

from encore.plans import stateless


def _customers(feed, spark, pairs):
    for cid, born, kind in pairs:
        feed.add("customer", id=cid, fullname=f"c{cid}", birthdt=born, feed=kind)
    c = feed.df(spark, "customer")
    return c.filter("feed = 'current'"), c.filter("feed = 'legacy'")


def test_target_customers_bounds(spark, feed):
    cur, leg = _customers(feed, spark, [(123, "1989-01-20", "current"), (456, "1990-01-20", "current"),
                                        (567, "1999-01-20", "current"), (678, "2000-01-20", "current")])
    assert rows(stateless.target_customer_filter(cur, leg), "id") == [(456,), (567,)]


def test_target_customers_merge_legacy_feed(spark, feed):
    cur, leg = _customers(feed, spark, [(123, "1989-01-20", "current"), (456, "1990-01-20", "current"),
                                        (567, "1999-01-20", "legacy"), (678, "2000-01-20", "legacy")])
    assert rows(stateless.target_customer_filter(cur, leg), "id") == [(456,), (567,)]


def test_target_customers_bad_dates_dropped(spark, feed):
    cur, leg = _customers(feed, spark, [(1, "unknown", "current"), (2, None, "current"),
                                        (3, "1995", "legacy")])
    assert rows(stateless.target_customer_filter(cur, leg), "id") == [(3,)]


def _address(feed, spark, **kw):
    base = dict(customerid=1, line1=None, line2=None, citynm=None, state=None, zip5=None,
                zip4=None, countrycd=None)
    base.update(kw)
    feed.add("address", **base)
    return feed.df(spark, "address")


def test_address_default_branch(spark, feed):
    a = _address(feed, spark, id="a1", line1="111 1st St", line2="Apt 2", citynm="Madison", state="WI",
                 zip5="55555", zip4="1234", countrycd="USA")
    assert rows(stateless.address_split_default(a), "state", "address") == [
        ("WI", "111 1st St, Apt 2, Madison, WI 55555-1234 USA")]
    assert stateless.address_split_priority(a).count() == 0


def test_address_priority_branch(spark, feed):
    a = _address(feed, spark, id="a2", line1="222 1st St", line2="Suite 4", citynm="Minneapolis",
                 state="MN", zip5="55419", zip4="1234", countrycd="USA")
    assert rows(stateless.address_split_priority(a), "state", "address") == [
        ("MN", "222 1st St, Suite 4, Minneapolis, MN 55419-1234 USA")]
    assert stateless.address_split_default(a).count() == 0


def test_address_null_parts_print_null_and_null_state_is_default(spark, feed):
    a = _address(feed, spark, id="a3", line1="1 Lake St", line2=None, citynm="Reno", state=None,
                 zip5="85409", zip4="1234", countrycd="USA")
    assert rows(stateless.address_split_default(a), "address") == [
        ("1 Lake St, null, Reno, null 85409-1234 USA",)]
    assert stateless.address_split_priority(a).count() == 0


def test_split_by_owner(spark, feed):
    feed.add("address", id="v1", customerid=None, state="MN")
    feed.add("address", id="c1", customerid=7, state="WI")
    out = stateless.split_addresses_by_owner(feed.df(spark, "address"))
    assert rows(out, "id", "owner") == [("c1", "customer"), ("v1", "venue")]
