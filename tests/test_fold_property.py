"""Ranked lists against a plain fold of the counter-map semantics on random inputs.

The fold keeps an insertion-ordered map, increments a key in place (new keys
go last), then stably re-sorts by count (descending for top artists,
ascending for least streamers) and reads the first N entries.
"""

import random

import pytest
from pyspark.sql import functions as F

from encore.plans import ranking


def _fold(seq, descending):
    book = {}
    for k in seq:
        book[k] = book.get(k, 0) + 1
        items = sorted(book.items(), key=lambda kv: -kv[1] if descending else kv[1])
        book = dict(items)
    return list(book.items())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_top_artists_fold(spark, feed, seed):
    rnd = random.Random(seed)
    seqs = {c: [rnd.randrange(6) for _ in range(rnd.randrange(1, 25))] for c in range(5)}
    order = [(c, a) for c, s in seqs.items() for a in s]
    rnd.shuffle(order)                      # customers interleave; each keeps its own order
    per = {c: [] for c in seqs}
    for c, _ in order:
        per[c].append(seqs[c][len(per[c])])
    for c, a in ((c, per[c][i]) for c, i in _interleave(order, per)):
        feed.add("listen", customerid=c, artistid=a)
    got = ranking.top_customer_artists(feed.df(spark, "listen")).collect()
    for c, s in per.items():
        want = _fold(s, descending=True)[:3]
        have = [(r.artistid, r.n) for r in sorted((r for r in got if r.customerid == c), key=lambda r: r.rnk)]
        assert have == want, (c, s)


def _interleave(order, per):
    seen = {c: 0 for c in per}
    for c, _ in order:
        yield c, seen[c]
        seen[c] += 1


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_least_streamers_fold(spark, feed, seed):
    rnd = random.Random(seed)
    A = 9
    feed.add("event", id=1, artistid=A, venueid=1, capacity=5)
    for c in range(7):
        feed.add("ticket", customerid=c, eventid=1)
    seq = [rnd.randrange(7) for _ in range(rnd.randrange(5, 40))]
    for c in seq:
        feed.add("listen", customerid=c, artistid=A)
    t, e, l = feed.df(spark, "ticket"), feed.df(spark, "event"), feed.df(spark, "listen")
    got = ranking.least_streaming_ticket_holders(t, e, l, n=7).filter(F.col("artistid") == A).collect()
    have = [(r.customerid, r.streamamount) for r in sorted(got, key=lambda r: r.rnk)]
    assert have == _fold(seq, descending=False), seq
