"""The bootstrap against a plain one over dictionaries."""

import hashlib
import random
from collections import defaultdict

import pytest
import regex
from encore.llm import pii
from test_rules import brute_spans


def _context(text, at):
    m = regex.search(r"([^ \t-\r]+[ \t-\r]+[^ \t-\r]+[ \t-\r]*)$", text[max(0, at - pii.CONTEXT):at])
    return regex.sub("[0-9]", "0", m[1].lower()) if m else ""


def brute(texts, min_support, confidence, neutral, min_length=6):
    """Spans per text, as the query writes them."""
    base = [brute_spans(t) for t in texts]
    found = []
    for t, spans in zip(texts, base):
        found.append([(m.start(), m.end(), m[0]) for m in regex.finditer(pii.CANDIDATE, t) if len(m[0]) >= min_length
                      and all(m.end() <= s or m.start() >= e for _, s, e in spans)])
    seeds = {(k, _context(t, s), t[s:e]) for t, spans in zip(texts, base) for k, s, e in spans}
    open_ = set()
    for t, some in zip(texts, found):
        for s, e, hit in some:
            shaped = regex.search(pii.SECRET, hit)
            (seeds if shaped else open_).add(*[("secret" if shaped else "", _context(t, s), hit)])
    seeds, open_ = {x for x in seeds if x[1]}, {x for x in open_ if x[1]}
    items = defaultdict(set)
    for _, context, hit in seeds | open_:
        items[context].add(hit)
    known, accepted = {(k, c, h): 1.0 for k, c, h in seeds}, {}
    while True:
        mass = defaultdict(list)
        for (k, c, _), score in known.items():
            mass[k, c].append(score)
        now = {(k, c): (sum(v) + neutral * (len(items[c]) - len(v))) / len(items[c])
               for (k, c), v in mass.items() if len(v) >= min_support}
        now = {p: s for p, s in now.items() if s >= confidence}
        if len(now) <= len(accepted):
            accepted = now
            break
        accepted = now
        best = defaultdict(float)
        for _, c, h in open_:
            for (k, pc), s in accepted.items():
                if pc == c:
                    best[k, h] = max(best[k, h], s)
        known = {(k, c, h): 1.0 for k, c, h in seeds}
        for _, c, h in open_:
            for (k, item), s in best.items():
                if item == h:
                    known[k, c, h] = s
    out = []
    for t, spans, some in zip(texts, base, found):
        more = {(f"found_{k}", s, e) for s, e, _ in some for k, c in accepted if c == _context(t, s)}
        order = [*pii.KINDS, *[f"found_{k}" for k in pii.SEEDS]]
        out.append(",".join(f"{k}:{s}:{e}" for k, s, e in
                            sorted({*spans, *more}, key=lambda x: (order.index(x[0]), x[1], x[2]))))
    return out


def _texts(seed):
    rnd = random.Random(seed)
    number = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    key = lambda: "".join(rnd.choice("0123456789abcdefABC") for _ in range(rnd.randrange(18, 44)))
    shared = [key() for _ in range(6)] + [f"emp-{number(6)}" for _ in range(6)]
    say = [lambda: f'token = "{key()}"', lambda: f'TOKEN = "{rnd.choice(shared)}"', lambda: f"write to a{number(2)}@b.org",
           lambda: f"call me at +1 (555) 555-{number(4)}", lambda: f"call me at {number(3)}-{number(4)}",
           lambda: f"badge number {rnd.choice(shared)}", lambda: f"call me at {rnd.choice(shared)}",
           lambda: f"paid with card {number(4)} {number(4)} {number(3)}", lambda: f"my account is DE{number(2)} {number(4)} {number(4)}",
           lambda: f"in the year {number(4)}", lambda: f"item {number(7)} of {number(8)}", lambda: f"from 10.0.{number(2)}.{number(1)}",
           lambda: "é word\nand more", lambda: f"my account is {rnd.choice(shared)}"]
    return [" so ".join(rnd.choice(say)() for _ in range(rnd.randrange(1, 7))) for _ in range(120)] + ["", " ", "x" * 3000]


@pytest.mark.parametrize("seed,min_support,confidence,neutral", [(1, 3, 0.8, 0.5), (2, 2, 0.6, 0.5), (3, 3, 0.7, 0.0)])
def test_bootstrap_equals_brute_force(spark, seed, min_support, confidence, neutral):
    texts = _texts(seed)
    df = spark.createDataFrame(list(enumerate([*texts, texts[0]])), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.annotate(df, min_support=min_support, confidence=confidence,
                                             neutral=neutral).collect()}
    want = brute(texts, min_support, confidence, neutral)
    assert [got[i].spans for i in range(len(texts))] == want
    assert any("found_" in w for w in want)
    assert [got[i].n_spans for i in range(len(texts))] == [w.count(":") // 2 for w in want]
    assert [got[i].n_found for i in range(len(texts))] == [w.count("found_") for w in want]


def test_secrets_and_account_groups_are_found(spark):
    """At the production settings: keys behind one phrase, and another format behind it."""
    rows = [(i, f'set api token = "{hashlib.sha1(bytes([i])).hexdigest()}" there') for i in range(12)]
    rows += [(50, 'set api token = "tok_4711" there'), (51, "see the 0123456789abcdef0123456789 there"),
             (52, "clean text without anything to find in it")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.annotate(df).collect()}
    assert all(got[i].spans == "found_secret:17:57" for i in range(12))
    assert got[50].spans == "found_secret:17:25"
    assert got[51].spans == got[52].spans == ""
