import hashlib
import random
import re
from collections import Counter, defaultdict

from encore.llm import line_rules, pii, site_lines
from pyspark.sql import functions as F

WORD = r"[^ \t-\r]+"


def base_measures(t):
    t = t or ""
    w = re.findall(WORD, t)
    lines = [x for x in t.split("\n") if re.search(WORD, x)]
    n = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = set()
    for i in range(len(w) - 7):
        if n[tuple(w[i:i + 8])] > 1:
            hit.update(range(i, i + 8))
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit),
            len(w) < 20 or 100 * len(hit) > 30 * len(w))


def text_rows(r, n):
    vocab = ["alpha", "beta", "gam#ma", "d|", "été", "x"]
    rows = []
    for i in range(n):
        words = [r.choice(vocab) + r.choice([" ", "  ", "\n", "\t", " \x0b"]) for _ in range(r.randrange(80))]
        rows.append((i, "".join(words) + "".join(words[:r.randrange(30)]), r.choice(["a", "b", None])))
    return rows + [(900, None, "a"), (901, "", None), (902, " \n \n", "b"), (None, "one two", "a"),
                   (903, rows[3][1], rows[3][2]), (3, rows[3][1], rows[3][2]), (904, "spam " * 3000, "a"),
                   (905, "\U0001d4b3 " * 9, "a")]


def test_base_rules_equal_brute_force(spark, docs):
    rows = text_rows(random.Random(4), 60)
    df = docs(rows).withColumn("n_words", F.lit("clash"))
    got = line_rules.apply_rules(df, max_share=1.0)
    assert got.columns == ["doc_id", "text", "source", *line_rules.RESULTS]
    want = sorted([(d, *base_measures(t)) for d, t, _ in rows], key=str)
    assert sorted([tuple(r) for r in got.select("doc_id", *line_rules.RESULTS[:6]).collect()], key=str) == want


def test_frequent_lines_and_depletion(spark, docs):
    body = " ".join(f"word{i}" for i in range(30))
    rows = [(i, f"Read MORE  item {i}\n{body.replace('word', f'w{chr(97 + i % 26)}')} {i}x", "h") for i in range(12)]
    rows += [(50, "read more item 7", "h"), (51, "\n".join(["read more item 1"] * 6), "h"),
             (52, "read more item 1", "other"), (53, None, "h")]
    got = {r.doc_id: r for r in line_rules.apply_rules(docs(rows), min_words=1, max_repeat_percent=100, min_docs=3,
                                                       max_share=0.2).collect()}
    assert got[0].kept and got[0].n_lines_removed == 1 and "MORE" not in got[0].text and "wa0" in got[0].text
    assert not got[50].kept and got[50].text == ""
    assert not got[51].kept and got[51].n_lines_removed == 6
    assert got[52].kept and got[52].text == "read more item 1"
    assert got[53].base_failed and not got[53].kept
    # copies are one document: they do not make their own lines frequent
    copies = docs([(i, f"{body}\nsecond {body}", "h") for i in range(30)])
    assert line_rules.apply_rules(copies, max_repeat_percent=100, min_docs=3, max_share=0.2).filter("kept").count() == 30


def test_site_lines_equal_brute_force(spark, docs):
    r = random.Random(8)
    lines = [f"line {i}" for i in range(12)] + ["", "  "]
    rows = [(i, "\n".join(r.choice([" ", ""]) + r.choice(lines) + r.choice(["\r", " ", ""])
                          for _ in range(r.randrange(5))), r.choice(["a", "a", "b", None])) for i in range(80)]
    rows += [(900, None, "a"), (901, "", "b"), (5, rows[5][1], rows[5][2])]
    trim = lambda x: x.strip(" \t\r")
    pages, seen = Counter(s for _, _, s in rows), defaultdict(int)
    for _, t, s in rows:
        for x in {trim(y) for y in (t or "").split("\n")} - {""}:
            seen[s, x] += 1
    want = []
    for d, t, s in rows:
        parts = (t or "").split("\n")
        kept = [x for x in parts if not trim(x) or not (seen[s, trim(x)] >= 5 and seen[s, trim(x)] > 0.2 * pages[s])]
        want.append((d, "\n".join(kept), s, sum(bool(trim(x)) for x in parts), len(parts) - len(kept)))
    got = site_lines.drop_boilerplate(docs(rows).withColumn("n_lines", F.lit(1)), ratio=0.2)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert site_lines.drop_boilerplate(docs([])).count() == 0


def test_site_lines_of_distinct_pages(spark, docs):
    body = "first own line\nsecond own line"
    rows = [(i, body, "s") for i in range(12)] + [(3, body, "s")] + [      # a group of copies, one a repeated row
        (100 + i, f"menu\nline {i}", "s") for i in range(20)] + [(200, None, "s"), (201, "", "s"), (202, "menu", None)]
    got = {r.doc_id: r.text for r in site_lines.drop_boilerplate(docs(rows), distinct=True).collect()}
    assert len(got) == 35 and all(got[i] == body for i in range(12))
    assert all(got[100 + i] == f"line {i}" for i in range(20)) and got[202] == "menu"
    # the ratio is of distinct pages: 20 copies and 20 others are 21 pages, "menu" is on 4 of them
    rows = [(i, body, "s") for i in range(20)] + [(100 + i, f"{'menu' if i < 4 else 'x%d' % i}\nline {i}", "s")
                                                  for i in range(20)]
    for ratio, kept in ((0.18, False), (0.2, True)):
        out = site_lines.drop_boilerplate(docs(rows), ratio=ratio, min_pages=3, distinct=True).collect()
        assert all(r.text.startswith("menu") == kept for r in out if 100 <= r.doc_id < 104)


def test_one_of_a_group_of_copies_keeps_its_text(spark, docs):
    import corpus_pipeline as cp
    body = "\n".join(" ".join(f"word{j}x{k}" for k in range(12)) for j in range(4))
    rows = [(i, body, "en", "s", len(body)) for i in range(40)] + [
        (100 + i, " ".join(f"other{i}y{k}" for k in range(30)), "en", "s", 5) for i in range(60)]
    out = docs(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in cp.STAGES[1:3]:
        out = stage(spark, spark.createDataFrame(out.collect(), out.schema), "")
    left = [r.text for r in out.collect()]
    assert left.count(body) == 1 and "" not in left and len(left) == 61


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, d[::-1]))) % 10 == 0


def brute_spans(t):
    t = t or ""
    digits = lambda x: re.sub("[^0-9]", "", x)
    kinds = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda x: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda x: all(int(p) <= 255 for p in x.split(".")) if len(x) < 4000 else False),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda x: 13 <= len(digits(x)) <= 19 and luhn(digits(x))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda x: 9 <= len(digits(x)) <= 15))
    return [(k, m.start(), m.end()) for k, p, ok in kinds for m in re.finditer(p, t) if ok(m[0])]


PII = ["a@b.c a@b.c_d@e.f x@y", "mail joe.doe+x@mail-1.example.com.", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.255",
       "4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (555) 555-0100, +12 3", "é\U0001d4b3 +49 30 123456 1.1.1.1",
       "79927398713000 0000000000000000", "1" * 500, "a." * 300 + "@b.cc", "a@" + "b." * 4000 + "c", "9" * 5000 + ".1.1.1",
       "+" * 50 + "1 2 3 4 5 6 7 8 9", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5", "a@b..c", "1..2.3.4", "-@-.-", None, "", " "]


def test_base_spans_equal_brute_force(spark, docs):
    r = random.Random(6)
    rows = list(enumerate(PII + ["".join(r.choice("1234 .-+()@ab") for _ in range(60)) for _ in range(300)]))
    rows += [(None, PII[0]), (1, PII[1]), (1, PII[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("clash"))
    got = pii.annotate(df)
    want = []
    for d, t in rows:
        spans = brute_spans(t)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        count = Counter(k for k, _, _ in spans)
        want.append((d, *[count[k] for k in pii.KINDS], hashlib.sha256(joined.encode()).hexdigest()))
    cols = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]
    assert sorted([tuple(x) for x in got.select(*cols).collect()], key=str) == sorted(want, key=str)
    assert pii.annotate(df.limit(0)).count() == 0


def test_bootstrap_finds_identifiers_by_context(spark, docs):
    rows = [(i, f"some text call me {'+1 (555) 555-01%02d' % i} now") for i in range(6)]
    rows += [(20, "some text call me x77abc12 now"), (21, "price was x77abc99 now"), (22, "Call me  77abc55"),
             (23, "room number b12345 here")]
    rows += [(30 + i, f"see the item z9{i}9999 or see the +1 (555) 555-02{i}0") for i in range(4)]
    got = {r.doc_id: r.spans for r in pii.annotate(spark.createDataFrame(rows, "doc_id long, text string"),
                                                   confidence=0.7).collect()}
    assert got[20] == "found_phone:18:26"
    assert got[21] == "" and got[23] == "" and got[0].startswith("phone:18:")
    assert got[22] == ""            # the gap differs: another context
    copies = spark.createDataFrame([(i, "some text call me +1 (555) 555-0100 ok") for i in range(9)]
                                   + [(20, "some text call me x77abc12 now")], "doc_id long, text string")
    assert {r.spans for r in pii.annotate(copies).collect() if r.doc_id == 20} == {""}


def test_bootstrap_looks_past_earlier_matches_and_separators(spark):
    """At the production settings: digits in the context, identifiers with inner separators."""
    rows = [(i, f"room 7 please call 24 hotline +1 (555) 555-01{i:02d} now") for i in range(30)]
    rows += [(100, "call 24 hotline 5551234 now"), (101, "please call 24 hotline 555-123-4567."),
             (102, "call 99 hotline EMP-483920/b"), (103, "call hotline 24 5551234"), (104, "a-" * 5000 + " x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.annotate(df).collect()}
    assert got[100] == "found_phone:16:23" and got[101] == "found_phone:23:35"
    assert got[102] == "found_phone:16:28"
    assert got[103] == got[104] == ""
