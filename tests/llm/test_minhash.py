import random
import re

from encore.llm import minhash
from encore.llm.components import components
from pyspark.sql import functions as F


def brute(rows, size, percent):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = min((x for x in groups[root(i)] if x is not None), default=None)
        out.append((d, len(sets[i]), c, d is None or d == c))
    return sorted(out, key=str)


def family(r, n, words, edits):
    base = [f"w{r.randrange(500)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randrange(edits + 1)):
            w[r.randrange(words)] = f"w{r.randrange(500)}"
        out.append(" ".join(w))
    return out


def test_components_equal_brute_force(spark):
    r = random.Random(5)
    texts = (family(r, 40, 120, 6) + family(r, 30, 60, 4) + family(r, 25, 200, 9) + family(r, 10, 20, 1)
             + [None, "", " \n", "one", "ONE", "one two", "a b c", "A b  c", "É b c", "é b c"])
    r.shuffle(texts)
    rows = list(enumerate(texts)) + [(None, texts[0]), (7, texts[7]), (None, "alone here without any id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit("x"))
    for size, percent in ((3, 85), (5, 80)):
        got = minhash.near_duplicates(df, size=size, percent=percent)
        assert sorted(map(tuple, got.collect()), key=str) == brute(rows, size, percent)
    left = minhash.drop_near_duplicates(df, size=5, percent=80)
    want = {d for d, _, _, kept in brute(rows, 5, 80) if kept and d is not None}
    got = [x.doc_id for x in left.collect()]
    assert set(got) - {None} == want and len([d for d in got if d is not None]) == len(want)
    assert got.count(None) == 2 and left.columns == df.columns


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(df).count() == 0


def test_estimate_follows_similarity(spark):
    r = random.Random(2)
    base = [f"v{i}" for i in range(400)]
    rows = [(i, " ".join(w if r.random() > i / 50 else f"z{r.random()}" for w in base)) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sigs = minhash.signatures(df, "doc_id", "text", 3)
    pair = (sigs.filter("id = 0").select(F.col("bits").alias("x"))
                .crossJoin(sigs.select("id", F.col("bits").alias("y")))
                .select("id", minhash.estimate("x", "y").alias("e")).collect())
    sets = {i: {tuple(t.split()[k:k + 3]) for k in range(398)} for i, t in rows}
    for row in pair:
        true = len(sets[0] & sets[row.id]) / len(sets[0] | sets[row.id])
        assert abs(row.e - true) < 0.25


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
