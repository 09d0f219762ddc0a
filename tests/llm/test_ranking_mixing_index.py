import math
import random

import numpy as np
import pytest
from encore.llm import hnsw, mixing, preference
from pyspark.sql import functions as F


def quality_rows(r, n):
    vocab = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        good = r.random() > 0.25
        words = [r.choice(vocab) for _ in range(r.randrange(15, 90))]
        junk = r.choice([lambda w: w.upper() + "!!", lambda w: w + "$$$", lambda w: "buy"])
        rows.append((i, " ".join(words if good else map(junk, words)) + "."))
        labels.append((i, int(good)))
    return rows, labels


def test_ranking_separates_held_out_rows(spark):
    rows, labels = quality_rows(random.Random(1), 600)
    rows += [(1000, None), (1001, ""), (None, rows[0][1]), (0, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    known = spark.createDataFrame(labels[:300] + [(7, None), (None, 1), (2000, 0)], "doc_id long, quality int")
    ranking = preference.train(docs, known)
    out = preference.score_texts(docs, ranking)
    got = out.collect()
    want = dict(labels)
    held = [x for x in got if x.doc_id is not None and 300 <= x.doc_id < 600]
    assert np.mean([x.predicted == want[x.doc_id] for x in held]) > 0.97
    assert all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in got)
    assert len({x.score for x in got if x.text == rows[0][1]}) == 1


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    ranking = preference.train(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert [x.score for x in preference.score_texts(docs, ranking).collect()] == [0.5, 0.5]
    assert preference.score_texts(docs.limit(0), ranking).count() == 0


def test_schedule_is_fair():
    """Earliest deadline first over one whole period of the integer weights."""
    share = mixing.integer_weights({"a": 5, "b": 3, "c": 1.3, "d": 0.001})
    assert share == {"a": 5000, "b": 3000, "c": 1300, "d": 1}
    period, names = sum(share.values()), sorted(share)
    blocks = sorted((k * period // share[s], -(-(k + 1) * period // share[s]), i, k)
                    for i, s in enumerate(names) for k in range(share[s]))
    plan = list(mixing.earliest_deadline_first(blocks))
    assert [x[4] for x in plan] == list(range(period))
    assert all(release <= slot < deadline for _, _, release, deadline, slot in plan)
    got = dict.fromkeys(share, 0)
    for slot, (i, k, *_) in enumerate(plan):
        assert k == got[names[i]]
        got[names[i]] += 1
        assert all(abs(got[x] - share[x] * (slot + 1) / period) < 1 for x in share)


def test_mixture_keeps_rows_and_weights(spark):
    rows = [(i, "big" if i % 10 else None if i % 20 else "small") for i in range(3000)] + [(None, "big"), (1, "big")]
    df = spark.createDataFrame(rows, "doc_id long, source string").withColumn("slot", F.lit("clash"))
    out = mixing.mix_sources(df, {"big": 1, "small": 1, None: 2}, block_rows=4)
    got = out.orderBy("position").collect()
    assert sorted([(r.doc_id, r.source) for r in got], key=str) == sorted(rows, key=str)
    assert len({r.position for r in got}) == len(rows)
    weight = {"big": 0.25, "small": 0.25, None: 0.5}
    blocks = {}
    for r in got:
        assert r.release <= r.slot < r.deadline
        assert r.release == math.floor(r.block / weight[r.source])
        blocks.setdefault(r.source, set()).add(r.block)
        live = min(150 // 4 / weight[s] for s in weight)
        if r.slot < live - 1:
            for s, w in weight.items():
                assert abs(len([b for b in blocks.get(s, ()) if b is not None]) - w * (r.slot + 1)) < 1 + 1
    assert all(b == set(range(len(b))) for b in blocks.values())


def test_mixture_errors_and_empty(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, source string")
    with pytest.raises(ValueError):
        mixing.mix_sources(df, {"b": 1})
    assert mixing.mix_sources(df.limit(0)).count() == 0
    assert mixing.mix_sources(df).count() == 1


def lags(rows, weight):
    """Largest deviation of any source from ``weight * slots`` over a mixture of one-row blocks."""
    at = {}
    for r in rows:
        at.setdefault(r.source, []).append(r.slot)
    last = min(max(slots) for slots in at.values())      # no source has run out before
    worst = 0.0
    for s, slots in at.items():
        for got, slot in enumerate(sorted(slots)):
            if slot <= last:
                worst = max(worst, abs(got - weight[s] * slot), abs(got + 1 - weight[s] * (slot + 1)))
    return worst


def test_mixture_holds_irrational_weights_of_many_sources(spark):
    # one source at 30 %, 899 small ones: the shares of a 1000-slot period gave it 10 %
    weight = {"big": math.pi, **{f"s{i}": math.pi * 7 / 3 / 899 for i in range(899)}}
    rows = [(i, "big") for i in range(1200)] + [(10_000 + i, f"s{i % 899}") for i in range(3 * 899)]
    out = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, source string"), weight, block_rows=1)
    got = out.orderBy("position").collect()
    total = sum(weight.values())
    assert all(r.release <= r.slot < r.deadline for r in got) and len({r.slot for r in got}) == len(rows)
    assert lags(got, {s: w / total for s, w in weight.items()}) < 1 + 1e-6
    assert abs(sum(r.source == "big" for r in got[:3000]) - 900) <= 1
    # many slots of few sources: the rounding to thousandths grew with the slots
    weight = {"a": 2 ** 0.5, "b": 1.0, "c": 0.0005}
    rows = [(i, "a") for i in range(15_000)] + [(20_000 + i, "b") for i in range(10_000)] + [
        (40_000 + i, "c") for i in range(6)]
    out = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, source string"), weight, block_rows=1)
    total = sum(weight.values())
    assert lags(out.collect(), {s: w / total for s, w in weight.items()}) < 1 + 1e-6


def test_mixture_takes_any_number_of_sources(spark):
    n = 12_000
    rows = [(i, f"s{i % n}") for i in range(3 * n)] + [(100_000 + i, "big") for i in range(2000)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, source string"), block_rows=1).collect()
    assert sorted((r.doc_id, r.source) for r in got) == sorted(rows)
    assert all(r.release <= r.slot < r.deadline for r in got) and len({r.position for r in got}) == len(rows)
    root = {**{f"s{i}": 3 ** 0.5 for i in range(n)}, "big": 2000 ** 0.5}
    assert lags(got, {s: w / sum(root.values()) for s, w in root.items()}) < 1 + 1e-6


def exact(vectors, k):
    ok = {i: np.array(v, float) for i, v in vectors if v is not None and i is not None and len(v) == 8
          and None not in v and np.isfinite(v).all() and np.any(v)}
    ids = np.array(sorted(ok))
    m = np.array([ok[i] for i in ids])
    out = {}
    for q in ids:
        if q % 20 == 0:
            s = m @ ok[q]
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
            out[q] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(20, 8))
    vectors = [(i, [float(x) for x in np.float32(centre[i % 20] + 0.4 * rng.normal(size=8))]) for i in range(2000)]
    vectors += [(2000 + i, vectors[40][1]) for i in range(60)]
    vectors += [(3000, None), (3020, [0.0] * 8), (3040, [math.nan] + [1.0] * 7), (3060, [None] + [1.0] * 7), (3080, []),
                (3100, [1.0] * 5), (3120, [math.inf] + [1.0] * 7), (None, vectors[0][1])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("rank", F.lit("clash"))
    out = hnsw.nearest(df, df.filter("vec_id % 20 = 0"), k=20, shard_rows=500)
    want = exact(vectors, 20)
    got = {}
    for r in out.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.95
    truth = {i: np.array(v, float) for i, v in vectors if v is not None and len(v) == 8 and None not in v}
    for q, found in got.items():
        assert len(found) == 20 and q not in {i for i, _ in found}
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
        assert all(abs(s - truth[i] @ truth[q]) < 1e-9 for i, s in found)
    assert [i for i, _ in got[40]][:20] == [2000 + i for i in range(20)] or got[40] == want[40]


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.5, 0.0])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in hnsw.nearest(df, df.filter("vec_id = 0"), k=20).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 0.5)]
    assert hnsw.nearest(df.limit(0), df.limit(0)).count() == 0
    one = df.filter("vec_id = 0")
    assert hnsw.nearest(one, one).count() == 0
