"""Edge cases that all operators over documents share: maps, long texts, empty tables."""

import random

import numpy as np
from encore.llm import (common, line_rules, minhash, mixing, pii, preference, prefix_free, site_lines, substring)
from pyspark.sql import functions as F

LONG = "word " * 300_000


def _docs(spark, rows):
    """Documents with a map, and columns named like those the operators use themselves."""
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.withColumns({"m": F.create_map(F.lit("a"), "doc_id"), "r1": F.lit("clash"), "host": F.lit(1),
                           "spans": F.lit(2), "_t": F.lit(3)})


def test_map_columns_pass_through(spark):
    rows = [(i, f"line one of {i % 7}\nshared line here\n+1 (555) 555-01{i:02d} and more words", "s") for i in range(30)]
    df = _docs(spark, rows)
    for out in (pii.annotate(df), line_rules.apply_rules(df), site_lines.drop_boilerplate(df),
                mixing.mix_sources(df), substring.remove_repeats(df, width=5, gram=3, cells=1 << 10),
                prefix_free.remove_repeated_strings(df, width=40, cells=1 << 10, phrases=prefix_free.Phrases(40, 8, 8, 12))):
        got = out.select("doc_id", "m", "r1").collect()
        assert sorted((r.doc_id, r.m["a"], r.r1) for r in got) == [(i, i, "clash") for i in range(30)]
    kept = minhash.drop_near_duplicates(df, size=5, percent=80)
    assert kept.columns == df.columns and 0 < kept.count() <= 30


def test_very_long_texts(spark):
    rows = [(1, LONG, "a"), (2, LONG + "end", "a"), (3, "x" * 1_000_000, "b"), (4, "short text", "b"), (5, "\n" * 100_000, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    gone = {r.doc_id: r.n_removed for r in substring.remove_repeats(df, cells=1 << 12, digest=True).collect()}
    assert gone == {1: 300_000, 2: 300_000, 3: 0, 4: 0, 5: 0}
    gone = {r.doc_id: r.n_removed for r in prefix_free.remove_repeated_strings(df, cells=1 << 12, digest=True).collect()}
    assert gone == {1: 1_500_000, 2: 1_500_000, 3: 1_000_000, 4: 0, 5: 100_000}
    near = {r.doc_id: r.component_id for r in minhash.near_duplicates(df).collect()}
    assert near == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5}
    lines = {r.doc_id: (r.n_lines, r.n_dropped) for r in site_lines.drop_boilerplate(df).collect()}
    assert lines == {1: (1, 0), 2: (1, 0), 3: (1, 0), 4: (1, 0), 5: (0, 0)}
    rules = {r.doc_id: (r.n_words, r.kept) for r in line_rules.apply_rules(df).collect()}
    assert rules == {1: (300_000, False), 2: (300_001, False), 3: (1, False), 4: (2, False), 5: (0, False)}
    ranking = preference.train(df, spark.createDataFrame([(1, 0), (4, 1)], "doc_id long, quality int"))
    scores = {r.doc_id: r.score for r in preference.score_texts(df, ranking).collect()}
    assert len(scores) == 5 and all(0 <= s <= 1 for s in scores.values()) and scores[4] > scores[1]


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string").limit(0)
    for out in (pii.annotate(df), line_rules.apply_rules(df), site_lines.drop_boilerplate(df), mixing.mix_sources(df),
                substring.remove_repeats(df, cells=1 << 10), prefix_free.remove_repeated_strings(df, cells=1 << 10),
                minhash.near_duplicates(df), minhash.drop_near_duplicates(df)):
        assert out.count() == 0


def test_training_does_not_depend_on_the_order_of_repeated_ids(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice("ab!c$") * rnd.randrange(1, 5) for _ in range(20))) for i in range(80)] * 1
    rows += [(i, t.upper()) for i, t in rows[:40]]
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    fits = []
    for seed in range(2):
        rnd.shuffle(rows)
        fits.append(preference.train(spark.createDataFrame(rows, "doc_id long, text string").repartition(3 + seed), labels))
    assert np.allclose(fits[0].weights, fits[1].weights) and np.isclose(fits[0].bias, fits[1].bias)


def test_a_bitmap_of_ids_lets_every_wanted_row_through(spark):
    wanted = spark.range(0, 5000, 7).select((F.col("id") * 1_000_003 - 9).alias("x"))
    rows = spark.range(5000).select((F.col("id") * 1_000_003 - 9).alias("y"))
    for bits, most in ((1 << 20, 760), (64, 5000)):
        got = rows.filter(common.among(wanted, F.col("y"), bits))
        assert wanted.join(got, F.col("x") == F.col("y"), "left_anti").count() == 0 and got.count() <= most
    assert rows.filter(common.among(wanted.limit(0), F.col("y"))).count() == 0
