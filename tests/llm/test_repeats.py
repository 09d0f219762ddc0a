import hashlib
import random
import re
from collections import Counter

import pytest
from encore.llm import prefix_free, repeats, substring
from pyspark.sql import functions as F


def brute_words(rows, width):
    texts = [re.findall(r"[^ \t-\r]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + width]) for w in texts for i in range(len(w) - width + 1))
    out = []
    for (d, _), w in zip(rows, texts):
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                gone[i:i + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def brute_bytes(rows, width):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(w[i:i + width] for w in texts for i in range(len(w) - width + 1))
    out = []
    for (d, _), w in zip(rows, texts):
        gone, until = bytearray(len(w)), 0
        for i in range(len(w)):
            if i + width <= len(w) and seen[w[i:i + width]] > 1:
                until = i + width
            gone[i] = i < until
        kept = bytes(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), len(re.findall(b"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


EDGES = [(90, None), (91, ""), (92, " \n"), (None, "a b"), (95, "a " * 150), (96, "a" * 300)]


def word_rows(r):
    base = [[r.choice("a b c dd e".split()) for _ in range(60)] for _ in range(4)]
    rows = []
    for i in range(40):
        words = r.choice(base)[r.randrange(30):][:r.randrange(60)] + [r.choice("xyzab") for _ in range(r.randrange(12))]
        rows.append((i, "".join(w + r.choice([" ", "\n", "  "]) for w in words)))
    return rows + EDGES + [(5, rows[5][1]), (None, rows[3][1])]


def byte_rows(r):
    base = ["".join(r.choice("ab é") for _ in range(300)) for _ in range(4)]
    rows = []
    for i in range(40):
        rows.append((i, r.choice(base)[r.randrange(100):][:r.randrange(260)]
                     + "".join(r.choice("xyzab") for _ in range(r.randrange(42))) + r.choice(base)[:r.randrange(90)]))
    return rows + EDGES + [(5, rows[5][1]), (None, rows[3][1])]


@pytest.mark.parametrize("cells", [1 << 20, 64])        # a roomy sketch, and one that is full
def test_repeated_windows_equal_brute_force(spark, cells):
    rows = word_rows(random.Random(cells))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", F.lit("x"))
    got = substring.remove_repeats(df, width=8, gram=5, cells=cells, keep=["doc_id"], digest=True)
    assert sorted(map(tuple, got.collect()), key=str) == brute_words(rows, 8)


def test_repeated_strings_equal_brute_force(spark):
    rows = byte_rows(random.Random(3))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for phrases in (prefix_free.Phrases(40, 4, 8, 12, (4, 12)), prefix_free.Phrases(40, 8, 1000, 10, (5,))):
        got = prefix_free.remove_repeated_strings(df, width=40, cells=1 << 20, digest=True, phrases=phrases)
        assert sorted(map(tuple, got.collect()), key=str) == brute_bytes(rows, 40)


def test_texts_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c d x"), (2, "a b c d y"), (3, None)], "doc_id long, text string")
    got = substring.remove_repeats(df, width=4, gram=2, cells=1 << 10)
    assert sorted(map(tuple, got.collect())) == [(1, 5, 4, "x"), (2, 5, 4, "y"), (3, 0, 0, "")]
    got = prefix_free.remove_repeated_strings(df, width=7, cells=1 << 10, phrases=prefix_free.Phrases(7, 2, 2, 3, ()))
    assert sorted((a, b, c, d, bytes(e)) for a, b, c, d, e in got.collect()) == [
        (1, 9, 8, 1, b"x"), (2, 9, 8, 1, b"y"), (3, 0, 0, 0, b"")]
    assert substring.remove_repeats(df.limit(0), cells=1 << 10).count() == 0
    assert prefix_free.remove_repeated_strings(df.limit(0), cells=1 << 10).count() == 0


def test_sketch_never_undercounts(spark):
    rows = word_rows(random.Random(9))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    cutter = substring.WordWindows(8, 5)
    merged = repeats.sketch(df, "text", cutter, 2, 128)
    total = sum(r.n for r in merged.collect())
    from encore.llm.common import text_chunks
    import pyarrow as pa
    blocks = 0
    for _, _, data, offsets in text_chunks(pa.array([t for _, t in rows])):
        blocks += len(cutter.cut(data, offsets).at)
    assert total == 2 * blocks


def test_texts_are_cut_into_blocks_twice(spark, monkeypatch):
    """Once to find contents (one shuffle for both uses) and once to list their blocks; free blocks ride along."""
    from encore.llm.common import row_key
    plans, write = [], repeats.materialize

    def seen(df, name):
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0])
        return write(df, name)

    monkeypatch.setattr(repeats, "materialize", seen)
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("abcdefgh ") for _ in range(3000)) for _ in range(3)]
    df = spark.createDataFrame([(i, texts[i // 2] + "q" * 900 + str(i % 2)) for i in range(6)], "id long, text string")
    docs = df.select("text", *row_key(df, "id", "text"))
    runs = repeats.repeated_windows(docs, "text", prefix_free.Phrases(400), 1, 1 << 20)
    assert plans[0].count("MapInArrow") == 2 and "ReusedExchange" in plans[0]
    assert "free#" not in runs._jdf.queryExecution().optimizedPlan().toString()
    assert runs.count() == 6
