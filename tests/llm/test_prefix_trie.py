"""The prefix trie against one built from dictionaries."""

import hashlib
import random
import zlib

import pytest

from encore.llm import prefix_trie
from encore.llm.queries import op13_prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        head = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(head, [])[:h]) + tuple(own[c][h:])
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    children, total, leaves = {}, {}, {}
    for key in sorted(nodes, key=len, reverse=True):
        size = len(key[-1][1].encode()) if key else 0
        total[key] = total.get(key, 0) + (len(nodes[key]) - 1) * size
        leaves[key] = leaves.get(key, 0) or 1
        if key:
            up = key[:-1]
            children[up] = children.get(up, 0) + 1
            total[up] = total.get(up, 0) + total[key]
            leaves[up] = leaves.get(up, 0) + leaves[key]
    out = []
    for key, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if len(built[c]) == len(key)))
        out.append((min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members),
                    children.get(key, 0), leaves[key], total[key], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def _table(spark, rows):
    # extra columns with names that the operator uses itself
    return spark.createDataFrame([(*r, 1, "x") for r in rows],
                                 "conv_id long, turn long, role string, text string, depth int, parent string")


def _got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def _trie(spark, table):
    ids = table.selectExpr("conv_id as c").filter("c is not null").distinct()
    return prefix_trie.prefix_trie(*prefix_trie.rebuilt_turns(prefix_trie.numbered_turns(table), ids))


def _rows(seed, low=-12, high=40):
    rnd = random.Random(seed)
    rows = []
    for c in range(low, high):
        for t in range(rnd.choice([0, 1, 2, 5, 9, 12])):
            rows.append((c, rnd.choice([t, t, t, 3, None]), rnd.choice(["user", "assistant", None]),
                         rnd.choice(["a", "é", "", None, "bb", "a"])))
    rows += [(None, 1, "user", "lost")] * 2 + rows[:7] + [(100_000_007, 0, "user", "alone")]
    return rows


@pytest.mark.parametrize("seed,run,slice_,piece,jumped", [(1, 4096, 1 << 16, 8192, 200_000), (2, 3, 16, 2, 300),
                                                          (3, 1, 7, 1, 200_000)])
def test_equals_dictionary_trie(spark, monkeypatch, seed, run, slice_, piece, jumped):
    """Also with runs, slices and pieces far below their usual size, over many partitions, and
    with a list that is contracted before it is ranked."""
    for name, value in (("RUN", run), ("SLICE", slice_), ("PIECE", piece), ("JUMPED", jumped)):
        monkeypatch.setattr(prefix_trie, name, value)
    rows = _rows(seed)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert _got(_trie(spark, _table(spark, rows))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_copies_one_long_conversation_and_long_texts(spark):
    rows = [(5 * c, t, "user", f"same {t}") for c in range(60) for t in range(3)]
    rows += [(7, t, "user", f"long {t % 11}") for t in range(400)] + [(8, 0, "user", "w " * 200_000)] * 2
    assert _got(_trie(spark, _table(spark, rows))) == brute(rows)


def test_empty_table_and_only_turnless(spark):
    rows = _rows(1)
    assert _trie(spark, _table(spark, rows).limit(0)).count() == 0
    alone = [(c, 0, "user", "x") for c in (1, 2, 3) if zlib.crc32(str(c).encode()) % 9 > 0]
    assert _got(_trie(spark, _table(spark, alone))) == brute(alone)


def test_query_covers_every_conversation(spark):
    root = "/root/testdata/sf0.001"
    talks = spark.read.parquet(f"{root}/conversations.parquet")
    rows = [tuple(r) for r in talks.select("conv_id", "turn", "role", "text").collect()]
    assert _got(op13_prefix_trie(spark, root)) == brute(rows)
