"""Registered queries on the smallest tables: oracles, brute force, contracts, the pipeline."""

import os

import duckdb
import numpy as np
import pytest
from encore.llm.oracle import ORACLE
from encore.llm.queries import QUERIES
from pyspark.sql import functions as F

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="test data not present")


@pytest.fixture(scope="module")
def tables(spark):
    return {t: spark.read.parquet(f"{ROOT}/{t}.parquet") for t in ("documents", "labels", "embeddings")}


def canon(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{ROOT}/{table}.parquet')")
    df = QUERIES[name](spark, ROOT)
    cols = sorted(df.columns)
    assert canon(df.select(*cols).collect()) == canon(
        con.sql(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})").fetchall())


def test_registered_names():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES


def test_codec_query_equals_library(spark, tables):
    import hashlib

    import sentencepiece
    from encore.llm.queries import piece_model
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    texts = {r.doc_id: r.text for r in tables["documents"].select("doc_id", "text").collect()}
    for r in QUERIES["op1_sentencepiece"](spark, ROOT).collect():
        ids = library.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_personal_data_query(spark, tables):
    from test_rules import brute_spans
    texts = {r.doc_id: r.text for r in tables["documents"].select("doc_id", "text").collect()}
    for r in QUERIES["op2_pii"](spark, ROOT).collect():
        want = [f"{k}:{a}:{b}" for k, a, b in brute_spans(texts[r.doc_id])]
        assert [s for s in r.spans.split(",") if s and not s.startswith("found_")] == want


def test_rules_query(spark, tables):
    from test_rules import base_measures
    texts = {r.doc_id: r.text for r in tables["documents"].select("doc_id", "text").collect()}
    for r in QUERIES["op3_line_rules"](spark, ROOT).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.base_failed) == base_measures(texts[r.doc_id])
        assert not (r.kept and r.base_failed)


def test_quality_query_on_held_out_rows(spark):
    out = QUERIES["op4_preference"](spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    got = out.join(truth, "doc_id").filter("held_out").select("quality", "predicted").collect()
    assert np.mean([r.quality == r.predicted for r in got]) > 0.95


def test_strings_query(spark, tables):
    from test_repeats import brute_bytes
    rows = [(r.doc_id, r.text) for r in tables["documents"].select("doc_id", "text").collect()]
    got = QUERIES["op8_prefix_free"](spark, ROOT).collect()
    assert canon(got) == canon(brute_bytes(rows, 400))


def test_neighbours_query(spark, tables):
    from test_ranking_mixing_index import exact  # noqa: F401 - same measure, other width
    rows = tables["embeddings"].select("vec_id", "embedding").collect()
    ids = np.array([r.vec_id for r in rows])
    m = np.array([r.embedding for r in rows], float)
    got = {}
    for r in QUERIES["op7_hnsw"](spark, ROOT).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        s = m @ m[i]
        want = {int(ids[j]) for j in np.lexsort((ids, -s)) if j != i}
        want = set([int(ids[j]) for j in np.lexsort((ids, -s)) if j != i][:20])
        hits += len(got[ids[i]] & want)
        total += len(want)
    assert hits / total >= 0.95


def test_near_duplicates_query(spark, tables):
    from test_minhash import brute
    rows = [(r.doc_id, r.text) for r in tables["documents"].select("doc_id", "text").collect()]
    assert canon(QUERIES["op10_minhash"](spark, ROOT).collect()) == canon(brute(rows, 3, 85))


def test_mixing_query_keeps_every_row(spark, tables):
    out = QUERIES["op9_mixing"](spark, ROOT)
    assert canon(out.select("doc_id", "source").collect()) == canon(
        tables["documents"].select("doc_id", "source").collect())
    assert out.select("position").distinct().count() == out.count()


def test_pipeline_stages(spark, tables):
    import corpus_pipeline as cp
    docs, seen = tables["documents"], []
    for name, stage in cp.STAGES:
        out = stage(spark, docs, ROOT)
        seen.append({r.doc_id for r in out.select("doc_id").collect()})
        if name != cp.STAGES[-1][0]:
            assert out.columns == tables["documents"].columns and out.dtypes == tables["documents"].dtypes
        docs = spark.createDataFrame(out.toPandas(), out.schema) if name != cp.STAGES[-1][0] else out
    assert seen[0] >= seen[1] >= seen[2] and seen[2] == seen[3] == seen[4]
    assert len(seen[2]) < len(seen[0])
    done = cp.run(spark, ROOT)
    assert {r.doc_id for r in done.collect()} == seen[-1]


def test_pipeline_takes_awkward_tables(spark, tables):
    """Nulls in every column, empty texts, repeated rows, an empty table."""
    import corpus_pipeline as cp
    schema = tables["documents"].schema
    rows = [(1, "a b c d e f g h i j " * 3, "en", "s", 60), (1, "a b c d e f g h i j " * 3, "en", "s", 60),
            (2, None, None, None, None), (None, "some text without an id here", None, "s", 3), (3, "", "en", None, 0)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in cp.STAGES:
            out = stage(spark, docs, ROOT)
            if name == "quality_classifier":
                continue                # its verdict on such texts is the ranking's affair
            docs = spark.createDataFrame(out.collect(), out.schema)
        assert docs.count() == (4 if data else 0)


def test_pipeline_order_is_the_mixture(spark, tables, tmp_path):
    """Through files that a scan reads in another order; places against a brute-force schedule."""
    import math

    import corpus_pipeline as cp
    rows = [(i, f"text number {i} of this table", "en", s, 30) for i, s in enumerate(
        ["a"] * 900 + ["b"] * 400 + ["c"] * 100 + [None] * 16)]
    docs = spark.createDataFrame(rows, tables["documents"].schema)
    path = str(tmp_path / "mixed")
    mixed = cp.mix_by_source(spark, docs, ROOT).collect()
    # five files of very different sizes, in the order of the mixture
    cuts = [0, 10, 700, 720, 1400, len(mixed)]
    for n, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        spark.createDataFrame(mixed[lo:hi], docs.schema).coalesce(1).write.parquet(f"{path}-{n}")
        part = next(f for f in os.listdir(f"{path}-{n}") if f.startswith("part-"))
        os.makedirs(path, exist_ok=True)
        with open(f"{path}-{n}/{part}", "rb") as source, open(f"{path}/part-0000{n}-x.parquet", "wb") as target:
            target.write(source.read())
    got = cp.encode(spark, spark.read.parquet(path), ROOT).orderBy("position").collect()
    assert [r.position for r in got] == list(range(len(rows)))
    assert [r.doc_id for r in got] == [r.doc_id for r in mixed]
    # earliest deadline first, slot by slot, over blocks of 16 rows with square-root weights
    size = {"a": 900, "b": 400, "c": 100, None: 16}
    total = sum(map(math.sqrt, size.values()))
    order, done, slot = [], dict.fromkeys(size, 0), 0
    while any(done[s] * 16 < n for s, n in size.items()):
        ready = [(math.ceil((done[s] + 1) * total / math.sqrt(n)), str(s or ""), s) for s, n in size.items()
                 if done[s] * 16 < n and math.floor(done[s] * total / math.sqrt(n)) <= slot]
        if ready:
            s = min(ready)[2]
            order += [s] * min(16, size[s] - 16 * done[s])
            done[s] += 1
        slot += 1
    assert [r.source for r in got] == order


def test_pipeline_result_is_in_mixture_order(spark, tables):
    """``run`` over its own files: the places of stage 4 arrive in the last result."""
    import corpus_pipeline as cp
    from encore.llm import mixing
    done = cp.run(spark, ROOT)
    got = [(r.doc_id, r.source) for r in done.orderBy("position").collect()]
    docs = tables["documents"]
    for name, stage in cp.STAGES[:3]:
        out = stage(spark, docs, ROOT)
        docs = spark.createDataFrame(out.toPandas(), out.schema)
    want = [(r.doc_id, r.source) for r in mixing.mix_sources(docs).orderBy("position").collect()]
    assert got == want
