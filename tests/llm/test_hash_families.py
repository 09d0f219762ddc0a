"""Texts on which polynomials modulo a power of two collide for every base."""


import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece as spm
from encore.llm import common, minhash, prefix_free, sentencepiece, substring

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def thue_morse(length, one="a", other="b"):
    return "".join((one, other)[bin(i).count("1") % 2] for i in range(length))


def pair(length):
    return thue_morse(length), thue_morse(length, "b", "a")


def test_the_texts_collide_in_the_old_family():
    for text in pair(1024):
        assert len(text) == 1024
    data = [np.frombuffer(t.encode(), np.uint8) for t in pair(2048)]
    ends = [np.array([0]), np.array([2048])]
    old = [common.Rolling(common.BYTE_VALUE[d], common.BASE_A).slices(*ends)[0] for d in data]
    assert old[0] == old[1]
    new = [common.PrimeRolling(d).slices(*ends)[0] for d in data]
    assert new[0] != new[1]
    for salt in (5, 6):
        spans = [common.span_hashes(d, ends[0], ends[1], salt)[0][0] for d in data]
        assert spans[0] != spans[1]


def test_prime_rolling_equals_its_definition():
    rnd, prime = np.random.default_rng(1), (1 << 61) - 1
    for values, plain in ((rnd.integers(0, 256, 40_000).astype(np.uint8), lambda x: int(x) + 1),
                          (rnd.integers(0, 1 << 63, 40_000).astype(np.uint64), lambda x: int(x) >> 3)):
        rolled = common.PrimeRolling(values)
        for start, end in ((0, 0), (0, 1), (16_380, 16_390), (5, 700), (0, 40_000), (39_990, 40_000)):
            want = 0
            for x in reversed(values[start:end]):
                want = (want * common.PrimeRolling._BASE + plain(x)) % prime
            assert int(rolled.slices(np.array([start]), np.array([end]))[0]) == want


@pytest.mark.parametrize("length", [1024, 2048, 4096])
def test_sentencepiece_tells_them_apart(spark, length):
    library = spm.SentencePieceProcessor(model_file=MODEL)
    texts = [*pair(length), *pair(length)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = sentencepiece.encode_texts(rows, MODEL, keep=["doc_id"], outputs=("ids",)).collect()
    assert [r.ids for r in sorted(got)] == [library.encode(t) for t in texts]


def test_sentencepiece_survives_equal_hashes(monkeypatch):
    """All parts share one hash: the run is encoded text by text."""
    monkeypatch.setattr(sentencepiece, "span_hashes", lambda data, start, end, salt: [np.zeros(len(start), np.uint64)])
    library = spm.SentencePieceProcessor(model_file=MODEL)
    with open(MODEL, "rb") as f:
        model = sentencepiece.MergeModel(f.read())
    texts = ["a few words", None, "", "other words\n here", "a"]
    table = sentencepiece._Parts()
    for column in (pa.array(texts), pa.array(["words"]), pa.array(["a"]), pa.array(texts)):
        made = [(ids, offsets) for ids, offsets in sentencepiece.encode_column(column, model, table)]
        got = [ids[a:b].tolist() for ids, offsets in made for a, b in zip(offsets, offsets[1:])]
        assert got == [library.encode(t or "") for t in column.to_pylist()]


@pytest.mark.parametrize("length", [1024, 4096])
def test_substring_dedup_keeps_both(spark, length):
    """Long words that differ, and long runs of short words that differ."""
    one, other = pair(length)
    rows = [(1, " ".join([one] * 35)), (2, " ".join([other] * 35))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring.remove_repeats(df, width=35, cells=1 << 12).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (2, 0)]
    rows = [(1, " ".join(one)), (2, " ".join(other))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring.remove_repeats(df, width=length, gram=length, cells=1 << 12).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (2, 0)]


@pytest.mark.parametrize("length", [1024, 4096])
def test_prefix_free_keeps_both(spark, length):
    rows = list(enumerate(pair(length)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = prefix_free.remove_repeated_strings(df, width=length, cells=1 << 12,
                                              phrases=prefix_free.Phrases(length, head=length // 2)).collect()
    assert [r.n_removed for r in got] == [0, 0]


@pytest.mark.parametrize("length", [1024, 2048])
def test_minhash_does_not_link_them(spark, length):
    one, other = pair(length)
    rows = [(1, one), (2, other), (3, f"{one} x y z"), (4, f"{other} x y z"), (5, one)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, size=3, percent=85).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}
