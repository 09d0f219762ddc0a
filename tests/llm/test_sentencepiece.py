import hashlib

import pytest
from encore.llm import sentencepiece as sp
from encore.llm.queries import piece_model

TEXTS = [None, "", " ", "  a", "a  b", " a ", "a\n\nb", "\0x", "a▁b", "a ▁ b", "▁", "﻿x",
         "é日本", "<s></s><unk><0x41>", "a\tb", "\U0001d4b3", "\r\n", "x" * 50, " \n", "\n", "\n a",
         "a \n", "aaaa" * 5000, "the quick brown fox " * 3000, "the the the", "the the the"]


@pytest.fixture(scope="module")
def model():
    with open(piece_model(), "rb") as f:
        return sp.MergeModel(f.read())


def test_agenda_equals_library(model):
    for t in TEXTS:
        assert model.encode(t or "") == model.library.encode(t or "")


def test_encode_and_decode_columns(spark, docs, model):
    df = docs([(i, t, "n_tokens") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string")
    out = sp.encode_texts(df, piece_model(), outputs=("ids", "n_tokens", "ids_sha256", "decoded", "decoded_sha256"))
    assert out.columns == ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded", "decoded_sha256"]
    for r in out.collect():
        ids = model.library.encode(TEXTS[r.doc_id] or "")
        back = model.library.decode(ids)
        assert (r.ids, r.n_tokens, r.decoded) == (ids, len(ids), back)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
    again = sp.decode_ids(out.select("doc_id", "ids"), piece_model())
    assert {r.doc_id: r.decoded for r in again.collect()} == {r.doc_id: r.decoded for r in out.collect()}


def test_full_table_of_parts_keeps_results(model, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(sp, "TABLE_PARTS", 5)
    parts = sp._Parts()
    for words in (["one two three four five six"] * 2, ["seven eight one two"], ["nine ten eleven six seven"]):
        for ids, offsets in sp.encode_column(pa.array(words), model, parts):
            for i, w in enumerate(words):
                assert ids[offsets[i]:offsets[i + 1]].tolist() == model.library.encode(w)


def test_difference_from_library_fails(model):
    with pytest.raises(ValueError):
        model.compare({"▁the": (5,)})


def test_empty_table(spark, docs):
    assert sp.encode_texts(docs([]), piece_model()).count() == 0
