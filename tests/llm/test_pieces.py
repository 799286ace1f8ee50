"""Distinct-chunk encoding against the library itself, text by text."""

import hashlib

import public_tokenizers
import pytest
import sentencepiece

from geoscribe.llm import pieces

PATH = public_tokenizers.path(pieces.MODEL)
AWKWARD = [None, "", " ", "  ", "   ", " a", "a ", "a  ", "a  b", "▁", "▁▁x", " ▁ y", "a▁b ▁", "\0a b\0", "\t\n\r\n", "x\n y",
           "😀 日本語テキスト  é é ﻿ x�", "<s> </s> <unk> <0x41> ▁<s>", "　 x", "a" * 20_000, " " * 3_000,
           "y" + " " * 40 + "z", " ".join(f"word{i}" for i in range(40_000)), "日本" * 9_000, "Ａ ﬁ ½ ﷺ", "same same same"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def expected(library, text):
    ids = library.encode(text or "", add_eos=True)
    return ids, library.decode(ids)


def test_awkward_texts(spark, library):
    rows = [(None if i == 3 else i // 2, t, "x", [1]) for i, t in enumerate(AWKWARD * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, id string, ids array<int>").coalesce(1)
    got = pieces.encode_texts(df, PATH).collect()
    assert [r.id for r in got] == [r[0] for r in rows]
    for row, (_, text, *_) in zip(got, rows):
        assert (list(row.ids), row.decoded) == expected(library, text)
    assert pieces.encode_texts(df.limit(0), PATH).count() == 0


def test_small_tables_give_the_same(library, monkeypatch):
    model = pieces.Model(open(PATH, "rb").read())
    texts = [t or "" for t in AWKWARD]
    for chunks, chars in ((7, 1 << 20), (1 << 20, 200), (1, 1)):
        monkeypatch.setattr(pieces, "TABLE_CHUNKS", chunks)
        monkeypatch.setattr(pieces, "TABLE_CHARS", chars)
        few = pieces.ChunkTable(model)
        for part in (texts, texts[::-1], ["a b", "c d"], ["a b"]):
            ids, decoded = few.encode(part)
            assert list(zip(ids.to_pylist(), decoded.to_pylist())) == [expected(library, t) for t in part]


def test_each_distinct_chunk_is_segmented_once(monkeypatch):
    model, seen = pieces.Model(open(PATH, "rb").read()), []
    plain = model.segment
    monkeypatch.setattr(model, "segment", lambda chunks: seen.extend(chunks) or plain(chunks))
    own = pieces.ChunkTable(model)
    for _ in range(3):
        own.encode(["the cat  sat", "the dog sat", "cat cat cat"])
    assert sorted(seen) == [" sat", "cat", "dog", "sat", "the"]


def test_query_on_whole_tables(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in pieces.op13_distinct_chunk_pieces(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == docs.count()
    for r in docs.select("doc_id", "text").collect():
        ids, decoded = expected(library, r.text)
        row = got[r.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_models_that_cannot_be_chunked_are_refused(monkeypatch):
    model = pieces.Model(open(PATH, "rb").read())
    monkeypatch.setattr(pieces, "MARK", "e")        # pieces do cross an "e"
    with pytest.raises(ValueError):
        model.check()


def test_no_shuffle(spark):
    plan = pieces.op13_distinct_chunk_pieces(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
