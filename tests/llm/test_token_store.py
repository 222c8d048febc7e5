"""Token store: exact round trip through the files."""

import tempfile
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from regfuse.llm import token_store as T
from regfuse.llm.queries import tokenizer_json
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def encode():
    t = Tokenizer.from_str(tokenizer_json())
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


def want(rows, encode):
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(encode(text), "<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_documents(spark, encode):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = [tuple(r) for r in T.encode_documents(docs.repartition(7), tokenizer_json()).orderBy("doc_id").collect()]
    assert got == want(rows, encode)


def test_edge_rows_and_single_reads(spark, encode, monkeypatch):
    monkeypatch.setattr(T, "BLOCK_BYTES", 300)
    rows = [(5, None), (4, ""), (3, "é <|endoftext|> \U0001f600\n\n"), (-2, "a b"), (None, "no id"), (9, "long words " * 60_000)]
    rows += [(100 + i, f"text number {i}") for i in range(60)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, bytes string, row int")
    path = tempfile.mkdtemp(prefix="token-store-") + "/s"
    T.write_store(df.repartition(3), path, tokenizer_json())
    assert [tuple(r) for r in T.digests(spark, path).orderBy("doc_id").collect()] == want(rows, encode)
    ids = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in T.read_store(spark, path).collect()}
    assert ids[3] == encode(rows[2][1]) and ids[5] == [0]
    index = T.index_of(spark, path)
    assert index.count() == len(rows) and index.select("part", "block").distinct().count() > 3
    twice = [(1, "same"), (1, "same"), (1, "other")]
    got = T.encode_documents(spark.createDataFrame(twice, "doc_id bigint, text string"), tokenizer_json()).collect()
    assert sorted((r.n_tokens, r.ids_crc32) for r in got) == sorted((n, c) for _, _, n, c in want(twice, encode))
    assert sorted(r.start for r in got)[0] == 0


def test_special_tokens_as_the_library_does(spark, encode):
    rows = [(1, "a <|endoftext|> b"), (2, "<|endoftext|>"), (3, "word<|endoftext|>word and more"), (4, "a b")]
    assert encode(rows[0][1]) == [64, 220, 50256, 275, 0]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert [tuple(r) for r in T.encode_documents(df, tokenizer_json()).orderBy("doc_id").collect()] == want(rows, encode)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert T.encode_documents(df, tokenizer_json()).count() == 0


def test_white_space_and_signs_as_the_library_does(encode):
    texts = ["", " ", "\n", "\n\n", " \n", "\n ", "a", " a", "\na", "a\n", "a ", "a\n\n", "a\n\nb", "a\n\n\nb", "a \nb", "a\n b", "a  b", "a\n\n b"]
    texts += ["a\r\nb", "a\r\n\r\nb", "a\t b", "a\t\n\tb\t", "a\u00a0 b", "a \u3000b", "a\u2028\nb", "\x1c \n", "a\x00b \x7f\xad c"]
    texts += ["it's 's ' '' don't.", "été, Élan. naïve×÷", "ß\nÀ: x2y 12a3 (b) c$$$ d_e .,%%% \"q\"", "日本語 text", "e\u0301 \u0250a ǅ½²"]
    texts += ["w" * 100 + " " + "w" * 100, "<|endoftext|>\n\na", "a. b, c; D:\nE! f? g.\n\nH"]
    made = T._encoder(tokenizer_json())
    assert [np.frombuffer(x, "<u4").tolist() for x in made(texts)] == [encode(t) for t in texts]


def test_rare_words_do_not_push_out_frequent_ones(encode, monkeypatch):
    monkeypatch.setattr(T._Pieces, "limit", 20)
    made = T._encoder.__wrapped__(tokenizer_json())
    calls = []
    monkeypatch.setattr(T._Pieces, "piece", lambda self, text, piece=T._Pieces.piece: (calls.append(text), piece(self, text))[1])
    texts = [f"and then{chr(97 + i)} comes" for i in range(26)]
    assert [np.frombuffer(made([t])[0], "<u4").tolist() for t in texts] == [encode(t) for t in texts]
    assert calls.count(" comes") == 1 and len(calls) == 28
