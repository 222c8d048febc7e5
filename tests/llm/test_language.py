"""Language identification: held-out accuracy, whole texts, edge rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from regfuse.llm import language as L
from tests.conftest import SF_MID

SCHEMA = "doc_id bigint, text string, lang string, score int, held_out string"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = L.identify(docs).alias("p").join(docs.alias("d"), "doc_id").select("doc_id", "held_out", "lang_pred", "score", "lang").collect()
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_edge_rows(spark):
    rows = [(i, t, g, 0, "x") for i, (t, g) in enumerate([("the thing that", "en"), ("der die das und", "de")] * 20)]
    rows += [(100, None, "en", 0, "x"), (101, "", "de", 0, "x"), (102, "12 !? 3", "fr", 0, "x"), (103, "the " * 200_000, None, 0, "x"), (None, "die das", "de", 0, "x")]
    rows += [(104, "\U0001f600", "en", 0, "x"), (105, "日本", None, 0, "x")]
    got = {r.doc_id: r for r in L.identify(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[i].lang_pred for i in (100, 101, 102, 104)] == ["und"] * 4 and got[100].score == 0.0
    assert got[103].lang_pred == "en" and got[None].lang_pred == "de" and got[None].held_out
    assert got[105].lang_pred in ("en", "de", "fr")
    assert L.identify(spark.createDataFrame([], SCHEMA)).count() == 0
    assert {r.lang_pred for r in L.identify(spark.createDataFrame([(1, "abc", None, 0, "x")], SCHEMA)).collect()} == {"und"}


def test_pieces_do_not_change_features(monkeypatch):
    text = ("Ünï  cødé, 12 words--and\n more " * 50).encode()
    whole = Counter(np.concatenate(list(L.features(text))).tolist())
    for piece in (1, 2, 3, 7, 64):
        monkeypatch.setattr(L, "PIECE", piece)
        assert Counter(np.concatenate(list(L.features(text))).tolist()) == whole
    assert list(L.features(b"123 ...")) == []


def test_naive_bayes_by_hand(spark):
    rows = [(1, "abab", "x"), (2, "baba a", "x"), (3, "cdcd", "y")]
    langs, table, priors = L.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert langs == ["x", "y"]
    count = {g: Counter() for g in langs}
    for _, t, g in rows:
        for f in L.features(t.encode()):
            count[g].update(f.tolist())
    text = b"abcd"
    want = []
    for g in langs:
        total = sum(count[g].values()) + L.SMOOTHING * L.BUCKETS
        s = math.log({"x": 2 / 3, "y": 1 / 3}[g])
        for f in L.features(text):
            s += sum(math.log((count[g][k] + L.SMOOTHING) / total) for k in f.tolist())
        want.append(s)
    best, score = L.classify(text, langs, table, priors)
    assert best == langs[int(np.argmax(want))]
    assert abs(score - 1 / sum(math.exp(w - max(want)) for w in want)) < 1e-9


def test_more_languages_than_the_matrix_holds(spark, monkeypatch):
    monkeypatch.setattr(L, "MATRIX_CELLS", 2 * L.BUCKETS)
    rows = spark.createDataFrame([(i, "abc", g) for i, g in enumerate("xyz")], "doc_id bigint, text string, lang string")
    with pytest.raises(ValueError, match="more than 2 languages"):
        L.train(rows)
    assert L.train(rows, buckets=L.BUCKETS // 2)[0] == ["x", "y", "z"]


def test_sample_of_a_large_language(spark):
    rows = [(i, "abab", "x") for i in range(400)] + [(1000, "cdcd", "y")]
    langs, table, priors = L.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), fit_rows=100)
    assert langs == ["x", "y"] and abs(np.exp(priors[0]) - 400 / 401) < 1e-9  # priors are of all rows
    assert L.classify(b"cd cd", langs, table, priors)[0] == "y"
