"""Quality classifier: held-out accuracy, shrinking, edge rows."""

import numpy as np
from pyspark.sql import functions as F

from regfuse.llm import quality as Q
from tests.conftest import SF_MID


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    seen = labels.where("doc_id % 2 = 0")
    got = Q.score(docs, seen, host=F.col("source"), path=F.col("lang"))
    rows = got.join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good = [r for r in rows if r.quality == 1]
    bad = [r for r in rows if r.quality == 0]
    assert np.mean([r.kept for r in good]) > 0.98
    assert np.mean([not r.kept for r in bad]) > 0.85
    assert got.count() == 1000


def test_sites_shrink(spark):
    """Texts tell nothing apart; hosts do, and a sparse path leans on its host."""
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(1200):
        host = f"h{i % 6}"
        rows.append((i, f"word{i % 7} text of {i}", host, f"p{i % 5}"))
        labels.append((i, int(rng.uniform() < (0.95 if i % 6 < 3 else 0.15))))
    rows += [(9000, "word1 text of 9", "h0", "new"), (9001, "word1 text of 9", "h5", "new"), (9002, "word1 text of 9", "unseen", "new")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, host string, path string")
    lab = spark.createDataFrame(labels, "doc_id bigint, quality int")
    got = {r.doc_id: r for r in Q.score(docs, lab, host=F.col("host"), path=F.col("path")).collect()}
    assert got[9000].score > 0.8 > 0.35 > got[9001].score
    assert 0.4 < got[9002].site_score < 0.75
    assert np.mean([got[i].site_score for i in range(0, 1200, 6)]) > 0.85


def test_prior_strength(spark):
    flat = spark.createDataFrame([(100.0, 50.0, 0.5)] * 20, "n double, s double, m double")
    assert Q.prior_strength(flat, "n", "s", "m") == 1e6
    apart = spark.createDataFrame([(100.0, 95.0, 0.5), (100.0, 5.0, 0.5)] * 10, "n double, s double, m double")
    assert Q.prior_strength(apart, "n", "s", "m") < 1
    assert Q.prior_strength(apart.limit(0), "n", "s", "m") == 1e6


def test_edge_rows(spark):
    rows = [(i, f"good text number {i}, quite plain." if i % 2 else "BUY!! NOW!! $$$", "y", "h") for i in range(40)]
    rows += [(100, None, "y", None), (101, "", "y", "h"), (None, "good text", "y", "h"), (1, "repeated id", "y", "h"), (102, "w " * 100_000, "y", "h")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, y string, host string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (3, 0), (5, 7), (6, None)], "doc_id bigint, quality int")
    got = Q.score(docs, labels, host=F.col("host")).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert Q.score(docs.limit(0), labels).count() == 0
    alone = Q.score(docs, labels.limit(0)).collect()
    assert all(abs(r.score - 0.5) < 1e-6 for r in alone)
    one = Q.score(docs, labels.where("quality = 1")).collect()
    assert all(r.kept for r in one)
