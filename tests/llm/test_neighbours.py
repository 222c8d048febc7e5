"""Nearest neighbours against brute force."""

import numpy as np

from regfuse.llm import neighbours as V

SCHEMA = "vec_id bigint, embedding array<float>, shard int, dim string"


def brute(rows, k=5, every=50):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and None not in v]
    ok = [(i, v) for i, v in ok if np.isfinite(v).all() and v.any()]
    out = []
    for i, q in ok:
        if i % every == 0:
            c = [(-(q @ v) / (np.sqrt(q @ q) * np.sqrt(v @ v)), j) for j, v in ok if j != i and len(v) == len(q)]
            c = sorted((round(s, 12), j) for s, j in c)[:k]
            out += [(i, r + 1, j, round(-s, 9)) for r, (s, j) in enumerate(c)]
    return sorted(out)


def got(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 0, "") for i, v in rows], SCHEMA)
    index = V.build_index(df, shard_rows=options.pop("shard_rows", 200))
    r = V.nearest(df.where("vec_id % 50 = 0"), index, **options).collect()
    return sorted((x.query_id, x.rank, x.vec_id, round(x.score, 9)) for x in r)


def test_exact_with_factor_one(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=12)]) for i in range(900)]
    rows += [(1000 + i, rows[50][1]) for i in range(40)]  # a crowd of equal vectors: ties to the smaller vec_id
    rows += [(2000, None), (2050, [0.0] * 12), (2100, [float("nan")] + [1.0] * 11), (2150, [float("inf")] * 12), (2200, [None] + [1.0] * 11)]
    rows += [(None, [1.0] * 12), (2250, []), (2300, [1.0, 2.0]), (2301, [2.0, 1.0]), (2350, [1.0, 2.0, 3.0])]
    assert got(spark, rows, block_rows=7) == brute(rows)


def test_few_candidates_and_empty(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []


def test_two_vectors_under_one_id_are_two_queries(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (50, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [0.1, 1.0]), (3, [1.0, 1.0])]
    found = [(r, v) for _, r, v, _ in got(spark, rows, k=2)]
    assert sorted(found) == [(1, 1), (1, 2), (2, 3), (2, 3)]


def test_relaxed_recall_and_work():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 32))
    x = V._unit(centres[rng.integers(0, 40, 4000)] + 0.4 * rng.normal(size=(4000, 32)))
    ids = np.arange(4000)
    tree = V.build(x)
    exact = V.Search(tree, x, ids, x[::50], ids[::50], 5, 1.0).run()
    loose = V.Search(tree, x, ids, x[::50], ids[::50], 5, 1.5).run()
    full = np.array([[j for j in np.lexsort((ids, -(x @ q))) if j != i][:5] for i, q in zip(ids[::50], x[::50], strict=True)])
    assert (exact.found == full).all()
    recall = np.mean([len(set(a) & set(b)) / 5 for a, b in zip(loose.found, full, strict=True)])
    assert recall >= 0.9 and loose.seen < exact.seen < 80 * 4000 * 1.2
