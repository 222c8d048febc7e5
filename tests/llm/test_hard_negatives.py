import random

import numpy as np
import pytest

from regfuse.llm import hard_negatives as H

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, dim int, shard int"


def brute(rows, positives=5, negatives=10):
    """(id, label, integer vector) rows, each once -> the contract's rows."""
    out = []
    for aid, alabel, a in rows:
        if aid % 100:
            continue
        score = lambda v: sum(x * y for x, y in zip(a, v, strict=True))  # noqa: B023, E731
        others = sorted((-score(v), i, label) for i, label, v in rows if i != aid and len(v) == len(a))
        for s, p, _ in [x for x in others if x[2] == alabel][:positives]:
            window = [(n, -t) for t, n, label in others if label != alabel and 30 * -s <= 100 * -t <= 90 * -s]
            out += [(aid, p, r, n, -s, t) for r, (n, t) in enumerate(window[:negatives], 1)]
    return sorted(out)


def made(n, dim, labels, seed, spread=3.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, spread) for _ in range(dim)] for _ in range(labels)]
    return [(i, [float(np.float32(c + rng.gauss(0, 1))) for c in centres[i % labels]], (i * 7) % labels) for i in range(1, n + 1)]


def ints(v):
    return [int(np.floor(256 * float(x))) for x in v]


@pytest.mark.parametrize(("dim", "shard_rows", "block_rows"), [(3, 10_000, 512), (8, 150, 2), (1, 100, 3)])
def test_against_all_pairs(spark, dim, shard_rows, block_rows):
    rows = made(700, dim, 4, dim)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    v = H.scaled(df)
    got = H.mine(v, v.where("id % 100 = 0"), shard_rows=shard_rows, block_rows=block_rows).collect()
    assert sorted(map(tuple, got)) == brute([(i, label, ints(e)) for i, e, label in rows])


def test_ties_repeats_nulls_lengths_and_clashing_columns(spark):
    good = [(i, [1.0, float(i % 3)], i // 10 % 2) for i in range(0, 300, 10)]  # many equal scores
    bad = [(1000, None, 1), (1100, [1.0, None], 1), (1200, [float("nan"), 1.0], 0), (1300, [float("inf"), 1.0], 0), (1400, [1.0, 1.0], None),
           (None, [1.0, 1.0], 1), (1600, [1.0, 2.0, 3.0], 1)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in good + good + bad], SCHEMA)
    v = H.scaled(df)
    got = H.mine(v, v.where("id % 100 = 0")).collect()
    assert sorted(map(tuple, got)) == brute([(i, label, ints(e)) for i, e, label in good])
    assert got


def test_empty_and_no_partner(spark):
    empty = H.scaled(spark.createDataFrame([], SCHEMA))
    assert H.mine(empty, empty).collect() == []
    alone = H.scaled(spark.createDataFrame([(100, [1.0], 1)], "vec_id bigint, embedding array<float>, label int"))
    assert H.mine(alone, alone).collect() == []


def test_a_label_of_a_third_of_all_rows_is_split(spark):
    rows = [(i, [1.0, i / 1000], 0 if i % 3 else i) for i in range(900)]
    index = H.build_index(H.scaled(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")), 100)
    sizes = [len(r["ids"]) // 8 for r in index.collect()]
    assert sum(sizes) == 900 and max(sizes) < 200


def test_the_queue_prunes():
    rng = np.random.default_rng(3)
    centres = rng.integers(-2000, 2000, (40, 6))
    x = np.repeat(centres, 200, axis=0) + rng.integers(-20, 20, (8000, 6))
    labels, ids = rng.integers(0, 3, 8000), np.arange(8000)
    tree = H.Tree.packed(ids, labels, x)
    assert sorted(tree.ids) == list(range(8000))
    s = H.Search(tree, x[:20], ids[:20], labels[:20], 10, False)
    low, high = np.array([-(2**63)]), np.array([2**63 - 1])
    for i in range(20):
        (found, scores), = s.best(i, low, high)
        all_scores = x @ x[i]
        wanted = np.flatnonzero((labels != labels[i]))
        first = wanted[np.lexsort((wanted, -all_scores[wanted]))[:10]]
        assert list(found) == list(first) and list(scores) == list(all_scores[first])
    assert s.seen < 0.3 * 20 * 8000


def test_numbers_beyond_double_and_beyond_64_bits():
    big = np.array([[2**30, 1], [2**30, 2], [2**30, 3]])
    tree = H.Tree.packed(np.arange(3), np.array([0, 1, 1]), big)
    s = H.Search(tree, big[:1], np.array([0]), np.array([0]), 2, False)
    (found, scores), = s.best(0, np.array([-(2**63)]), np.array([2**63 - 1]))
    assert list(found) == [2, 1] and list(scores) == [2**60 + 3, 2**60 + 2]
    with pytest.raises(ValueError, match="64 bits"):
        H.Search(tree, np.array([[2**40, 1]]), np.array([0]), np.array([0]), 2, False)
