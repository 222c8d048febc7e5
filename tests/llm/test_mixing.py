"""Mixing: targets against step-by-step filling, rounding by its invariants."""

import numpy as np

from regfuse.llm import mixing as M


def fill(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, total = {}, set(names), float(sum(sizes.values()))
    while left:
        level = (total - sum(target.values())) / sum(w[s] for s in left)
        over = {s for s in left if level * w[s] > most * sizes[s] + 1e-9}
        for s in over or left:
            target[s] = most * sizes[s] if over else level * w[s]
        left -= over or left
    return target


def test_targets(spark):
    for sizes in ({"a": 100, "b": 5, "c": 900, None: 40}, {"b": 1, "é": 2, "Z": 3}, {"x": 10}, {None: 7, "a": 0}, {"a": 0}):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
        got = {r.source: r.target for r in M.targets(df).collect()}
        want = fill(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want), (got, want)


def test_pivotal_keeps_the_sum_and_the_expectation():
    rng = np.random.default_rng(0)
    p = rng.uniform(0.01, 0.99, 9)
    mean, n = np.zeros(9), 4000
    for _ in range(n):
        out, held, rest = M.pivotal(p.tolist(), rng.uniform(size=9).tolist())
        assert abs(sum(out) + rest - p.sum()) < 1e-9 and 0 <= rest < 1
        mean += out
        if held >= 0:
            mean[held] += rest
    assert np.abs(mean / n - p).max() < 0.04
    assert M.pivotal([], []) == ([], -1, 0.0)
    assert M.pivotal([0.5, 0.5], [0.1, 0.9])[1] == -1


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(M, "GROUP", 40)
    monkeypatch.setattr(M, "FAN", 3)
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(["w"] * int(rng.integers(1, 200))), f"s{min(9, int(rng.exponential(2)))}", 1) for i in range(1500)]
    rows += [(5000, None, "s1", 1), (5001, "", "s1", 1), (5002, "x y", None, 1), (None, "x", "s2", 1), (7, "q w e", "s0", 1), (7, "q w e", "s0", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, size int").repartition(5)
    got = M.mix(df).collect()
    assert len(got) == len(rows)
    size = {}
    for r in got:
        size[r.source] = size.get(r.source, 0) + r.size
        assert r.taken in {c * r.size for c in range(4)}
        assert r.size > 0 or r.taken == 0
    want = fill(size)
    for s, t in want.items():
        own = [r for r in got if r.source == s]
        assert all(abs(r.target - t) < 1e-6 and r.source_size == size[s] for r in own)
        assert abs(sum(r.taken for r in own) - t) <= 200 + 0.01 * t
        assert abs(sum(r.copies for r in own if r.size) - t / size[s] * sum(r.size > 0 for r in own)) < 1 + 1e-6
    again = M.mix(df.repartition(2)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    mixed = M.mixed(df)
    assert mixed.columns == df.columns
    assert mixed.count() == sum(r.copies for r in got)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert M.mix(df).count() == 0 and M.mixed(df).count() == 0
    df = spark.createDataFrame([(1, None, None)], "doc_id bigint, text string, source string")
    assert [r.taken for r in M.mix(df).collect()] == [0]
