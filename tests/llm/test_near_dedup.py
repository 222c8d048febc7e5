"""Near-duplicates against all pairs in plain Python."""

import numpy as np
import pytest

from regfuse.llm import near_dedup as N
from regfuse.llm.components import components

SCHEMA = "doc_id bigint, text string, node string, size int"  # node and size clash with the operator's own names


def brute(rows):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[root(i)] = root(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((doc, len(sets[i]), least, doc == least))
    return sorted(out, key=repr)


def got(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    return sorted([tuple(r)[:4] for r in N.near_duplicates(df).collect()], key=repr)


def edited(words, *places):
    words = list(words)
    for p in places:
        words[p] = f"changed{p}"
    return " ".join(words)


def test_against_all_pairs(spark):
    rng = np.random.default_rng(7)
    base = [f"w{x}" for x in rng.integers(0, 5000, 400)]
    rows = [(i, " ".join(f"v{x}" for x in rng.integers(0, 900, rng.integers(1, 60)))) for i in range(60)]
    rows += [(100 + i, edited(base, *rng.integers(0, 400, i % 14))) for i in range(60)]  # a ladder of edits of one text
    rows += [(200, " ".join(base)), (201, " ".join(base).upper()), (202, "\t".join(base) + "\n")]
    rows += [(300, "a b c d"), (301, "A  b c\x0bd"), (302, "a b c"), (303, "a b c d e f g h"), (304, "a b c d e f g h i")]
    rows += [(400, None), (401, ""), (402, " \n\t"), (None, "x y z"), (None, "x y z"), (500, "x y z"), (501, "same id"), (501, "same id"), (502, "é É")]
    rows += [(600, " ".join(f"long{i}" for i in range(30000))), (601, " ".join(f"long{i}" for i in range(29000)))]
    chain = [f"c{i}" for i in range(300)]  # each text is linked to the next, the ends are far apart
    rows += [(700 + i, " ".join(chain[6 * i : 6 * i + 200] + [f"t{i}"])) for i in range(14)]
    result = got(spark, rows)
    assert result == brute(rows)
    assert {r[2] for r in result if r[0] is not None and r[0] >= 700} == {700}


def test_prefix_pairs_lose_no_pair_of_two_components(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**40, 120)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40))) for _ in range(40)]  # frequent shingles, many sizes
    for _ in range(80):  # copies without their original: 0 to 40 % of it replaced, partly by the same few
        x = base.copy()
        at = rng.choice(120, rng.integers(0, 48), replace=False)
        x[at] = rng.choice([0, 10**13], len(at)) + rng.integers(0, 400, len(at))
        sets.append(np.unique(x[: rng.integers(90, 121)]))
    sets += [np.array([5]), np.array([5]), np.array([7])]
    cids = [int(c) for c in rng.integers(0, 60, len(sets))]
    rows = [(i, c, bytearray(x.astype(np.int64).tobytes())) for i, (c, x) in enumerate(zip(cids, sets, strict=True))]
    df = spark.createDataFrame(rows, "nid bigint, cid bigint, shingles binary")
    made = {(r.a, r.b) for r in N._prefix_pairs(df, 75).collect()}
    wanted = set()
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(np.intersect1d(a, sets[j]))
            if cids[i] != cids[j] and 100 * common >= 75 * (len(a) + len(sets[j]) - common):
                wanted.add((j, i))
    assert len(wanted) > 20 and wanted <= made
    assert all(a < b and cids[a] != cids[b] for a, b in made)
    assert N._prefix_pairs(df.where("nid < 0"), 75).collect() == []


def test_sets_with_enough_of_their_own_meet_nobody(spark):
    """A frequent passage of 100 shingles in 300 sets that hold 20 more each (similarity 0.71): no pair is made."""
    own = np.arange(300 * 20).reshape(300, 20) + 10**6
    rows = [(i, i, bytearray(np.concatenate([np.arange(100), own[i]]).astype(np.int64).tobytes())) for i in range(300)]
    df = spark.createDataFrame(rows, "nid bigint, cid bigint, shingles binary")
    assert N._prefix_pairs(df, 75).count() == 0


def test_intermediate_tables_are_removed(spark):
    from pathlib import Path

    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = set(folder.iterdir())
    got(spark, [(1, "a b c d e f"), (2, "a b c d e f g"), (3, "a b c d e f g h")])
    assert len(set(folder.iterdir()) - before) == 2  # the rows and their classes, which the result reads


def test_empty_table(spark):
    assert got(spark, []) == []


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 3000, dtype=np.int64).astype(np.uint64)
    a, b = np.unique(x[:2000]), np.unique(x[400:2400])
    assert (N.merge(N.sketch(a), N.sketch(b)) == N.sketch(np.union1d(a, b))).all()
    equal = (N.sketch(a) == N.sketch(b)).mean()
    assert abs(equal - 1600 / 2400) < 0.15
    sa, sb = N.sketch(a)[None], N.sketch(b)[None]
    n = np.array([2000.0])
    assert N.may_reach(sa, sb, n, n, 0.75)[0]  # 0.67 is not excluded by 128 registers
    other = N.sketch(np.unique(x[1000:3000]))[None]
    assert not N.may_reach(sa, other, n, n, 0.75)[0]  # 0.33 is


@pytest.mark.parametrize("n", [0, 1, 7])
def test_components(spark, n):
    links = [(i, i + 1) for i in range(n)] + [(50, 50), (90, 80), (80, 90)] * (n > 0)
    df = spark.createDataFrame(links, "a bigint, b bigint")
    found = {r.node: r.component for r in components(df).collect()}
    assert found == ({i: 0 for i in range(n + 1)} | {80: 80, 90: 80} if n else {})
