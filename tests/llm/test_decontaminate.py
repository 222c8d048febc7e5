"""Decontamination against alignment of all pairs."""

import numpy as np
import pyarrow as pa

from regfuse.llm import decontaminate as D


def align(a, b, penalty=0.5):
    h = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = 0.0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (1 if a[i - 1] == b[j - 1] else -penalty), h[i - 1][j] - penalty, h[i][j - 1] - penalty)
            best = max(best, h[i][j])
    return best


def test_alignment_is_smith_waterman():
    rng = np.random.default_rng(2)
    for _ in range(40):
        a = rng.integers(0, 6, rng.integers(1, 20)).astype(np.uint64)
        b = rng.integers(0, 6, rng.integers(0, 40)).astype(np.uint64)
        assert abs(D.align(a, b)[0] - align(a, b)) < 1e-9


def test_copies_edits_and_clean(spark):
    rng = np.random.default_rng(4)

    def prose(n):
        return [f"w{x}" for x in rng.integers(0, 4000, n)]

    items = [(1, prose(40)), (2, prose(25)), (3, ["only", "three", "words"]), (4, prose(60)), (7, prose(1))]
    docs = [(i, prose(rng.integers(1, 300))) for i in range(40)]
    text = dict(items)
    edited = list(text[1])
    for p in (5, 17, 30):
        edited[p] = "edited"
    docs += [(100, prose(80) + text[1] + prose(90)), (101, prose(30) + edited + prose(5)), (102, text[2]), (103, prose(9) + text[4][:45])]
    docs += [(104, ["only", "three", "words"]), (105, text[1] + prose(200) + text[2]), (106, text[1][:9] + prose(100))]
    docs += [(200 + i, prose(20) + text[4]) for i in range(30)]  # a leak so common that its grams are not rare
    rows = [(i, " ".join(w).title() + ".", 1, "x") for i, w in docs] + [(300, None, 1, "x"), (301, "", 1, "x"), (None, " ".join(text[1]), 1, "x")]
    rows += [rows[40]] * 3
    d = spark.createDataFrame(rows, "doc_id bigint, text string, item int, gram string")
    b = spark.createDataFrame([(i, " ".join(w), 0) for i, w in items] + [(5, None, 0), (6, "", 0), (None, "x", 0), (1, " ".join(text[1]), 0)], "item_id bigint, text string, doc int")
    got = {(r.doc_id, r.item_id): r.score for r in D.contaminated(d, b).collect()}
    want = {(i, j): align(t, w) / len(t) for i, w in docs for j, t in items}
    want = {k: v for k, v in want.items() if v >= D.THRESHOLD}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert {(100, 1), (101, 1), (102, 2), (103, 4), (104, 3), (105, 1), (105, 2), (229, 4)} <= got.keys()
    assert (106, 1) not in got


def found_and_wanted(spark, docs, items):
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id bigint, text string")
    b = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r.score for r in D.contaminated(d, b).collect()}
    want = {(i, j): align(t, w) / len(t) for i, w in docs for j, t in items}
    return got, {k: v for k, v in want.items() if v >= D.THRESHOLD}


def test_edited_copies_beside_the_exact_text(spark):
    rng = np.random.default_rng(8)
    items = [(j, [f"w{x}" for x in rng.integers(0, 4000, 40)]) for j in range(8)]
    docs = []
    for j, text in items:  # five to eight edits, beside the exact text once or five times
        places = np.linspace(3, 36, 5 + j % 4).astype(int)
        docs.append((100 * j, [f"new{i}" if i in places else w for i, w in enumerate(text)]))
        docs += [(100 * j + k, ["before", *text, "after"]) for k in range(1, 2 + j)]
    got, want = found_and_wanted(spark, docs, items)
    assert got.keys() == want.keys() and len(want) == len(docs)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_spread_edits_and_short_items(spark):
    rng = np.random.default_rng(9)
    lengths = [1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 14, 20, 33]
    items = [(j, [f"w{x}" for x in rng.integers(0, 4000, n)]) for j, n in enumerate(lengths)]
    docs = []
    for j, text in items:
        forms = [[f"new{i}" if i % every == every // 2 else w for i, w in enumerate(text)] for every in (3, 4, 5)]  # changed
        forms += [[w for i, w in enumerate(text) if i % every != 1] for every in (3, 4)]  # left out
        forms += [[x for i, w in enumerate(text) for x in ([w] if i % every else [f"more{i}", w])] for every in (1, 2, 3)]  # put in
        forms += [text[: (len(text) + 1) // 2], ["new" if i == len(text) // 2 else w for i, w in enumerate(text)], text[:1]]
        forms += [[*text[:1], *[f"far{i}" for i in range(len(text) - 1)], *text[1:]]]
        for k, words in enumerate(forms):
            docs.append((100 * j + k, [f"a{x}" for x in rng.integers(0, 99, 30)] + words + [f"z{x}" for x in rng.integers(0, 99, 30)]))
    docs += [(9000 + k, [w for _, t in items for w in rng.permutation(t)]) for k in range(3)]  # the words without their order
    got, want = found_and_wanted(spark, docs, items)
    assert got.keys() == want.keys() and len(want) > 100
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_least_number_of_seeds():
    rng = np.random.default_rng(10)
    checked = 0
    for _ in range(3000):
        item = np.arange(1, rng.integers(2, 26)).astype(np.uint64) + np.uint64(1 << 40)
        text = []
        for w in item:  # edits of all kinds at random rates
            kind = rng.random()
            text += [w] if kind < 0.6 else [] if kind < 0.7 else [rng.integers(0, 1 << 30)] if kind < 0.8 else [rng.integers(0, 1 << 30), w]
        text = np.array(text, np.uint64)
        if D.align(item, text)[0] / len(item) < D.THRESHOLD:
            continue
        n, slack, least = D._seed_shape(len(item), D.THRESHOLD, D.PENALTY)
        of_item, of_text = (dict(zip(*D.seed_hashes(x, n, slack), strict=True)) for x in (item, text))
        assert len({of_item[g] for g in of_item.keys() & of_text.keys()}) >= least >= 1
        checked += 1
    assert checked > 500


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c d e")], "doc_id bigint, text string")
    b = spark.createDataFrame([(1, "a b c d e")], "item_id bigint, text string")
    assert D.contaminated(d.limit(0), b).count() == 0
    assert D.contaminated(d, b.limit(0)).count() == 0
    assert [tuple(r) for r in D.contaminated(d, b).collect()] == [(1, 1, 1.0, 5)]


def test_windows_with_too_few_of_the_words_are_not_aligned(monkeypatch):
    calls = []
    monkeypatch.setattr(D, "align", lambda *a, align=D.align: (calls.append(a), align(*a))[1])
    item = "one two three four five six seven eight"
    texts = ["one two three a b c d e f", "x one two three four y z", "one x two y three z four", "four three two one"]
    columns = {"doc": [1, 2, 3, 4], "item": [7] * 4, "low": [0] * 4, "high": [1] * 4, "text": texts, "item_text": [item] * 4}
    found = [r for b in D._aligned(0.5, 0.5)([pa.RecordBatch.from_pydict(columns)]) for r in b.to_pylist()]
    assert [(r["doc_id"], r["score"]) for r in found] == [(2, 0.5)] and len(calls) == 3
