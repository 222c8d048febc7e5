import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from regfuse.llm import lexical_search as L

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(A_Z))


def brute(items, docs, k):
    bags = [(d, Counter(words(t)), len(words(t))) for d, t in docs]
    bags = [b for b in bags if b[2]]
    n_docs, n_terms = len(bags), sum(b[2] for b in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for d, bag, n in bags:
            m = 50 + (50 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m))
                    for t in set(words(text)) if t in bag)
            if s > 0 and d is not None:
                scored.append((-s, d))
        out += [(item, r, d, -s) for r, (s, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def run(spark, items, docs, **more):
    i = spark.createDataFrame([(*x, "a", 1) for x in items], "item_id bigint, text string, term string, score int")
    d = spark.createDataFrame([(*x, 1, "a") for x in docs], "doc_id bigint, text string, item_id int, rank string").repartition(3)
    return sorted((tuple(r) for r in L.search(i, d, **more).collect()), key=str)


def corpus(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["ñu", "Ärger", "x-1", "日本"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    return [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 80)))) for i in range(n)]


@pytest.mark.parametrize("more", [{"k": 5}, {"k": 50, "shard_postings": 200}, {"k": 3, "item_terms": 7}])
def test_against_scores_of_all_documents(spark, more):
    docs = corpus(400, 1)
    items = [(i, t) for i, t in corpus(12, 2)] + [(100, "w0 w1 w2"), (101, "w59 w58"), (102, "nothing of it")]
    assert run(spark, items, docs, **more) == brute(items, docs, more["k"])


def test_nulls_repeats_ties_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(L, "PIECE", 64)
    long = "w1 " * 5000 + "tail"
    docs = [(1, "Same Words here"), (2, "same words, HERE!"), (2, "same words, HERE!"), (None, "same words here"), (3, None), (4, ""), (5, "-- ... --"),
            (6, long), (7, "wörter ÄÖ x here"), (-4, "same words here")]
    items = [(1, "same words"), (1, "same words"), (1, "tail"), (2, None), (3, ""), (None, "here"), (4, "WÖRTER wÖrter ÄÖ x")]
    assert run(spark, items, docs, k=3) == brute(items, docs, 3)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == []
    assert run(spark, [(1, "a")], []) == []
    assert run(spark, [(1, "a")], [(1, None)]) == []


def test_the_walk_skips_but_loses_nothing():
    rng = np.random.default_rng(1)
    for trial in range(30):
        n, k = 5000, int(rng.integers(1, 20))
        bounds = np.append(np.arange(0, n, 256), n)
        whole, lists = np.zeros(n, np.int64), []
        for size in rng.integers(1, n, 5):
            docs = np.sort(rng.choice(n, size, replace=False))
            scores = rng.integers(1, 4 + trial, size) * int(rng.integers(1, 50))
            whole[docs] += scores
            lists.append(L.Postings(docs, scores, bounds))
        places, scores = L.walk(lists, bounds, k, 1)
        first = np.lexsort((np.arange(n), -whole))[:k]
        first = first[whole[first] > 0]
        assert list(places) == list(first) and list(scores) == list(whole[first])


def test_rare_lists_become_one_iterator():
    docs, scores = L.accumulated([(np.array([1, 5, 9]), np.array([1, 2, 3])), (np.array([5]), np.array([10])), (np.array([0, 9]), np.array([4, 4]))])
    assert list(docs) == [0, 1, 5, 9] and list(scores) == [4, 1, 12, 7]
