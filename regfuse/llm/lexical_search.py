"""Ranked lexical search over whole documents, for a stated set of items: accumulators first, then documents in order.

One pass over the documents makes *shards*: each task cuts what it reads into runs of at most ``SHARD_POSTINGS`` postings
and writes, for each run, the lists (document, occurrences) of the items' terms, with documents in ascending id.  No row
is shuffled and no key decides where a document goes, so neither a hot source nor a group of copies makes a large shard.

A search takes one item and one shard at a time.  The lists of rare terms are added up into one list of accumulators
(term at a time); that list then takes part as one iterator with a known highest sum in a walk over the frequent terms'
lists (document at a time).  The walk goes through the shard in windows of documents: a window whose lists' highest sums
do not reach the k-th best score so far is skipped, lists that cannot reach it together only answer for documents
that other lists have brought, and of those only for the ones still within reach.  Nothing is approximate: what is skipped
cannot be among the k best.

Scores are integers (see ``search``).  The items' vocabulary goes to all tasks; items are taken in blocks of about
``ITEM_TERMS`` terms, so its size is bounded whatever the number of items, at one pass per block.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regfuse.llm.common import ship, texts_of, written
from regfuse.session import remove

ITEM_TERMS, SHARD_POSTINGS, WINDOW, SHORT, PIECE = 500_000, 4_000_000, 4096, 32, 1 << 20
_SHARD = "n_docs bigint, n_terms bigint, df_terms array<int>, df_counts array<bigint>, docs binary, lengths binary, terms binary, starts binary, places binary, tfs binary"
_BEST = "item int, item_id bigint, doc_id bigint, score bigint"


def _folded(b: int) -> int:
    if b < 0x30 or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F:
        return 0x20  # between terms
    return b + 0x20 if 0x41 <= b <= 0x5A else b


_FOLD = bytes(map(_folded, range(256)))


def pieces_of_terms(text: bytes):
    """The terms of a text, piece by piece: runs of ASCII letters, digits and all characters beyond ASCII; A-Z lower-cased."""
    folded, at = text.translate(_FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + PIECE)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


class _Shard:
    """Postings of one run of documents, gathered row by row."""

    def __init__(self) -> None:
        self.n_docs = self.n_terms = 0
        self.df: Counter = Counter()
        self.docs, self.lengths = array("q"), array("q")
        self.terms, self.places, self.tfs = array("i"), array("i"), array("q")

    def add(self, doc: int | None, text: bytes, ids: dict[bytes, int]) -> None:
        n, counts = 0, Counter()
        for words in pieces_of_terms(text):
            n += len(words)
            counts.update(map(ids.get, words))
        if not n:
            return
        self.n_docs, self.n_terms = self.n_docs + 1, self.n_terms + n
        counts.pop(None, None)
        self.df.update(counts.keys())
        if doc is not None and counts:
            self.terms.extend(counts.keys())
            self.tfs.extend(counts.values())
            self.places.extend([len(self.docs)] * len(counts))
            self.docs.append(doc)
            self.lengths.append(n)

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        docs, lengths = np.array(self.docs, np.int64), np.array(self.lengths, np.int64)
        order = np.argsort(docs, kind="stable")
        place = np.empty(len(docs), np.int32)
        place[order] = np.arange(len(docs), dtype=np.int32)
        terms, places = np.array(self.terms, np.int32), place[np.array(self.places, np.int32)]
        by_list = np.lexsort((places, terms))
        names, starts = np.unique(terms[by_list], return_index=True)
        row = {
            "n_docs": self.n_docs, "n_terms": self.n_terms, "df_terms": list(self.df.keys()), "df_counts": list(self.df.values()),
            "docs": docs[order].tobytes(), "lengths": lengths[order].tobytes(), "terms": names.astype(np.int32).tobytes(),
            "starts": np.append(starts, len(terms)).astype(np.int64).tobytes(), "places": places[by_list].tobytes(),
            "tfs": np.array(self.tfs, np.int64)[by_list].tobytes(),
        }
        return pa.RecordBatch.from_pylist([row], schema=schema)


_SHARD_ARROW = pa.schema(
    [("n_docs", pa.int64()), ("n_terms", pa.int64()), ("df_terms", pa.list_(pa.int32())), ("df_counts", pa.list_(pa.int64()))]
    + [(name, pa.binary()) for name in ("docs", "lengths", "terms", "starts", "places", "tfs")]
)


def build_shards(documents: DataFrame, vocabulary, id_col: str = "doc_id", text_col: str = "text",
                 shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """Written shards with the lists of the terms in ``vocabulary`` (a broadcast of {term: id})."""

    def index(batches):
        ids, shard = vocabulary.value, _Shard()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                if text:
                    shard.add(doc, text, ids)
                    if len(shard.terms) >= shard_postings:
                        yield shard.batch(_SHARD_ARROW)
                        shard = _Shard()
        if shard.n_docs:
            yield shard.batch(_SHARD_ARROW)

    rows = documents.select(documents[id_col].cast("bigint").alias("doc"), documents[text_col].cast("string").alias("text"))
    return written(rows.where(F.col("text").isNotNull()).mapInArrow(index, _SHARD))


class Postings:
    """One list in document order: places in the shard, scores, its highest score, and both by window."""

    def __init__(self, docs: np.ndarray, scores: np.ndarray, bounds: np.ndarray):
        self.docs, self.scores, self.top = docs, scores, int(scores.max())
        self.edges = np.searchsorted(docs, bounds)
        self.tops = np.zeros(len(bounds) - 1, np.int64)
        full = np.flatnonzero(np.diff(self.edges))
        self.tops[full] = np.maximum.reduceat(scores, self.edges[full])


def accumulated(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time: the lists added up into one, in document order."""
    docs, scores = np.concatenate([x[0] for x in lists]), np.concatenate([x[1] for x in lists])
    order = np.argsort(docs, kind="stable")
    docs, scores = docs[order], scores[order]
    first = np.flatnonzero(np.append(True, docs[1:] != docs[:-1]))
    return docs[first], np.add.reduceat(scores, first)


def walk(lists: list[Postings], bounds: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """Document at a time: places and scores of the k best with a score of ``floor`` or more, best first, ties by place."""
    lists = sorted(lists, key=lambda x: x.top)
    reach = np.cumsum([x.top for x in lists])  # the most that the first lists give together
    window_tops = sum(x.tops for x in lists)
    best, best_scores = np.empty(0, np.int64), np.empty(0, np.int64)
    for w in np.flatnonzero(window_tops >= floor):
        if window_tops[w] < floor:
            continue
        needed = int(np.searchsorted(reach, floor))  # a document of the lists before alone stays below the floor
        got = np.zeros(bounds[w + 1] - bounds[w], np.int64)
        for x in lists[needed:]:
            part = slice(x.edges[w], x.edges[w + 1])
            got[x.docs[part] - bounds[w]] += x.scores[part]
        at = np.flatnonzero(got)
        for i in range(needed - 1, -1, -1):
            at = at[got[at] + reach[i] >= floor]
            part = slice(lists[i].edges[w], lists[i].edges[w + 1])
            docs = lists[i].docs[part]
            if not len(at):
                break
            if len(docs):
                p = np.minimum(np.searchsorted(docs, at + bounds[w]), len(docs) - 1)
                hit = docs[p] == at + bounds[w]
                got[at[hit]] += lists[i].scores[part][p[hit]]
        at = at[got[at] >= floor]
        if len(at):
            best, best_scores = np.append(best, at + bounds[w]), np.append(best_scores, got[at])
            first = np.lexsort((best, -best_scores))[:k]
            best, best_scores = best[first], best_scores[first]
            if len(best) == k:
                floor = max(floor, int(best_scores[-1]))
    return best, best_scores


class ShardSearch:
    """A shard's lists with their scores, searched item by item."""

    def __init__(self, row: dict, weights: np.ndarray, n_docs: int, n_terms: int, short: int = SHORT, window: int = WINDOW):
        read = lambda name, kind: np.frombuffer(row[name], kind)
        self.docs, lengths, terms = read("docs", np.int64), read("lengths", np.int64), read("terms", np.int32)
        self.starts, self.places, tfs = read("starts", np.int64), read("places", np.int32), read("tfs", np.int64)
        self.at = {int(t): i for i, t in enumerate(terms)}
        m = 100 - 50 + (50 * lengths * n_docs) // n_terms
        self.scores = np.repeat(weights[terms], np.diff(self.starts)) * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * m[self.places]))
        self.bounds = np.append(np.arange(0, len(self.docs), window), len(self.docs))
        self.short, self.lists = max(1, len(self.docs) // short), {}

    def _long(self, i: int) -> Postings:
        if i not in self.lists:
            part = slice(self.starts[i], self.starts[i + 1])
            self.lists[i] = Postings(self.places[part], self.scores[part], self.bounds)
        return self.lists[i]

    def best(self, terms: list[int], k: int, floor: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Document ids and scores of the k best for some terms, among those with a score of ``floor`` or more."""
        there = [self.at[t] for t in terms if t in self.at]
        sizes = {i: self.starts[i + 1] - self.starts[i] for i in there}
        rare = [slice(self.starts[i], self.starts[i + 1]) for i in there if sizes[i] <= self.short]
        lists = [self._long(i) for i in there if sizes[i] > self.short]
        if rare:
            lists.append(Postings(*accumulated([(self.places[p], self.scores[p]) for p in rare]), self.bounds))
        if not lists:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        places, scores = walk(lists, self.bounds, k, floor)
        return self.docs[places], scores


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    schema = pa.schema([("item_id", pa.int64()), ("key", pa.int64()), ("terms", pa.list_(pa.binary()))])

    def split(batches):
        for batch in batches:
            found = [sorted({w for words in pieces_of_terms(t) for w in words}) for t in texts_of(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, schema.field("terms").type)], schema=schema)

    rows = items.select(items[id_col].cast("bigint").alias("item_id"), items[text_col].cast("string").alias("text"))
    rows = rows.where(F.col("text").isNotNull()).distinct().select("item_id", F.xxhash64("item_id", "text").alias("key"), "text")
    return written(rows.mapInArrow(split, "item_id bigint, key bigint, terms array<binary>").where(F.size("terms") > 0))


def _weights(df: dict[int, int], size: int, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(size)], np.int64)


def search(items: DataFrame, documents: DataFrame, k: int = 50, item_col: str = "item_id", item_text_col: str = "text",
           id_col: str = "doc_id", text_col: str = "text", item_terms: int = ITEM_TERMS, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """The ``k`` highest-scoring documents of each item (all with a score above 0, if fewer): item_id, rank (from 1), doc_id,
    score; equal scores by ascending doc_id.

    With N documents that have a term, L terms in them, and for a term its df documents: w = floor(1000 ln((2N+2)/(2df+1))),
    and a document of n terms scores, for each of the item's terms once, w * (10^9 tf div (1000 tf + 20 m)), where
    m = 50 + 50 n N div L.

    A null or empty text has no terms: such an item gives no rows, such a document counts nowhere.  A document without an
    id counts in N, L and df, but is not returned.  Rows that repeat a document are documents of their own, each with a
    rank; rows that repeat an item (id and text) are one item, two texts under one id are two.  Very long texts are read
    whole, a piece at a time.  Other columns are ignored; empty tables give an empty result.
    """
    spark = documents.sparkSession
    ship(spark)
    terms = _item_terms(items, item_col, item_text_col)
    blocks = math.ceil((terms.agg(F.sum(F.size("terms"))).first()[0] or 0) / item_terms)
    found = None
    for block in range(blocks):
        rows = terms.where(F.pmod("key", F.lit(blocks)) == block).collect()  # about ITEM_TERMS terms
        part = _search_block(spark, [(r["item_id"], [bytes(t) for t in r["terms"]]) for r in rows], documents, k, id_col, text_col, shard_postings)
        part = part.withColumn("block", F.lit(block))
        found = part if found is None else found.unionByName(part)
    remove(terms)
    if found is None:
        found = spark.createDataFrame([], _BEST + ", block int")
    order = Window.partitionBy("block", "item").orderBy(F.col("score").desc(), "doc_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _search_block(spark, items: list, documents: DataFrame, k: int, id_col: str, text_col: str, shard_postings: int) -> DataFrame:
    """Written best rows of every task for some items: at most ``k`` an item and task."""
    ids: dict[bytes, int] = {}
    queries = [(item_id, [ids.setdefault(t, len(ids)) for t in terms]) for item_id, terms in items]
    vocabulary = spark.sparkContext.broadcast(ids)
    shards = build_shards(documents, vocabulary, id_col, text_col, shard_postings)
    n_docs, n_terms = shards.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    if not n_docs:
        return spark.createDataFrame([], _BEST)
    counts = shards.select(F.explode(F.map_from_arrays("df_terms", "df_counts")).alias("term", "n")).groupBy("term").agg(F.sum("n").alias("df"))
    weights = _weights({r["term"]: r["df"] for r in counts.collect()}, len(ids), n_docs)  # a row a term of the block
    shared = spark.sparkContext.broadcast((queries, weights))
    schema = pa.schema([("item", pa.int32()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        queries, weights = shared.value
        best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in queries]
        for batch in batches:
            for i in range(batch.num_rows):
                shard = ShardSearch(batch.slice(i, 1).to_pylist()[0], weights, n_docs, n_terms)
                for item, (_, terms) in enumerate(queries):
                    docs, scores = best[item]
                    more, more_scores = shard.best(terms, k, int(scores[-1]) if len(scores) == k else 1)
                    docs, scores = np.append(docs, more), np.append(scores, more_scores)
                    first = np.lexsort((docs, -scores))[:k]
                    best[item] = docs[first], scores[first]
        for item, (docs, scores) in enumerate(best):
            if len(docs):
                columns = [pa.array([x] * len(docs), t) for x, t in ((item, pa.int32()), (queries[item][0], pa.int64()))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(docs), pa.array(scores)], schema=schema)

    out = written(shards.select("docs", "lengths", "terms", "starts", "places", "tfs").mapInArrow(run, _BEST))
    remove(shards)
    return out
