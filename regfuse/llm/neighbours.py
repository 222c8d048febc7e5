"""Nearest neighbours by cosine: a vantage-point tree per shard, searched by blocks of queries.

On unit vectors the chord is a metric that orders by cosine.  Vectors are dealt by a hash into shards of about
``SHARD_ROWS``; each shard is a tree: a node takes a vantage point and splits the rest at the median distance from it.  A
search enters the nearer side first and the other side only if the triangle inequality leaves room there: if the distance
to the border is at most ``tau / relax``, where tau is the distance of the k-th best so far.  ``relax`` 1 is the exact
search, larger values prune more and may miss.  The index is a written table, one row a shard, and can be searched again.

Each pair of a shard and a block of queries is one group of two rows; the best k of each query per shard are then merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regfuse.llm.common import written

SHARD_ROWS, BLOCK_ROWS, LEAF = 4096, 1024, 32
_SLACK = 1e-9  # of rounding, against ties lost
_INDEX = "dim int, shard int, ids binary, vectors binary, points binary, mu binary, inner binary, outer binary"


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.sqrt((v * v).sum(axis=1))[:, None]


def build(unit: np.ndarray, leaf: int = LEAF) -> tuple[list, list, list, list]:
    """The tree as lists by node: its points (leaf: all; else the vantage point), border, inner and outer child (-1)."""
    points, mu, inner, outer = [], [], [], []

    def add(p):
        points.append(p), mu.append(0.0), inner.append(-1), outer.append(-1)
        return len(points) - 1

    todo = [(add(None), np.arange(len(unit)))]
    while todo:
        node, rows = todo.pop()
        points[node] = rows
        if len(rows) <= leaf:
            continue
        # the candidate vantage point whose distances to a few others spread most
        step = max(1, len(rows) // 8)
        some = rows[:: max(1, len(rows) // 64)]
        spread = [np.var(np.linalg.norm(unit[some] - unit[c], axis=1)) for c in rows[::step]]
        vantage = rows[::step][int(np.argmax(spread))]
        rest = rows[rows != vantage]
        d = np.linalg.norm(unit[rest] - unit[vantage], axis=1)
        border = float(np.median(d))
        near = d <= border
        if near.all():
            continue  # all at one distance: a leaf, whatever its size
        points[node], mu[node] = np.array([vantage]), border
        inner[node], outer[node] = add(None), add(None)
        todo += [(inner[node], rest[near]), (outer[node], rest[~near])]
    return points, mu, inner, outer


class Search:
    """The k best rows of one tree for each of some queries; ``seen`` counts the compared pairs."""

    def __init__(self, tree, unit, ids, queries, query_ids, k: int, relax: float = 1.0):
        self.points, self.mu, self.inner, self.outer = tree
        self.unit, self.ids, self.queries, self.query_ids, self.relax, self.seen = unit, ids, queries, query_ids, relax, 0
        self.best = np.full((len(queries), k), -np.inf)
        self.found = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.rows = np.full((len(queries), k), -1)

    def _compare(self, node: int, active: np.ndarray) -> np.ndarray:
        """Offer a node's points to some queries; their cosines.  Summed pair by pair, so that equal vectors tie."""
        at = self.points[node]
        sims = np.empty((len(active), len(at)))
        for i in range(0, len(active), max(1, 200_000 // max(1, len(at)))):
            part = active[i : i + max(1, 200_000 // max(1, len(at)))]
            sims[i : i + len(part)] = (self.queries[part][:, None, :] * self.unit[at][None, :, :]).sum(axis=2)
        self.seen += sims.size
        own = self.ids[at][None, :] == self.query_ids[active][:, None]
        offer = np.where(own, -np.inf, sims)
        some = (offer >= self.best[active, -1][:, None]).any(axis=1)
        if some.any():
            q = active[some]
            s = np.concatenate([self.best[q], offer[some]], axis=1)
            ids = np.concatenate([self.found[q], np.broadcast_to(self.ids[at], (len(q), len(at)))], axis=1)
            rows = np.concatenate([self.rows[q], np.broadcast_to(at, (len(q), len(at)))], axis=1)
            ids = np.where(np.isneginf(s), np.iinfo(np.int64).max, ids)
            first = np.lexsort((ids, -s), axis=1)[:, : self.best.shape[1]]
            self.best[q] = np.take_along_axis(s, first, 1)
            self.found[q] = np.take_along_axis(ids, first, 1)
            self.rows[q] = np.take_along_axis(rows, first, 1)
        return sims

    def run(self) -> Search:
        if len(self.queries) and len(self.points):
            self._visit(0, np.arange(len(self.queries)))
        return self

    def _visit(self, node: int, active: np.ndarray) -> None:
        sims = self._compare(node, active)
        if self.inner[node] < 0:
            return
        d = np.sqrt(np.maximum(0, 2 - 2 * sims[:, 0]))
        inside = d <= self.mu[node]
        for first, second, side in ((self.inner[node], self.outer[node], inside), (self.outer[node], self.inner[node], ~inside)):
            if side.any():
                self._visit(first, active[side])
                tau = np.sqrt(np.maximum(0, 2 - 2 * self.best[active[side], -1]))  # infinite while fewer than k are known
                gap = np.abs(d[side] - self.mu[node])
                open_ = gap <= tau / self.relax + _SLACK
                if open_.any():
                    self._visit(second, active[side][open_])


def _valid(column):
    """Vectors that take part: not null, no null or non-finite component, not all zero."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return column.isNotNull() & (F.size(column) > 0) & finite & F.exists(column, lambda x: x != 0)


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A written table with a tree per shard; every valid vector with an id is in one.  Vectors of different lengths are
    in different shards."""
    v = vectors.select(vectors[id_col].cast("bigint").alias("id"), vectors[vector_col].cast("array<double>").alias("v"))
    v = v.where(F.col("id").isNotNull() & _valid(F.col("v"))).withColumn("dim", F.size("v"))
    sizes = v.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("shards"))
    v = v.join(written(sizes), "dim")
    v = v.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.col("shards")).cast("int"))

    def tree(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", kind="stable")
        x = np.array(rows["v"].tolist(), np.float64)
        points, mu, inner, outer = build(_unit(x))
        sizes = np.array([len(p) for p in points], np.int32)
        order = np.concatenate([sizes, *points]).astype(np.int32)
        return pd.DataFrame({
            "dim": rows["dim"].iloc[:1].to_numpy(), "shard": rows["shard"].iloc[:1].to_numpy(), "ids": [rows["id"].to_numpy(np.int64).tobytes()],
            "vectors": [x.tobytes()], "points": [order.tobytes()], "mu": [np.array(mu).tobytes()],
            "inner": [np.array(inner, np.int32).tobytes()], "outer": [np.array(outer, np.int32).tobytes()],
        })

    return written(v.select("dim", "shard", "id", "v").groupBy("dim", "shard").applyInPandas(tree, _INDEX))


def _search(k: int, relax: float):
    def run(index: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"key": [], "query_id": [], "vec_id": [], "score": []}).astype({"key": "int64", "query_id": "int64", "vec_id": "int64"})
        if index.empty or block.empty:
            return empty
        i, b = index.iloc[0], block.iloc[0]
        ids, query_ids = np.frombuffer(i["ids"], np.int64), np.frombuffer(b["ids"], np.int64)
        keys = np.frombuffer(b["keys"], np.int64)
        x = np.frombuffer(i["vectors"], np.float64).reshape(len(ids), -1)
        q = np.frombuffer(b["vectors"], np.float64).reshape(len(query_ids), -1)
        mu, inner, outer = np.frombuffer(i["mu"]), np.frombuffer(i["inner"], np.int32), np.frombuffer(i["outer"], np.int32)
        flat = np.frombuffer(i["points"], np.int32)
        points = np.split(flat[len(mu) :], np.cumsum(flat[: len(mu)])[:-1])
        s = Search((points, mu, inner, outer), _unit(x), ids, _unit(q), query_ids, k, relax).run()
        at, rank = np.nonzero(s.rows >= 0)
        if not len(at):
            return empty
        a, c = q[at], x[s.rows[at, rank]]
        score = (a * c).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((c * c).sum(axis=1)))
        return pd.DataFrame({"key": keys[at], "query_id": query_ids[at], "vec_id": s.found[at, rank], "score": score})

    return run


def nearest(queries: DataFrame, index: DataFrame, k: int = 5, relax: float = 1.0, id_col: str = "vec_id",
            vector_col: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The ``k`` nearest indexed vectors of each query (all, if fewer): query_id, rank (from 1), vec_id, score (cosine in
    double precision); ties go to the smaller vec_id.

    Rows of the index with the query's own id are not its neighbours.  A query whose vector is null, zero, or holds null or
    non-finite components, or whose id is null, gives no rows; vectors of another length are not compared.  Rows that
    repeat an id are one query each if their vectors differ.  Other columns are ignored; empty tables give an empty result.
    """
    q = queries.select(queries[id_col].cast("bigint").alias("id"), queries[vector_col].cast("array<double>").alias("v"))
    q = q.where(F.col("id").isNotNull() & _valid(F.col("v"))).withColumn("dim", F.size("v")).distinct()
    sizes = q.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    q = q.join(written(sizes), "dim").withColumn("key", F.xxhash64("id", "v"))  # two vectors under one id are two queries
    q = q.withColumn("block", F.pmod("key", F.col("blocks")).cast("int"))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", kind="stable")
        x = np.array(rows["v"].tolist(), np.float64)
        return pd.DataFrame({"dim": rows["dim"].iloc[:1].to_numpy(), "block": rows["block"].iloc[:1].to_numpy(),
                             "ids": [rows["id"].to_numpy(np.int64).tobytes()], "keys": [rows["key"].to_numpy(np.int64).tobytes()],
                             "vectors": [x.tobytes()]})

    packed = "dim int, block int, ids binary, keys binary, vectors binary"
    blocks = written(q.select("dim", "block", "id", "key", "v").groupBy("dim", "block").applyInPandas(pack, packed))
    pairs = index.select("dim", "shard").join(blocks.select("dim", "block"), "dim")  # a row for each shard and block
    left, right = index.join(pairs, ["dim", "shard"]), blocks.join(pairs, ["dim", "block"])
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)  # their columns come from the same tables
    by = ("dim", "shard", "block")
    found = written(
        left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(_search(k, relax), "key bigint, query_id bigint, vec_id bigint, score double")
    )
    order = Window.partitionBy("query_id", "key").orderBy(F.col("score").desc(), "vec_id")
    best = found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
