"""Hard negatives by inner product: a packed R-tree per shard, searched best first.

Vectors are scaled to integers (floor of 256 x), so that scores are exact.  They are dealt by a hash into shards of about
``SHARD_ROWS``, whatever their labels.  Each shard is an R-tree packed by sort-tile-recursion: rows are sorted and cut into
slabs by label, then by one coordinate after the other, and boxes are packed in the same way until one is left.  A
box knows the lowest and highest value of each coordinate and of the label; the products with an anchor's coordinates give
an interval that holds the score of every row inside.

The search keeps a queue of boxes by their highest possible score.  A box is left out if its interval misses every score
window, if its labels cannot be wanted, or if it is strictly below the k-th best of each window it could serve (strictly,
since a row of the same score may have a smaller id).  Positives are found with one open window among the rows of
the anchor's label, negatives with a window for each positive among the others.

Each pair of a shard and a block of anchors is one group of two rows; each anchor's best of all shards are then merged.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regfuse.llm.common import ship, written
from regfuse.session import remove

SHARD_ROWS, BLOCK_ROWS, LEAF, FANOUT = 8192, 512, 64, 16
_TREE = "dim int, shard int, ids binary, labels binary, vectors binary, lo binary, hi binary, first binary, size binary, leaf binary"
_FOUND = "anchor_key bigint, anchor_id bigint, slot int, id bigint, score bigint"


def tiled(points: np.ndarray, size: int) -> list[np.ndarray]:
    """Sort-tile-recursion: the rows of ``points`` in groups of at most ``size``, neighbours by their coordinates.

    A slab of P pages and c coordinates left is sorted by the next one and cut into the c-th root of P slabs."""
    done, todo = [], [(np.arange(len(points)), 0)]
    while todo:
        rows, c = todo.pop()
        pages = -(-len(rows) // size)
        if pages <= 1:
            done.append(rows)
            continue
        left = max(1, points.shape[1] - c)
        # the label comes first and has few values; every other coordinate halves at least
        slabs = pages if left == 1 else max(2, int(np.ceil(pages ** (1 / left))))
        if c == 0 and points.shape[1] > 1:
            slabs = min(pages, len(np.unique(points[rows, 0])))
        rows = rows[np.argsort(points[rows, min(c, points.shape[1] - 1)], kind="stable")]
        step = -(-pages // slabs) * size
        todo += [(rows[i : i + step], c + 1) for i in range(0, len(rows), step)][::-1]
    return done


class Tree:
    """Boxes by node: label and coordinate bounds, and where its rows (leaf) or its children start, and how many."""

    def __init__(self, ids, labels, vectors, lo, hi, first, size, leaf):
        self.ids, self.labels, self.vectors, self.lo, self.hi = ids, labels, vectors, lo, hi
        self.first, self.size, self.leaf = first, size, leaf

    @classmethod
    def packed(cls, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, leaf: int = LEAF, fanout: int = FANOUT) -> Tree:
        points = np.column_stack([labels, vectors]).astype(np.float64)
        spread = 1 + np.argsort(-vectors.astype(np.float64).var(axis=0), kind="stable") if len(vectors) else np.arange(1, points.shape[1])
        points = points[:, np.append(0, spread).astype(int)]  # widest coordinates first
        groups = tiled(points, leaf)
        order = np.concatenate(groups)
        ids, labels, vectors = ids[order], labels[order], vectors[order]
        whole = np.column_stack([labels, vectors])
        size = np.array([len(g) for g in groups])
        first = np.cumsum(size) - size
        lo, hi = np.minimum.reduceat(whole, first, axis=0), np.maximum.reduceat(whole, first, axis=0)
        levels = [(lo, hi, first, size, True)]
        while len(levels[-1][0]) > 1:  # children of a box stand together
            lo, hi, first, size, bottom = levels[-1]
            groups = tiled((lo.astype(np.float64) + hi)[:, np.append(0, spread).astype(int)], fanout)
            order = np.concatenate(groups)
            levels[-1] = lo, hi, first, size, bottom = lo[order], hi[order], first[order], size[order], bottom
            size = np.array([len(g) for g in groups])
            first = np.cumsum(size) - size
            levels.append((np.minimum.reduceat(lo, first, axis=0), np.maximum.reduceat(hi, first, axis=0), first, size, False))
        levels.reverse()  # the root is node 0
        starts = np.cumsum([0] + [len(x[0]) for x in levels])
        first = np.concatenate([x[2] + (0 if x[4] else starts[i + 1]) for i, x in enumerate(levels)])
        return cls(ids, labels, vectors, np.concatenate([x[0] for x in levels]), np.concatenate([x[1] for x in levels]), first,
                   np.concatenate([x[3] for x in levels]), np.concatenate([np.full(len(x[0]), x[4]) for x in levels]))


def _number_type(a: np.ndarray, b: np.ndarray):
    """In which numbers all inner products of two sets of integer vectors are exact."""
    most = a.shape[1] * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if most >= 2**63:
        raise ValueError("inner products of these vectors do not fit 64 bits")
    return np.float64 if most < 2**53 else np.int64


class Search:
    """The best rows of one tree for each anchor and window; ``seen`` counts the compared pairs."""

    def __init__(self, tree: Tree, anchors: np.ndarray, anchor_ids: np.ndarray, anchor_labels: np.ndarray, k: int, same: bool):
        self.tree, self.k, self.same, self.seen = tree, k, same, 0
        kind = _number_type(anchors, tree.vectors)
        self.anchors, self.vectors = anchors.astype(kind), tree.vectors.astype(kind)
        self.ids, self.labels = anchor_ids, anchor_labels
        up, down = np.maximum(self.anchors, 0), np.minimum(self.anchors, 0)
        lo, hi = tree.lo[:, 1:].astype(kind), tree.hi[:, 1:].astype(kind)
        self.upper, self.lower = up @ hi.T + down @ lo.T, up @ lo.T + down @ hi.T

    def _open(self, nodes: np.ndarray, i: int, floor: np.ndarray, ceiling: np.ndarray) -> np.ndarray:
        """Which boxes may hold a wanted row of a window."""
        lo, hi, own = self.tree.lo[nodes, 0], self.tree.hi[nodes, 0], self.labels[i]
        wanted = (lo <= own) & (own <= hi) if self.same else (lo != own) | (hi != own)
        reach = (self.upper[i, nodes][:, None] >= floor) & (self.lower[i, nodes][:, None] <= ceiling)
        return wanted & reach.any(axis=1)

    def best(self, i: int, low: np.ndarray, high: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For anchor ``i`` and each window of scores [low, high]: ids and scores of the k best, ties by id."""
        t, a, k = self.tree, self.anchors[i], self.k
        floor = np.array(low, self.upper.dtype)
        found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in floor]
        queue = [(-self.upper[i, 0], 0)] if len(t.ids) and self._open(np.array([0]), i, floor, high)[0] else []
        while queue:
            top, node = heapq.heappop(queue)
            if -top < floor.min():
                break  # below every window or its k-th best, and so are all that follow
            if not ((-top >= floor) & (self.lower[i, node] <= high)).any():
                continue
            part = slice(t.first[node], t.first[node] + t.size[node])
            if not t.leaf[node]:
                children = np.arange(part.start, part.stop)
                for child in children[self._open(children, i, floor, high)]:
                    heapq.heappush(queue, (-self.upper[i, child], int(child)))
                continue
            scores = self.vectors[part] @ a
            self.seen += len(scores)
            wanted = (t.labels[part] == self.labels[i]) if self.same else (t.labels[part] != self.labels[i])
            wanted &= (t.ids[part] != self.ids[i]) & (scores >= floor.min()) & (scores <= high.max())
            if not wanted.any():
                continue
            ids, scores = t.ids[part][wanted], scores[wanted]
            for w in range(len(floor)):
                at = (scores >= floor[w]) & (scores <= high[w])
                if at.any():
                    more = np.append(found[w][0], ids[at]), np.append(found[w][1], scores[at].astype(np.int64))
                    first = np.lexsort((more[0], -more[1]))[:k]
                    found[w] = more[0][first], more[1][first]
                    if len(first) == k:
                        floor[w] = max(floor[w], found[w][1][-1])
        return found


def scaled(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """id, label, v (floor of 256 times each component, in double precision) of the rows that take part, each once."""
    v = rows[vector_col].cast("array<double>")
    ok = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    out = rows.select(rows[id_col].cast("bigint").alias("id"), rows[label_col].cast("bigint").alias("label"), v.alias("x"))
    out = out.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & ok)
    return out.select("id", "label", F.transform("x", lambda c: F.floor(c * 256.0).cast("bigint")).alias("v")).distinct()


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A written table with a tree per shard, of ``scaled`` rows; vectors of different lengths are in different shards."""
    v = vectors.withColumn("dim", F.size("v"))
    sizes = v.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("shards"))
    v = v.join(sizes, "dim").withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.col("shards")).cast("int"))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", kind="stable")
        x = np.array(rows["v"].tolist(), np.int64).reshape(len(rows), -1)
        t = Tree.packed(rows["id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64), x)
        whole = {"ids": t.ids, "labels": t.labels, "vectors": t.vectors, "lo": t.lo, "hi": t.hi, "first": t.first, "size": t.size, "leaf": t.leaf}
        own = rows[["dim", "shard"]].iloc[:1].reset_index(drop=True)
        return own.assign(**{k: [a.astype(bool if k == "leaf" else np.int64).tobytes()] for k, a in whole.items()})

    return written(v.select("dim", "shard", "id", "label", "v").groupBy("dim", "shard").applyInPandas(pack, _TREE))


def _tree_of(row) -> Tree:
    dim = int(row["dim"])
    get = lambda k: np.frombuffer(row[k], np.int64)
    boxes = lambda k: get(k).reshape(-1, dim + 1)
    ids = get("ids")
    return Tree(ids, get("labels"), get("vectors").reshape(len(ids), dim), boxes("lo"), boxes("hi"), get("first"), get("size"),
                np.frombuffer(row["leaf"], bool))


def _searched(index: DataFrame, anchors: DataFrame, k: int, same: bool, block_rows: int) -> DataFrame:
    """``anchors``: key, id, label, v, low and high (arrays of windows).  Written best rows of every shard: the anchor's
    key and id, slot (the window's place), id, score."""
    a = anchors.withColumn("dim", F.size("v"))
    shards = index.groupBy("dim").agg((F.max("shard") + 1).alias("shards"))
    blocks = a.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    sizes = written(shards.join(blocks, "dim"))  # a row a length of vectors
    trees = index.join(sizes, "dim").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    a = a.join(sizes, "dim").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    a = a.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))

    def run(tree: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(tree) and len(block):
            t = _tree_of(tree.iloc[0])
            x = np.array(block["v"].tolist(), np.int64).reshape(len(block), -1)
            s = Search(t, x, block["id"].to_numpy(np.int64), block["label"].to_numpy(np.int64), k, same)
            for i, (key, anchor, low, high) in enumerate(zip(block["key"], block["id"], block["low"], block["high"], strict=True)):
                for slot, (ids, scores) in enumerate(s.best(i, np.asarray(low, np.int64), np.asarray(high, np.int64))):
                    out.append(np.column_stack([np.tile([key, anchor, slot], (len(ids), 1)).astype(np.int64), ids, scores]))
        whole = np.concatenate(out) if out else np.empty((0, 5), np.int64)
        return pd.DataFrame(whole, columns=["anchor_key", "anchor_id", "slot", "id", "score"])

    by = ["dim", "shard", "block"]
    left = trees.drop("shards", "blocks")
    right = a.select(*by, "key", "id", "label", "v", "low", "high")
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)  # their columns come from the same tables
    out = written(left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(run, _FOUND))
    remove(sizes)
    return out


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Hard negatives of each anchor and positive: anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score.  ``vectors`` and ``anchors`` are ``scaled`` rows; an anchor need not be one of the vectors.

    An anchor's positives are its first ``positives`` other rows of the same label; each positive's negatives are the first
    ``negatives`` rows of another label with ``low`` to ``high`` per cent of the positive's score.  Higher scores come
    first, ties by smaller id.  Rows with the anchor's own id are neither.

    Fewer rows than asked for are all returned; an anchor without a positive, and a positive whose score leaves no window (0
    or below: only a score of exactly 0 can match a positive of 0), give what there is, or nothing.  Rows without id,
    label or vector, or with a null or non-finite component, take no part; rows that repeat id, label and vector count once, two
    vectors under one id are two rows.  Vectors of different lengths are not compared.  Empty tables give an empty result; a
    score that would not fit 64 bits is an error.
    """
    ship(vectors.sparkSession)
    index = build_index(vectors, shard_rows)
    a = written(anchors.withColumn("key", F.xxhash64("id", "label", "v")))
    whole = {"low": F.array(F.lit(-(2**63))), "high": F.array(F.lit(2**63 - 1))}
    first = _searched(index, a.withColumns(whole), positives, True, block_rows)
    order = Window.partitionBy("anchor_key", "anchor_id").orderBy(F.col("score").desc(), "id")
    first = written(first.withColumn("slot", F.row_number().over(order)).where(F.col("slot") <= positives))
    # bounds of the windows: the least and the greatest integer within; none for a score below 0
    windows = first.groupBy("anchor_key", "anchor_id").agg(F.sort_array(F.collect_list(F.struct("slot", "score"))).alias("w"))  # few each
    windows = windows.select("anchor_key", "anchor_id",
                             F.expr(f"transform(w, x -> if(x.score < 0, 1L, (x.score * {low} + 99) div 100))").alias("low"),
                             F.expr(f"transform(w, x -> if(x.score < 0, 0L, (x.score * {high}) div 100))").alias("high"))
    with_windows = a.join(windows, (a["key"] == windows["anchor_key"]) & (a["id"] == windows["anchor_id"]))
    found = _searched(index, with_windows.select(a["*"], "low", "high"), negatives, False, block_rows)
    found = found.select("anchor_key", "anchor_id", (F.col("slot") + 1).alias("slot"), F.col("id").alias("negative_id"),
                         F.col("score").alias("negative_score"))
    order = Window.partitionBy("anchor_key", "anchor_id", "slot").orderBy(F.col("negative_score").desc(), "negative_id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    positive = first.select("anchor_key", "anchor_id", "slot", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = found.join(positive, ["anchor_key", "anchor_id", "slot"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
