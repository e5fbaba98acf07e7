"""Exact top-k inner-product search: ball-tree branch and bound per shard.

Candidates are dealt into shards and each shard becomes one packed ball tree;
queries are packed into blocks.  A task searches one block through a few
shards: a node is visited best bound first, bound = q.centre +
|q| * radius, and skipped when that is below the query's current k-th score.
The k-th scores carry over from shard to shard of a task, and start from a
first pass over one shard.  Scores are whole numbers; equal scores are never
pruned, so ties go to the smaller id exactly.
"""

from __future__ import annotations

import heapq
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import sized_broadcast
from .common import frozen, python_ready

SHARD_ROWS = 4096
BLOCK_QUERIES = 128
#: Shards that one task searches in turn, sharing the k-th scores.
SHARDS_TOGETHER = 4
LEAF = 64

_TREE = "dim int, shard int, ids binary, vectors binary, nodes binary, centres binary, radii binary"
_FOUND = "query_id bigint, vec_id bigint, score bigint"


def quantised(column: str, scale: int = 1024) -> Column:
    """floor(scale * x) of every component as long; null when the vector or any
    component is null or not finite, or the vector is empty."""
    v = F.transform(F.col(column), lambda x: x.cast("double"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(v, lambda x: F.floor(x * scale).cast("bigint"))
    return F.when(F.col(column).isNotNull() & (F.size(F.col(column)) > 0) & ~F.coalesce(bad, F.lit(True)),
                  whole)


def build_tree(vectors: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, ...]:
    """(order, nodes, centres, radii).  A node is (first row, last row, left, right) over
    ``order``; leaves have left = -1.  Equal vectors stay together in one leaf."""
    order = np.arange(len(vectors))
    points = vectors.astype(np.float64)
    nodes, centres, radii = [], [], []
    todo = [(0, len(order), -1, 0)]
    while todo:
        lo, hi, parent, side = todo.pop()
        own = points[order[lo:hi]]
        centre = own.mean(axis=0)
        gaps = np.sqrt(((own - centre) ** 2).sum(axis=1))
        me = len(nodes)
        nodes.append([lo, hi, -1, -1])
        centres.append(centre)
        radii.append(float(gaps.max()) * (1 + 1e-9) + 1e-6)
        if parent >= 0:
            nodes[parent][2 + side] = me
        if hi - lo <= leaf or not gaps.any():
            continue
        far = own[gaps.argmax()]
        other = own[((own - far) ** 2).sum(axis=1).argmax()]
        along = own @ (other - far)
        cut = (hi - lo) // 2
        rank = np.argsort(along, kind="stable")
        order[lo:hi] = order[lo:hi][rank]
        todo += [(lo, lo + cut, me, 0), (lo + cut, hi, me, 1)]
    return order, np.array(nodes, dtype=np.int64), np.array(centres), np.array(radii)


class Tree:
    """A shard's tree as unpacked from its row."""

    def __init__(self, row, dim: int):
        self.ids = np.frombuffer(row.ids, dtype="<i8")
        self.vectors = np.frombuffer(row.vectors, dtype="<i8").reshape(-1, dim)
        self.nodes = np.frombuffer(row.nodes, dtype="<i8").reshape(-1, 4)
        self.centres = np.frombuffer(row.centres, dtype="<f8").reshape(-1, dim)
        self.radii = np.frombuffer(row.radii, dtype="<f8")
        peak = float(np.abs(self.vectors).max()) if len(self.vectors) else 0.0
        self.peak = peak * dim
        self.floats = self.vectors.astype(np.float64)

    def scores(self, lo: int, hi: int, q: np.ndarray) -> np.ndarray:
        """Exact inner products of rows lo..hi; floating point while it is exact."""
        if self.peak * float(np.abs(q).max()) < 2.0 ** 52:
            return (self.floats[lo:hi] @ q.astype(np.float64)).astype(np.int64)
        return self.vectors[lo:hi] @ q

    def search(self, q_id: int, q: np.ndarray, k: int, best: list[tuple[int, int]]) -> None:
        """Improve ``best``, a heap of at most k (score, -id) with the worst on top."""
        qf = q.astype(np.float64)
        norm = float(np.sqrt(qf @ qf))
        bounds = self.centres @ qf + norm * self.radii
        bounds += np.abs(bounds) * 1e-9 + 1e-3
        queue = [(-bounds[0], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            if len(best) == k and -bound < best[0][0]:
                return  # every other node is bounded lower still
            lo, hi, left, right = self.nodes[node]
            if left >= 0:
                for child in (left, right):
                    if len(best) < k or bounds[child] >= best[0][0]:
                        heapq.heappush(queue, (-bounds[child], child))
                continue
            scores, ids = self.scores(lo, hi, q), self.ids[lo:hi]
            keep = np.flatnonzero(scores >= best[0][0]) if len(best) == k else np.arange(hi - lo)
            if len(keep) > k + 1:  # in a leaf of equal vectors only the smallest ids can count
                keep = keep[np.lexsort((ids[keep], -scores[keep]))[:k + 1]]
            for i in keep:
                item = (int(scores[i]), -int(ids[i]))
                if ids[i] == q_id:
                    continue
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)


def ball_trees(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard of ``(vec_id, v, dim)``; about ``shard_rows`` vectors each."""
    counts = vectors.groupBy("dim").agg(F.count(F.lit(1)).alias("__n"))
    shards = F.greatest(F.lit(1), F.ceil(F.col("__n") / shard_rows)).cast("int")
    # one row per dimension length; sized before it is broadcast
    dealt = (vectors.join(sized_broadcast(counts.select(F.col("dim").alias("__d"), shards.alias("__s"))),
                          F.col("dim") == F.col("__d"))
             .withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.col("__s")).cast("int"))
             .select("dim", "shard", "vec_id", "v"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id", kind="stable")
        v = np.array(pdf["v"].tolist(), dtype=np.int64)
        order, nodes, centres, radii = build_tree(v)
        ids = pdf["vec_id"].to_numpy(dtype=np.int64)[order]
        return pd.DataFrame([[int(pdf["dim"].iloc[0]), int(pdf["shard"].iloc[0])] + [
            np.ascontiguousarray(a).tobytes() for a in (ids, v[order], nodes, centres, radii)]],
            columns=["dim", "shard", "ids", "vectors", "nodes", "centres", "radii"])

    return python_ready(dealt).groupBy("dim", "shard").applyInPandas(build, _TREE)


def query_blocks(queries: DataFrame, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """``(dim, block, query_ids, query_vectors)``: about ``block_queries`` queries a row."""
    counts = queries.groupBy("dim").agg(F.count(F.lit(1)).alias("__n"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("__n") / block_queries)).cast("int")
    dealt = queries.join(sized_broadcast(counts.select(F.col("dim").alias("__d"), blocks.alias("__b"))),
                         F.col("dim") == F.col("__d"))
    q = F.struct("vec_id", "v")
    return (dealt.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.col("__b")).cast("int"))
            .groupBy("dim", "block").agg(F.sort_array(F.collect_list(q)).alias("qs"))
            .select("dim", "block", F.transform("qs", lambda x: x["vec_id"]).alias("query_ids"),
                    F.transform("qs", lambda x: x["v"]).alias("query_vectors")))


def _search(pairs: DataFrame, k: int) -> DataFrame:
    """Top k of each query of a block over a group of ``SHARDS_TOGETHER`` shards."""
    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard")
        head = pdf.iloc[0]
        queries = [(int(i), np.asarray(v, dtype=np.int64))
                   for i, v in zip(head.query_ids, head.query_vectors)]
        # a floor is a score that k others are known to reach
        floors = head.floors if head.floors is not None else [None] * len(queries)
        best: dict[int, list] = {i: [] for i, _ in queries}
        for row in pdf.itertuples():
            tree = Tree(row, int(row.dim))
            for (i, q), floor in zip(queries, floors):
                _search_one(tree, i, q, k, best[i], floor)
        rows = [(q, -i, s) for q, heap in best.items() for s, i in heap]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    return (pairs.withColumn("together", F.floor(F.col("shard") / SHARDS_TOGETHER))
            .groupBy("dim", "block", "together").applyInPandas(work, _FOUND))


def _search_one(tree: Tree, i: int, q: np.ndarray, k: int, best: list, floor) -> None:
    """Search one tree, treating ``floor`` as the k-th score while ``best`` is short of it."""
    if floor is not None and not pd.isna(floor) and (len(best) < k or best[0][0] < floor):
        filler = [(int(floor), -(1 << 62))] * k
        heap = sorted([b for b in best if b[0] >= floor] + filler, reverse=True)[:k]
        heapq.heapify(heap)
        tree.search(i, q, k, heap)
        best[:] = [b for b in heap if b[1] != -(1 << 62)]
        heapq.heapify(best)
        return
    tree.search(i, q, k, best)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = SHARD_ROWS,
          block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` highest inner products of every query
    among the vectors with another id, equal scores to the smaller id, all if fewer.

    ``vectors`` and ``queries`` are ``(vec_id, v)`` with whole-number arrays; rows with a
    null id or vector take no part; only vectors of equal length are compared; a row
    repeated exactly counts once; of one id with several vectors each is a candidate
    and each query keeps its own id out.  Empty inputs give an empty result.
    """
    def ready(df: DataFrame) -> DataFrame:
        return (df.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
                .select(F.col("vec_id").cast("bigint").alias("vec_id"), "v").distinct()
                .withColumn("dim", F.size("v")))

    trees = frozen(ball_trees(ready(vectors), shard_rows))
    blocks = query_blocks(ready(queries), block_queries)
    none = F.lit(None).cast("array<bigint>")
    first = trees.where(F.col("shard") == 0)

    def met(trees: DataFrame, blocks: DataFrame) -> DataFrame:
        # every block meets every shard: the stated query set against all rows, in blocks
        last = trees.groupBy("dim").agg(F.max("shard").alias("__last"))
        grid = (blocks.join(sized_broadcast(last), "dim")
                .withColumn("shard", F.explode(F.sequence(F.lit(0), "__last"))).drop("__last"))
        return grid.join(trees, ["dim", "shard"])

    opening = _search(met(first, blocks.withColumn("floors", none)), k)
    kth = (opening.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s"))
           .where(F.col("n") >= k).select("query_id", F.col("s").alias("floor")))
    floors = (blocks.select("dim", "block", F.posexplode("query_ids").alias("at", "query_id"))
              .join(kth, "query_id", "left").groupBy("dim", "block")
              .agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "floor"))),
                               lambda x: x["floor"]).alias("floors")))
    found = _search(met(trees, blocks.join(floors, ["dim", "block"])), k)
    by_score = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(by_score))
            .where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
