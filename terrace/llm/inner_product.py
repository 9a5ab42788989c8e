"""Exact search for the largest inner products: a ball tree per shard, branch and bound.

Vectors are dealt to shards by a hash of their id; every shard builds its own ball tree.
A query first searches the shard it lies in. The k-th best score it finds there is a score
that its final answer cannot fall below, and all other shards start from it. A node with
centre c and radius r holds no product above q.c + |q| r; nodes are opened from the largest
such bound down, and the search of a shard ends when the next bound is below the k-th score.

Components become integers, ``floor(scale * x)``, so products are exact and ties are real.

Defined results: null vectors, vectors with a null or non-finite component, and rows
without an id take no part. Vectors meet only vectors of as many components. Empty vectors
have product 0. A repeated row is a candidate as often as it occurs, but never for a query
with its own id. Equal scores go by the smaller id. Empty tables give empty results.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from terrace.llm.tables import parts

SHARD_ROWS = 16_384
QUERY_BLOCK = 8_192
LEAF_ROWS = 64
FOUND = "query_id long, query_hash long, vec_id long, score long"


class BallTree:
    """Balls over the rows of an integer matrix; ``order`` lists rows by leaf."""

    def __init__(self, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.order = np.arange(len(points))
        self.span: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        centres, radii = [], []
        todo = [(0, len(points), -1, 0)]
        while todo:
            low, high, parent, side = todo.pop()
            node = len(self.span)
            if parent >= 0:
                left, right = self.children[parent]
                self.children[parent] = (node, right) if side == 0 else (left, node)
            inside = points[self.order[low:high]]
            centre = inside.mean(axis=0)
            distance = np.sqrt(((inside - centre) ** 2).sum(axis=1))
            centres.append(centre)
            radii.append(distance.max())
            self.span.append((low, high))
            self.children.append(None)
            if high - low > leaf_rows and radii[-1] > 0:
                one = inside[distance.argmax()]
                other = inside[((inside - one) ** 2).sum(axis=1).argmax()]
                middle = (high - low) // 2
                halves = np.argpartition(inside @ (other - one), middle)
                self.order[low:high] = self.order[low:high][halves]
                self.children[node] = (-1, -1)
                todo += [(low, low + middle, node, 0), (low + middle, high, node, 1)]
        self.centres, self.radii = np.array(centres), np.array(radii)

    def bounds(self, query: np.ndarray) -> np.ndarray:
        exact = self.centres @ query + np.sqrt(query @ query) * self.radii
        return exact + 1e-9 * np.abs(exact) + 1e-6  # rounding may not cost an answer


def search(tree: BallTree, points, exact, ids, query, exact_query, own, k, least):
    """The k best (score, id) of one tree that are not below ``least``; ``own`` is left out."""
    bounds = tree.bounds(query)
    heap, best = [(-bounds[0], 0)], []
    kth = least
    while heap:
        bound, node = heapq.heappop(heap)
        if kth is not None and -bound < kth:
            break
        if (down := tree.children[node]) is not None:
            for child in down:
                if kth is None or bounds[child] >= kth:
                    heapq.heappush(heap, (-bounds[child], child))
            continue
        rows = tree.order[slice(*tree.span[node])]
        rows = rows[ids[rows] != own]
        best += zip((exact[rows] @ exact_query).tolist(), (-ids[rows]).tolist(), strict=True)
        if kth is not None:
            best = [x for x in best if x[0] >= kth]
        if len(best) > k:
            best = heapq.nlargest(k, best)
        if len(best) == k:
            kth = min(x[0] for x in best) if kth is None else max(kth, min(x[0] for x in best))
    return [(score, -i) for score, i in heapq.nlargest(k, best)]


def matrices(vectors: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """As doubles for bounds, and as integers that products cannot overflow."""
    exact = np.array([np.asarray(v, dtype=np.int64) for v in vectors]).reshape(len(vectors), -1)
    points = exact.astype(np.float64)
    largest = np.abs(points).max(initial=0) ** 2 * max(1, exact.shape[1])
    return points, points if largest < 2**52 else exact if largest < 2**62 else exact.astype(object)


def run_queries(vectors: pd.DataFrame, queries: pd.DataFrame, k: int):
    """(query row, its best (score, id)) for every query of a shard."""
    points, exact = matrices(vectors["v"])
    asked, exact_asked = matrices(queries["v"])
    kind = object if object in (exact.dtype, exact_asked.dtype) else np.int64 if np.int64 in (exact.dtype, exact_asked.dtype) else np.float64
    exact, exact_asked = exact.astype(kind), exact_asked.astype(kind)
    if kind is object:  # doubles in between are exact integers below 2**52
        exact = np.array([[int(x) for x in r] for r in exact], dtype=object).reshape(exact.shape)
        exact_asked = np.array([[int(x) for x in r] for r in exact_asked], dtype=object).reshape(exact_asked.shape)
    tree, ids = BallTree(points), vectors["vec_id"].to_numpy(dtype=np.int64)
    for i, row in enumerate(queries.itertuples(index=False)):
        least = None if pd.isna(row.least) else int(row.least)
        yield row, search(tree, points, exact, ids, asked[i], exact_asked[i], row.vec_id, k, least)


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component as double; null if the vector takes no part."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))))


def top_products(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    scale: int = 1024,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """For each row of ``vectors`` where ``queries`` holds, the k largest products with all other rows."""
    shards = parts(vectors, shard_rows)
    ready = (
        vectors.select(F.col(vec_id).cast("long").alias("vec_id"), whole_numbers(F.col(vector), scale).alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
        .where("vec_id IS NOT NULL AND v IS NOT NULL")
        .select("vec_id", "v", "asks", F.size("v").alias("components"), F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"))
    )
    blocks = parts(vectors.where(queries), query_block)

    def first_bound(shard: pd.DataFrame) -> pd.DataFrame:
        asking = shard[shard["asks"]].assign(least=None)
        found = run_queries(shard, asking, k) if len(asking) else ()
        return pd.DataFrame(
            [(r.vec_id, r.v, r.components, min(s for s, _ in best) if len(best) == k else None) for r, best in found],
            columns=["vec_id", "v", "components", "least"],
        )

    asking = ready.groupBy("shard", "components").applyInPandas(first_bound, "vec_id long, v array<bigint>, components int, least long")
    asking = asking.groupBy("vec_id", "v", "components").agg(F.max("least").alias("least"))
    asking = asking.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    )
    held = ready.drop("asks").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search_shard(shard: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if shard.empty or asked.empty:
            return pd.DataFrame(columns=["query_id", "query_hash", "vec_id", "score"])
        rows = [
            (r.vec_id, hash(tuple(r.v)) & (2**62 - 1), i, s) for r, best in run_queries(shard, asked, k) for s, i in best
        ]
        return pd.DataFrame(rows, columns=["query_id", "query_hash", "vec_id", "score"])

    keys = ("shard", "components", "block")
    found = held.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInPandas(search_shard, FOUND)
    best_first = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best_first))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast(T.IntegerType()), "vec_id", "score")
    )
