"""Exact top-k by inner product, with a KD-tree for every shard of the vectors."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslink.operators.scale import materialize

LEAF = 128


@dataclass
class Tree:
    """Boxes of a KD-tree; node j has the rows first[j] to last[j] of `ids` and `vectors`."""

    ids: np.ndarray
    vectors: np.ndarray
    low: np.ndarray
    high: np.ndarray
    least_id: np.ndarray
    first: np.ndarray
    last: np.ndarray
    child: np.ndarray


def build(ids: np.ndarray, vectors: np.ndarray) -> Tree:
    """Median splits of the widest side, down to leaves of at most `LEAF` rows; boxes are tight."""
    order = np.arange(len(ids))
    nodes, todo = [], [(0, len(ids), -1)]
    while todo:
        a, b, parent = todo.pop()
        rows = order[a:b]
        low, high = vectors[rows].min(0), vectors[rows].max(0)
        nodes.append([low, high, ids[rows].min(), a, b, -1])
        if parent >= 0 and nodes[parent][5] < 0:
            nodes[parent][5] = len(nodes) - 1
        elif parent >= 0:
            nodes[parent].append(len(nodes) - 1)
        if b - a > LEAF:
            side = int((high - low).argmax())
            half = (b - a) // 2
            order[a:b] = rows[np.argpartition(vectors[rows, side], half)]
            todo += [(a, a + half, len(nodes) - 1), (a + half, b, len(nodes) - 1)]
    child = np.array([[n[5], n[6]] if n[5] >= 0 else [-1, -1] for n in nodes])
    low, high, least, first, last = (np.array([n[k] for n in nodes]) for k in range(5))
    return Tree(ids[order], vectors[order], low, high, least, first, last, child)


def search(tree: Tree, ids: np.ndarray, queries: np.ndarray, known: np.ndarray, k: int,
           leaves: int | None = None) -> list[tuple[int, int, int]]:
    """(query row, id, score) of the best k of each query, ties to the smaller id.

    Best first: the node whose box allows the largest product comes next, and the
    search ends when it allows less than the k-th score, of this tree or, as `known`, of
    others; at the same score, when it holds no smaller id. `leaves` ends it after so many.
    """
    bounds = np.maximum(queries, 0) @ tree.high.T + np.minimum(queries, 0) @ tree.low.T
    out = []
    for q in range(len(queries)):
        best: list[tuple] = []  # heap of (score, -id)
        heap, seen = [(-bounds[q, 0], 0)], 0
        while heap:
            bound, node = heapq.heappop(heap)
            bound = -bound
            if bound < known[q]:
                break
            if len(best) == k:
                if bound < best[0][0]:
                    break
                if bound == best[0][0] and tree.least_id[node] > -best[0][1]:
                    continue
            if tree.child[node, 0] >= 0:
                for c in tree.child[node]:
                    heapq.heappush(heap, (-bounds[q, c], int(c)))
                continue
            a, b = tree.first[node], tree.last[node]
            scores = tree.vectors[a:b] @ queries[q]
            least = max(known[q], best[0][0]) if len(best) == k else known[q]
            for row in np.flatnonzero((scores >= least) & (tree.ids[a:b] != ids[q])):
                item = (scores[row], -int(tree.ids[a + row]))
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
            seen += 1
            if leaves and seen >= leaves:
                break
        out += [(q, -i, int(s)) for s, i in best]
    return out


def _numbers(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.int64) for v in column])


def _searched(vectors: DataFrame, queries: DataFrame, k: int, leaves: int | None) -> DataFrame:
    """Best k of every query in every shard; one task holds one shard and one block of queries."""
    def find(part: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(part) or not len(asked):
            return pd.DataFrame({"query": [], "vec_id": [], "score": []}).astype("int64")
        v, q = _numbers(part["numbers"]), _numbers(asked["numbers"])
        most = max(1, int(np.abs(v).max(initial=0))) * max(1, int(np.abs(q).max(initial=0))) * max(1, v.shape[1])
        if most < 1 << 53:  # then products and sums are exact in double, which is faster
            v, q = v.astype(float), q.astype(float)
        known = asked["known"].to_numpy() if "known" in asked else np.full(len(q), -np.inf)
        got = search(build(part["vec_id"].to_numpy(), v), asked["vec_id"].to_numpy(), q, known, k, leaves)
        rows = asked["query"].to_numpy()
        return pd.DataFrame({"query": [rows[g[0]] for g in got], "vec_id": [g[1] for g in got],
                             "score": [g[2] for g in got]}, dtype="int64")

    keys = ["dims", "shard", "block"]
    return vectors.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(
        find, "query bigint, vec_id bigint, score bigint")


def top_products(embeddings: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
                 vec_col: str = "embedding", shard_rows: int = 4096, block_rows: int = 4096) -> DataFrame:
    """The k largest inner products of each query with every other vector.

    Each component x counts as floor(256 x). Queries are the rows for which `is_query`,
    an expression over the input, holds. Returns query_id, rank (from 1), vec_id and
    score; ties go to the smaller vec_id; fewer rows where there are fewer candidates.
    Rows with a null id, a null vector, or a null or non-finite component take no part.
    Vectors are compared with vectors of their own length. Rows with the query's own id
    are no candidates; queries equal in id and vector are one; repeated rows of
    candidates each count. Scores must fit in 64 bits.

    Vectors are dealt to shards of about `shard_rows`, queries to blocks of `block_rows`.
    First each shard searches the best leaf for each query; the k-th score that all
    shards together have then is known to every shard in the whole search.
    """
    x = F.col(f"`{vec_col}`")
    sound = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = embeddings.where(sound & F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), F.size(x).alias("dims"),
        F.transform(x, lambda v: F.floor(v.cast("double") * 256)).alias("numbers"),
        F.coalesce(is_query, F.lit(False)).alias("asks"), F.monotonically_increasing_id().alias("at"))
    rows = materialize(rows)
    queries = materialize(rows.where("asks").select("vec_id", "dims", "numbers").distinct()
                          .withColumn("query", F.monotonically_increasing_id()))
    shards = max(1, -(-rows.count() // shard_rows))
    blocks = max(1, -(-queries.count() // block_rows))
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    vectors = rows.select("vec_id", "dims", "numbers", deal("at", shards).alias("shard"), each(blocks).alias("block"))
    asked = queries.withColumn("block", deal("query", blocks)).withColumn("shard", each(shards))

    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    first = _searched(vectors, asked, k, leaves=1)
    known = materialize(first.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
                        .select("query", F.col("score").cast("double").alias("known")))
    asked = asked.join(known, "query", "left").fillna(float("-inf"), ["known"])
    found = _searched(vectors, asked, k, leaves=None)
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    ids = queries.select("query", F.col("vec_id").alias("query_id"))
    return ranked.join(ids, "query").select("query_id", "rank", "vec_id", "score")
