"""Exact top-k by inner product with Fagin's threshold algorithm.

Vectors and queries are dealt to a grid of cells (query block x vector block),
so that no cell grows with the data and the work is spread. Inside a cell every
dimension has its list of vectors sorted by value. A query walks all its lists
in step (from the top where its own component is positive, from the bottom
where it is negative) and stops as soon as the bound on all unseen vectors, the
sum of the components at the present depth, is below its kth score. The cells'
best k rows are then merged. The scores are not made vector by vector as they
show up: one product scores all vectors of a cell for all its queries, so the
stopping rule saves looking at scores, not making them.

Defined cases: a vector that is null, empty, or holds a null or non-finite
component takes no part. Repeated rows count once. Only vectors of equal length
are compared. A null id takes no part. Ties go to the smaller id. Scores beyond
the range of a long are held at its ends.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows of a vector block and of a query block.
VECTOR_BLOCK, QUERY_BLOCK = 4096, 512
#: The grid has at least this many vector blocks, to keep all executors busy.
LEAST_BLOCKS = 16
FOUND = "query_id long, vec_id long, score long"


def quantised(embedding: Column, scale: int = 64) -> Column:
    """``floor(scale * x)`` of each component; null where the vector takes no part."""
    ok = F.forall(
        embedding,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    return F.when(
        (F.size(embedding) > 0) & ok,
        F.transform(embedding, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")),
    )


def best_of(ids: np.ndarray, score: np.ndarray, index: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest scores with their vectors; of equal ones those with smaller ids."""
    if len(score) <= k:
        return score, index
    top = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    top = top[np.lexsort((ids[index[top]], -score[top]))[:k]]
    return score[top], index[top]


def threshold_search(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """The best ``k`` vectors of each query: (query index, vector index, score) arrays."""
    n, dims = vectors.shape
    big = int(np.abs(vectors).max(initial=0)) * int(np.abs(queries).max(initial=0)) * dims
    kind = np.float32 if big < 2**24 else np.float64 if big < 2**53 else np.int64 if big < 2**63 else object
    vectors, queries = vectors.astype(kind), queries.astype(kind)
    order = np.argsort(-vectors, axis=0, kind="stable")
    lists = np.take_along_axis(vectors, order, axis=0)  # each column falls
    rank = np.empty((n, dims), np.int16 if n < 2**15 else np.int32)
    np.put_along_axis(rank, order, np.arange(n, dtype=rank.dtype)[:, None], axis=0)
    # for a falling and a rising walk, the depth at which each list reaches each vector
    reached = np.concatenate([rank.T, n - 1 - rank.T])
    walks = np.arange(dims) + dims * (queries < 0)
    depths = [max(1, n >> s) for s in range(max(1, dims.bit_length() - 1), 0, -1)]
    ups, downs = np.where(queries >= 0, queries, 0), np.where(queries < 0, queries, 0)
    bounds = np.stack([ups @ lists[min(d, n - 1)] + downs @ lists[max(n - 1 - d, 0)] for d in depths], axis=1)
    scores = queries @ vectors.T  # random access: cheaper at once than row by row
    found = []
    for at, own in enumerate(query_ids):
        first = reached.take(walks[at], axis=0).min(axis=0)
        first[ids == own] = n
        index = np.flatnonzero(first < depths[0])
        score, index = best_of(ids, scores[at, index], index, k)
        # the kth score only grows: at the first depth with a bound below it the walk ends
        ends = bounds[at] < score.min() if len(score) == k else np.zeros(len(depths), bool)
        depth = depths[int(ends.argmax())] if ends.any() else n
        if depth > depths[0]:
            new = np.flatnonzero((first >= depths[0]) & (first < depth))
            fresh = scores[at, new]
            if len(score) == k:  # equal scores stay: the smaller id decides
                new, fresh = new[fresh >= score.min()], fresh[fresh >= score.min()]
            score, index = best_of(ids, np.concatenate([score, fresh]), np.concatenate([index, new]), k)
        found.append((np.full(len(index), at), index, score))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def cell_search(k: int):
    """The function for one grid cell, whose rows are queries and vectors."""

    def run(cell: pd.DataFrame) -> pd.DataFrame:
        asks = cell.is_query.to_numpy(bool)
        if asks.all() or not asks.any():
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        data = np.stack(cell.ints.to_list()).astype(np.int64)
        ids = cell.vec_id.to_numpy(np.int64)
        at, index, score = threshold_search(ids[~asks], data[~asks], ids[asks], data[asks], k)
        low, high = -(2**63), 2**63 - 1
        held = score.astype(np.int64) if score.dtype != object else [min(max(int(s), low), high) for s in score]
        return pd.DataFrame({"query_id": ids[asks][at], "vec_id": ids[~asks][index], "score": held})

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64) -> DataFrame:
    """For each row with ``is_query``: its ``k`` best other rows of (vec_id, embedding)."""
    rows = (
        vectors.select("vec_id", quantised(F.col("embedding"), scale).alias("ints"), is_query.alias("asks"))
        .where(F.col("vec_id").isNotNull() & F.col("ints").isNotNull())
        .distinct()
    )
    counts = vectors.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    v_blocks = max(LEAST_BLOCKS, math.ceil(counts.n / VECTOR_BLOCK))
    q_blocks = max(1, math.ceil(counts.q / QUERY_BLOCK))
    block = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    common = ["vec_id", "ints", F.size("ints").alias("dims")]
    stock = rows.select(*common, block(v_blocks, 1).alias("vb"), every(q_blocks).alias("qb"), F.lit(False).alias("is_query"))
    asks = rows.where("asks").select(
        *common, every(v_blocks).alias("vb"), block(q_blocks, 2).alias("qb"), F.lit(True).alias("is_query")
    )
    found = stock.unionByName(asks).groupBy("dims", "qb", "vb").applyInPandas(cell_search(k), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
