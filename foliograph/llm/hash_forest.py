"""Approximate nearest neighbours by cosine with a forest of sorted hash strings.

1. Equal vectors form one class, of which the ``k + 1`` smallest ids are kept: no
   query can need more of them. A class has a string of 64 bits in each of
   ``TREES`` trees, the signs of its products with fixed random planes.
2. A tree is a sorted array of strings, cut into cells by the first bits so that a
   cell holds about as many strings as a query wants from a tree. Cells beyond
   ``BLOCK`` strings are dealt to several blocks. A task sorts one block.
3. A query descends to its longest common prefixes, and ascends in all trees at the
   same time: its level is the longest prefix length at which the trees together
   hold ``wanted`` strings (all, at the root). Counts come from the query's cells,
   and from the sizes of cells above them.
4. All strings with that prefix are candidates, whatever their number, and are
   scored where they lie, by their original vectors in double precision. The best
   of all blocks are merged.
5. ``wanted`` is fitted: for at most ``SAMPLE`` classes, picked by a hash, the true
   nearest rows are found among all rows, and ``wanted`` is what ``RECALL`` of them
   need. So recall holds at every size and for every shape of data, at the price
   of more candidates where vectors have no structure.

Defined cases: a vector that is null, empty, zero, or holds a null or non-finite
component takes no part, nor does a null id; rows that share an id count once,
with the smallest vector; only vectors of equal length are compared; ties go to
the smaller id; an empty table or one without queries gives no rows; other
columns are ignored. A query with fewer than ``k`` candidates returns them all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foliograph.llm.common import BROADCAST_ROWS, staged

#: Trees of the forest, and strings that one task sorts.
TREES, BLOCK = 12, 16_384
#: Classes whose true nearest rows fit ``wanted``, and the share of those rows that must be candidates.
SAMPLE, RECALL = 200, 0.96
BITS = 64
_CLASS = "cid long, dims int, asks boolean, ids array<long>, vector binary, strings array<long>"


def planes(dims: int) -> np.ndarray:
    return np.random.default_rng((20240611, dims)).standard_normal((dims, TREES * BITS))


def strings(vectors: np.ndarray) -> np.ndarray:
    """The strings of each vector, one a tree, as unsigned numbers whose order is that of the strings."""
    sides = vectors @ planes(vectors.shape[1]) > 0
    return np.packbits(sides.reshape(len(vectors), TREES, BITS), axis=2).view(">u8")[:, :, 0].astype(np.uint64)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors times a power of two each, so that no square leaves the range of doubles; cosines do not change."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def cosines(vectors: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Cosines of each vector with one, worked out alike wherever a vector lies."""
    return (vectors * one).sum(axis=1) / (np.sqrt((vectors * vectors).sum(axis=1)) * np.sqrt((one * one).sum()))


def nearest(vectors: np.ndarray, norms: np.ndarray, ids: np.ndarray, one: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` vectors nearest to one, ties by id: (index, cosine). A product picks, ``cosines`` decides."""
    rough = (vectors @ one) / (norms * math.sqrt((one * one).sum()))
    index = np.arange(len(rough))
    if len(rough) > k:
        index = np.flatnonzero(rough >= np.partition(rough, len(rough) - k)[len(rough) - k] - 1e-9)
    exact = cosines(vectors[index], one)
    best = np.lexsort((ids[index], -exact))[:k]
    return index[best], exact[best]


def common_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of strings."""
    x = a ^ b
    high = x >> np.uint64(32)
    top = np.where(high > 0, high, x & np.uint64(0xFFFFFFFF)).astype(np.float64)
    used = np.frexp(top)[1]
    return np.where(x == 0, BITS, np.where(high > 0, 32 - used, 64 - used))


def prefix_range(ordered: np.ndarray, string: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 place of the strings that share ``level`` bits with each string."""
    free = np.uint64(BITS) - np.maximum(level, 1).astype(np.uint64)
    mask = np.where(level > 0, (np.uint64(1) << free) - np.uint64(1), np.uint64(2**64 - 1))
    return np.searchsorted(ordered, string & ~mask, "left"), np.searchsorted(ordered, string | mask, "right")


def classes(vectors: DataFrame, is_query: Column, k: int) -> tuple[DataFrame, DataFrame]:
    """Classes of equal vectors with their strings, and the class of each query (vec_id, cid)."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    usable = usable & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(usable, F.lit(False)))
    # 0.0 and -0.0 are one value
    rows = rows.withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0)))
    rows = staged(rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"), F.max("asks").alias("asks")), "forest-rows")
    first = Window.partitionBy("embedding", "asks").orderBy("vec_id")
    few = rows.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1)
    some = few.groupBy("embedding").agg(F.slice(F.array_sort(F.collect_list("vec_id")), 1, k + 1).alias("ids"), F.max("asks").alias("asks"))
    some = staged(some, "forest-vectors")
    named = some.where("asks").select("embedding", F.col("ids")[0].alias("cid"))
    members = staged(rows.where("asks").join(named, "embedding").select("vec_id", "cid"), "forest-members")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            flat, size = lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())
            place = np.cumsum(size) - size
            for dims in np.unique(size):
                at = np.flatnonzero(size == dims)
                x = scaled(flat[place[at, None] + np.arange(dims)])
                part = batch.take(pa.array(at))
                found = pa.array(strings(x).view(np.int64).ravel())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([v[0] for v in part.column("ids").to_pylist()], pa.int64()),
                        pa.array(np.full(len(at), dims, np.int32)),
                        part.column("asks"),
                        part.column("ids"),
                        pa.array([v.tobytes() for v in packed(x)], pa.binary()),
                        pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32) * TREES, found),
                    ],
                    names=["cid", "dims", "asks", "ids", "vector", "strings"],
                )

    return staged(some.mapInArrow(run, _CLASS), "forest-classes"), members


def packed(x: np.ndarray) -> np.ndarray:
    """Vectors in single precision where that holds them exactly."""
    single = x.astype(np.float32)
    return single if (single == x).all() else x


def unpacked(vectors: list[bytes], dims: int) -> np.ndarray:
    out = np.empty((len(vectors), dims))
    for i, v in enumerate(vectors):
        out[i] = np.frombuffer(v, np.float32 if len(v) == 4 * dims else np.float64)
    return out


def fit_wanted(stock: DataFrame, k: int) -> int:
    """How many strings a query wants of all trees together, so that ``RECALL`` of the true nearest rows are candidates.

    A row is a candidate at all levels up to its longest common prefix with the
    query, so it needs one string more than the levels above hold.
    """
    sample = stock.where("asks").orderBy(F.xxhash64("cid"), "cid").limit(SAMPLE).select("cid", "dims", "vector", "strings").collect()
    asked = {}
    for dims in {r.dims for r in sample}:
        rows = [r for r in sample if r.dims == dims]
        own = np.array([r.strings for r in rows], np.int64).view(np.uint64)
        asked[dims] = [r.cid for r in rows], unpacked([bytes(r.vector) for r in rows], dims), own
    levels = np.arange(BITS + 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[int, np.ndarray] = {}
        best: dict[int, list[tuple[float, int, int]]] = {}
        for frame in batches:
            for dims, part in frame.groupby("dims"):
                if dims not in asked:
                    continue
                x, ids = unpacked(part.vector.to_list(), dims), part.cid.to_numpy()
                norms = np.sqrt((x * x).sum(axis=1))
                s = np.array(part.strings.to_list(), np.int64).view(np.uint64)
                cids, queries, own = asked[dims]
                held = np.zeros((len(cids), BITS + 1), np.int64)
                for t in range(TREES):
                    low, high = prefix_range(np.sort(s[:, t]), own[:, t, None], levels)
                    held += high - low
                for q, cid in enumerate(cids):
                    counts[cid] = counts.get(cid, 0) + held[q]
                    index, score = nearest(x, norms, ids, queries[q], k + 1)
                    seen = [(-c, int(ids[i]), int(common_bits(s[i], own[q]).max())) for i, c in zip(index, score) if ids[i] != cid]
                    best[cid] = sorted(best.get(cid, []) + seen)[:k]
        rows = [(c, "level", i, float(n), 0) for c, held in counts.items() for i, n in enumerate(held)]
        rows += [(c, "near", i, s, b) for c, found in best.items() for s, i, b in found]
        yield pd.DataFrame(rows, columns=["cid", "kind", "item", "value", "bits"])

    facts = stock.select("cid", "dims", "vector", "strings").mapInPandas(run, "cid long, kind string, item long, value double, bits int")
    held = facts.where("kind = 'level'").groupBy("cid", "item").agg(F.sum("value").alias("n"))
    place = F.row_number().over(Window.partitionBy("cid").orderBy("value", "item"))
    near = facts.where("kind = 'near'").withColumn("place", place).where(F.col("place") <= k)
    table = {(r.cid, r.item): r.n for r in held.collect()}  # at most SAMPLE * 65 and SAMPLE * k rows
    need = [1 + table.get((r.cid, r.bits + 1), 0) for r in near.select("cid", "bits").collect()]
    return max((k + 1) * TREES, int(np.quantile(need, RECALL, method="higher"))) if need else (k + 1) * TREES


def level_counts(depth: int):
    """The function for one block: how many of its strings share each number of bits with each query; single ones are left out."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        asks, levels = block.asks.to_numpy(bool), np.arange(depth, BITS + 1)
        s = block.string.to_numpy(np.int64).view(np.uint64)
        low, high = prefix_range(np.sort(s[~asks]), s[asks][:, None], levels)
        query, level = np.nonzero(high - low > 1)
        return pd.DataFrame({"cid": block.cid.to_numpy()[asks][query], "level": levels[level].astype(np.int32), "n": (high - low)[query, level]})

    return run


def candidates(k: int):
    """The function for one block: the best ``k + 1`` of the strings that share a query's level."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        dims, asks = int(block.dims.iloc[0]), block.level.to_numpy() >= 0
        stock, queries = block[~asks], block[asks]
        s = stock.string.to_numpy(np.int64).view(np.uint64)
        order = np.argsort(s, kind="stable")
        s, cids, ids = s[order], stock.cid.to_numpy()[order], stock.ids.to_numpy()[order]
        x = unpacked([stock.vector.iloc[i] for i in order], dims)
        norms = np.sqrt((x * x).sum(axis=1))
        low, high = prefix_range(s, queries.string.to_numpy(np.int64).view(np.uint64), queries.level.to_numpy())
        rows = []
        for cid, one, a, b in zip(queries.cid, unpacked(queries.vector.to_list(), dims), low, high, strict=True):
            index, score = nearest(x[a:b], norms[a:b], cids[a:b], one, k + 1)
            rows += [(cid, cids[a + i], ids[a + i], c) for i, c in zip(index, score)]
        return pd.DataFrame(rows, columns=["cid", "near", "ids", "score"])

    return run


def by_tree(rows: DataFrame, depth: int, *extra: str) -> DataFrame:
    """One row a tree, with its string and the cell of its first ``depth`` bits."""
    out = rows.select("cid", "dims", *extra, F.posexplode("strings").alias("tree", "string"))
    return out.withColumn("cell", F.shiftrightunsigned("string", BITS - depth) if depth else F.lit(0).cast("long"))


def search(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each row with ``is_query``."""
    stock, members = classes(vectors, is_query, k)
    wanted, n = fit_wanted(stock, k), stock.count()
    depth = min(24, max(0, math.floor(math.log2(max(1, n * TREES / wanted)))))
    cell = ["dims", "tree", "cell"]
    cells = by_tree(stock, depth).groupBy(cell).agg(F.count("*").alias("rows"))
    cells = staged(cells.withColumn("blocks", F.ceil(F.col("rows") / BLOCK).cast("int")), "forest-cells")
    n_cells = cells.count()
    lookup = lambda df: F.broadcast(df) if n_cells * (depth + 1) <= BROADCAST_ROWS else df
    sizes = lookup(cells.select(*cell, "blocks"))
    blocks = [*cell, "block"]
    dealt = by_tree(stock, depth, "ids", "vector").join(sizes, cell).withColumn("block", F.pmod(F.xxhash64("cid"), "blocks").cast("int"))
    asked = by_tree(stock.where("asks"), depth, "vector")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")

    # ascend: counts by level within the cell, sizes of cells above it
    here = asked.drop("vector").join(sizes, cell).select("cid", *cell, "string", every)
    inside = dealt.select("cid", *blocks, "string", F.lit(False).alias("asks")).unionByName(here.withColumn("asks", F.lit(True)))
    inside = inside.groupBy(blocks).applyInPandas(level_counts(depth), "cid long, level int, n long")
    # each cell at each level above its own, by its prefix
    above = cells.select("dims", "tree", "cell", "rows", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level"))
    above = above.withColumn("prefix", F.expr(f"shiftrightunsigned(cell, {depth} - level)"))
    held = inside.groupBy("cid", "level").agg(F.sum("n").alias("n"))
    deep = staged(held.where(F.col("n") >= wanted).groupBy("cid").agg(F.max("level").alias("level")), "forest-levels")
    left = asked.select("cid", *cell).join(deep, "cid", "left_anti")
    left = left.select("cid", "dims", "tree", "cell", F.explode(F.sequence(F.lit(0), F.lit(max(0, depth - 1)))).alias("level"))
    left = left.withColumn("prefix", F.expr(f"shiftrightunsigned(cell, {depth} - level)")).drop("cell")
    totals = above.groupBy("dims", "tree", "level", "prefix").agg(F.sum("rows").alias("n"))
    shallow = left.join(lookup(totals), ["dims", "tree", "level", "prefix"]).groupBy("cid", "level").agg(F.sum("n").alias("n"))
    shallow = shallow.groupBy("cid").agg(F.coalesce(F.max(F.when(F.col("n") >= wanted, F.col("level"))), F.lit(0)).alias("level"))
    level = staged(deep.unionByName(shallow), "forest-level")

    # candidates: all strings with the prefix, in the query's cell or, above it, in all cells below the prefix
    going = asked.join(level, "cid").withColumn("at", F.least("level", F.lit(depth)))
    going = going.withColumn("prefix", F.expr(f"shiftrightunsigned(cell, {depth} - at)"))
    below = above.select("dims", "tree", F.col("level").alias("at"), "prefix", "cell")
    going = going.drop("cell").join(lookup(below), ["dims", "tree", "at", "prefix"]).join(sizes, cell)
    going = going.select("cid", *cell, "string", "vector", F.col("level").cast("int").alias("level"), every)
    mine = F.array(F.lit(0).cast("long"))
    both = dealt.select("cid", *blocks, "string", "vector", "ids", F.lit(-1).alias("level")).unionByName(going.withColumn("ids", mine))
    found = both.groupBy(blocks).applyInPandas(candidates(k), "cid long, near long, ids array<long>, score double").distinct()
    best = Window.partitionBy("cid").orderBy(F.desc("score"), "near")
    found = staged(found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1).drop("place"), "forest-found")

    # each query of a class gets the class's finds but its own id
    rows = members.select(F.col("vec_id").alias("query_id"), "cid").join(found, "cid").select("query_id", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = rows.where("query_id <> vec_id").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
