"""Exact nearest neighbours by cosine distance."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Queries and rows of the corpus that are compared at once; both sides are cut into hashed blocks of about that size.
BLOCK = 20_000
ROWS = 50_000


def _unit(col: pa.Array) -> np.ndarray:
    n = len(col)
    x = np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(n, -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _compared(queries: DataFrame, corpus: DataFrame, key: str, vector: str, block: int, near: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``query``, ``neighbour``, ``distance`` where ``near`` of a matrix of distances holds, for each pair of blocks."""
    kind = corpus.schema[key].dataType.simpleString()
    q = queries.select(F.col(key).alias("query"), F.col(vector).alias("v"))
    c = corpus.select(F.col(key).alias("neighbour"), F.col(vector).alias("v"))
    groups, parts = max(1, -(-q.count() // block)), max(1, -(-c.count() // ROWS))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
    q = q.withColumn("g", F.pmod(F.xxhash64("query"), F.lit(groups))).withColumn("p", each(parts))
    c = c.withColumn("p", F.pmod(F.xxhash64("neighbour"), F.lit(parts))).withColumn("g", each(groups))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, names = left.column("query").combine_chunks(), right.column("neighbour").combine_chunks()
        qs, cs, ds = [ids[:0]], [names[:0]], [np.zeros(0)]
        if len(ids) and len(names):
            x, y = _unit(left.column("v").combine_chunks()), _unit(right.column("v").combine_chunks())
            for i in range(0, len(x), 64):
                d = 1 - x[i : i + 64] @ y.T
                r, at = np.nonzero(near(d))
                qs.append(ids.take(pa.array(i + r))), cs.append(names.take(pa.array(at))), ds.append(d[r, at])
        return pa.table({"query": pa.concat_arrays(qs), "neighbour": pa.concat_arrays(cs), "distance": np.concatenate(ds)})

    return q.groupBy("g", "p").cogroup(c.groupBy("g", "p")).applyInArrow(run, f"query {kind}, neighbour {kind}, distance double")


def exact_top_k(queries: DataFrame, corpus: DataFrame, key: str, vector: str, k: int = 5, itself: bool = True, block: int = BLOCK) -> DataFrame:
    """``query``, ``neighbour``, ``distance``, ``rank`` of the k nearest rows of the corpus for each query; ties by key.

    Both sides are cut into hashed blocks, queries of about ``block`` rows, and each pair of blocks is a group that
    keeps k rows a query; a window keeps the best k of all groups. Both sides need vectors of one length without null
    or NaN, and not of length 0. With ``itself=False`` a row is no neighbour of its own.
    """

    def near(d: np.ndarray) -> np.ndarray:
        n = min(d.shape[1], k + 1)
        # everything as near as the n-th, so that ties are left to the window
        return d <= np.partition(d, n - 1, axis=1)[:, n - 1 : n] + 1e-12

    found = _compared(queries, corpus, key, vector, block, near)
    if not itself:
        found = found.where("query <> neighbour")
    best = found.withColumn("rank", F.row_number().over(W.partitionBy("query").orderBy("distance", "neighbour"))).where(F.col("rank") <= k)
    return best.select("query", "neighbour", "distance", "rank")


def nearest_ties(queries: DataFrame, corpus: DataFrame, key: str, vector: str, tolerance: float = 1e-6, block: int = BLOCK) -> DataFrame:
    """``query``, ``neighbour``, ``distance``: all rows of the corpus as near as a query's nearest, within ``tolerance``.

    Equal vectors are one node while they are compared, and its rows are joined to the result. Each pair of blocks
    keeps what is near its own least distance, which is never below the least of all. Vectors as in ``exact_top_k``.
    """
    node = F.concat_ws("-", F.xxhash64(vector), F.xxhash64(F.lit(1), vector)).alias("node")
    asked, rows = queries.select(key, node, vector), corpus.select(key, node, vector)
    one = lambda x: x.groupBy("node").agg(F.first(vector).alias(vector))
    found = _compared(one(asked), one(rows), "node", vector, block, lambda d: d <= d.min(axis=1, keepdims=True) + tolerance + 1e-12)
    near = tie_sets(found, tolerance).withColumnsRenamed({"query": "_q", "neighbour": "_n"})
    of = lambda x, at, name: x.select(F.col("node").alias(at), F.col(key).alias(name))
    return near.join(of(asked, "_q", "query"), "_q").join(of(rows, "_n", "neighbour"), "_n").select("query", "neighbour", "distance")


def tie_sets(neighbours: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Neighbours as near as the nearest of their query, within ``tolerance``."""
    least = F.min("distance").over(W.partitionBy("query"))
    return neighbours.withColumn("_least", least).where(F.col("distance") - F.col("_least") <= tolerance).drop("_least")
