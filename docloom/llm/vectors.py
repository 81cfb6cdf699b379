"""Problem 4: most similar vectors by additive quantisation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.shared import durable, small

#: Vectors that the codebooks are fitted on: a bounded sample, the smallest by a hash. All vectors are indexed.
SAMPLE = 16_384
BOOKS, WORDS = 16, 64
#: Cells that each vector is put into, and vectors of a cell beyond which it is divided.
BEAM = 8
CELL = 4_096
#: Codes that a cell is told apart by at most: what so many codes don't divide is nearly equal.
MAX_DEPTH = 6
#: Vectors that cells hold on average at most; deeper prefixes of the codes make more cells for more vectors.
OCCUPANCY = 64
#: Similarity from which cells find nearly all neighbours; vectors with fewer than k such are looked up among all codes.
NEAR = 0.85
#: Rows of cells that make up a partition: scoring takes far longer than its few bytes suggest.
PARTITION_ROWS = 50_000


@dataclass
class Codebooks:
    """Full-dimensional residual codebooks; a vector is approximated by the sum of one word of each."""

    words: np.ndarray  # books x words x dim

    def __post_init__(self) -> None:
        m, k, d = self.words.shape
        self.flat = np.ascontiguousarray(self.words.reshape(m * k, d))
        self.squares = (self.words**2).sum(2)
        for i in range(m):  # a word that a book has twice is used once, so that a beam holds different sums
            _, first = np.unique(self.words[i].round(6), axis=0, return_index=True)
            self.squares[i, np.setdiff1d(np.arange(k), first)] = np.inf
        self.gram = np.ascontiguousarray(2 * (self.flat @ self.flat.T)).reshape(m, k, m, k)

    def encode(self, x: np.ndarray, beam: int, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes by beam search, the ``beam`` best prefixes of ``depth`` codes, and which of these there are."""
        m, k, _ = self.words.shape
        n = len(x)
        dots = -2 * (x @ self.flat.T).reshape(n, m, k)
        codes = np.zeros((n, 1, 0), np.uint8)
        error = np.zeros((n, 1), np.float32)
        prefixes, there = codes, np.ones((n, 1), bool)
        for i in range(m):
            e = error[:, :, None] + (dots[:, i] + self.squares[i])[:, None, :]
            for j in range(i):
                e += self.gram[j, :, i][codes[:, :, j]]
            e = e.reshape(n, -1)
            top = min(beam, e.shape[1])
            at = np.argpartition(e, top - 1, axis=1)[:, :top]
            error = np.take_along_axis(e, at, 1)
            at = np.take_along_axis(at, np.argsort(error, axis=1), 1)
            error = np.take_along_axis(e, at, 1)
            before = np.take_along_axis(codes, (at // k)[:, :, None], 1)
            codes = np.concatenate([before, (at % k).astype(np.uint8)[:, :, None]], axis=2)
            if i + 1 == depth:
                prefixes, there = codes, np.isfinite(error)
        return codes[:, 0], prefixes, there

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return self.words[np.arange(codes.shape[1]), codes].sum(1)

    def scores(self, queries: np.ndarray, codes: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Approximate cosines of unit queries with coded vectors, from one table of products per query."""
        m, k, _ = self.words.shape
        table = np.ascontiguousarray((queries @ self.flat.T).T)  # a row of products for each word
        at = codes.astype(np.int64) + np.arange(m) * k
        out = np.empty((len(queries), len(codes)), np.float32)
        step = max(64, (1 << 17) // max(1, len(queries)))  # sums that stay in the cache
        for i in range(0, len(codes), step):
            s = table[at[i : i + step, 0]]
            for j in range(1, m):
                s += table[at[i : i + step, j]]
            out[:, i : i + step] = (s / np.maximum(norms[i : i + step, None], 1e-6)).T
        return out


def fit(sample: np.ndarray, books: int = BOOKS, words: int = WORDS, rounds: int = 6, seed: int = 7) -> Codebooks:
    """Codebooks for unit vectors: k-means of what the ones before leave over."""
    rng = np.random.default_rng(seed)
    rest = np.asarray(sample, np.float32).copy()
    d = rest.shape[1]
    out = np.zeros((books, words, d), np.float32)
    for i in range(books):
        c = rest[rng.choice(len(rest), words, replace=len(rest) < words)] if len(rest) else np.zeros((words, d), np.float32)
        for _ in range(rounds if len(rest) else 0):
            a = np.argmax(rest @ c.T - (c**2).sum(1) / 2, axis=1)
            n = np.bincount(a, minlength=words)
            sums = np.zeros_like(c)
            np.add.at(sums, a, rest)
            c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], rest[rng.choice(len(rest), words)])
        if len(rest):
            rest -= c[np.argmax(rest @ c.T - (c**2).sum(1) / 2, axis=1)]
        out[i] = c
    return Codebooks(out)


def usable(vector: str, dim: int) -> Column:
    """Whether a vector is there, has ``dim`` finite numbers and isn't zero."""
    c = F.col(vector)
    # array<float>: a NaN or an infinite number doesn't lie between the largest ones
    fine = F.forall(c, lambda x: x.isNotNull() & F.coalesce(x.between(-3.4e38, 3.4e38), F.lit(False)))
    return c.isNotNull() & (F.size(c) == dim) & fine & F.exists(c, lambda x: x != 0)


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    x = np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.float32).reshape(-1, dim)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def train(vectors: DataFrame, column: str, dim: int, n: int, size: int = SAMPLE) -> Codebooks:
    """Codebooks fitted on ``size`` of ``n`` vectors, those with the smallest hashes.

    Hashes far above those are left out before the smallest are sought, so that no task sees more than a few samples.
    """
    h = F.xxhash64(column)
    space = 1 << 30
    near = vectors if n <= 2 * size else vectors.where(F.pmod(h, F.lit(space)) < int(2 * size / n * space) + 1)
    rows = near.select(column).orderBy(F.pmod(h, F.lit(space)), h).limit(size).toArrow().column(0).combine_chunks()
    return fit(_matrix(rows, dim) if len(rows) else np.zeros((0, dim), np.float32))


def _encoder(books: Codebooks, dim: int, depth: int, beam: int):
    """Arrow batches (node, vector) to (node, up, cell, code_a, code_b, norm), a row for each of the ``beam`` best cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 2000):
                batch = whole.slice(at, 2000)
                codes, cells, there = books.encode(_matrix(batch.column(1), dim), beam, depth)
                norms = np.linalg.norm(books.decode(codes), axis=1).astype(np.float32)
                key = up = np.zeros(cells.shape[:2], np.int64)
                for j in range(depth):
                    up = key
                    key = key * (WORDS + 1) + cells[:, :, j] + 1
                packed = np.ascontiguousarray(codes).view(np.int64)  # eight codes a number
                each, _ = np.nonzero(there)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(each)), pa.array(up[there]), pa.array(key[there]), pa.array(packed[each, 0]), pa.array(packed[each, 1]), pa.array(norms[each])],
                    names=["node", "up", "cell", "code_a", "code_b", "norm"],
                )

    return run


_SCORED = "a long, b long, s float"


def _scorer(books: Codebooks, keep: int, least: float):
    """The best ``keep`` neighbours in a cell of each vector in it, with approximate cosines of ``least``."""

    def run(cell: pa.Table) -> pa.Table:
        node = cell.column("node").to_numpy()
        codes = np.column_stack([cell.column("code_a").to_numpy(), cell.column("code_b").to_numpy()]).view(np.uint8)
        norms = cell.column("norm").to_numpy()
        n = len(node)
        own = books.decode(codes) / np.maximum(norms, 1e-6)[:, None]
        a, b, s = [], [], []
        for at in range(0, n, 512):
            t = books.scores(own[at : at + 512], codes, norms)
            t[np.arange(len(t)), np.arange(at, at + len(t))] = -9
            if n > keep:
                i = np.argpartition(t, n - keep, axis=1)[:, n - keep :]
                v = np.take_along_axis(t, i, 1)
            else:
                i, v = np.broadcast_to(np.arange(n), t.shape), t
            r, c = np.nonzero(v >= least)
            a.append(node[at + r]), b.append(node[i[r, c]]), s.append(v[r, c])
        a, b, s = (np.concatenate(x) for x in (a, b, s))
        one = a != b
        return pa.table({"a": a[one], "b": b[one], "s": s[one].astype(np.float32)})

    return run


def depth_for(n: int, words: int = WORDS) -> int:
    """Codes that make up a cell, so that cells hold about ``OCCUPANCY`` vectors or fewer however many there are."""
    depth = 1
    while depth < MAX_DEPTH and n / words**depth > OCCUPANCY:
        depth += 1
    return max(depth, 2)


def candidates(nodes: DataFrame, books: Codebooks, dim: int, n: int, keep: int, least: float, cell_size: int = CELL) -> DataFrame:
    """Pairs (a, b, s): the best approximate neighbours of every node among those that share a cell with it.

    A cell is a prefix of the codes, and each node is in the ``BEAM`` cells, for
    each code beyond the first, that fit it best. Cells with more than
    ``cell_size`` nodes are divided by one more code, their nodes being encoded again; cells that all codes don't
    divide are compared whole, in blocks.
    """
    found, depth = [], depth_for(n)
    # deeper cells are smaller, and close vectors more often apart in one code
    beam = BEAM * (depth - 1)
    todo, hot_before = nodes, None
    score = _scorer(books, keep, least)
    parts = max(1, n * beam // PARTITION_ROWS)

    def by_cell(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.repartition(parts, *keys).groupBy(*keys).applyInArrow(score, _SCORED)

    while True:
        cells = todo.mapInArrow(_encoder(books, dim, depth, beam), "node long, up long, cell long, code_a long, code_b long, norm float")
        if hot_before is not None:
            cells = cells.join(small(hot_before.select(F.col("cell").alias("up"))), "up", "left_semi")
        cells = durable(cells.drop("up"))
        hot = durable(cells.groupBy("cell").count().where(F.col("count") > cell_size))
        if hot.isEmpty():
            found.append(by_cell(cells, "cell"))
            break
        found.append(by_cell(cells.join(small(hot.select("cell")), "cell", "left_anti"), "cell"))
        rest = cells.join(small(hot.select("cell", "count")), "cell")
        if depth >= MAX_DEPTH:
            half = max(1, cell_size // 2)
            own = rest.withColumn("k", F.ceil(F.col("count") / half).cast("int")).withColumn("i", F.pmod(F.xxhash64("node", F.lit(3)), F.col("k")).cast("int"))
            met = own.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
            blocks = met.select("node", "code_a", "code_b", "norm", "cell", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"))
            found.append(by_cell(blocks, "cell", "lo", "hi"))
            break
        todo = durable(nodes.join(rest.select("node").distinct(), "node", "left_semi"))
        hot_before, depth = hot, depth + 1
    return reduce(DataFrame.unionByName, found)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity in double precision."""
    d = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return d(a, b) / F.sqrt(d(a, a) * d(b, b))


def _coded(books: Codebooks, dim: int):
    """Arrow batches (key, vector) to (key, code_a, code_b, norm)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 2000):
                b = whole.slice(at, 2000)
                codes, _, _ = books.encode(_matrix(b.column(1), dim), BEAM, 1)
                packed = np.ascontiguousarray(codes).view(np.int64)
                norms = np.linalg.norm(books.decode(codes), axis=1).astype(np.float32)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(packed[:, 0]), pa.array(packed[:, 1]), pa.array(norms)], names=["key", "code_a", "code_b", "norm"])

    return run


def scan(asked: DataFrame, known: DataFrame, books: Codebooks, dim: int, rerank: int, rows: int, wanted: int, block: int = 50_000) -> DataFrame:
    """``q``, ``key``, ``s``: exact cosines of the ``rerank`` rows of ``known`` (key, v) whose codes score best for each query.

    Every code is scored for every query (q, v), from the query's table of products. Both sides are cut into hashed
    blocks of about ``block`` rows (queries a tenth of it), and each pair of blocks is a group. A block keeps its best
    by code; a window keeps the best of all blocks, and those are compared exactly.
    """
    kind, asker = known.schema["key"].dataType.simpleString(), asked.schema["q"].dataType.simpleString()
    parts, groups = max(1, -(-rows // block)), max(1, -(-wanted // (block // 10)))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({"q": left.column("q").slice(0, 0), "key": right.column("key").slice(0, 0), "s": pa.array([], pa.float32())})
        x = _matrix(left.column("v").combine_chunks(), dim)
        codes = np.column_stack([right.column("code_a").to_numpy(), right.column("code_b").to_numpy()]).view(np.uint8)
        norms = right.column("norm").to_numpy()
        n = min(rerank + 1, len(norms))
        a, b, s = [], [], []
        for at in range(0, len(x), 128):
            t = books.scores(x[at : at + 128], codes, norms)
            i = np.argpartition(t, len(norms) - n, axis=1)[:, len(norms) - n :]
            a.append(np.repeat(np.arange(at, at + len(t)), n)), b.append(i.ravel()), s.append(np.take_along_axis(t, i, 1).ravel())
        a, b, s = (np.concatenate(z) for z in (a, b, s))
        return pa.table({"q": left.column("q").take(pa.array(a)), "key": right.column("key").take(pa.array(b)), "s": s.astype(np.float32)})

    coded = known.select("key", "v").mapInArrow(_coded(books, dim), f"key {kind}, code_a long, code_b long, norm float")
    coded = coded.withColumn("p", F.pmod(F.xxhash64("key"), F.lit(parts))).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>")))
    spread = asked.withColumn("g", F.pmod(F.xxhash64("q"), F.lit(groups))).withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<long>")))
    scored = spread.groupBy("g", "p").cogroup(coded.groupBy("g", "p")).applyInArrow(score, f"q {asker}, key {kind}, s float").where("q <> key")
    best = scored.withColumn("r", F.row_number().over(W.partitionBy("q").orderBy(F.desc("s"), "key"))).where(F.col("r") <= rerank).select("q", "key")
    return best.join(known, "key").join(asked.withColumnRenamed("v", "x"), "q").select("q", "key", cosine(F.col("x"), F.col("v")).alias("s"))


def most_similar(vectors: DataFrame, key: str, column: str, k: int = 5, min_similarity: float = -1.0, dim: int = 64, slack: float = 0.25, rerank: int = 60) -> DataFrame:
    """``key``, ``neighbour``, ``similarity``, ``rank``: the ``k`` most similar other rows of every row.

    Codebooks are fitted on ``SAMPLE`` vectors; every vector is encoded by beam search and compared, by lookup tables
    over the codes and stored norms, with those that share one of its ``BEAM`` cells; the best 4k are compared again
    exactly. With ``min_similarity`` only neighbours that are at least as similar count, and codes whose cosine is more
    than ``slack`` below it aren't compared exactly.

    Cells hold near vectors together, not far ones. Vectors that have fewer than ``k`` neighbours of at least ``NEAR``
    so far are therefore looked up by ``scan`` among all codes, the best ``rerank`` being compared exactly, unless
    ``min_similarity`` is ``NEAR`` or more. That work grows with the number of such vectors times all.

    Vectors that are null, not ``dim`` long, hold a null, NaN or infinite number, or are zero take no part; lengths
    other than 1 do. Rows with null keys take no part, keys must be unique. Equal vectors (of one 64-bit hash) are
    encoded once; of more than k + 1 equal ones the first by key stand for all as neighbours, so that ties go to the
    smaller key. An empty table gives an empty result; other columns are not carried along.
    """
    if key in ("neighbour", "similarity", "rank"):
        raise ValueError(f"{key} is the name of an added column")
    base = vectors.where(F.col(key).isNotNull() & usable(column, dim)).select(F.col(key).alias("key"), F.col(column).cast("array<float>").alias("v"))
    rows = base.select("key", F.xxhash64("v").alias("node"))
    counts = durable(rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first")))
    total = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    copied = small(durable(counts.where("n > 1").select("node", "first")))
    nodes = base.select("key", F.xxhash64("v").alias("node"), "v").join(copied, "node", "left").where("first IS NULL OR key = first").select("node", "v")
    books = train(nodes, "v", dim, total[0])
    keep = 4 * k
    scored = candidates(nodes, books, dim, total[0], keep, min_similarity - slack)
    best = scored.groupBy("a", "b").agg(F.max("s").alias("s"))
    best = best.withColumn("r", F.row_number().over(W.partitionBy("a").orderBy(F.desc("s"), "b"))).where(F.col("r") <= keep)
    pairs = durable(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    asked = durable(pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct())
    full = durable(nodes.join(small(asked), "node", "left_semi"))
    exact = pairs.join(full.select(F.col("node").alias("a"), F.col("v").alias("x")), "a").join(full.select(F.col("node").alias("b"), F.col("v").alias("y")), "b")
    rated = durable(exact.select("a", "b", cosine(F.col("x"), F.col("y")).alias("s")).where(F.col("s") >= min_similarity))
    turned = lambda x: x.select(F.col("a").alias("node"), F.col("b").alias("other"), "s").unionAll(x.select(F.col("b").alias("node"), F.col("a").alias("other"), "s"))

    if min_similarity < NEAR:
        sizes = counts.select(F.col("node").alias("other"), "n")
        held = turned(rated.where(F.col("s") >= NEAR)).join(sizes, "other").groupBy("node").agg(F.sum("n").alias("held"))
        settled = counts.join(held, "node", "left").where(F.coalesce("held", F.lit(0)) + F.col("n") - 1 >= k).select("node")
        open_ = durable(nodes.join(small(durable(settled)), "node", "left_anti"))
        if wanted := open_.count():
            looked = scan(open_.select(F.col("node").alias("q"), "v"), nodes.select(F.col("node").alias("key"), "v"), books, dim, rerank, total[0], wanted)
            top = looked.withColumn("r", F.row_number().over(W.partitionBy("q").orderBy(F.desc("s"), "key"))).where((F.col("r") <= k + 1) & (F.col("s") >= min_similarity))
            rated = durable(rated.unionByName(top.select(F.least("q", "key").alias("a"), F.greatest("q", "key").alias("b"), "s")).groupBy("a", "b").agg(F.max("s").alias("s")))

    # of a node with many rows, k + 1 can be neighbours of any one row; counted in hashed parts first
    part = rows.withColumn("p", F.pmod(F.xxhash64("key"), F.lit(64)))
    few = part.withColumn("r", F.row_number().over(W.partitionBy("node", "p").orderBy("key"))).where(F.col("r") <= k + 1)
    shown = few.withColumn("r", F.row_number().over(W.partitionBy("node").orderBy("key"))).where(F.col("r") <= k + 1).select("node", "key") if total[1] > total[0] else rows
    same = counts.where("n > 1").select("node", F.col("node").alias("other"), F.lit(1.0).alias("s"))
    near = turned(rated).withColumn("r", F.row_number().over(W.partitionBy("node").orderBy(F.desc("s"), "other"))).where(F.col("r") <= k + 1).drop("r").unionAll(same)
    # each node's neighbours as rows, then those of each of its rows
    listed = near.join(shown.select(F.col("node").alias("other"), F.col("key").alias("neighbour")), "other")
    listed = listed.withColumn("r", F.row_number().over(W.partitionBy("node").orderBy(F.desc("s"), "neighbour"))).where(F.col("r") <= k + 1).drop("r")
    own = rows.join(listed, "node").where(F.col("key") != F.col("neighbour"))
    ranked = own.withColumn("rank", F.row_number().over(W.partitionBy("key").orderBy(F.desc("s"), "neighbour"))).where(F.col("rank") <= k)
    return ranked.select(F.col("key").alias(key), "neighbour", F.col("s").alias("similarity"), "rank")


def search(queries: DataFrame, base: DataFrame, key: str, column: str, k: int = 5, dim: int = 64, rerank: int = 200, block: int = 50_000) -> DataFrame:
    """``key`` (of the query), ``neighbour``, ``similarity``, ``rank``: the k most similar other rows of ``base``.

    Every row of ``base`` is encoded and scored for every query, whatever cell it is in (``scan``); the ``rerank`` best
    of each query are compared exactly. Queries are a stated set.

    The rows that take part are those of ``most_similar``. Repeated queries or keys give repeated rows.
    """
    known = base.where(F.col(key).isNotNull() & usable(column, dim)).select(F.col(key).alias("key"), F.col(column).cast("array<float>").alias("v"))
    asked = queries.where(F.col(key).isNotNull() & usable(column, dim)).select(F.col(key).alias("q"), F.col(column).cast("array<float>").alias("v"))
    rows, wanted = known.count(), asked.count()
    exact = scan(asked, known, train(known, "v", dim, rows), dim, rerank, rows, wanted, block)
    ranked = exact.withColumn("rank", F.row_number().over(W.partitionBy("q").orderBy(F.desc("s"), "key"))).where(F.col("rank") <= k)
    return ranked.select(F.col("q").alias(key), F.col("key").alias("neighbour"), F.col("s").alias("similarity"), "rank")
