"""Problem 5: near-duplicate texts with an LSH forest."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.shared import durable, small

_WORD = re.compile(r"[a-z0-9]+")
#: Values of a signature, two bytes each. Orders read disjoint runs of them.
VALUES = 64
#: Chance with which a pair at the threshold may be missed by all orders.
MISS = 0.01
#: Thresholds below this would need orders of one value, where most texts are neighbours of most others.
LEAST_THRESHOLD = 0.35
#: A region of up to so many texts is compared one value higher up, where more neighbours are found.
SPARSE = 4
#: A region of one order with more texts, too many for one block, is compared in pairs of blocks.
REGION = 512
#: Texts and shingles of a block of a crowded region, about.
BLOCK, BLOCK_SHINGLES = 512, 400_000
#: Copies of one text up to which all their pairs are listed; of more, only those with the first.
EXPAND = 64
_rng = np.random.default_rng(20240229)
_XOR = _rng.integers(0, 1 << 32, VALUES, dtype=np.uint32)
_MUL = _rng.integers(0, 1 << 31, VALUES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


class _Words(dict):
    """Hashes of words, kept while a task runs."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def _shingles(texts: list[str], cache: _Words, size: int, least: int) -> tuple[list[int], np.ndarray, np.ndarray, list[np.ndarray]]:
    """Texts with ``least`` words: their places, the hashes of all their shingles, where each begins, and word hashes."""
    kept, arrays = [], []
    for i, t in enumerate(texts):
        if t is None:
            continue
        words = _WORD.findall(t.lower())
        if len(words) >= max(least, size):
            kept.append(i)
            arrays.append(np.fromiter(map(cache.__getitem__, words), np.uint64, len(words)))
    if not kept:
        return [], np.zeros(0, np.uint64), np.zeros(0, np.int64), []
    flat = np.concatenate(arrays)
    n = len(flat) - size + 1
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = h * np.uint64(0x100000001B3) + flat[k : k + n] * _MIX[k % 3]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    ends = np.cumsum([len(a) for a in arrays])
    inside = np.ones(n, bool)
    for k in range(1, size):
        cut = ends[:-1] - k
        inside[cut[cut < n]] = False
    h = h[inside]
    starts = np.concatenate([[0], np.cumsum([len(a) - size + 1 for a in arrays])[:-1]]).astype(np.int64)
    return kept, h, starts, arrays


def signatures(size: int, least: int):
    """A function of Arrow batches (key, text) to (key, node, signature, sketch) for ``mapInArrow``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Words()
        for whole in batches:
            for at in range(0, len(whole), 1000):
                batch = whole.slice(at, 1000)
                kept, h, starts, arrays = _shingles(batch.column(1).to_pylist(), cache, size, least)
                if not kept:
                    continue
                low = h.astype(np.uint32)
                sig = np.empty((len(kept), VALUES), np.uint32)
                for k in range(VALUES):
                    sig[:, k] = np.minimum.reduceat((low ^ _XOR[k]) * _MUL[k], starts)
                # minima are small numbers: what is kept of them is mixed first
                sig *= np.uint32(0x85EBCA6B)
                sig ^= sig >> np.uint32(15)
                bits = np.packbits((sig >> np.uint32(16)) & np.uint32(1), axis=1).view(np.int64).ravel()
                node = np.array([xxhash.xxh64_intdigest(a.tobytes()) for a in arrays], np.uint64).view(np.int64)
                short = np.ascontiguousarray(sig.astype(np.uint16))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(kept)), pa.array(node), pa.array([r.tobytes() for r in short], pa.binary()), pa.array(bits)], names=["key", "node", "sig", "sketch"]
                )

    return run


def shingle_sets(size: int):
    """A function of Arrow batches (node, text) to (node, distinct shingle hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Words()
        for batch in batches:
            kept, h, starts, _ = _shingles(batch.column(1).to_pylist(), cache, size, size)
            parts = np.split(h.view(np.int64), starts[1:]) if kept else []
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept, pa.int64())), pa.array([np.unique(p) for p in parts], pa.list_(pa.int64()))], names=["node", "shingles"])

    return run


def forest(threshold: float) -> tuple[int, int, int]:
    """Depth and number of the orders for a threshold, and the bits of 64 in which sketches of such texts may differ.

    The deepest orders that ``VALUES`` values allow are taken of which all miss a pair at the threshold with a
    probability of at most ``MISS``; a bit of the sketch differs with half the dissimilarity, and three standard
    deviations more are allowed.
    """
    if not LEAST_THRESHOLD <= threshold <= 1:
        raise ValueError(f"threshold must be from {LEAST_THRESHOLD} to 1")
    depth = max(d for d in range(1, 9) if (1 - threshold**d) ** (VALUES // d) <= MISS)
    p = (1 - threshold) / 2
    return depth, VALUES // depth, int(np.ceil(64 * p + 3 * np.sqrt(64 * p * (1 - p))))


def region(order: Column, begin: Column, depth: int) -> Column:
    """Key of the region of a signature in an order: its first ``depth`` values from ``begin`` on."""
    return F.xxhash64(order, F.lit(depth), F.substring(F.col("sig"), 2 * begin + 1, F.lit(2 * depth)))


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bits in which 64-bit sketches differ; of signed numbers NumPy would count those of the absolute value."""
    return np.bitwise_count((x ^ y).view(np.uint64))


def neighbours(bits: int):
    """Arrow batches (r, node, sketch), sorted by r, to pairs (a, b) of nodes in runs of one r whose sketches are near.

    Runs are of bounded size: the last of a batch waits for the next batch.
    """

    def pairs(r: np.ndarray, node: np.ndarray, sketch: np.ndarray) -> pa.RecordBatch:
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        i, d = np.arange(len(r)), 0
        while len(i):
            d += 1
            i = i[: np.searchsorted(i, len(r) - d)]
            i = i[r[i] == r[i + d]]
            near = i[_apart(sketch[i], sketch[i + d]) <= bits]
            x, y = node[near], node[near + d]
            a.append(np.minimum(x, y)), b.append(np.maximum(x, y))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            now = [np.concatenate([x, batch.column(k).to_numpy()]) for k, x in enumerate(rest)]
            if not len(now[0]):
                continue
            cut = int(np.argmax(now[0] == now[0][-1])) if now[0][0] != now[0][-1] else 0
            rest = [x[cut:] for x in now]
            yield pairs(*(x[:cut] for x in now))
        yield pairs(*rest)

    return run


def placed(nodes: DataFrame, depth: int, orders: int) -> tuple[DataFrame, DataFrame]:
    """Each node's region in each order (o, r, node, sketch), and the crowded regions (r, count).

    Texts that share the first values of a sorted order are neighbours there. A region is as deep as it has to be:
    ``depth`` values, or one less where only ``SPARSE`` texts share those. No region is deeper, however many texts it
    has, so that what is found doesn't depend on the table's size. Sizes are counted with a partial count first.
    """
    rows = nodes.select("node", "sig", "sketch", F.explode(F.sequence(F.lit(0), F.lit(orders - 1))).alias("o"))
    begin = F.col("o") * depth
    # the signature doesn't travel: regions are hashes
    flat = rows.select("o", "node", "sketch", region(F.col("o"), begin, depth).alias("r"), region(F.col("o"), begin, depth - 1).alias("up"))
    if depth > 1:
        dense = durable(flat.groupBy("up").count().where(F.col("count") > SPARSE).select("up", F.col("count").alias("size")))
        flat = flat.join(small(dense), "up", "left").withColumn("r", F.when(F.col("size").isNotNull(), F.col("r")).otherwise(F.col("up")))
        # what has few texts one value higher up isn't crowded below
        counted = flat.where(F.col("size") > REGION)
    else:
        counted = flat
    crowded = durable(counted.groupBy("r").count().where(F.col("count") > REGION))
    return flat.select("o", "r", "node", "sketch"), crowded


def candidates(flat: DataFrame, crowded: DataFrame, bits: int) -> DataFrame:
    """Distinct pairs (a < b) of nodes that are neighbours in some region that isn't crowded."""
    rows = flat if crowded.isEmpty() else flat.join(small(crowded.select("r")), "r", "left_anti")
    ordered = rows.select("r", "node", "sketch").repartition("r").sortWithinPartitions("r")
    return ordered.mapInArrow(neighbours(bits), "a long, b long").distinct()


def crowd_links(threshold: float, bits: int):
    """A function of one pair of blocks of a crowded region to its links (a, b, n, m): shared and summed shingles.

    Pairs whose sketches are near are compared exactly: few of them set by set, many by products of incidence
    matrices, a slice of the shingles at a time. A pair is left to the first order in which its nodes meet.
    """

    def meet(rows: pa.Table) -> pa.Table:
        node, own, order = rows.column("node").to_numpy(), rows.column("i").to_numpy(), rows.column("o").to_numpy()[0]
        sketch = rows.column("sketch").to_numpy()
        lists = rows.column("shingles").combine_chunks()
        size, values = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()
        starts = np.concatenate([[0], np.cumsum(size)])
        regions = np.asarray(rows.column("regions").combine_chunks().flatten().to_numpy(), np.int64).reshape(len(node), -1)
        lo, hi = rows.column("lo").to_numpy()[0], rows.column("hi").to_numpy()[0]
        left, right = np.nonzero(own == lo)[0], np.nonzero(own == hi)[0]
        x, y = np.nonzero(_apart(sketch[left][:, None], sketch[right][None, :]) <= bits)
        x, y = left[x], right[y]
        keep = node[x] < node[y] if lo == hi else node[x] != node[y]
        x, y = x[keep], y[keep]
        first = ~(regions[x][:, :order] == regions[y][:, :order]).any(1) if order else np.ones(len(x), bool)
        x, y = x[first], y[first]
        if len(x) <= 20 * len(node):
            parts = np.split(values, starts[1:-1])
            shared = np.array([len(np.intersect1d(parts[p], parts[q], assume_unique=True)) for p, q in zip(x, y)], np.int64)
        else:
            _, code, times = np.unique(values, return_inverse=True, return_counts=True)
            at = np.repeat(np.arange(len(node)), size)
            fine = times[code] > 1  # others are in one text only
            dense, code = np.unique(code[fine], return_inverse=True)
            at, total = at[fine], np.zeros((len(node), len(node)), np.float32)
            for begin in range(0, len(dense), 4096):
                inside = (code >= begin) & (code < begin + 4096)
                there = np.zeros((len(node), min(4096, len(dense) - begin)), np.float32)
                there[at[inside], code[inside] - begin] = 1
                total += there @ there.T
            shared = total[x, y].astype(np.int64)
        both = size[x] + size[y]
        link = shared * (1 + threshold) >= threshold * both - 1e-9
        a, b = node[x[link]], node[y[link]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b), "n": shared[link].astype(np.int32), "m": both[link].astype(np.int32)})

    return meet


@dataclass
class NearDuplicates:
    """``members``: key, node (texts of the same words), copies. ``links``: a, b, similarity between different nodes."""

    members: DataFrame
    links: DataFrame

    def pairs(self, expand: int = EXPAND) -> DataFrame:
        """Pairs of keys, the smaller first: of linked texts and of copies.

        Copies of one text are listed with each other and with all of a linked text's up to ``expand`` copies; of
        more, the first stands for all, and ``members`` has the rest.
        """
        shown = self.members.where((F.col("copies") <= expand) | (F.col("key") == F.col("first"))).select("key", "node")
        a = shown.select(F.col("node").alias("a"), F.col("key").alias("x"))
        b = shown.select(F.col("node").alias("b"), F.col("key").alias("y"))
        linked = self.links.join(a, "a").join(b, "b").select("x", "y")
        copies = self.members.where("copies > 1").select("key", "node", "copies", "first")
        few = copies.where(F.col("copies") <= expand)
        same = few.select("node", F.col("key").alias("x")).join(few.select("node", F.col("key").alias("y")), "node").where("x < y").select("x", "y")
        star = copies.where((F.col("copies") > expand) & (F.col("key") != F.col("first"))).select(F.col("first").alias("x"), F.col("key").alias("y"))
        return reduce(DataFrame.unionByName, [linked, same, star]).select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))

    def classes(self) -> DataFrame:
        """One row a text: key, class_id (the first of its copies), copies, links (different texts near it)."""
        ends = self.links.select(F.col("a").alias("node")).unionAll(self.links.select(F.col("b").alias("node"))).groupBy("node").count()
        return self.members.join(ends, "node", "left").select("key", F.col("first").alias("class_id"), "copies", F.coalesce("count", F.lit(0)).alias("links"))


def near_duplicates(texts: DataFrame, key: str, text: str, threshold: float = 0.8, shingle: int = 5, least_words: int = 20) -> NearDuplicates:
    """Texts whose sets of word shingles have a Jaccard similarity of at least ``threshold``.

    Words are the maximal runs of a-z and 0-9 of the lower-cased text. Texts of the same words are one node. A forest
    of sorted orders of the signature makes nodes neighbours (``forest``, ``placed``), and neighbours are compared
    exactly, by their whole sets. Regions of more than ``REGION`` texts are cut into hashed blocks of about ``BLOCK``
    texts, and each pair of blocks is compared as a group of its own, so that only bounded groups are gathered and no
    pair is lost. A pair at the threshold is missed with a probability of at most ``MISS``, above it with less.

    Texts that are null or have fewer than ``least_words`` words take no part. Keys must be unique and not null; rows
    with null keys take no part, repeated rows are copies of each other. Other columns are not carried along. An
    empty table gives empty results. Thresholds below ``LEAST_THRESHOLD`` raise ``ValueError``.
    """
    depth, orders, bits = forest(threshold)
    base = texts.select(F.col(key).alias("key"), F.col(text).alias("text")).where("key IS NOT NULL")
    kind = base.schema["key"].dataType.simpleString()
    sigs = durable(base.mapInArrow(signatures(shingle, least_words), f"key {kind}, node long, sig binary, sketch long"))
    count = sigs.groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.min("key").alias("first"))
    classes = durable(count)
    members = sigs.select("key", "node").join(classes, "node")
    copied = small(classes.where("copies > 1").select("node", "first"))
    nodes = sigs.join(copied, "node", "left").where("first IS NULL OR key = first").select("node", "sig", "sketch")

    def sets_of(asked: DataFrame) -> DataFrame:
        keys = durable(asked.join(classes, "node").select("node", F.col("first").alias("key")))
        return durable(base.join(small(keys), "key").select("node", "text").mapInArrow(shingle_sets(shingle), "node long, shingles array<long>"))

    flat, crowded = placed(nodes, depth, orders)
    pairs = durable(candidates(flat, crowded, bits))
    sets = sets_of(pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct())
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("s"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("t"))
    rated = pairs.join(a, "a").join(b, "b").select("a", "b", F.size(F.array_intersect("s", "t")).alias("n"), (F.size("s") + F.size("t")).alias("m"))
    # n / (m - n) >= threshold
    links = rated.where(F.col("n") * (1 + threshold) >= threshold * F.col("m") - 1e-9)
    if not crowded.isEmpty():
        there = durable(flat.join(small(crowded), "r"))
        met = there.select("node").distinct()
        sets = sets_of(met)
        regions = flat.join(small(durable(met)), "node", "left_semi").groupBy("node").agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "r"))), lambda x: x["r"]).alias("regions"))
        full = durable(there.join(sets, "node").join(regions, "node"))
        cuts = full.groupBy("r").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum(F.size("shingles")) / BLOCK_SHINGLES)).cast("int").alias("k"))
        own = full.join(small(durable(cuts)), "r").withColumn("i", F.pmod(F.xxhash64("node", F.lit(1)), F.col("k")).cast("int"))
        facing = own.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        blocks = facing.select("r", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"), "i", "o", "node", "sketch", "shingles", "regions")
        links = links.unionByName(blocks.groupBy("r", "lo", "hi").applyInArrow(crowd_links(threshold, bits), "a long, b long, n int, m int")).distinct()
    return NearDuplicates(members, durable(links.select("a", "b", (F.col("n") / (F.col("m") - F.col("n"))).alias("similarity"))))
