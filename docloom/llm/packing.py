"""Problem 7: filling fixed-capacity containers with items, by non-negative least squares over length combinations."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.functions.tokens import token_count
from docloom.shared import durable, small

#: Rows that share one numbering bucket; more buckets are used for more rows.
BUCKET_ROWS = 500_000


def combinations(sizes: np.ndarray, counts: np.ndarray, capacity: int, window: int, fillers: int = 24) -> np.ndarray:
    """Shallow combinations that fill a container up to ``window``: rows (a, m, b, n, c, o), for m x a + n x b + o x c.

    For every size a, some multiples m of it and some frequent sizes b with all multiples n that fit, c is the largest
    size that still fits.
    """
    mass = np.cumsum(counts * sizes)
    b = np.unique(sizes[np.searchsorted(mass, mass[-1] * (np.arange(fillers) + 0.5) / fillers)])
    out = []
    for a in sizes:
        top = capacity // a
        for m in {1, 2, (top + 1) // 2, top} - {0}:
            if m > top:
                continue
            rest = capacity - m * a
            n = np.unique(np.concatenate([np.zeros(len(b), int), rest // b, rest // b // 2]))[:, None]
            left = rest - n * b[None, :]
            k = np.searchsorted(sizes, left, side="right") - 1
            c = np.where((left > 0) & (k >= 0), sizes[np.maximum(k, 0)], 0)
            fits = (left >= 0) & (left - c <= window)
            i, j = np.nonzero(fits)
            out.append(np.column_stack([np.full(len(i), a), np.full(len(i), m), b[j], n[i, 0], c[i, j], c[i, j] > 0]))
    found = np.concatenate(out) if out else np.zeros((0, 6), int)
    found[found[:, 3] == 0, 2] = 0
    return np.unique(found, axis=0)


def solve(combos: np.ndarray, sizes: np.ndarray, counts: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Repeat counts x >= 0 that make the sizes used come nearest to ``counts``: accelerated projected gradient.

    Rows are weighted by 1 / sqrt(count), so that rare and frequent sizes count alike.
    """
    at = np.searchsorted(sizes, combos[:, [0, 2, 4]]).clip(0, len(sizes) - 1)
    times = (combos[:, [1, 3, 5]] * (combos[:, [0, 2, 4]] > 0)).astype(float)
    weight = 1 / np.sqrt(counts)
    times = times * weight[at]
    goal = counts * weight

    def used(x: np.ndarray) -> np.ndarray:
        return np.bincount(at.ravel(), (times * x[:, None]).ravel(), len(sizes))

    v = np.ones(len(combos))
    for _ in range(20):  # largest eigenvalue, for the step
        v = (times * used(v)[at]).sum(1)
        top = np.linalg.norm(v)
        v /= top
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - (times * (used(y) - goal)[at]).sum(1) / (1.05 * top))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / t2 * (new - x), new, t2
    return x


@dataclass
class Plan:
    """How often which combination of sizes is used: ``patterns`` has (repeats, {size: items}) in container order."""

    patterns: list[tuple[int, dict[int, int]]]

    @property
    def containers(self) -> int:
        return sum(r for r, _ in self.patterns)

    def segments(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For items numbered within their size: keys (size and first number), first container, items a container."""
        nxt: dict[int, int] = {}
        rows, base = [], 0
        for repeats, parts in self.patterns:
            for s, k in parts.items():
                rows.append(((s << 44) + nxt.get(s, 0), base, k))
                nxt[s] = nxt.get(s, 0) + k * repeats
            base += repeats
        table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 3)
        return table[:, 0], table[:, 1], table[:, 2]


def plan(histogram: dict[int, int], capacity: int, window: int | None = None) -> Plan:
    """Containers for a histogram of sizes from 1 to ``capacity``.

    Its work is bounded by ``capacity``, whatever the counts: combinations are solved for, rounded down, used as far
    as items last, and what is left is packed by size, the largest first, a combination as often as its items allow.
    """
    left = {s: n for s, n in histogram.items() if n > 0}
    patterns: list[tuple[int, dict[int, int]]] = []
    if n := left.pop(capacity, 0):
        patterns.append((n, {capacity: 1}))
    if left:
        sizes = np.array(sorted(left))
        counts = np.array([left[int(s)] for s in sizes], dtype=float)
        combos = combinations(sizes, counts, capacity, max(1, capacity // 256) if window is None else window)
        if len(combos):
            x = np.floor(solve(combos, sizes, counts) + 1e-6).astype(np.int64)
            for i in np.argsort(-x, kind="stable"):
                if x[i] < 1:
                    break
                parts: dict[int, int] = {}
                for s, k in combos[i].reshape(3, 2).tolist():
                    if s and k:
                        parts[s] = parts.get(s, 0) + k
                r = min(int(x[i]), *(left[s] // k for s, k in parts.items()))
                if r > 0:
                    patterns.append((r, parts))
                    for s, k in parts.items():
                        left[s] -= k * r
    alive = sorted(s for s, n in left.items() if n > 0)
    while alive:
        parts, space = {}, capacity
        i = len(alive) - 1
        while i >= 0 and space:
            i = int(np.searchsorted(alive, space, side="right")) - 1 if alive[i] > space else i
            if i < 0:
                break
            s = alive[i]
            k = min(space // s, left[s])
            parts[s] = k
            space -= k * s
            i -= 1
        r = min(left[s] // k for s, k in parts.items())
        patterns.append((r, parts))
        for s, k in parts.items():
            left[s] -= k * r
        alive = [s for s in alive if left[s] > 0]
    return Plan(patterns)


def numbered(rows: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    """``rows`` with ``_rank``, from 0, within ``group``; large groups are numbered in hashed buckets, then shifted."""
    buckets = max(1, -(-n // BUCKET_ROWS))
    split = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = split.groupBy(group, "_bucket").count()
    before = W.partitionBy(group).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    shift = durable(counts.select(group, "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_shift")))
    ranked = split.withColumn("_rank", F.row_number().over(W.partitionBy(group, "_bucket").orderBy(*order)) - 1)
    return ranked.join(small(shift), [group, "_bucket"]).withColumn("_rank", F.col("_rank") + F.col("_shift")).drop("_bucket", "_shift")


def pack(documents: DataFrame, key: str, text: str, capacity: int = 2048) -> DataFrame:
    """``key``, ``piece_no``, ``n_pieces``, ``first_token`` (from 0), ``tokens``, ``container`` of every piece of every document.

    Sizes are in tokens of the public rule. Documents of up to ``capacity`` tokens are one piece; larger ones are cut
    into full containers and a rest. The histogram of sizes, at most ``capacity`` numbers, is all that the driver
    sees; documents get their containers from their number within their size.
    Null and empty texts have size 0 and stand in container 0, of which they use nothing. Repeated rows are packed
    each; ties are ordered by key. An empty table gives an empty result; other columns are not carried along.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    if key in ("piece_no", "n_pieces", "first_token", "tokens", "container"):
        raise ValueError(f"{key} is the name of an added column")
    size = F.coalesce(token_count(text), F.lit(0).cast("long"))
    sized = durable(documents.select(F.col(key).alias("_key"), size.alias("_tokens")))
    n_pieces = F.greatest(F.lit(1), F.ceil(F.col("_tokens") / capacity)).cast("int")
    cut = sized.withColumn("n_pieces", n_pieces).withColumn("piece_no", F.explode(F.sequence(F.lit(1), F.col("n_pieces"))))
    rest = F.col("_tokens") - (F.col("n_pieces") - 1) * F.lit(capacity)
    pieces = cut.select("_key", "piece_no", "n_pieces", F.when(F.col("piece_no") < F.col("n_pieces"), F.lit(capacity)).otherwise(rest).cast("long").alias("tokens"))
    histogram = {r["tokens"]: r["count"] for r in pieces.groupBy("tokens").count().collect()}
    n = sum(histogram.values())
    keys, base, per = plan({int(s): int(c) for s, c in histogram.items() if s > 0}, capacity).segments()

    @F.pandas_udf("long")
    def container(tokens: pd.Series, rank: pd.Series) -> pd.Series:
        k = (tokens.to_numpy(np.int64) << 44) + rank.to_numpy(np.int64)
        i = np.searchsorted(keys, k, side="right") - 1
        return pd.Series(np.where(tokens > 0, base[i] + (k - keys[i]) // per[i], 0)) if len(keys) else pd.Series(np.zeros(len(k), np.int64))

    ranked = numbered(pieces, "tokens", ["_key", "piece_no"], n)
    return ranked.select(F.col("_key").alias(key), "piece_no", "n_pieces", ((F.col("piece_no") - 1) * F.lit(capacity)).cast("long").alias("first_token"), "tokens", container("tokens", "_rank").alias("container"))
