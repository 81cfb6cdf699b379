"""Vectors, near-duplicates, packing and mixing: against brute force on small tables."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docloom.llm import neardup, packing, vectors
from docloom.llm.mixing import mix
from docloom.llm.neardup import near_duplicates
from docloom.llm.packing import pack, plan
from docloom.llm.vectors import most_similar

# near-duplicates


def word_sets(rows, size, least):
    out = {}
    for k, t in rows:
        w = re.findall("[a-z0-9]+", (t or "").lower())
        if k is not None and len(w) >= least:
            out[k] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
    return out


def true_pairs(rows, threshold, size=3, least=20):
    s = word_sets(rows, size, least)
    ks = sorted(s)
    return {(a, b) for i, a in enumerate(ks) for b in ks[i + 1 :] if len(s[a] & s[b]) >= threshold * len(s[a] | s[b])}


def some_texts(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            w = rng.choice(rows)[1].split()
            for _ in range(rng.randrange(0, 8)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
        else:
            w = rng.choices(vocabulary, k=rng.randrange(15, 60))
        rows.append((f"k{i:04}", " ".join(w)))
    return rows


def pairs_of(found, **more):
    rows = found.pairs(**more).collect()
    assert len(rows) == len({(r.id_a, r.id_b) for r in rows})
    return {(r.id_a, r.id_b) for r in rows}


def test_near_duplicates_against_brute_force(spark):
    rows = [*some_texts(250, 1), ("x1", None), ("x2", ""), ("x3", "too few words"), (None, "w1 " * 30)]
    df = spark.createDataFrame(rows, "key string, text string").withColumn("node", F.lit(1)).withColumn("first", F.lit("clash"))
    found, want = pairs_of(near_duplicates(df, "key", "text", 0.6, 3)), true_pairs(rows, 0.6)
    assert found <= want and len(found) >= 0.98 * len(want) > 50


@pytest.mark.parametrize("threshold", [0.4, 0.6, 0.8])
def test_orders_follow_the_threshold(spark, threshold):
    depth, orders, _ = neardup.forest(threshold)
    assert depth * orders <= neardup.VALUES and (1 - threshold**depth) ** orders <= neardup.MISS
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(4000)]
    rows = []
    for i in range(200):
        w = rng.choices(vocabulary, k=60)
        rows.append((f"a{i:03}", " ".join(w)))
        for at in rng.sample(range(60), round((1 - threshold) * 11)):
            w[at] = rng.choice(vocabulary)
        rows.append((f"b{i:03}", " ".join(w)))
    found, want = pairs_of(near_duplicates(spark.createDataFrame(rows, "key string, text string"), "key", "text", threshold, 3)), true_pairs(rows, threshold)
    assert found <= want and len(want) >= 40 and len(found) >= 0.97 * len(want)


def test_thresholds_that_no_order_serves(spark):
    for bad in (0.2, 1.1):
        with pytest.raises(ValueError):
            near_duplicates(spark.createDataFrame([], "key string, text string"), "key", "text", bad)


def family(n, words, least, most, seed):
    """Edited copies of one text, most pairs of them near the threshold."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    first = rng.choices(vocabulary, k=words)
    out = []
    for i in range(n):
        w = list(first)
        for at in rng.sample(range(words), rng.randrange(least, most)):
            w[at] = rng.choice(vocabulary)
        out.append((f"f{i:04}", " ".join(w)))
    return out + [(f"o{i:04}", " ".join(rng.choices(vocabulary, k=60))) for i in range(2 * n)]


@pytest.mark.parametrize("block", [512, 20])
def test_a_crowded_family_is_found_as_well_as_others(spark, monkeypatch, block):
    # a third of the rows in one region; small regions and blocks, so that all of it goes through pairs of blocks
    for name, value in (("SPARSE", 4), ("REGION", 8), ("BLOCK", block)):
        monkeypatch.setattr(neardup, name, value)
    rows = family(150, 90, 2, 8, 4)
    found, want = pairs_of(near_duplicates(spark.createDataFrame(rows, "key string, text string"), "key", "text", 0.6, 3)), true_pairs(rows, 0.6)
    assert found <= want and len(want) > 3000 and len(found) >= 0.99 * len(want)


def test_a_family_of_a_thousand(spark):
    rows = family(1000, 200, 8, 13, 5)
    near = near_duplicates(spark.createDataFrame(rows, "key string, text string"), "key", "text", 0.6, 3)
    want = true_pairs(rows[:1000], 0.6)
    links = near.links.count()
    assert 0.95 * len(want) <= links <= len(want) and len(want) > 100_000
    assert near.classes().agg(F.sum("links")).first()[0] == 2 * links


def test_groups_of_copies(spark):
    text = " ".join(f"a{i}" for i in range(40))
    rows = [(f"c{i:03}", text.upper() if i % 2 else text) for i in range(90)] + [("d", text + " more")]
    df = spark.createDataFrame(rows, "key string, text string")
    found = near_duplicates(df, "key", "text", 0.6, 3)
    assert pairs_of(found, expand=100) == true_pairs(rows, 0.6)
    assert pairs_of(found, expand=10) == {("c000", f"c{i:03}") for i in range(1, 90)} | {("c000", "d")}
    classes = {r.key: (r.class_id, r.copies, r.links) for r in found.classes().collect()}
    assert classes["c077"] == ("c000", 90, 1) and classes["d"] == ("d", 1, 1)


def test_near_duplicates_of_nothing(spark):
    df = spark.createDataFrame([], "key long, text string")
    assert near_duplicates(df, "key", "text").pairs().count() == 0


# vectors


def neighbours(x, ids, k, least):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = np.round(u @ u.T, 6)
    out = {}
    for i in range(len(x)):
        order = sorted((j for j in range(len(x)) if j != i), key=lambda j: (-s[i, j], ids[j]))[:k]
        out[ids[i]] = [ids[j] for j in order if s[i, j] >= least]
    return out


def some_vectors(n, dim, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for i in range(n // 2, n):
        x[i] = x[rng.integers(0, n // 2)] + rng.normal(size=dim) * 0.15
    return x.astype(np.float32).astype(float)


@pytest.mark.parametrize("cell", [4096, 12])
def test_most_similar_against_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(vectors.candidates, "__defaults__", (cell,))
    x = some_vectors(400, 16, 1)
    ids = [f"v{i:03}" for i in range(len(x))]
    rows = [(k, [float(a) for a in v]) for k, v in zip(ids, x)]
    odd = [("o1", None), ("o2", [1.0] * 15), ("o3", [float("nan")] + [1.0] * 15), ("o4", [0.0] * 16), ("o5", [None] + [1.0] * 15), (None, [1.0] * 16), ("o6", [float("inf")] + [1.0] * 15)]
    df = spark.createDataFrame(rows + odd, "key string, v array<float>").withColumn("node", F.lit(0)).withColumn("s", F.lit(0))
    got = {}
    for r in most_similar(df, "key", "v", 5, 0.9, dim=16).orderBy("key", "rank").collect():
        got.setdefault(r.key, []).append(r.neighbour)
    want = {k: v for k, v in neighbours(x, ids, 5, 0.9).items() if v}
    hit = sum(len(set(got.get(k, [])) & set(v)) for k, v in want.items())
    assert set(got) <= set(want) and hit >= 0.97 * sum(map(len, want.values()))


def test_equal_vectors(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(40)] + [(50, [2.0, 4.0, 6.0, 8.0]), (51, [1.0, 2.1, 3.0, 4.0]), (52, [-1.0, 0.0, 0.0, 1.0])]
    df = spark.createDataFrame(rows, "key long, v array<float>")
    got = {}
    for r in most_similar(df, "key", "v", 3, 0.9, dim=4).orderBy("key", "rank").collect():
        got.setdefault(r.key, []).append(r.neighbour)
    assert got[0] == [1, 2, 3] and got[30] == [0, 1, 2] and len(got[51]) == 3 and len(got[50]) == 3 and 52 not in got


def test_vectors_of_nothing(spark):
    df = spark.createDataFrame([("a", None)], "key string, v array<float>")
    assert most_similar(df, "key", "v").count() == 0 and most_similar(df.limit(0), "key", "v").count() == 0


def test_every_child_has_five_neighbours(spark, tmp_path):
    from docloom.llm.queries import queries

    # far neighbours as well: random directions, and a third of the rows near one of them
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 64))
    x[400:] = x[0] + rng.normal(size=(200, 64)) * 0.1
    x = x.astype(np.float32).astype(float)
    ids = [f"c{i:03}" for i in range(600)]
    rows = [(k, [float(v) for v in r]) for k, r in zip(ids, x)] + [("none", None), ("short", [1.0] * 63)]
    spark.createDataFrame(rows, "chunk_id string, embedding array<float>").write.parquet(str(tmp_path / "children.parquet"))
    got = {}
    for r in queries()["p4_neighbours"](spark, str(tmp_path)).collect():
        got.setdefault(r.chunk_id, []).append(r.neighbour)
    want = neighbours(x, ids, 5, -1)
    assert set(got) == set(ids) and all(len(v) == 5 for v in got.values())
    assert sum(len({*got[k]} & {*want[k]}) for k in ids) >= 0.95 * 5 * len(ids)


def test_recall_over_the_test_table(spark, data):
    from docloom.llm.queries import queries
    from docloom.shared import table

    rows = [r for r in table(spark, data, "children").select("chunk_id", "embedding").collect() if r.embedding is not None and len(r.embedding) == 64 and np.isfinite(r.embedding).all()]
    ids = [r.chunk_id for r in rows]
    u = np.array([r.embedding for r in rows])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    fifth = {k: np.sort(v)[-5] for k, v in zip(ids, s)}
    at = {k: i for i, k in enumerate(ids)}
    got = queries()["p4_neighbours"](spark, data).collect()
    assert len(got) == 5 * len(ids)
    assert sum(s[at[r.chunk_id], at[r.neighbour]] >= fifth[r.chunk_id] - 1e-6 for r in got) >= 0.95 * 5 * len(ids)


@pytest.mark.parametrize("block", [50_000, 100])
def test_search_against_brute_force(spark, block):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(1500, 64)).astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)] + [(9000, None), (None, [1.0] * 64)], "key long, v array<float>").repartition(4)
    got = {}
    for r in vectors.search(df.where("key % 50 = 0"), df, "key", "v", 5, block=block).orderBy("key", "rank").collect():
        got.setdefault(r.key, []).append(r.neighbour)
    want = neighbours(x, list(range(1500)), 5, -1)
    hit = sum(len(set(got[q]) & set(want[q])) for q in got)
    assert len(got) == 30 and hit >= 0.9 * 150
    assert vectors.search(df.limit(0), df, "key", "v").count() == 0 and vectors.search(df.where("key = 0"), df.limit(0), "key", "v").count() == 0


def test_codes_and_tables():
    x = some_vectors(500, 16, 3).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    books = vectors.fit(x, books=8, words=16)
    codes, cells, there = books.encode(x, 4, 2)
    y = books.decode(codes)
    assert np.mean(((x - y) ** 2).sum(1)) < np.mean(((x - books.decode(codes[:, :1].repeat(8, 1) * 0)) ** 2).sum(1)) and cells.shape == (500, 4, 2) and there.all()
    s = books.scores(x[:5], codes, np.linalg.norm(y, axis=1))
    assert np.allclose(s, x[:5] @ (y / np.linalg.norm(y, axis=1, keepdims=True)).T, atol=1e-4)
    greedy, _, _ = books.encode(x, 1, 2)
    assert ((x - y) ** 2).sum() <= ((x - books.decode(greedy)) ** 2).sum() + 1e-3


# packing


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), min_size=1, max_size=20))
@settings(max_examples=60, deadline=None)
def test_plans_hold_every_item_once(histogram):
    p = plan(histogram, 64)
    used = Counter()
    for repeats, parts in p.patterns:
        assert repeats > 0 and sum(s * k for s, k in parts.items()) <= 64
        for s, k in parts.items():
            used[s] += repeats * k
    assert used == Counter(histogram)


def test_plans_waste_little():
    rng = np.random.default_rng(1)
    h = Counter(np.clip(rng.lognormal(5, 1, 20_000).astype(int), 1, 2048).tolist())
    total = sum(s * n for s, n in h.items())
    assert plan(h, 2048).containers <= 1.005 * total / 2048 + 1


def test_pack(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 7)
    rows = [(i, "w " * (i % 13), 1) for i in range(100)] + [(200, None, 1), (201, "", 1), (202, "w " * 45, 1), (203, "w " * 20, 1), (5, "w " * 5, 1), (None, "w w", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, container int")
    got = pack(df, "doc_id", "text", 20).toPandas()
    sums = got.groupby("container").tokens.sum()
    assert len(got) == len(rows) + 2 and sums.max() <= 20 and got.tokens.sum() == sum(len((t or "").split()) for _, t, _ in rows)
    big = got[got.doc_id == 202].sort_values("piece_no")
    assert big.tokens.tolist() == [20, 20, 5] and set(big.n_pieces) == {3} and len(set(big.container)) == 3
    assert len(sums) <= got.tokens.sum() / 20 + 3 and sorted(sums.index) == list(range(len(sums)))
    assert pack(df.limit(0), "doc_id", "text", 20).count() == 0
    with pytest.raises(ValueError):
        pack(df, "doc_id", "text", 0)


# mixing


def test_mix(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randrange(5, 30), rng.choice([" A ", "a", "B", "c", None, "unknown"]), rng.choice(["en", "DE", None, "xx"]), rng.choice(["Big Pump", None, "Tank", "Old Pump"])) for i in range(3000)]
    rows += [(5000, None, "a", None, None), (5001, "", "b", "en", "T")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, title string").withColumn("uses", F.lit(9))
    targets = spark.createDataFrame([("A", 0.5, 1), ("b ", 0.1, 3), ("C", 0.3, 4), ("nobody", 0.1, 2)], "source string, target_share double, max_repeats int")
    m = mix(docs, targets, "doc_id", "text")
    s = {r.source: r for r in m.shares.collect()}
    tokens = Counter()
    for _, t, name, _, _ in rows:
        if name:
            tokens[name.strip().lower()] += len((t or "").split())
    total = sum(tokens.values())
    assert not s["A"].reachable and not s["nobody"].reachable and s["b "].reachable and s["C"].reachable
    assert s["A"].reached_tokens == tokens["a"] and s["nobody"].reached_tokens == 0
    assert all(abs(r.reached_tokens - r.goal) <= 2 for r in s.values())
    uses = m.uses.collect()
    assert len(uses) == len(rows) and all(0 <= r.uses <= {"a": 1, "b": 3, "c": 4}.get(r.source, 0) for r in uses)
    assert {r.doc_id: r.uses for r in uses} == {r.doc_id: r.uses for r in mix(docs.repartition(7), targets, "doc_id", "text").uses.collect()}
    assert total > 0 and mix(docs.limit(0), targets, "doc_id", "text").uses.count() == 0
    assert mix(docs, targets.limit(0), "doc_id", "text").shares.count() == 0
