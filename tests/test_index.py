import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.config import Config
from docloom.errors import GuardError, InputError, SchemaMismatch
from docloom.operators import chunk, embed, index, knn
from docloom.operators.store import CHILDREN, PARENTS, IndexStore

CONFIG = Config(dim=4)


def unit(*x):
    v = np.array(x, float)
    return [float(y) for y in v / np.linalg.norm(v)]


def inputs(spark, version="1", n=6, revision="r"):
    parents, children = [], []
    for i in range(n):
        pid = f"{version}:m:c:page{i}:p01"
        shared = {"title": f"t{i}", "source_url": f"u{i}", "version": version, "mod": "m", "chapter": "c", "page": f"page{i}", "section": f"t{i}"}
        parents.append({"parent_id": pid, "text": f"whole text {i} of it", "token_count": 5, **shared})
        children.append({"chunk_id": f"{pid}:c01", "parent_id": pid, "text": f"text {i}", "token_count": 2, "embedding": unit(1, i, 2, 3), "model_name": "model", "model_revision": revision, **shared})
    return spark.createDataFrame(parents, PARENTS), spark.createDataFrame(children, CHILDREN)


def counts(df):
    return {(r.table, r.change): r.n for r in df.collect()}


def content(store):
    return [store._read(n, s).orderBy(k).collect() for n, s, k in (("parents", PARENTS, "parent_id"), ("children", CHILDREN, "chunk_id"))]


CASES = {
    "orphan": (None, lambda c: c.withColumn("parent_id", F.when(F.col("parent_id").contains("page1"), "gone").otherwise(F.col("parent_id"))), "orphan"),
    "versions": (None, lambda c: c.withColumn("version", F.when(F.col("page") == "page1", "2").otherwise("1")), "version"),
    "duplicate": (None, lambda c: c.unionByName(c.limit(1)), "duplicate"),
    "dim": (None, lambda c: c.withColumn("embedding", F.when(F.col("page") == "page1", F.slice("embedding", 1, 3)).otherwise(F.col("embedding"))), "vector"),
    "nan": (None, lambda c: c.withColumn("embedding", F.when(F.col("page") == "page1", F.array(*[F.lit(float("nan")).cast("float")] * 4)).otherwise(F.col("embedding"))), "vector"),
    "nul": (lambda p: p.withColumn("title", F.when(F.col("page") == "page1", F.lit("a\0b")).otherwise(F.col("title"))), None, "shape"),
    "childless": (None, lambda c: c.where("page <> 'page1'"), "childless"),
    "substring": (None, lambda c: c.withColumn("text", F.when(F.col("page") == "page1", "other").otherwise(F.col("text"))), "misplaced"),
    "prefix": (None, lambda c: c.withColumn("chunk_id", F.when(F.col("page") == "page1", "x:c01").otherwise(F.col("chunk_id"))), "misplaced"),
    "models": (None, lambda c: c.withColumn("model_revision", F.when(F.col("page") == "page1", "q").otherwise("r")), "models"),
    "norm": (None, lambda c: c.withColumn("embedding", F.transform("embedding", lambda x: (x * 1.01).cast("float"))), "vector"),
    "count": (lambda p: p.withColumn("token_count", F.lit(0)), None, "shape"),
}


@pytest.mark.parametrize("case", CASES)
def test_faults_are_found_and_nothing_is_written(spark, tmp_path, case):
    p, c = inputs(spark)
    alter_p, alter_c, rule = CASES[case]
    p, c = alter_p(p) if alter_p else p, alter_c(c) if alter_c else c
    assert rule in {r.rule for r in index.violations(p, c, "1", CONFIG).collect()}
    store = IndexStore(spark, str(tmp_path / "s"), CONFIG)
    with pytest.raises(InputError):
        store.write(p, c, "1", "update")
    assert store.pointer() == {"parents": {}, "children": {}}


def test_vector_rows_are_held_against_chunks(spark):
    p, c = inputs(spark)
    chunks = c.drop("embedding", "model_name", "model_revision")
    assert index.violations(p, c, "1", CONFIG, chunks).count() == 0
    other = chunks.withColumn("title", F.when(F.col("page") == "page1", None).otherwise(F.col("title"))).where("page <> 'page2'")
    assert {(r.rule, r.key[-12:-4]) for r in index.violations(p, c, "1", CONFIG, other).collect()} == {("pairing", "age1:p01"), ("pairing", "age2:p01")}
    found = {r.key[-12:-4]: r.differing for r in index.row_differences(other, c.unionByName(c.where("page = 'page3'")), "chunk_id", ["title", "text"]).collect()}
    assert found == {"age1:p01": ["title"], "age2:p01": ["unforeseen"], "age3:p01": ["repeated"]}
    wrong = c.withColumn("embedding_input", F.concat("section", F.lit("\n\n"), F.when(F.col("page") == "page4", "x").otherwise(F.col("text"))))
    assert [r.rule for r in index.violations(p, wrong, "1", CONFIG).collect()] == ["input"]


def test_of_two_writers_one_is_refused(spark, tmp_path):
    from docloom.errors import WriteError

    one, two = IndexStore(spark, str(tmp_path / "s"), CONFIG), IndexStore(spark, str(tmp_path / "s"), CONFIG)
    with pytest.raises(WriteError):
        one.write(*inputs(spark), "1", "update", before_publish=lambda: two.write(*inputs(spark, version="2"), "2", "update"))
    assert one.parents().count() == 6 and set(one.pointer()["parents"]) == {"2"}


def test_good_inputs_have_no_faults(spark):
    assert index.violations(*inputs(spark), "1", CONFIG).count() == 0


def test_update_counts_and_idempotence(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "s"), CONFIG)
    p, c = inputs(spark)
    assert counts(store.write(p, c, "1", "update")) == {("parents", "inserted"): 6, ("children", "inserted"): 6}
    p2 = p.where("page NOT IN ('page4', 'page5')").withColumn("title", F.when(F.col("page") == "page1", "new").otherwise(F.col("title")))
    c2 = c.where("page NOT IN ('page4', 'page5')").withColumn("section", F.when(F.col("page") == "page2", "new").otherwise(F.col("section")))
    want = {(t, k): n for t in ("parents", "children") for k, n in (("deleted", 2), ("unchanged", 3), ("updated", 1))}
    assert counts(store.write(p2, c2, "1", "update")) == want
    before = content(store)
    assert counts(store.write(p2, c2, "1", "update")) == {("parents", "unchanged"): 4, ("children", "unchanged"): 4}
    assert content(store) == before


def test_a_failure_before_publishing_changes_nothing(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "s"), CONFIG)
    store.write(*inputs(spark), "1", "update")
    before = content(store)

    def fail():
        raise RuntimeError("lost")

    for mode in ("update", "rebuild"):
        with pytest.raises(RuntimeError):
            store.write(*inputs(spark, n=3), "1", mode, before_publish=fail)
        assert content(store) == before


def test_versions_and_models_are_guarded(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "s"), CONFIG)
    store.write(*inputs(spark), "1", "update")
    with pytest.raises(GuardError, match="rebuild"):
        store.write(*inputs(spark, revision="other"), "1", "update")
    assert counts(store.write(*inputs(spark, n=2, revision="other"), "1", "rebuild")) == {("parents", "deleted_before"): 6, ("parents", "inserted"): 2, ("children", "deleted_before"): 6, ("children", "inserted"): 2}
    with pytest.raises(GuardError):
        store.write(*inputs(spark, version="2"), "2", "rebuild")
    store.write(*inputs(spark, version="2", revision="other"), "2", "rebuild")
    assert store.parents("1").count() == 2 and store.parents("2").count() == 6 and store.parents().count() == 8


def test_schema_is_checked(spark, tmp_path):
    p, c = inputs(spark)
    for bad in (p.drop("page"), p.withColumn("more", F.lit(1)), p.withColumn("token_count", F.col("token_count").cast("long"))):
        with pytest.raises(SchemaMismatch):
            IndexStore(spark, str(tmp_path / "s"), CONFIG).write(bad, c, "1", "update")


def test_fingerprint_ignores_order_only(spark):
    p, _ = inputs(spark)
    f = lambda df: index.fingerprint(df, "parent_id", index.PARENT_COLUMNS).first()
    assert f(p) == f(p.orderBy(F.desc("parent_id")).repartition(3)) != f(p.withColumn("title", F.lit("x")))
    assert f(p.limit(0)).n == 0


def test_embedding(spark):
    _, c = inputs(spark)
    out = embed.embed(c.drop("embedding", "model_name", "model_revision"), lambda: embed.hashing_encoder(4), "m", "r", CONFIG)
    rows = out.collect()
    assert all(abs(sum(x * x for x in r.embedding) - 1) < 1e-5 and r.embedding_input == f"{r.section}\n\n{r.text}" for r in rows)
    with pytest.raises(InputError):
        embed.embed(c, lambda: embed.hashing_encoder(4), "m", "r", Config(input_limit=2))


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 8))
    x[7] = x[3]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, v array<float>").repartition(3)
    x = x.astype(np.float32).astype(float)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    d = 1 - u @ u.T
    got = knn.exact_top_k(df.where("id % 10 = 0 OR id = 3"), df, "id", "v", 4, block=3).collect()
    for q in {r["query"] for r in got}:
        mine = sorted((r["rank"], r["neighbour"], r["distance"]) for r in got if r["query"] == q)
        want = sorted(range(60), key=lambda j: (round(d[q, j], 12), j))[:4]
        assert [m[1] for m in mine] == want and all(abs(m[2] - d[q, m[1]]) < 1e-9 for m in mine)
    ties = knn.tie_sets(spark.createDataFrame([(1, 2, 0.1), (1, 3, 0.1 + 5e-7), (1, 4, 0.2)], "query long, neighbour long, distance double"))
    assert {r.neighbour for r in ties.collect()} == {2, 3}
    assert knn.exact_top_k(df.limit(0), df, "id", "v").count() == 0


def test_tie_sets_are_whole(spark, tmp_path):
    from docloom.plans.queries import queries

    # rows 0 to 19 are copies, row 200 nearly is one; a query of them has 21 nearest rows
    x = np.random.default_rng(5).normal(size=(201, 8))
    x[:20] = x[0]
    x[200] = x[0] * (1 + 1e-9)
    spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>").repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {(r["query"], r.neighbour) for r in queries()["nearest_ties"](spark, str(tmp_path)).collect()}
    assert got == {(q, j) for q in (0, 200) for j in (*range(20), 200)} | {(100, 100)}


def test_every_section_of_every_version_is_classified(spark, tmp_path):
    from docloom.plans.queries import queries

    made = [("3.9", "a-1x", 1, "t"), ("3.9", "a-1x", 2, "t"), ("3.9", "a-2x", 1, "u"), ("3.10", "a-3x", 1, "t"), ("3.10", "a-3x", 2, "new"), ("4.0", "a-4x", 2, "new"), ("4.0", "b-4x", 1, "t")]
    rows = [(f"{v}:m:c:{page}:p{n:02}", v, "m", "c", page, "T", "S", text) for v, page, n, text in made]
    spark.createDataFrame(rows, "parent_id string, version string, mod string, chapter string, page string, title string, section string, text string").write.parquet(str(tmp_path / "parents.parquet"))
    got = {(r.version, r.k, r.copy, r.change) for r in queries()["version_changes"](spark, str(tmp_path)).collect()}
    assert got == {("3.10", "m:c:a:p01", 1, "unchanged"), ("3.10", "m:c:a:p01", 2, "deleted"), ("3.10", "m:c:a:p02", 1, "updated"), ("4.0", "m:c:a:p01", 1, "deleted"), ("4.0", "m:c:a:p02", 1, "unchanged"), ("4.0", "m:c:b:p01", 1, "inserted")}


def test_chunks(spark):
    body = "lead\n\n## A\nx\n### B\ny\n## C\nz"
    pages = spark.createDataFrame([(1, "T", body), (2, "U", None), (3, "V", " \n ")], "page_id long, title string, body string")
    parents = chunk.parent_sections(pages).orderBy("part").collect()
    assert [(r.part, r.section, r.text) for r in parents] == [(1, "T", "lead"), (2, "T > A", "## A\nx\n### B\ny"), (3, "T > C", "## C\nz")]


@pytest.mark.parametrize("text", ["word " * 700, "One two three. " * 120, "x" * 50, "a,b;" * 300, "line one is here\n" * 90, "字" * 400])
def test_children_cover_their_parent(text):
    spans = chunk.child_spans(text, 64, 8)
    covered = set()
    for s, e in spans:
        assert len(chunk._TOKEN.findall(text[s:e])) <= 64
        covered |= set(range(s, e))
    assert covered == set(range(len(text))) and all(a[0] < b[0] <= a[1] for a, b in zip(spans, spans[1:]))


def test_children_of_parents(spark):
    rows = [(1, 1, "S", "short text"), (1, 2, "S", "字 word. " * 60), (2, 1, "S", None)]
    got = chunk.children(spark.createDataFrame(rows, "page int, part int, section string, text string"), 50, 10).orderBy("part", "piece").collect()
    assert [(r.part, r.piece, r.text) for r in got if r.page == 1][0] == (1, 1, "short text")
    long = [r for r in got if r.part == 2]
    assert len(long) > 3 and all(r.token_count <= 50 and rows[1][3][r.start :].startswith(r.text) for r in long)


def test_child_sections(spark):
    text = "## S\n### X\naa\n### Y\nbb"
    p = spark.createDataFrame([("p", text, "P")], "parent_id string, text string, section string")
    c = spark.createDataFrame([(f"c{i}", "p", i) for i in (0, 5, 11, 14)], "chunk_id string, parent_id string, start int")
    assert [r.path for r in chunk.sub_sections(c, p).orderBy(F.length("chunk_id"), "chunk_id").collect()] == ["P", "P > X", "P > X", "P > Y"]


def test_chunk_ids(spark):
    df = spark.createDataFrame([("v:m:c:p", 1, 100)], "k string, a int, b int")
    assert df.select(chunk.chunk_ids("k", "a", "b")).first()[0] == "v:m:c:p:p01:c100"
