"""The queries of the training-data operators and the SQL to hold them against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.mainbody import main_body
from docloom.llm.mixing import mix
from docloom.llm.neardup import NearDuplicates, near_duplicates
from docloom.llm.packing import pack
from docloom.llm.quality import text_quality
from docloom.llm.repeated import mine, without_repeated
from docloom.llm.residue import find_residue
from docloom.llm.splitting import split_oversized
from docloom.llm.vectors import most_similar, search
from docloom.shared import table

CAPACITY = 2048
PARENT_LIMIT, CHILD_LIMIT, OVERLAP = 2048, 256, 32


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return find_residue(table(spark, d, "extracted").select("page_id", "text", "title", "mod", "http_status")).where("is_residue").select("page_id")


def p1_kept(spark: SparkSession, d: str) -> DataFrame:
    """The records that stay, with what share of them is residue (below the limit in every line)."""
    return find_residue(table(spark, d, "extracted").select("page_id", "text", "title", "mod", "http_status")).where("NOT is_residue").select("page_id", "http_status", "text")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "extracted").select("page_id", "hostname", "text")
    # of the lines that frequent sequences cover, those that have three words themselves
    lines = mine(pages, "page_id", "hostname", "text").lines
    return lines.where("words >= 3").select(F.col("page").alias("page_id"), F.col("n").alias("line_no"))


def p2_sequences(spark: SparkSession, d: str) -> DataFrame:
    return mine(table(spark, d, "extracted").select("page_id", "hostname", "text"), "page_id", "hostname", "text").sequences


def p2_clean(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "extracted").select("page_id", "hostname", "text")
    return without_repeated(pages, "page_id", "hostname", "text").select("page_id", "clean_text", "n_removed")


def _p3_pieces(spark: SparkSession, d: str, *more: str) -> DataFrame:
    parents = table(spark, d, "parents").select(F.lit("parent").alias("item_kind"), F.col("parent_id").alias("item_id"), "text")
    children = table(spark, d, "children").select(F.lit("child").alias("item_kind"), F.col("chunk_id").alias("item_id"), "text")
    return split_oversized(parents, "text", PARENT_LIMIT, OVERLAP).unionByName(split_oversized(children, "text", CHILD_LIMIT, OVERLAP))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _p3_pieces(spark, d).where("piece_no = 2").select("item_kind", "item_id")


def p3_pieces(spark: SparkSession, d: str) -> DataFrame:
    return _p3_pieces(spark, d).where("n_pieces > 1").drop("text")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    near = most_similar(table(spark, d, "children").select("chunk_id", "embedding"), "chunk_id", "embedding", k=5, min_similarity=0.9)
    pair = near.select(F.least("chunk_id", "neighbour").alias("chunk_id_a"), F.greatest("chunk_id", "neighbour").alias("chunk_id_b"))
    return pair.distinct()


def p4_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """The five most similar other children, however far, of every usable row."""
    return most_similar(table(spark, d, "children").select("chunk_id", "embedding"), "chunk_id", "embedding", k=5)


def p4_search(spark: SparkSession, d: str) -> DataFrame:
    """The five most similar rows, of all, for every query whose id is divisible by 100; every code is scored."""
    rows = table(spark, d, "embeddings").select("vec_id", "embedding")
    return search(rows.where("vec_id % 100 = 0"), rows, "vec_id", "embedding", k=5)


P5_KINDS = {"parent": ("parents", "parent_id"), "child": ("children", "chunk_id")}


def _p5(spark: SparkSession, d: str, kind: str) -> NearDuplicates:
    name, key = P5_KINDS[kind]
    # problem 5 is stated for word triples and a similarity of 0.6
    return near_duplicates(table(spark, d, name).select(key, "text"), key, "text", threshold=0.6, shingle=3, least_words=20)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    parts = [_p5(spark, d, k).pairs().select(F.lit(k).alias("item_kind"), "id_a", "id_b") for k in P5_KINDS]
    return parts[0].unionByName(parts[1])


def p5_classes(spark: SparkSession, d: str) -> DataFrame:
    parts = [_p5(spark, d, k).classes().select(F.lit(k).alias("item_kind"), F.col("key").alias("item_id"), "class_id", "copies", "links") for k in P5_KINDS]
    return parts[0].unionByName(parts[1])


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "extracted").select("page_id", "text", "markdown", "title", "hostname", "mod")
    return main_body(pages).select("page_id", F.explode("other_lines").alias("line_no"))


def p6_body(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "extracted").select("page_id", "text", "markdown", "title", "hostname", "mod")
    return main_body(pages).select("page_id", "body")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """The documents whose pieces stand in more than one container."""
    pieces = pack(table(spark, d, "documents"), "doc_id", "text", CAPACITY)
    ends = pieces.groupBy("doc_id").agg(F.min("container").alias("first"), F.max("container").alias("last"))
    return ends.where("first < last").select("doc_id")


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    return pack(table(spark, d, "documents"), "doc_id", "text", CAPACITY)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return mix(table(spark, d, "documents"), table(spark, d, "mix_targets"), "doc_id", "text").shares.where("NOT reachable").select("source")


def p8_uses(spark: SparkSession, d: str) -> DataFrame:
    return mix(table(spark, d, "documents"), table(spark, d, "mix_targets"), "doc_id", "text").uses


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mix(table(spark, d, "documents"), table(spark, d, "mix_targets"), "doc_id", "text").shares


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _p9(spark, d).where("NOT is_prose").select("doc_id")


def p9_statistics(spark: SparkSession, d: str) -> DataFrame:
    return _p9(spark, d).drop("text")


def _p9(spark: SparkSession, d: str) -> DataFrame:
    return text_quality(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "common_words"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_kept, p2_found, p2_sequences, p2_clean, p3_found, p3_pieces, p4_found, p4_neighbours, p4_search, p5_found, p5_classes, p6_found, p6_body, p7_found, p7_containers, p8_found, p8_uses, p8_shares, p9_found, p9_statistics)}


_TOKENS = r"len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\r\n]'))"

#: Pairs of texts by brute force: all that share a word triple are counted.
_SIMILAR = """
    WITH w AS (SELECT {key} AS id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM {name}),
    s AS (SELECT id, list_distinct(list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS t FROM w WHERE len(w) >= 20),
    e AS (SELECT id, len(t) AS n, unnest(t) AS g FROM s),
    p AS (SELECT a.id AS id_a, b.id AS id_b, any_value(a.n) + any_value(b.n) AS n, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.id < b.id GROUP BY a.id, b.id)
    SELECT '{kind}' AS item_kind, id_a, id_b FROM p WHERE c >= 0.6 * (n - c)"""


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": r"""
            WITH l AS (
                SELECT page_id, regexp_replace(lower(trim(hostname)), '^www\.', '') AS host, string_split(text, chr(10)) AS ls FROM extracted WHERE hostname IS NOT NULL AND text IS NOT NULL
            ), e AS (SELECT page_id, host, unnest(ls) AS line, generate_subscripts(ls, 1) AS line_no FROM l),
            k AS (SELECT page_id, host, line_no, regexp_replace(lower(line), '[^\p{L}]', '', 'g') AS letters FROM e WHERE len(regexp_extract_all(line, '\p{L}+')) >= 3),
            f AS (SELECT host, letters FROM k GROUP BY host, letters HAVING count(DISTINCT page_id) >= 10)
            SELECT page_id, CAST(line_no AS INTEGER) AS line_no FROM k JOIN f USING (host, letters)""",
        "p3_found": f"SELECT 'parent' AS item_kind, parent_id AS item_id FROM parents WHERE {_TOKENS} > 2048 UNION ALL SELECT 'child', chunk_id FROM children WHERE {_TOKENS} > 256",
        "p4_found": """
            WITH v AS (SELECT chunk_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM children WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x))) = 0),
            u AS (SELECT chunk_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e)))::DOUBLE[64] AS e FROM v),
            s AS (SELECT a.chunk_id AS a, b.chunk_id AS b, array_inner_product(a.e, b.e) AS c FROM u a JOIN u b ON a.chunk_id <> b.chunk_id),
            r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY c DESC, b) AS k FROM s)
            SELECT DISTINCT least(a, b) AS chunk_id_a, greatest(a, b) AS chunk_id_b FROM r WHERE k <= 5 AND c >= 0.9""",
        "p5_found": " UNION ALL ".join(f"SELECT * FROM ({_SIMILAR.format(kind=k, name=n, key=i)})" for k, (n, i) in P5_KINDS.items()),
        "p7_found": f"SELECT doc_id FROM documents WHERE {_TOKENS} > 2048",
        "p8_found": f"""
            WITH d AS (SELECT lower(trim(source)) AS s, {_TOKENS} AS n FROM documents WHERE source IS NOT NULL),
            h AS (SELECT s, sum(n) AS n FROM d GROUP BY s)
            SELECT t.source FROM mix_targets t LEFT JOIN h ON h.s = lower(trim(t.source)) WHERE t.max_repeats * coalesce(h.n, 0) < t.target_share * (SELECT sum(n) FROM d)""",
    }
