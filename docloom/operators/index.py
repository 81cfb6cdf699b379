"""The index: checks before a write, model guards, and what a write changes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.config import Config
from docloom.errors import GuardError
from docloom.functions.vectors import fault

#: Columns of the index tables in their order.
PARENT_COLUMNS = ["parent_id", "text", "title", "source_url", "version", "mod", "chapter", "page", "section", "token_count"]
CHILD_COLUMNS = ["chunk_id", "parent_id", "text", "title", "source_url", "version", "mod", "chapter", "page", "section", "token_count", "embedding", "model_name", "model_revision"]


def shape_faults(rows: DataFrame, key: str, strings: list[str]) -> DataFrame:
    """(key, faults): columns that are null, blank or hold a NUL, and token counts that aren't positive."""
    bad = [F.when(F.col(c).isNull() | (F.trim(c) == "") | F.contains(F.col(c), F.lit("\0")), F.lit(c)) for c in strings]
    bad.append(F.when(F.col("token_count").isNull() | (F.col("token_count") <= 0), F.lit("token_count")))
    return rows.select(F.col(key).alias("key"), F.array_compact(F.array(*bad)).alias("faults")).where(F.size("faults") > 0)


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    """(key, n) of keys that occur more than once."""
    return rows.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def orphans(parents: DataFrame, children: DataFrame) -> DataFrame:
    """Children without their parent."""
    return children.join(parents.select("parent_id"), "parent_id", "left_anti")


def childless(parents: DataFrame, children: DataFrame) -> DataFrame:
    """Parents without a child."""
    return parents.join(children.select("parent_id"), "parent_id", "left_anti")


def misplaced(parents: DataFrame, children: DataFrame) -> DataFrame:
    """Children whose text isn't part of their parent's, or whose id doesn't begin with its id and ``:c``."""
    own = parents.select("parent_id", F.col("text").alias("parent_text"))
    joined = children.select("chunk_id", "parent_id", "text").join(own, "parent_id")
    apart = ~F.contains(F.col("parent_text"), F.col("text"))
    prefix = ~F.col("chunk_id").startswith(F.concat("parent_id", F.lit(":c")))
    return joined.select("chunk_id", "parent_id", F.coalesce(apart, F.lit(True)).alias("not_in_parent"), prefix.alias("wrong_prefix")).where("not_in_parent OR wrong_prefix")


def vector_faults(children: DataFrame, config: Config) -> DataFrame:
    """(chunk_id, fault) of children whose vector is missing, of another length, not finite or not of unit norm."""
    return children.select("chunk_id", fault("embedding", config.dim, config.norm_tolerance).alias("fault")).where("fault IS NOT NULL")


def model_pairs(children: DataFrame) -> DataFrame:
    """(model_name, model_revision, n)."""
    return children.groupBy("model_name", "model_revision").agg(F.count(F.lit(1)).alias("n"))


def row_differences(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, differing): rows that one side lacks or has more than once, and the columns in which paired rows differ.

    Nulls are equal; rows with null keys pair with nothing. ``differing`` is ``missing`` or ``unforeseen`` where the
    right side lacks the row or the left one does, ``repeated`` where a side has it twice.
    """
    one = lambda x, name: x.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*columns)).alias(name))
    a, b = one(left, "a").alias("l"), one(right, "b").alias("r")
    both = a.join(b, F.col("l.key") == F.col("r.key"), "full_outer")
    apart = F.array_compact(F.array(*(F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.lit(c)) for c in columns)))
    found = F.when(F.col("r.n").isNull(), F.array(F.lit("missing"))).when(F.col("l.n").isNull(), F.array(F.lit("unforeseen"))).when((F.col("l.n") > 1) | (F.col("r.n") > 1), F.array(F.lit("repeated"))).otherwise(apart)
    return both.select(F.coalesce("l.key", "r.key").alias("key"), found.alias("differing")).where(F.size("differing") > 0)


def input_faults(vectors: DataFrame) -> DataFrame:
    """Vector rows whose ``embedding_input`` isn't section, a blank line and text."""
    return vectors.where(~F.col("embedding_input").eqNullSafe(F.concat("section", F.lit("\n\n"), "text")))


def violations(parents: DataFrame, children: DataFrame, version: str, config: Config, chunks: DataFrame | None = None) -> DataFrame:
    """(rule, key) of everything that forbids writing this version; empty for good inputs.

    ``chunks`` are the children as they were before embedding: each must have its vector row with the same fields, and
    vector rows that carry an ``embedding_input`` must carry the right one.
    """
    strings = [c for c in PARENT_COLUMNS if c != "token_count"]

    def found(rule: str, rows: DataFrame, key: str) -> DataFrame:
        return rows.select(F.lit(rule).alias("rule"), F.col(key).cast("string").alias("key"))

    def faults(rows: DataFrame, key: str, texts: list[str], more: dict[str, Column]) -> DataFrame:
        # the rules of single rows in one pass over the table
        bad = F.exists(F.array(*(F.col(c) for c in texts)), lambda x: x.isNull() | (F.trim(x) == "") | F.contains(x, F.lit("\0")))
        rules = {"version": ~F.col("version").eqNullSafe(version), "shape": bad | F.col("token_count").isNull() | (F.col("token_count") <= 0)} | more
        hit = F.array_compact(F.array(*(F.when(c, F.lit(r)) for r, c in rules.items())))
        return rows.select(F.explode(hit).alias("rule"), F.col(key).cast("string").alias("key"))

    parts = [
        faults(parents, "parent_id", strings, {}),
        faults(children, "chunk_id", ["chunk_id", *strings], {"vector": fault("embedding", config.dim, config.norm_tolerance).isNotNull()}),
        found("duplicate", duplicate_keys(parents, "parent_id"), "key"),
        found("duplicate", duplicate_keys(children, "chunk_id"), "key"),
        found("orphan", orphans(parents, children), "chunk_id"),
        found("childless", childless(parents, children), "parent_id"),
        found("misplaced", misplaced(parents, children), "chunk_id"),
    ]
    if chunks is not None:
        fields = [c for c in CHILD_COLUMNS if c in chunks.columns and c not in ("chunk_id", "embedding", "model_name", "model_revision")]
        parts.append(found("pairing", row_differences(chunks, children, "chunk_id", fields), "key"))
    if "embedding_input" in children.columns:
        parts.append(found("input", input_faults(children), "chunk_id"))
    pairs = model_pairs(children)
    mixed = pairs.agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts.append(mixed.select(F.lit("models").alias("rule"), F.col("n").cast("string").alias("key")))
    return reduce(DataFrame.unionByName, parts)


def guard(existing: DataFrame, incoming: DataFrame, version: str, mode: str) -> None:
    """Raises ``GuardError`` where a write would mix models: with the whole table on update, with other versions on rebuild."""
    other = existing if mode == "update" else existing.where(F.col("version") != version)
    pairs = other.select("model_name", "model_revision", F.size("embedding").alias("dim")).distinct()
    new = incoming.select("model_name", "model_revision", F.size("embedding").alias("dim")).distinct()
    strange = pairs.join(new, ["model_name", "model_revision", "dim"], "left_anti").limit(3).collect()
    if strange:
        raise GuardError(f"the table holds vectors of another model ({strange[0]['model_name']} {strange[0]['model_revision']}); use rebuild")


def changed(columns: list[str]) -> Column:
    """Whether any of ``o.column`` and ``n.column`` differ; nulls are equal."""
    return reduce(lambda a, b: a | b, [~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in columns])


def classify(old: DataFrame, new: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """(key, change) of every row: inserted, updated, unchanged or deleted, by one full outer join."""
    o, n = old.select(*key, *columns).alias("o"), new.select(*key, *columns).alias("n")
    same = reduce(lambda a, b: a & b, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in key])
    change = F.when(F.col(f"o.{key[0]}").isNull(), "inserted").when(F.col(f"n.{key[0]}").isNull(), "deleted").when(changed(columns), "updated").otherwise("unchanged")
    return o.join(n, same, "full_outer").select(*(F.coalesce(f"o.{k}", f"n.{k}").alias(k) for k in key), change.alias("change"))


def row_digests(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, digest): SHA-256 of a row's columns, each as its length in bytes, a colon and its text; null as ``-``."""
    parts = [F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return rows.select(F.col(key).alias("key"), F.sha2(F.concat(*parts), 256).alias("digest"))


def fingerprint(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row (n, fingerprint): the content of a table whatever its order, from digests summed up without a sort.

    The digests' first and second 60 bits are added as decimals, so that partial sums combine before the shuffle.
    """
    part = lambda at: F.conv(F.substring("digest", at, 15), 16, 10).cast("decimal(38,0)")
    d = row_digests(rows, key, columns)
    sums = d.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(part(1)), F.lit(0)).alias("a"), F.coalesce(F.sum(part(16)), F.lit(0)).alias("b"))
    return sums.select("n", F.concat_ws("-", F.col("a").cast("string"), F.col("b").cast("string")).alias("fingerprint"))


def audit(parents: DataFrame, children: DataFrame, config: Config) -> DataFrame:
    """(check, ok, detail) of the tables as they are, whatever wrote them: one row a check."""

    def counted(check: str, rows: DataFrame, want: int = 0) -> DataFrame:
        return rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(check).alias("check"), (F.col("n") == want).alias("ok"), F.col("n").cast("string").alias("detail"))

    strings = [c for c in PARENT_COLUMNS if c != "token_count"]
    parts = [
        counted("parents of bad shape", shape_faults(parents, "parent_id", strings)),
        counted("children of bad shape", shape_faults(children, "chunk_id", ["chunk_id", *strings])),
        counted("repeated parents", duplicate_keys(parents, "parent_id")),
        counted("repeated children", duplicate_keys(children, "chunk_id")),
        counted("orphans", orphans(parents, children)),
        counted("childless parents", childless(parents, children)),
        counted("misplaced children", misplaced(parents, children)),
        counted("faulty vectors", vector_faults(children, config)),
        counted("models", model_pairs(children), 1),
        counted("versions of one table only", parents.select("version").distinct().unionAll(children.select("version").distinct()).groupBy("version").count().where("count = 1")),
    ]
    return reduce(DataFrame.unionByName, parts)
