"""Chunks: parents at headings, children within a token limit, and their provenance."""

from __future__ import annotations

import re
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.errors import InputError
from docloom.functions.text import content_of, level_of
from docloom.functions.tokens import TOKEN, token_count

SEPARATOR = " > "
_TOKEN = re.compile(TOKEN)


def parent_sections(pages: DataFrame, body: str = "body", title: str = "title", page: str = "page_id") -> DataFrame:
    """Parents of each page: page, part (from 1), section, text, token_count.

    Every heading of level 1 or 2 begins a parent, text before the first is one of its own; lines are trimmed and
    blank ones dropped. The section is the title, and the heading of level 2 if there is one.
    """
    lines = F.filter(F.transform(F.split(body, "\n", -1), lambda x: F.trim(x)), lambda x: x != "")
    # no filter on what is computed here: pushed down, it would have the body computed again
    base = pages.select(F.col(page).alias("page"), F.col(title).alias("title"), lines.alias("lines"))
    # parents begin at the first line and at headings of level 1 and 2: slices of the page's own array, nothing is shuffled
    starts = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: (i == 0) | level_of(F.get("lines", i)).between(1, 2))
    base = base.withColumn("starts", F.when(F.size("lines") > 0, starts))
    end = lambda k: F.coalesce(F.get("starts", k + 1), F.size("lines"))
    blocks = F.transform("starts", lambda i, k: F.struct((k + 1).alias("part"), F.get("lines", i).alias("head"), F.array_join(F.slice("lines", i + 1, end(k) - i), "\n").alias("text")))
    each = base.select("page", "title", F.explode_outer(blocks).alias("b")).where("b IS NOT NULL").select("page", "title", "b.*")
    h2 = F.when(level_of(F.col("head")) == 2, content_of(F.col("head")))
    section = F.when(F.coalesce(h2, F.lit("")) != "", F.concat("title", F.lit(SEPARATOR), h2)).otherwise(F.col("title"))
    return each.select("page", "part", section.alias("section"), "text", token_count("text").alias("token_count"))


def _atoms(text: str, limit: int, separators: tuple[str, ...]) -> list[str]:
    """Pieces of up to ``limit`` tokens, cut behind the first separator that makes them small enough."""
    if len(_TOKEN.findall(text)) <= limit:
        return [text]
    if not separators:
        ends = [m.end() for m in _TOKEN.finditer(text)][limit - 1 :: limit]
        return [text[a:b] for a, b in zip([0, *ends], [*ends, len(text)]) if a < b]
    parts = re.split(f"(?<={re.escape(separators[0])})", text)
    return [a for p in parts if p for a in _atoms(p, limit, separators[1:])]


def child_spans(text: str, limit: int, overlap: int, separators: tuple[str, ...] = ("\n", ". ", " ")) -> list[tuple[int, int]]:
    """Start and end of chunks: atoms are put together while they fit, and up to ``overlap`` tokens are repeated."""
    atoms, at = [], 0
    for a in _atoms(text, limit, separators):
        atoms.append((at, at + len(a), len(_TOKEN.findall(a))))
        at += len(a)
    out, run, size = [], [], 0
    for a in atoms:
        if run and size + a[2] > limit:
            out.append((run[0][0], run[-1][1]))
            while run and (size > overlap or size + a[2] > limit):
                size -= run.pop(0)[2]
        run.append(a)
        size += a[2]
    if run:
        out.append((run[0][0], run[-1][1]))
    return out


def children(parents: DataFrame, limit: int = 256, overlap: int = 32) -> DataFrame:
    """Children of parents (columns page, part, section, text): page, part, section, piece, start, text, token_count.

    Parents within the limit are their own child: only larger texts go to Python, and only places come back.
    """

    def places(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else [{"s": s, "e": e} for s, e in child_spans(t, limit, overlap)] for t in texts])

    cut = F.pandas_udf(places, "array<struct<s: int, e: int>>").asNondeterministic()  # so that it is never evaluated twice
    sized = parents.select("page", "part", "section", "text").withColumn("large", token_count("text") > limit)
    spans = sized.withColumn("spans", cut(F.when(F.col("large"), F.col("text"))))
    whole = F.array(F.struct(F.lit(0).alias("s"), F.length("text").alias("e")))
    each = spans.select("page", "part", "section", "text", F.posexplode(F.coalesce("spans", whole)).alias("piece", "at"))
    piece = F.rtrim(F.substring("text", F.col("at.s") + 1, F.col("at.e") - F.col("at.s")), F.lit("\n "))
    out = each.select("page", "part", "section", (F.col("piece") + 1).alias("piece"), F.col("at.s").alias("start"), piece.alias("text"))
    return out.withColumn("token_count", token_count("text"))


def chunk_ids(prefix: str, part: str, piece: str | None = None) -> Column:
    """``prefix:pNN`` or ``prefix:pNN:cNN``, numbers with at least two digits."""

    def padded(letter: str, c: str) -> Column:
        return F.concat(F.lit(letter), F.when(F.col(c) < 10, F.concat(F.lit("0"), F.col(c).cast("string"))).otherwise(F.col(c).cast("string")))

    out = F.concat_ws(":", F.col(prefix), padded("p", part))
    return out if piece is None else F.concat_ws(":", out, padded("c", piece))


def sub_sections(children_: DataFrame, parents: DataFrame) -> DataFrame:
    """Children (with parent_id, start) and ``path``: the parent's section and the headings of level 3 and more above.

    A heading counts where its line begins at or before the child; of each level the last one, unless one of a lower
    level came after it.
    """
    lines = parents.select("parent_id", "section", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    w = W.partitionBy("parent_id").orderBy("line_no")
    at = F.coalesce(F.sum(F.length("line") + 1).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    heads = lines.withColumn("at", at).withColumn("level", level_of(F.trim("line"))).where("level >= 3").select("parent_id", "at", "level", F.trim(content_of(F.trim("line"))).alias("heading"))
    near = children_.select("chunk_id", "parent_id", "start").join(heads, "parent_id").where("at <= start")
    later = W.partitionBy("chunk_id").orderBy(F.desc("at")).rowsBetween(W.unboundedPreceding, -1)
    live = near.withColumn("low", F.min("level").over(later)).where("low IS NULL OR level < low")
    path = live.groupBy("chunk_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "heading"))), lambda x: x["heading"]), SEPARATOR).alias("sub"))
    base = children_.join(parents.select("parent_id", F.col("section").alias("parent_section")), "parent_id")
    return base.join(path, "chunk_id", "left").withColumn("path", F.concat_ws(SEPARATOR, "parent_section", "sub")).drop("sub", "parent_section")


def require_limits(parents: DataFrame, pieces: DataFrame, parent_limit: int, child_limit: int) -> None:
    """Raises ``InputError`` with the first ids if any chunk is over its limit, so that nothing of a batch is written."""
    over = parents.where(F.col("token_count") > parent_limit).select(F.col("parent_id").alias("id")).unionByName(pieces.where(F.col("token_count") > child_limit).select(F.col("chunk_id").alias("id")))
    if found := over.limit(5).collect():
        raise InputError("over the limit: " + ", ".join(r.id for r in found))
