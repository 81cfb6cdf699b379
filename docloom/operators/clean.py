"""Cleaning of extracted pages: rules over the array of their lines.

All rules stay inside the page's row, so that cleaning needs no shuffle and no sort.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.config import Config
from docloom.functions.text import content_of, level_of, one_of

#: Kinds of lines besides the levels of headings: text, blank ones, and labels' lines.
TEXT, BLANK, LABEL = 0, -1, -2


def first_lines(pages: DataFrame, config: Config) -> DataFrame:
    """``pages`` (with title, markdown) and ``r1_type``, ``r1_guard``, ``lines``: the title taken from the first lines.

    A: the first line is the title and goes. B: it begins with the title and an ASCII capital follows: the title is
    cut off; where another character follows nothing is cut and ``r1_guard`` is set. C: the second line is the title
    and goes, unless the first is the site's name; ``site_name_first`` says that it is, where the settings have one.
    Null markdown is one blank line.
    """
    lines = F.split(F.coalesce("markdown", F.lit("")), "\n", -1)
    base = pages.withColumn("_l", lines).withColumn("_0", content_of(F.element_at("_l", 1))).withColumn("_1", content_of(F.get("_l", F.lit(1))))
    rest = F.substring(F.col("_0"), F.length("title") + 1, F.length("_0"))
    longer = F.col("_0").startswith(F.col("title")) & (F.length("_0") > F.length("title"))
    kind = (
        F.when(F.coalesce(F.col("title"), F.lit("")) == "", None)
        .when(F.col("_0") == F.col("title"), "A")
        .when(longer & rest.rlike("^[A-Z]"), "B")
        .when(longer, None)
        .when((F.col("_1") == F.col("title")) & (F.trim("_0") != config.site_name), "C")
    )
    tail = F.slice("_l", F.lit(2), F.greatest(F.size("_l") - 1, F.lit(0)))
    named = F.trim("_0") == config.site_name if config.site_name else F.lit(False)
    out = base.withColumn("site_name_first", named).withColumn("r1_type", kind).withColumn("r1_guard", F.coalesce(F.col("title") != "", F.lit(False)) & longer & ~rest.rlike("^[A-Z]"))
    lines = (
        F.when(F.col("r1_type") == "A", tail)
        .when(F.col("r1_type") == "B", F.concat(F.array(rest), tail))
        .when(F.col("r1_type") == "C", F.concat(F.slice("_l", 1, 1), F.slice("_l", F.lit(3), F.greatest(F.size("_l") - 2, F.lit(0)))))
        .otherwise(F.col("_l"))
    )
    return out.withColumn("r1_guard", F.coalesce("r1_guard", F.lit(False))).withColumn("lines", lines).withColumn("n_source_lines", F.size("_l")).drop("_l", "_0", "_1")


def glued_tail(labels: tuple[str, ...]) -> str:
    """A pattern for a line that ends in labels stuck to the text: the text, then the labels from a Recipe on."""
    return rf"^(|.*?[^ ])((?:Recipes|Recipe) ?(?:{one_of(labels)} ?)*)$"


def item_names(recipes: str) -> Column:
    """The names of a page's recipe items: results, ingredients and slots; empty without recipes."""
    r, none = F.col(recipes), F.array().cast("array<string>")
    inner = lambda f: F.flatten(F.transform(r, lambda x: F.coalesce(F.transform(x[f], lambda y: y["name"]), none)))
    names = F.flatten(F.array(F.transform(r, lambda x: x["result"]), inner("ingredients"), inner("slots")))
    return F.coalesce(F.array_distinct(F.filter(names, lambda x: x.isNotNull() & (x != ""))), none)


def made_of(line: str, names: list[str]) -> bool:
    """Whether a line consists of two or more of the names, put together without anything between them.

    A fold over the places that names reach: its work is bounded by the line's length times the names.
    """
    reached = {0: 0}
    for at in range(len(line)):
        if at in reached:
            for x in names:
                if line.startswith(x, at):
                    reached[at + len(x)] = max(reached.get(at + len(x), 0), min(reached[at] + 1, 2))
    return reached.get(len(line), 0) == 2


def outline(kinds: np.ndarray) -> tuple[list[int], list[bool]]:
    """Of each line the depth of its heading, from 2 on (0 for others), and whether its section is empty.

    A heading is as deep as there are open headings of lower levels above it. Its section is empty if no text comes
    before the next heading of its level or a lower one; that doesn't depend on what other empty ones are removed.
    """
    depth, empty = [0] * len(kinds), [False] * len(kinds)
    is_open = [False] * 7
    for i, k in enumerate(kinds):
        if k > 0:
            depth[i] = 2 + sum(is_open[1:k])
            is_open[k:] = [True] + [False] * (6 - k)
    far = len(kinds)
    text, heads = far, [far] * 7
    for i in range(far - 1, -1, -1):
        k = kinds[i]
        if k == TEXT:
            text = i
        elif k > 0:
            empty[i] = text == far or min(heads[1 : k + 1]) < text
            heads[k] = i
    return depth, empty


def _verdicts(kinds: pd.Series, texts: pd.Series, names: pd.Series) -> pd.Series:
    out = []
    for k, t, own in zip(kinds, texts, names):
        k = np.array(k, np.int32)
        named = np.zeros(len(k), bool)
        if len(own):
            own = [*own]
            named[:] = [x is not None and made_of(x[:-1] if x[-1:] == "\r" else x, own) for x in t]
        k[named] = LABEL
        depth, empty = outline(k)
        out.append([{"named": bool(a), "level": b, "empty": c} for a, b, c in zip(named, depth, empty)])
    return pd.Series(out)


def with_lines(pages: DataFrame, config: Config) -> DataFrame:
    """``first_lines`` and ``parsed``, an array of its lines: line_no, line, level, content, word, is_label, is_suspect.

    A suspect is a line of 1 to 40 characters, no label and no list item, next to a label's line.
    """
    word = lambda x: F.trim(content_of(x))
    base = first_lines(pages, config).withColumn("_labels", F.transform("lines", lambda x: word(x).isin(*config.labels)))

    def line(x: Column, i: Column) -> Column:
        here, own = F.get("_labels", i), word(x)
        near = F.coalesce(F.get("_labels", i - 1), F.lit(False)) | F.coalesce(F.get("_labels", i + 1), F.lit(False))
        suspect = ~here & F.length(own).between(1, 40) & ~own.startswith("- ") & near
        return F.struct(i.alias("line_no"), x.alias("line"), level_of(x).alias("level"), content_of(x).alias("content"), own.alias("word"), here.alias("is_label"), suspect.alias("is_suspect"))

    return base.withColumn("parsed", F.transform("lines", line)).drop("_labels")


def with_rules(pages: DataFrame, config: Config) -> DataFrame:
    """``with_lines`` and ``ruled``, an array of its lines with ``glued``, ``rule`` (what removes the line, else null),
    ``out_level`` and ``out_line`` (as it is written).

    R4a removes labels' lines, R5 lines of recipe names alone, R7 headings with no text before the next heading of
    their level or above. R4b cuts labels stuck to the end of a page of one line. R6 gives headings the level of
    their depth, from 2 on.
    """
    base = with_lines(pages, config)

    def cut(x: Column) -> Column:
        before = F.regexp_extract(x["line"], glued_tail(config.labels), 1)
        glued = (F.col("n_source_lines") == 1) & (F.trim(before) != "") & ~x["is_label"]
        return x.withField("glued", glued).withField("line", F.when(glued, before).otherwise(x["line"]))

    base = base.withColumn("_cut", F.transform("parsed", cut)).withColumn("_names", item_names("recipes"))
    kind = lambda x: F.when(x["is_label"], LABEL).when(x["level"] > 0, x["level"]).when(F.trim(x["line"]) == "", BLANK).otherwise(TEXT)
    # only lines that may consist of names travel to Python, and only of pages that have any
    open_ = F.when(F.size("_names") > 0, F.transform("_cut", lambda x: F.when(~x["is_label"] & (x["level"] == 0), F.trim(x["line"]))))
    found = F.pandas_udf(_verdicts, "array<struct<named: boolean, level: int, empty: boolean>>").asNondeterministic()  # never evaluated twice
    base = base.withColumn("_found", found(F.transform("_cut", kind), open_, F.col("_names")))

    def line(x: Column, v: Column) -> Column:
        rule = F.when(x["is_label"], "R4a").when(v["named"], "R5").when(v["empty"], "R7")
        mark = F.concat(F.repeat(F.lit("#"), v["level"]), F.lit(" "), x["content"])
        return x.withField("rule", rule).withField("out_level", v["level"]).withField("out_line", F.when(v["level"] > 0, mark).otherwise(x["line"]))

    return base.withColumn("ruled", F.zip_with("_cut", "_found", line)).drop("_cut", "_names", "_found", "parsed")


def page_lines(pages: DataFrame, config: Config) -> DataFrame:
    """A row for each line left after the title rule: page_id and the fields of ``parsed``."""
    return with_lines(pages, config).select("page_id", F.explode("parsed").alias("x")).select("page_id", "x.*")


def ruled_lines(pages: DataFrame, config: Config) -> DataFrame:
    """A row for each line left after the title rule: page_id and the fields of ``ruled``."""
    return with_rules(pages, config).select("page_id", F.explode("ruled").alias("x")).select("page_id", "x.*")


def reduce_and(parts: list[Column]) -> Column:
    out = F.lit(True)
    for p in parts:
        out = out & p
    return out


def recipe_lines(recipes: str) -> Column:
    """A list line for each recipe: label, station, inputs and result."""

    def inputs(x: Column) -> Column:
        slots = F.transform(x["slots"], lambda s: F.concat_ws(" ", s["slot"], s["name"]))
        parts = F.transform(x["ingredients"], lambda i: F.concat(i["count"].cast("string"), F.lit(" × "), i["name"]))
        return F.array_join(F.when(F.size(slots) > 0, slots).otherwise(F.coalesce(parts, F.array().cast("array<string>"))), ", ")

    return F.transform(recipes, lambda x: F.concat(F.lit("- "), x["label"], F.lit(" ["), x["station"], F.lit("]: "), inputs(x), F.lit(" → "), x["result"]))


def clean_pages(pages: DataFrame, config: Config, keep: tuple[str, ...] = ()) -> DataFrame:
    """A row for each page: page_id, title, source, body, chars_after, skip_reason, short_body, recipes_added.

    Pages without title or source are skipped, and those whose body is blank; skipped ones have a null body. Recipes
    follow the lines that are left under a heading of their own. ``keep`` names columns of ``with_rules`` to carry on.
    """
    ruled = with_rules(pages.select("page_id", "title", "source", "markdown", "recipes"), config)
    base = ruled.withColumn("_kept", F.transform(F.filter("ruled", lambda x: x["rule"].isNull()), lambda x: x["out_line"]))
    chars = F.aggregate("_kept", F.lit(0), lambda n, x: n + F.length(content_of(x)) + 1) - 1
    some = F.size("_kept") > 0
    base = base.select("page_id", "title", "source", "recipes", *keep, F.when(some, F.array_join("_kept", "\n")).alias("lines_text"), F.when(some, chars).alias("chars"))
    n = F.coalesce(F.size("recipes"), F.lit(0))
    n = F.when(n > 0, n).otherwise(0)
    recipe = F.concat_ws("\n", F.lit("## Recipes"), recipe_lines("recipes"))
    lines_text = F.col("lines_text")
    body = F.when(n > 0, F.when(lines_text.isNull(), recipe).otherwise(F.concat(lines_text, F.lit("\n"), recipe))).otherwise(F.coalesce(lines_text, F.lit("")))
    out = base.withColumn("recipes_added", n).withColumn("body", body).withColumn("chars_after", F.coalesce("chars", F.lit(0)).cast("int"))
    reason = F.when((F.coalesce("title", F.lit("")) == "") | (F.coalesce("source", F.lit("")) == ""), "missing_title_or_source").when(F.regexp_replace("body", r"(?U)\s+", "") == "", "empty_body")
    out = out.withColumn("skip_reason", reason)
    ok = F.col("skip_reason").isNull()
    return out.select(
        "page_id", "title", "source", F.when(ok, F.col("body")).alias("body"), "chars_after", "skip_reason", F.when(ok, F.col("chars_after") < config.short_body).alias("short_body"), F.when(ok, F.col("recipes_added")).otherwise(0).alias("recipes_added"), *keep
    )


def cleaning_figures(pages: DataFrame, config: Config) -> DataFrame:
    """(section, item, n): the counts of a cleaning report; items that nothing belongs to have no row.

    Each page lists what it adds, so the report takes one pass and a sum.
    """
    cleaned = clean_pages(pages, config, keep=("r1_type", "ruled", "site_name_first"))
    lines = lambda holds: F.size(F.filter("ruled", holds))
    one = lambda holds: F.coalesce(holds, F.lit(False)).cast("int")
    entry = lambda section, item, n: F.struct(F.lit(section).alias("section"), item.alias("item"), n.cast("long").alias("n"))
    parts = [entry("pages", F.coalesce("skip_reason", F.lit("output")), F.lit(1)), entry("title", F.coalesce("r1_type", F.lit("none")), F.lit(1))]
    by_rule = lambda rule: lines(lambda x: F.coalesce(x["rule"] == rule, F.lit(False)))
    parts += [entry("lines", F.lit(r), by_rule(r)) for r in ("R4a", "R5", "R7")]
    parts += [entry("lines", F.lit("R4b"), lines(lambda x: x["glued"])), entry("lines", F.lit("suspect"), lines(lambda x: x["is_suspect"]))]
    parts += [entry("pages with", F.lit("recipes"), one(F.col("recipes_added") > 0)), entry("pages with", F.lit("short body"), one(F.col("short_body"))), entry("pages with", F.lit("site name first"), one(F.col("site_name_first")))]
    return cleaned.select(F.explode(F.array(*parts)).alias("x")).select("x.*").groupBy("section", "item").agg(F.sum("n").alias("n")).where("n > 0")
