"""Line and heading functions as JVM expressions."""

from __future__ import annotations

import re
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: a heading line is one to six marks, a blank and the heading.
HEADING = r"^(#{1,6}) (.*)$"


def level_of(line: Column) -> Column:
    """Heading level of a line, 0 for text."""
    return F.length(F.regexp_extract(line, HEADING, 1))


def content_of(line: Column) -> Column:
    """A line without its heading mark."""
    return F.regexp_replace(line, r"^#{1,6} ", "")


def blank_collapsed(c: str) -> Column:
    """White space, Unicode's too, as single blanks, none outside."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def one_of(words: tuple[str, ...]) -> str:
    """A pattern for any of the words, tried in their order."""
    return "(?:" + "|".join(re.sub(r"([^\w\s])", r"\\\1", w) for w in words) + ")"


def yaml_scalar(c: str) -> Column:
    """A string as a YAML scalar, in double quotes where it needs them; null as ''."""
    v = F.coalesce(F.col(c), F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    return F.when(v.rlike(r"""[:#"',{}\[\]&*!|>%@`]""") | (v != F.trim(v)) | (v == ""), quoted).otherwise(v)


def yaml_unscalar(c: Column) -> Column:
    """What ``yaml_scalar`` was given."""
    v = F.trim(c)
    inner = F.regexp_replace(F.substring(v, F.lit(2), F.length(v) - 2), r'\\(["\\])', "$1")
    return F.when(v.rlike('(?s)^".*"$') & (F.length(v) >= 2), inner).otherwise(v)


def table_cell(c: str) -> Column:
    """Text for a cell of a Markdown table."""
    return F.replace(F.replace(F.col(c), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))


def aligned(lines: str, headings: str) -> Column:
    """Headings (structs of level and text) put onto lines: a struct of the marked ``lines``, ``matched``, ``missed``.

    Each heading goes to the first line after the last heading's that equals it, outer blanks aside; one that finds
    none leaves the place where the search goes on as it is.
    """
    trimmed = F.transform(lines, lambda x: F.trim(x))

    def step(acc: Column, h: Column) -> Column:
        rest = F.slice(acc["left"], acc["at"] + 1, F.greatest(F.size(acc["left"]) - acc["at"], F.lit(0)))
        k = F.array_position(rest, F.trim(h["text"])).cast("int")
        hit = F.coalesce(k > 0, F.lit(False))
        place = F.struct((acc["at"] + k).alias("line"), h["level"].alias("level"))
        return F.struct(
            acc["raw"].alias("raw"),
            acc["left"].alias("left"),
            F.when(hit, acc["at"] + k).otherwise(acc["at"]).alias("at"),
            F.when(hit, F.concat(acc["places"], F.array(place))).otherwise(acc["places"]).alias("places"),
            F.when(hit, acc["missed"]).otherwise(F.concat(acc["missed"], F.array(h["text"]))).alias("missed"),
        )

    none = F.array().cast("array<struct<line: int, level: int>>")
    start = F.struct(F.col(lines).alias("raw"), trimmed.alias("left"), F.lit(0).alias("at"), none.alias("places"), F.array().cast("array<string>").alias("missed"))

    def finish(acc: Column) -> Column:
        level = F.map_from_entries(acc["places"])
        marked = F.transform(acc["raw"], lambda x, i: F.when(level[i + 1].isNotNull(), F.concat(F.repeat(F.lit("#"), level[i + 1]), F.lit(" "), F.trim(x))).otherwise(x))
        return F.struct(marked.alias("marked"), F.size(acc["places"]).alias("matched"), acc["missed"].alias("missed"))

    return F.aggregate(headings, start, step, finish)


def resolved(base: str, href: str) -> Column:
    """A link's address, seen from a page's."""
    def join(b: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else urljoin(x, y) for x, y in zip(b, h)])

    return F.pandas_udf(join, "string")(base, href)
