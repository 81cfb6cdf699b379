"""Writers: a version's files, replaced as a whole and only when there is something to write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.config import checked_version
from docloom.errors import InputError
from docloom.functions.text import table_cell, yaml_scalar


def markdown_of(title: str = "title", source: str = "source", body: str = "body"):
    """A cleaned page as Markdown: front matter, the title as its heading, the body, a final line end."""
    return F.concat(F.lit("---\ntitle: "), yaml_scalar(title), F.lit("\nsource_url: "), yaml_scalar(source), F.lit("\n---\n\n# "), F.col(title), F.lit("\n\n"), F.col(body), F.lit("\n"))


def readable_of():
    """An extracted page (title, source, hostname, http_status, text) as Markdown for reading: front matter with the
    text's length, the title as its heading, and the text as it is. Nulls are empty."""
    field = lambda name: F.concat(F.lit(f"{name}: "), yaml_scalar(name), F.lit("\n"))
    text, title = F.coalesce("text", F.lit("")), F.coalesce("title", F.lit(""))
    status = F.concat(F.lit("http_status: "), F.coalesce(F.col("http_status").cast("string"), F.lit('""')), F.lit("\n"))
    length = F.concat(F.lit("text_length: "), F.length(text).cast("string"), F.lit("\n"))
    return F.concat(F.lit("---\n"), field("title"), field("source"), field("hostname"), status, length, F.lit("---\n\n# "), title, F.lit("\n\n"), text, F.lit("\n"))


def index_row(*columns: str):
    """A line of an index of pages: the columns as cells of a Markdown table, nulls as empty cells."""
    return F.concat(F.lit("| "), F.array_join(F.array(*(F.coalesce(table_cell(c), F.lit("")) for c in columns)), " | "), F.lit(" |"))


def replace_version(rows: DataFrame, root: str, version: str, kind: str = "parquet") -> None:
    """Write rows as the partition ``version`` of ``root``, other versions untouched; nothing is replaced by nothing.

    ``kind`` is parquet or json (lines, with nulls written out).
    """
    checked_version(version)
    if rows.isEmpty():
        raise InputError(f"nothing to write for {version}: what is there stays")
    out = rows.withColumn("version", F.lit(version)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version")
    (out.option("ignoreNullFields", False).json if kind == "json" else out.parquet)(root)
