"""Readers: manifests, JSON lines, Markdown trees, sitemaps and pages over an injected fetcher."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.errors import InputError
from docloom.functions.text import yaml_unscalar
from docloom.shared import durable

ENTRY = "url string, chapter string, page_slug string, local_path string, http_status int, fetched_at string, error string"
MANIFEST = f"version string, mod string, mod_slug string, source string, fetched_at string, urls array<struct<{', '.join(x.replace(' ', ': ', 1) for x in ENTRY.split(', '))}>>"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A row for each page entry of manifest files, with the manifest's version, mod and slug."""
    files = spark.read.schema(MANIFEST).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return files.select("version", "mod", "mod_slug", F.explode("urls").alias("e")).select("version", "mod", "mod_slug", "e.*")


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType, key: str, limit: int = 20) -> DataFrame:
    """Rows of JSON-lines files under a strict contract.

    Blank lines, broken JSON, anything but objects, missing or null fields, repeated keys and empty inputs raise
    ``InputError`` with the first ``limit`` findings. The checks are one job over the files.
    """
    raw = spark.read.text(path)
    wide = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parsed = raw.select("value", F.from_json("value", wide, {"columnNameOfCorruptRecord": "_bad"}).alias("r"))
    missing = F.array_compact(F.array(*(F.when(F.col(f"r.{f.name}").isNull(), F.lit(f.name)) for f in schema.fields if not f.nullable)))
    faults = parsed.select(
        F.when(F.trim("value") == "", "blank line").when(F.col("r").isNull() | F.col("r._bad").isNotNull(), F.concat(F.lit("not a record: "), F.substring("value", 1, 60))).when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", "))).alias("fault"),
    ).where("fault IS NOT NULL")
    found = [r.fault for r in faults.limit(limit + 1).collect()]
    rows = parsed.select("r.*").drop("_bad")
    if not found:
        found = [f"repeated {key}: {r[0]}" for r in rows.groupBy(key).count().where("count > 1").limit(limit + 1).collect()]
    if not found and raw.isEmpty():
        found = ["no lines"]
    if found:
        raise InputError("; ".join(found[:limit]) + (" and more" if len(found) > limit else ""))
    return rows


def read_loose_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of JSON-lines files as they are: blank lines are passed over, fields may be missing, keys may be repeated.

    A line that isn't JSON fails the job.
    """
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_page_files(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """A row for each JSON file below ``root``, a page a file, and its ``path``; names that begin with ``_`` take no part."""
    files = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "[!_]*.json").option("multiLine", True).option("mode", "FAILFAST").json(root)
    return files.select("*", F.col("_metadata.file_path").alias("path"))


def read_markdown(spark: SparkSession, root: str) -> DataFrame:
    """version, mod, chapter, page (from the path), title, source_url (from the front matter) and body of each file."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").text(root, wholetext=True)
    part = F.split("_metadata.file_path", "/")
    head = r"(?s)\A---\n(.*?)\n---\n"
    field = lambda name: yaml_unscalar(F.regexp_extract(F.regexp_extract("value", head, 1), rf"(?m)^{name}: ?(.*)$", 1))
    return files.select(
        F.element_at(part, -4).alias("version"), F.element_at(part, -3).alias("mod"), F.element_at(part, -2).alias("chapter"), F.regexp_replace(F.element_at(part, -1), r"\.md$", "").alias("page"),
        field("title").alias("title"), field("source_url").alias("source_url"), F.regexp_replace(F.regexp_replace("value", head, ""), r"\A\n+", "").alias("body"),
    )


def robots_sitemaps(robots: DataFrame, text: str = "body") -> DataFrame:
    """``robots`` with ``sitemap``: a row for each address that a robots file declares."""
    lines = robots.withColumn("_line", F.explode(F.split(text, r"\r?\n"))).withColumn("_line", F.trim("_line")).where(F.lower(F.substring("_line", 1, 8)) == "sitemap:")
    return lines.withColumn("sitemap", F.trim(F.substring("_line", F.lit(9), F.length("_line")))).drop("_line")


def is_sitemap(status: str = "http_status", body: str = "body"):
    """Whether a response is a sitemap or an index of sitemaps."""
    return (F.col(status) == 200) & F.col(body).rlike(r"(?s)\A\s*(<\?xml.*?\?>\s*)?(<!--.*?-->\s*)*<(\w+:)?(urlset|sitemapindex)[\s>]")


def sitemap_locations(sitemaps: DataFrame, body: str = "body") -> DataFrame:
    """``sitemaps`` with ``loc`` and ``is_index``: a row for each trimmed, non-empty location in them."""
    found = F.transform(F.regexp_extract_all(body, F.lit(r"(?s)<(?:\w+:)?loc>\s*(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?\s*</(?:\w+:)?loc>"), F.lit(1)), lambda x: F.trim(x))
    plain = F.transform(found, lambda x: F.replace(F.replace(F.replace(x, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), F.lit("&amp;"), F.lit("&")))
    rows = sitemaps.withColumn("is_index", F.col(body).rlike(r"<(\w+:)?sitemapindex[\s>]")).withColumn("loc", F.explode(plain))
    return rows.where("loc <> ''")


Fetcher = Callable[[str], tuple[int | None, str | None, str | None]]


def fetch_pages(urls: DataFrame, fetcher: Fetcher, url: str = "url", interval: float = 0.5) -> DataFrame:
    """url, http_status, body, error, fetched_at of each address.

    Addresses of one host are fetched by one task after another with ``interval`` seconds between them; hosts run side
    by side. A failure is a row of its own: anything but status 200, or an exception of the fetcher.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: dict[str, float] = {}
        for b in batches:
            rows = []
            for u in b["url"]:
                host = urlsplit(u).netloc
                if host in last:
                    time.sleep(max(0.0, last[host] + interval - time.monotonic()))
                last[host] = time.monotonic()
                try:
                    status, body, error = fetcher(u)
                    if not error and status != 200:
                        body, error = None, f"HTTP {status}"
                except Exception as e:
                    status, body, error = None, None, str(e)
                rows.append((u, status, body, error or None, time.strftime("%Y-%m-%dT%H:%M:%S+00:00", time.gmtime())))
            yield pd.DataFrame(rows, columns=["url", "http_status", "body", "error", "fetched_at"]).astype({"http_status": "Int64"})

    host = F.regexp_extract("url", r"://([^/?#]*)", 1)
    return urls.select(F.col(url).alias("url")).repartition(host).mapInPandas(run, "url string, http_status int, body string, error string, fetched_at string")


def sitemap_pages(sitemaps: DataFrame, fetcher: Fetcher, url: str = "url", interval: float = 0.5) -> DataFrame:
    """``sitemap``, ``loc``: the pages that sitemaps name, those of nested indexes too, each as often as it is named.

    One job a level of nesting. A sitemap is fetched once, however many indexes name it, so that circles end. An answer
    that is neither a sitemap nor an index raises ``InputError``.
    """
    todo = durable(sitemaps.select(F.col(url).alias("url")).where("url IS NOT NULL").distinct())
    seen, found = todo, None
    while not todo.isEmpty():
        answers = durable(fetch_pages(todo, fetcher, interval=interval))
        bad = answers.where(~F.coalesce(is_sitemap(), F.lit(False))).limit(5).collect()
        if bad:
            raise InputError("no sitemap: " + ", ".join(f"{r.url} ({r.error or r.http_status})" for r in bad))
        locations = sitemap_locations(answers).select(F.col("url").alias("sitemap"), "loc", "is_index")
        pages = locations.where("NOT is_index").select("sitemap", "loc")
        found = pages if found is None else found.unionByName(pages)
        todo = durable(locations.where("is_index").select(F.col("loc").alias("url")).distinct().join(seen, "url", "left_anti"))
        seen = seen.unionByName(todo)
    if found is None:
        raise InputError("no sitemaps")
    return found
