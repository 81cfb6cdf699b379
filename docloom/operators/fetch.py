"""Captures: which addresses belong to a version, where their pages go, and what became of each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.functions.urls import chapter_of, in_version, slug_of, url_path
from docloom.shared import small


def version_urls(urls: DataFrame, url: str = "url", version: str = "version") -> DataFrame:
    """Addresses below their version's root, without its entry page; the addresses stay as they are."""
    return urls.where(in_version(url, version))


def with_path_elements(urls: DataFrame, url: str = "url", version: str = "version") -> DataFrame:
    """``urls`` with ``url_chapter``, ``url_slug`` and ``slug_missing``."""
    return urls.withColumn("url_chapter", chapter_of(url, version)).withColumn("url_slug", slug_of(url, version)).withColumn("slug_missing", F.col("url_slug") == "")


def latest_captures(manifest: DataFrame) -> DataFrame:
    """The last capture of each address; of equally late ones a successful one, then the one with the larger path.

    Times are compared as timestamps, so late and unordered entries and exact duplicates make no difference.
    """
    late = W.partitionBy("url").orderBy(F.to_timestamp("fetched_at").desc_nulls_last(), F.col("error").isNotNull(), F.col("local_path").desc_nulls_last())
    return manifest.withColumn("_n", F.row_number().over(late)).where("_n = 1").drop("_n")


def successful(manifest: DataFrame) -> DataFrame:
    """Captures that have a file, in no order of their own."""
    return manifest.where("local_path IS NOT NULL AND local_path <> ''")


def excluded_urls(sites: DataFrame) -> DataFrame:
    """Distinct (version, bare_url) that the sites' settings exclude, without final slashes."""
    return sites.select("version", F.explode("exclude").alias("u")).select("version", F.regexp_replace("u", "/+$", "").alias("bare_url")).distinct()


#: Shorter texts that are more than half links are navigation.
SHORT_TEXT, LINK_SHARE = 200, 0.5


def disposition(pages: DataFrame, sites: DataFrame, url: str = "source", text: str = "text", density: str | None = None) -> DataFrame:
    """``pages`` with ``disposition``: excluded, error (no text), navigation (an index page, or short and mostly links
    where there is a column of link densities), or output.

    The first that holds counts. The excluded addresses come from the sites' settings and are broadcast while small.
    """
    gone = small(excluded_urls(sites).withColumn("_gone", F.lit(True)))
    bare = pages.withColumn("bare_url", F.regexp_replace(url, "/+$", ""))
    marked = bare.join(gone, ["version", "bare_url"], "left")
    path = F.regexp_replace(url_path(url), "/+$", "")
    kind = (
        F.when(F.col("_gone").isNotNull(), "excluded_by_sources").when(F.coalesce(F.trim(text), F.lit("")) == "", "extraction_error").when(path.endswith("-index"), "url_ends_with_index")
    )
    if density:
        kind = kind.when((F.length(text) < SHORT_TEXT) & (F.col(density) > LINK_SHARE), "short_text_high_link_density")
    kind = kind.otherwise("output")
    return marked.withColumn("disposition", kind).drop("_gone", "bare_url")


def path_collisions(manifest: DataFrame) -> DataFrame:
    """Files that several addresses would be written to, with the number of addresses."""
    where = ["version", "mod_slug", "url_chapter", "url_slug"]
    return with_path_elements(manifest.select("version", "mod_slug", "url").distinct()).groupBy(*where).agg(F.count(F.lit(1)).alias("urls")).where("urls > 1")
