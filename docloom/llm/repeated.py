"""Problem 2: lines repeated across one site's documents, mined with a distributed PrefixSpan."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.functions.tokens import line_array
from docloom.shared import durable, small

SALTS = 32


def source_key(host: str) -> Column:
    """Hostnames in lower case, without outer blanks and a leading ``www.``; null where nothing is left."""
    key = F.regexp_replace(F.lower(F.trim(F.col(host))), r"^www\.", "")
    return F.when(key != "", key)


def keep_keys(rows: DataFrame, keys: DataFrame, on: str, spread: str) -> DataFrame:
    """``rows`` whose ``on`` stands in ``keys`` (distinct, durable).

    Few keys are broadcast. Many are joined by a shuffle in which every key is split over ``SALTS`` parts by
    ``spread``, so that no key, however frequent among the rows, falls to one task.
    """
    if (found := small(keys)) is not keys:
        return rows.join(found, on, "left_semi")
    salted = keys.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).join(salted, [on, "_salt"], "left_semi").drop("_salt")


def line_items(pages: DataFrame, page: str, source: str, text: str, min_words: int) -> DataFrame:
    """A row for each page: ``row`` (its number), ``source``, ``page``, and ``items``, its lines that have letters.

    An item has the line's number ``n``, its words ``w`` and its id ``g`` within the source: that of its lower-cased
    letters, kept apart for lines with ``min_words`` words and shorter ones.
    """
    lines = F.filter(
        F.transform(line_array(text), lambda x, i: F.struct((i + 1).alias("n"), F.regexp_replace(F.lower(x), r"[^\p{L}]+", "").alias("t"), F.regexp_count(x, F.lit(r"\p{L}+")).alias("w"))),
        lambda x: x["t"] != "",
    )
    items = F.transform(lines, lambda x: F.struct(x["n"].alias("n"), x["w"].alias("w"), F.xxhash64("_host", x["t"], x["w"] >= min_words).alias("g")))
    taking = pages.select(F.col(source).alias("_host"), F.col(page).alias("page"), F.col(text).alias(text)).where("_host IS NOT NULL AND page IS NOT NULL").where(F.col(text).isNotNull())
    return durable(taking.select(F.monotonically_increasing_id().alias("row"), F.col("_host").alias("source"), "page", items.alias("items")))


@dataclass
class Repeated:
    """What was mined. ``sequences``: source, k, support, first_page, first_line, of those that no longer sequence of
    the same support contains. ``lines``: page, n, words: every line that a frequent sequence covers, once,
    and the words it has itself."""

    sequences: DataFrame
    lines: DataFrame


def _frequent(seen: DataFrame, id_: str, min_pages: int) -> DataFrame:
    return seen.select(id_, "page").distinct().groupBy(id_).agg(F.count(F.lit(1)).alias("support")).where(F.col("support") >= min_pages)


def mine(pages: DataFrame, page: str, host: str, text: str, min_pages: int = 10, min_words: int = 3, gap: int = 1, step: int = 6) -> Repeated:
    """Frequent sequences of lines per source, grown line by line to their end as in PrefixSpan.

    A sequence is frequent if at least ``min_pages`` different pages of its source hold it. Lines that aren't frequent
    alone are taken out first; what is left of a page are runs of frequent lines with at most ``gap`` others between
    neighbours. The projected database of a sequence are the places where it ends, as pointers into the runs: each
    pass extends the sequences that are still frequent by up to ``step`` lines and counts their pages, until none is
    left. Counts are combined before the shuffle, keys are (sequence, page), and no group is collected. Only sequences
    of at least ``min_words`` words count; shorter lines do within longer ones.

    Null text, page or source: the row takes no part. Blank lines and lines without letters are passed over.
    Repeated rows of one page count once. An empty table gives empty results.
    """
    step = max(step, min_words, 2)
    base = pages.select(source_key(host).alias("_source"), F.col(page).alias("_page"), F.col(text).alias("_text"))
    stored = line_items(base, "_page", "_source", "_text", min_words)
    single = stored.select("row", "source", "page", F.posexplode("items").alias("pos", "x")).select("row", "source", "page", "pos", "x.*")
    alone = durable(_frequent(single, "g", min_pages))
    inside = W.partitionBy("row").orderBy("pos")
    runs = keep_keys(single, alone.select("g"), "g", "page").withColumn("run", F.sum(F.when(F.col("pos") - F.lag("pos").over(inside) > gap + 1, 1).otherwise(0)).over(inside)).withColumn("at", F.row_number().over(inside))
    ahead = [F.struct("run", "g", "w", "n")] + [F.lead(F.struct("run", "g", "w", "n"), j).over(inside) for j in range(1, step)]
    places = durable(runs.select("row", "source", "page", "run", "at", "n", F.array(*ahead).alias("ahead")))

    none = F.lit(None).cast("long")
    level = places.select("*", none.alias("id"), none.alias("suffix"), F.lit(0).alias("k"), F.lit(0).alias("words"))
    found, covered = [], []
    while True:
        grown, id_, suffix, words = [], F.col("id"), F.col("suffix"), F.col("words")
        for j in range(step):
            x = F.col("ahead")[j]
            before, length = id_, F.col("k") + j + 1
            suffix = F.when(length == 1, none).when(length == 2, x["g"]).otherwise(F.xxhash64(suffix, x["g"]))
            id_ = F.when(length == 1, x["g"]).otherwise(F.xxhash64(id_, x["g"]))
            short, words = words, words + x["w"]
            # the lines that this length adds: all of them where the words suffice for the first time
            own = F.when(short >= min_words, F.array(F.struct(x["n"], x["w"]))).when(words >= min_words, F.transform(F.slice("ahead", 1, j + 1), lambda y: F.struct(y["n"], y["w"])))
            grown.append(F.when(x["run"] == F.col("run"), F.struct(length.alias("k"), id_.alias("id"), before.alias("prefix"), suffix.alias("suffix"), words.alias("words"), own.alias("own"))))
        each = level.select("row", "source", "page", "run", "at", "n", F.explode(F.array_compact(F.array(*grown))).alias("x")).select("row", "source", "page", "run", "at", "n", "x.*")
        frequent = durable(_frequent(each, "id", min_pages))
        live = durable(keep_keys(each, frequent.select("id"), "id", "page"))
        hits = live.where(F.col("words") >= min_words)
        found.append(hits.groupBy("id", "k").agg(F.first("prefix").alias("prefix"), F.first("suffix").alias("suffix"), F.min("source").alias("source"), F.min(F.struct("page", "n")).alias("first")).join(frequent, "id"))
        covered.append(hits.select("page", F.explode("own").alias("x")).select("page", "x.n", F.col("x.w").alias("words")))
        longest = live.where(F.col("k") % step == 0)
        if longest.isEmpty():
            break
        follow = places.select("row", F.col("at").alias("next"), F.col("run").alias("_run"), F.col("ahead"))
        level = longest.withColumn("next", F.col("at") + F.col("k")).select("row", "source", "page", "run", "at", "n", "id", "suffix", "k", "words", "next").join(follow, ["row", "next"]).where("run = _run").drop("_run", "next")
    every = durable(reduce(DataFrame.unionByName, found))
    inner = every.select(F.explode(F.array_compact(F.array("prefix", "suffix"))).alias("id"), "support").distinct()
    sequences = every.join(inner, ["id", "support"], "left_anti").select("source", "k", "support", F.col("first.page").alias("first_page"), F.col("first.n").alias("first_line"))
    lines = reduce(DataFrame.unionByName, covered).distinct()
    return Repeated(sequences, lines)


def without_repeated(pages: DataFrame, page: str, host: str, text: str, **limits: int) -> DataFrame:
    """``pages`` with ``clean_text``, the text without the lines of frequent sequences, and ``n_removed``.

    Pages that take no part in ``mine`` keep their text (null stays null) with ``n_removed`` 0. Columns of these names
    are replaced. Rows of the same page lose the same lines.
    """
    base = pages.drop("clean_text", "n_removed")
    lines = mine(base, page, host, text, **limits).lines
    gone = lines.groupBy(F.col("page").alias("__page")).agg(F.collect_set("n").alias("__gone"))
    joined = base.join(gone, base[page] == gone["__page"], "left").withColumn("__lines", F.when(F.col("__gone").isNotNull(), line_array(text)))
    left = F.array_except(F.sequence(F.lit(1), F.size("__lines")), "__gone")
    kept = F.transform(left, lambda i: F.get("__lines", i - 1))
    clean = F.when(F.col("__gone").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    return joined.select(*base.columns, clean.alias("clean_text"), F.coalesce(F.size("__gone"), F.lit(0)).alias("n_removed"))
