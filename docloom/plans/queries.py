"""The engine's queries over the tables of a folder, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.config import LABELS, Config
from docloom.functions import text as tx
from docloom.functions import urls as ur
from docloom.functions import vectors as ve
from docloom.functions.tokens import TOKEN, line_array, token_count
from docloom.operators import chunk, clean, fetch, index, knn, report
from docloom.shared import table
from docloom.sources import writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: The labels of these sites: the fixed ones and two methods more.
SITE = Config(labels=(*LABELS, "Charging", "Pressing"))


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with SQL in which @ is the token rule."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql.replace("@TOKENS(", "len(regexp_extract_all(").replace("@RULE", f"'{TOKEN}'")
        return f

    return add


# Captures ---------------------------------------------------------------------------------------------------------

_PATH = "coalesce(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9_+.-]*://[^/?#]*([^?#]*)', 1), '')"


@query(
    f"""WITH p AS (SELECT url, version, {_PATH} AS path FROM fetch_manifest)
    SELECT url, version FROM p WHERE starts_with(path, '/' || version || '/') AND rtrim(path, '/') NOT IN ('/' || version, '/' || version || '/index')"""
)
def version_urls(s: SparkSession, d: str) -> DataFrame:
    """FLT1 over every capture."""
    return fetch.version_urls(table(s, d, "fetch_manifest").select("url", "version"))


@query(
    f"""WITH p AS (SELECT url, version, {_PATH} AS path FROM fetch_manifest),
    g AS (SELECT url, version, list_filter(string_split(CASE WHEN starts_with(path, '/' || version || '/') THEN substring(path, length(version) + 3) ELSE path END, '/'), lambda x: x <> '') AS seg FROM p)
    SELECT url, version, CASE WHEN len(seg) >= 2 THEN seg[-2] ELSE 'other' END AS url_chapter, CASE WHEN len(seg) >= 1 THEN seg[-1] ELSE '' END AS url_slug, len(seg) = 0 AS slug_missing FROM g"""
)
def path_elements(s: SparkSession, d: str) -> DataFrame:
    """FLT2, FLT3 over every capture."""
    return fetch.with_path_elements(table(s, d, "fetch_manifest").select("url", "version"))


@query("SELECT DISTINCT regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9_+.-]*://[^/?#]*)', 1) AS root FROM fetch_manifest")
def site_roots(s: SparkSession, d: str) -> DataFrame:
    """FLT4."""
    return table(s, d, "fetch_manifest").select(ur.site_root("url").alias("root")).distinct()


@query("SELECT mod, mod_slug, trim(regexp_replace(lower(mod), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM (SELECT DISTINCT mod, mod_slug FROM fetch_manifest)")
def mod_slugs(s: SparkSession, d: str) -> DataFrame:
    """STR15."""
    return table(s, d, "fetch_manifest").select("mod", "mod_slug").distinct().withColumn("slug", ur.slugify("mod"))


@query(
    """SELECT url, http_status, error, local_path FROM fetch_manifest
    QUALIFY row_number() OVER (PARTITION BY url ORDER BY CAST(fetched_at AS TIMESTAMPTZ) DESC NULLS LAST, error IS NOT NULL, local_path DESC NULLS LAST) = 1"""
)
def latest_captures(s: SparkSession, d: str) -> DataFrame:
    """SRC10, ORD1: one capture for each address."""
    return fetch.latest_captures(table(s, d, "fetch_manifest")).select("url", "http_status", "error", "local_path")


@query("SELECT version, mod, local_path, url FROM fetch_manifest WHERE local_path IS NOT NULL AND local_path <> ''")
def successful_captures(s: SparkSession, d: str) -> DataFrame:
    """FLT5."""
    return fetch.successful(table(s, d, "fetch_manifest")).select("version", "mod", "local_path", "url")


@query("SELECT version, coalesce(error, 'ok') AS outcome, http_status, count(*) AS n FROM fetch_manifest GROUP BY ALL")
def capture_outcomes(s: SparkSession, d: str) -> DataFrame:
    """AGG1, AGG2 of the fetch stage."""
    return report.counts_by(table(s, d, "fetch_manifest").withColumn("outcome", F.coalesce("error", F.lit("ok"))), "version", "outcome", "http_status")


@query(
    f"""WITH u AS (SELECT DISTINCT version, mod_slug, url, {_PATH} AS path FROM fetch_manifest),
    g AS (SELECT version, mod_slug, list_filter(string_split(CASE WHEN starts_with(path, '/' || version || '/') THEN substring(path, length(version) + 3) ELSE path END, '/'), lambda x: x <> '') AS seg FROM u)
    SELECT version, mod_slug, CASE WHEN len(seg) >= 2 THEN seg[-2] ELSE 'other' END AS url_chapter, CASE WHEN len(seg) >= 1 THEN seg[-1] ELSE '' END AS url_slug, count(*) AS urls FROM g GROUP BY 1, 2, 3, 4 HAVING count(*) > 1"""
)
def path_collisions(s: SparkSession, d: str) -> DataFrame:
    """SNK1: addresses that would overwrite each other's file."""
    return fetch.path_collisions(table(s, d, "fetch_manifest"))


@query(
    f"""WITH e AS (SELECT version, mod, lower(regexp_replace(trim(regexp_replace(lower(mod), '[^a-z0-9]+', '-', 'g'), '-'), '^$', '')) AS slug, url, error, local_path FROM fetch_manifest)
    SELECT version, slug AS mod_slug, count(*) AS entries, count(DISTINCT url) AS urls, count_if(local_path IS NOT NULL AND local_path <> '') AS files, count_if(error IS NOT NULL) AS errors FROM e GROUP BY version, slug"""
)
def fetch_log(s: SparkSession, d: str) -> DataFrame:
    """SNK2: the figures of a fetch log, by version and mod."""
    e = table(s, d, "fetch_manifest").select("version", ur.slugify("mod").alias("mod_slug"), "url", "error", "local_path")
    file = F.count_if(F.coalesce(F.col("local_path") != "", F.lit(False)))
    return e.groupBy("version", "mod_slug").agg(F.count(F.lit(1)).alias("entries"), F.countDistinct("url").alias("urls"), file.alias("files"), F.count_if(F.col("error").isNotNull()).alias("errors"))


# Extraction -------------------------------------------------------------------------------------------------------

_DISPOSED = """x AS (SELECT DISTINCT version, rtrim(u, '/') AS bare FROM (SELECT version, unnest(exclude) AS u FROM source_sites)),
    dis AS (SELECT e.page_id, e.version, CASE WHEN x.bare IS NOT NULL THEN 'excluded_by_sources' WHEN coalesce(trim(e.text, ' '), '') = '' THEN 'extraction_error'
        WHEN ends_with(rtrim(regexp_extract(e.source, '^[a-zA-Z][a-zA-Z0-9_+.-]*://[^/?#]*([^?#]*)', 1), '/'), '-index') THEN 'url_ends_with_index' ELSE 'output' END AS disposition
        FROM extracted e LEFT JOIN x ON x.version = e.version AND x.bare = rtrim(e.source, '/'))"""


def _disposed(s: SparkSession, d: str) -> DataFrame:
    return fetch.disposition(table(s, d, "extracted").select("page_id", "version", "source", "text"), table(s, d, "source_sites").select("version", "exclude"))


@query(f"WITH {_DISPOSED} SELECT page_id, disposition FROM dis")
def page_disposition(s: SparkSession, d: str) -> DataFrame:
    """FLT6 to FLT8, JN1."""
    return _disposed(s, d).select("page_id", "disposition")


@query(
    f"""WITH {_DISPOSED} SELECT version, count(*) AS total, count_if(disposition = 'output') AS output, count_if(disposition = 'excluded_by_sources') AS excluded_by_sources,
    count_if(disposition = 'extraction_error') AS extraction_error, count_if(disposition = 'url_ends_with_index') AS url_ends_with_index FROM dis GROUP BY version"""
)
def disposition_reconciliation(s: SparkSession, d: str) -> DataFrame:
    """AGG1: parts and total of each version."""
    return report.reconciliation(_disposed(s, d), ["version"], "disposition", ["output", "excluded_by_sources", "extraction_error", "url_ends_with_index"])


@query("SELECT m.url, bool_or(e.source IS NOT NULL) AS extracted FROM (SELECT DISTINCT url FROM fetch_manifest) m LEFT JOIN (SELECT DISTINCT source FROM extracted) e ON e.source = m.url GROUP BY m.url")
def captured_and_extracted(s: SparkSession, d: str) -> DataFrame:
    """JN2: a mark join."""
    there = table(s, d, "extracted").select("source").distinct().withColumn("_there", F.lit(True))
    urls = table(s, d, "fetch_manifest").select("url").distinct()
    return urls.join(there, F.col("url") == F.col("source"), "left").select("url", F.col("_there").isNotNull().alias("extracted"))


@query("SELECT f.url, f.error FROM fetch_manifest f WHERE f.error IS NOT NULL AND EXISTS (SELECT 1 FROM extracted e WHERE e.source = f.url)")
def failed_but_extracted(s: SparkSession, d: str) -> DataFrame:
    """JN1: a semi join of failures with what was extracted all the same."""
    failed = table(s, d, "fetch_manifest").where("error IS NOT NULL").select("url", "error")
    return failed.join(table(s, d, "extracted").select("source"), F.col("url") == F.col("source"), "left_semi")


@query("SELECT station, count(*) AS n FROM (SELECT unnest(recipes).station AS station FROM extracted) GROUP BY station")
def station_counts(s: SparkSession, d: str) -> DataFrame:
    """AGG3."""
    return report.counts_by(table(s, d, "extracted").select(F.explode("recipes.station").alias("station")), "station")


@query(
    """WITH r AS (SELECT page_id, unnest(recipes) AS r, generate_subscripts(recipes, 1) AS k FROM extracted WHERE len(recipes) > 0)
    SELECT page_id, CAST(k AS INTEGER) AS k, '- ' || r.label || ' [' || r.station || ']: ' || CASE WHEN len(r.slots) > 0 THEN array_to_string(list_transform(r.slots, lambda x: x.slot || ' ' || x.name), ', ')
        ELSE array_to_string(list_transform(r.ingredients, lambda x: CAST(x.count AS VARCHAR) || ' × ' || x.name), ', ') END || ' → ' || r.result AS line FROM r"""
)
def recipe_lines(s: SparkSession, d: str) -> DataFrame:
    """STR12."""
    pages = table(s, d, "extracted").select("page_id", "recipes")
    return pages.select("page_id", F.posexplode(clean.recipe_lines("recipes")).alias("k", "line")).withColumn("k", F.col("k") + 1)


@query("SELECT name, sum(count) AS used, count(*) AS recipes FROM (SELECT unnest(r.ingredients, recursive := true) FROM (SELECT unnest(recipes) AS r FROM extracted)) GROUP BY name")
def material_counts(s: SparkSession, d: str) -> DataFrame:
    """AGG15: what recipes use, over all pages."""
    parts = table(s, d, "extracted").select(F.explode("recipes.ingredients").alias("i")).select(F.explode("i").alias("m"))
    return parts.groupBy("m.name").agg(F.sum("m.count").alias("used"), F.count(F.lit(1)).alias("recipes"))


_LINES = "l AS (SELECT page_id, unnest(string_split(markdown, chr(10))) AS line, generate_subscripts(string_split(markdown, chr(10)), 1) AS line_no FROM extracted WHERE markdown IS NOT NULL)"


@query(f"WITH {_LINES} SELECT page_id, CAST(line_no AS INTEGER) AS line_no, length(regexp_extract(line, '^(#{{1,6}}) ', 1)) AS level, regexp_replace(line, '^#{{1,6}} ', '') AS content FROM l WHERE regexp_matches(line, '^#{{1,6}} ')")
def headings(s: SparkSession, d: str) -> DataFrame:
    """STR1, STR2, STR3, HTM4: the headings of every page."""
    lines = table(s, d, "extracted").select("page_id", F.posexplode(line_array("markdown")).alias("line_no", "line"))
    lines = lines.withColumn("level", tx.level_of(F.col("line")).cast("long")).where("level > 0")
    return lines.select("page_id", (F.col("line_no") + 1).alias("line_no"), "level", tx.content_of(F.col("line")).alias("content"))


@query(
    """SELECT page_id, len(string_split(text, chr(10))) AS lines, count_if(regexp_matches(m, '^#{1,6} ')) AS marked, count_if(regexp_replace(m, '^#{1,6} ', '') <> t) AS differing
    FROM (SELECT page_id, text, unnest(string_split(text, chr(10))) AS t, unnest(string_split(markdown, chr(10))) AS m FROM extracted WHERE len(string_split(text, chr(10))) = len(string_split(markdown, chr(10)))) GROUP BY page_id, text"""
)
def heading_alignment(s: SparkSession, d: str) -> DataFrame:
    """HTM5: markdown has the lines of the text, one for one, with heading marks added."""
    pages = table(s, d, "extracted").select("page_id", line_array("text").alias("t"), line_array("markdown").alias("m")).where("size(t) = size(m)")
    marked = F.size(F.filter("m", lambda x: x.rlike("^#{1,6} "))).cast("long")
    differing = F.size(F.filter(F.zip_with("t", "m", lambda t, m: tx.content_of(m) != t), lambda x: x)).cast("long")
    return pages.select("page_id", F.size("t").cast("long").alias("lines"), marked.alias("marked"), differing.alias("differing"))


_SCALAR = """CASE WHEN regexp_matches(coalesce({0}, ''), '[:#"'',{{}}\\[\\]&*!|>%@`]') OR coalesce({0}, '') <> trim(coalesce({0}, ''), ' ') OR coalesce({0}, '') = ''
    THEN '"' || replace(replace(coalesce({0}, ''), '\\', '\\\\'), '"', '\\"') || '"' ELSE {0} END"""


def _output(s: SparkSession, d: str, *columns: str) -> DataFrame:
    pages = table(s, d, "extracted").select("page_id", "version", "source", "text", *columns)
    return fetch.disposition(pages, table(s, d, "source_sites").select("version", "exclude")).where("disposition = 'output'")


@query(
    f"""WITH {_DISPOSED} SELECT e.page_id, '---' || chr(10) || 'title: ' || {_SCALAR.format("e.title")} || chr(10) || 'source: ' || {_SCALAR.format("e.source")} || chr(10) || 'hostname: ' || {_SCALAR.format("e.hostname")} || chr(10)
    || 'http_status: ' || coalesce(CAST(e.http_status AS VARCHAR), '""') || chr(10) || 'text_length: ' || length(e.text) || chr(10) || '---' || chr(10) || chr(10) || '# ' || coalesce(e.title, '') || chr(10) || chr(10) || e.text || chr(10) AS content
    FROM dis JOIN extracted e USING (page_id) WHERE disposition = 'output'"""
)
def readable_pages(s: SparkSession, d: str) -> DataFrame:
    """SNK4: every page that goes on, as Markdown for reading."""
    return _output(s, d, "title", "hostname", "http_status").select("page_id", writers.readable_of().alias("content"))


@query(
    f"""WITH {_DISPOSED} SELECT e.version, mod, page_id, '| ' || array_to_string(list_transform([title, chapter, page, CAST(length(text) AS VARCHAR), source], lambda x: coalesce(replace(replace(x, '|', '\\|'), chr(10), ' '), '')), ' | ') || ' |' AS line
    FROM dis JOIN extracted e USING (page_id) WHERE disposition = 'output'"""
)
def readable_index(s: SparkSession, d: str) -> DataFrame:
    """SNK4: the lines of each version's index of those pages."""
    rows = _output(s, d, "mod", "title", "chapter", "page").withColumn("text_length", F.length("text").cast("string"))
    return rows.select("version", "mod", "page_id", writers.index_row("title", "chapter", "page", "text_length", "source").alias("line"))


@query(
    f"""WITH {_DISPOSED} SELECT page_id, CASE WHEN disposition = 'extraction_error' THEN 'error' ELSE 'skipped' END AS kind, disposition AS reason FROM dis WHERE disposition <> 'output'
    UNION ALL SELECT e.page_id, 'warning', 'no ' || f FROM dis JOIN (SELECT page_id, unnest(list_filter([CASE WHEN coalesce(title, '') = '' THEN 'title' END, CASE WHEN coalesce(hostname, '') = '' THEN 'hostname' END, CASE WHEN http_status IS NULL THEN 'http_status' END], lambda x: x IS NOT NULL)) AS f FROM extracted) e USING (page_id) WHERE disposition = 'output'"""
)
def parse_report(s: SparkSession, d: str) -> DataFrame:
    """SNK5, ERR2: what the extraction skipped, failed at, or found incomplete, a row each."""
    pages = table(s, d, "extracted").select("page_id", "version", "source", "text", "title", "hostname", "http_status")
    rows = fetch.disposition(pages, table(s, d, "source_sites").select("version", "exclude"))
    out = F.col("disposition") == "output"
    entry = lambda kind, reason: F.struct(kind.alias("kind"), reason.alias("reason"))
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) == ""
    found = [F.when(~out, entry(F.when(F.col("disposition") == "extraction_error", "error").otherwise("skipped"), F.col("disposition")))]
    found += [F.when(out & blank(c), entry(F.lit("warning"), F.lit(f"no {c}"))) for c in ("title", "hostname", "http_status")]
    return rows.select("page_id", F.explode(F.array_compact(F.array(*found))).alias("x")).select("page_id", "x.*")


# Cleaning ---------------------------------------------------------------------------------------------------------

_LABEL_LIST = ", ".join("'" + x + "'" for x in SITE.labels)
_TAIL = "'" + clean.glued_tail(SITE.labels) + "'"
_RULED = rf"""
    src AS (SELECT page_id, coalesce(title, '') AS title, coalesce(source, '') AS source, coalesce(recipes, []) AS recipes, string_split(coalesce(markdown, ''), chr(10)) AS ls FROM extracted),
    one AS (SELECT *, regexp_replace(ls[1], '^#{{1,6}} ', '') AS c0, regexp_replace(ls[2], '^#{{1,6}} ', '') AS c1 FROM src),
    r1 AS (SELECT *, CASE WHEN title = '' THEN NULL WHEN c0 = title THEN 'A'
        WHEN starts_with(c0, title) THEN CASE WHEN regexp_matches(substring(c0, length(title) + 1), '^[A-Z]') THEN 'B' END
        WHEN c1 = title AND trim(c0, ' ') <> '' THEN 'C' END AS r1_type FROM one),
    cut AS (SELECT *, CASE r1_type WHEN 'A' THEN ls[2:] WHEN 'B' THEN list_concat([substring(c0, length(title) + 1)], ls[2:]) WHEN 'C' THEN list_concat([ls[1]], ls[3:]) ELSE ls END AS kept FROM r1),
    ln AS (SELECT page_id, len(ls) AS n_lines, recipes, unnest(kept) AS raw, generate_subscripts(kept, 1) - 1 AS line_no FROM cut),
    lv AS (SELECT *, length(regexp_extract(raw, '^(#{{1,6}}) ', 1)) AS level, trim(regexp_replace(raw, '^#{{1,6}} ', ''), ' ') AS word FROM ln),
    lb AS (SELECT *, word IN ({_LABEL_LIST}) AS is_label FROM lv),
    su AS (SELECT *, NOT is_label AND length(word) BETWEEN 1 AND 40 AND NOT starts_with(word, '- ') AND (coalesce(lag(is_label) OVER w, false) OR coalesce(lead(is_label) OVER w, false)) AS is_suspect
        FROM lb WINDOW w AS (PARTITION BY page_id ORDER BY line_no))"""


@query(f"WITH {_RULED} SELECT page_id, r1_type, len(kept) AS lines_left FROM cut")
def title_rule(s: SparkSession, d: str) -> DataFrame:
    """STR5, WIN6."""
    pages = table(s, d, "extracted").select("page_id", "title", "markdown")
    return clean.first_lines(pages, SITE).select("page_id", "r1_type", F.size("lines").cast("long").alias("lines_left"))


def _page_lines(s: SparkSession, d: str) -> DataFrame:
    return clean.page_lines(table(s, d, "extracted").select("page_id", "title", "markdown", "recipes"), SITE)


@query(f"WITH {_RULED} SELECT page_id, CAST(line_no AS INTEGER) AS line_no, word, is_label FROM su WHERE is_label OR is_suspect")
def label_lines(s: SparkSession, d: str) -> DataFrame:
    """STR6, STR8, WIN2: lines of labels and those beside them."""
    return _page_lines(s, d).where("is_label OR is_suspect").select("page_id", "line_no", "word", "is_label")


@query(f"WITH {_RULED} SELECT word AS label, count(*) AS n, count(DISTINCT page_id) AS pages, word IN ('Recipe', 'Recipes', 'Crafting', 'Crafting (Shapeless)') AS generic FROM su WHERE is_label GROUP BY word")
def label_histogram(s: SparkSession, d: str) -> DataFrame:
    """AGG4, AGG7, ORD2."""
    from docloom.config import GENERIC_LABELS

    labels = _page_lines(s, d).where("is_label").groupBy(F.col("word").alias("label")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("page_id").alias("pages"))
    return labels.withColumn("generic", F.col("label").isin(*GENERIC_LABELS))


@query(f"WITH {_RULED} SELECT page_id, array_to_string(list_sort(list(DISTINCT word)), ', ') AS labels FROM su WHERE is_label GROUP BY page_id")
def page_labels(s: SparkSession, d: str) -> DataFrame:
    """AGG8."""
    return _page_lines(s, d).where("is_label").groupBy("page_id").agg(F.array_join(F.sort_array(F.collect_set("word")), ", ").alias("labels"))


_CLEANED = (
    _RULED
    + r""",
    gl AS (SELECT *, n_lines = 1 AND NOT is_label AND trim(regexp_extract(raw, """
    + _TAIL
    + r""", 1), ' ') <> '' AS glued FROM su),
    g2 AS (SELECT *, CASE WHEN glued THEN regexp_extract(raw, """
    + _TAIL
    + r""", 1) ELSE raw END AS line,
        list_distinct(list_filter(list_concat(list_transform(recipes, lambda x: x.result), flatten(list_transform(recipes, lambda x: coalesce(list_transform(x.ingredients, lambda y: y.name), []))), flatten(list_transform(recipes, lambda x: coalesce(list_transform(x.slots, lambda y: y.name), [])))), lambda n: n IS NOT NULL AND n <> '')) AS names FROM gl),
    r5 AS (SELECT *, CASE WHEN is_label THEN 'R4a' WHEN level = 0 AND len(names) > 0 AND regexp_full_match(trim(line, ' '), '(?:' || array_to_string(list_transform(names, lambda n: '\Q' || n || '\E'), '|') || '){2,}') THEN 'R5' END AS rule FROM g2),
    hd AS (SELECT page_id, line_no, level FROM r5 WHERE rule IS NULL AND level > 0),
    up AS (SELECT h.page_id, h.line_no, count(a.line_no) AS depth FROM hd h LEFT JOIN hd a ON a.page_id = h.page_id AND a.line_no < h.line_no AND a.level < h.level
        AND NOT EXISTS (SELECT 1 FROM hd k WHERE k.page_id = h.page_id AND k.line_no > a.line_no AND k.line_no < h.line_no AND k.level <= a.level) GROUP BY ALL),
    em AS (SELECT h.page_id, h.line_no FROM hd h WHERE NOT EXISTS (SELECT 1 FROM r5 t WHERE t.page_id = h.page_id AND t.line_no > h.line_no AND t.rule IS NULL AND t.level = 0 AND trim(t.line, ' ') <> ''
        AND NOT EXISTS (SELECT 1 FROM hd k WHERE k.page_id = h.page_id AND k.line_no > h.line_no AND k.line_no < t.line_no AND k.level <= h.level))),
    ru AS (SELECT r5.page_id, r5.line_no, CASE WHEN em.line_no IS NOT NULL THEN 'R7' ELSE r5.rule END AS rule, glued,
        CASE WHEN up.line_no IS NOT NULL THEN 2 + up.depth ELSE 0 END AS out_level,
        CASE WHEN up.line_no IS NOT NULL THEN repeat('#', CAST(2 + up.depth AS BIGINT)) || ' ' || regexp_replace(r5.line, '^#{1,6} ', '') ELSE r5.line END AS out_line
        FROM r5 LEFT JOIN up ON up.page_id = r5.page_id AND up.line_no = r5.line_no LEFT JOIN em ON em.page_id = r5.page_id AND em.line_no = r5.line_no)"""
)


def _ruled(s: SparkSession, d: str) -> DataFrame:
    return clean.ruled_lines(table(s, d, "extracted").select("page_id", "title", "markdown", "recipes"), SITE)


@query(f"WITH {_CLEANED} SELECT page_id, CAST(line_no AS INTEGER) AS line_no, rule, CAST(out_level AS INTEGER) AS out_level, out_line FROM ru")
def ruled_lines(s: SparkSession, d: str) -> DataFrame:
    """STR6, STR7, STR9 to STR11, WIN4, WIN5, ARR1: every line with what its rules make of it."""
    return _ruled(s, d).select("page_id", "line_no", "rule", "out_level", "out_line")


@query(f"WITH {_CLEANED} SELECT rule, count(DISTINCT page_id) AS pages, count(*) AS lines, CAST(sum(length(out_line)) AS BIGINT) AS chars FROM ru WHERE rule IS NOT NULL GROUP BY rule")
def rule_hits(s: SparkSession, d: str) -> DataFrame:
    """AGG4."""
    return _ruled(s, d).where("rule IS NOT NULL").groupBy("rule").agg(F.countDistinct("page_id").alias("pages"), F.count(F.lit(1)).alias("lines"), F.sum(F.length("out_line")).alias("chars"))


@query(f"WITH {_CLEANED} SELECT CAST(out_level AS INTEGER) AS out_level, count(*) AS n FROM ru WHERE rule IS NULL AND out_level > 0 GROUP BY out_level")
def heading_totals(s: SparkSession, d: str) -> DataFrame:
    """AGG6."""
    return report.counts_by(_ruled(s, d).where("rule IS NULL AND out_level > 0"), "out_level")


@query("SELECT page_id, count_if(trim(regexp_replace(line, '^#{1,6} ', ''), ' ') = '-') AS orphan_dashes FROM (SELECT page_id, unnest(string_split(coalesce(markdown, ''), chr(10))) AS line FROM extracted) GROUP BY page_id")
def orphan_dashes(s: SparkSession, d: str) -> DataFrame:
    """STR13."""
    lines = line_array(F.coalesce("markdown", F.lit("")))
    n = F.size(F.filter(lines, lambda x: F.trim(tx.content_of(x)) == "-"))
    return table(s, d, "extracted").select("page_id", n.cast("long").alias("orphan_dashes"))


_RECIPE = """'- ' || x.label || ' [' || x.station || ']: ' || CASE WHEN len(x.slots) > 0 THEN array_to_string(list_transform(x.slots, lambda y: y.slot || ' ' || y.name), ', ')
    ELSE array_to_string(list_transform(x.ingredients, lambda y: CAST(y.count AS VARCHAR) || ' × ' || y.name), ', ') END || ' → ' || x.result"""
_BODIES = (
    _CLEANED
    + f""",
    bd AS (SELECT page_id, string_agg(out_line, chr(10) ORDER BY line_no) AS t, string_agg(regexp_replace(out_line, '^#{{1,6}} ', ''), chr(10) ORDER BY line_no) AS plain FROM ru WHERE rule IS NULL GROUP BY page_id),
    fin AS (SELECT s.page_id, s.title, s.source, CASE WHEN len(s.recipes) > 0 THEN CASE WHEN bd.t IS NULL THEN '' ELSE bd.t || chr(10) END || '## Recipes' || chr(10) || array_to_string(list_transform(s.recipes, lambda x: {_RECIPE}), chr(10)) ELSE coalesce(bd.t, '') END AS body,
        coalesce(length(bd.plain), 0) AS chars_after, len(s.recipes) AS n_recipes FROM src s LEFT JOIN bd USING (page_id)),
    rs AS (SELECT *, CASE WHEN title = '' OR source = '' THEN 'missing_title_or_source' WHEN regexp_replace(body, '[\\s\\p{{Z}}]+', '', 'g') = '' THEN 'empty_body' END AS skip_reason FROM fin)"""
)


def _clean(s: SparkSession, d: str) -> DataFrame:
    return clean.clean_pages(table(s, d, "extracted").select("page_id", "title", "source", "markdown", "recipes"), SITE)


@query(
    f"""WITH {_BODIES} SELECT page_id, CASE WHEN skip_reason IS NULL THEN body END AS body, CAST(chars_after AS INTEGER) AS chars_after, skip_reason,
    CASE WHEN skip_reason IS NULL THEN chars_after < 200 END AS short_body, CAST(CASE WHEN skip_reason IS NULL THEN n_recipes ELSE 0 END AS INTEGER) AS recipes_added FROM rs"""
)
def clean_pages(s: SparkSession, d: str) -> DataFrame:
    """FLT9, FLT10, STR3 to STR12, JSN2, ERR2: the cleaned body of every page."""
    return _clean(s, d).select("page_id", "body", "chars_after", "skip_reason", "short_body", "recipes_added")


@query(f"WITH {_BODIES} SELECT coalesce(skip_reason, 'output') AS outcome, count(*) AS n, CAST(sum(chars_after) AS BIGINT) AS chars FROM rs GROUP BY 1")
def clean_reconciliation(s: SparkSession, d: str) -> DataFrame:
    """AGG1, AGG2 of the cleaning stage."""
    return _clean(s, d).groupBy(F.coalesce("skip_reason", F.lit("output")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"), F.sum("chars_after").alias("chars"))


@query(f"WITH {_BODIES} SELECT r.page_id, length(array_to_string(list_transform(s.ls, lambda x: regexp_replace(x, '^#{{1,6}} ', '')), chr(10))) - r.chars_after AS delta FROM rs r JOIN src s USING (page_id) ORDER BY delta DESC, page_id LIMIT 10")
def largest_cuts(s: SparkSession, d: str) -> DataFrame:
    """ORD3: the ten pages that lose the most characters."""
    before = F.array_join(F.transform(line_array(F.coalesce("markdown", F.lit(""))), tx.content_of), "\n")
    raw = table(s, d, "extracted").select("page_id", F.length(before).alias("chars_before"))
    both = _clean(s, d).join(raw, "page_id")
    return both.select("page_id", (F.col("chars_before") - F.col("chars_after")).cast("long").alias("delta")).orderBy(F.desc("delta"), "page_id").limit(10)


@query(
    f"""WITH {_BODIES}, f AS (SELECT 'pages' AS section, coalesce(skip_reason, 'output') AS item, count(*) AS n FROM rs GROUP BY 2
    UNION ALL SELECT 'title', coalesce(r1_type, 'none'), count(*) FROM r1 GROUP BY 2 UNION ALL SELECT 'lines', rule, count(*) FROM ru WHERE rule IS NOT NULL GROUP BY 2
    UNION ALL SELECT 'lines', 'R4b', count(*) FROM ru WHERE glued UNION ALL SELECT 'lines', 'suspect', count(*) FROM su WHERE is_suspect
    UNION ALL SELECT 'pages with', 'recipes', count(*) FROM rs WHERE skip_reason IS NULL AND n_recipes > 0 UNION ALL SELECT 'pages with', 'short body', count(*) FROM rs WHERE skip_reason IS NULL AND chars_after < 200)
    SELECT section, item, n FROM f WHERE n > 0"""
)
def cleaning_figures(s: SparkSession, d: str) -> DataFrame:
    """AGG4, AGG5, SNK10, STR4: the counts of the cleaning report."""
    return clean.cleaning_figures(table(s, d, "extracted").select("page_id", "title", "source", "markdown", "recipes"), SITE)


@query(
    r"""SELECT page_id, CASE WHEN regexp_matches(coalesce(title, ''), '[:#"'',{}\[\]&*!|>%@`]') OR coalesce(title, '') <> trim(coalesce(title, ''), ' ') OR coalesce(title, '') = ''
    THEN '"' || replace(replace(coalesce(title, ''), '\', '\\'), '"', '\"') || '"' ELSE title END AS scalar, true AS round_trip FROM extracted"""
)
def yaml_titles(s: SparkSession, d: str) -> DataFrame:
    """STR14, SRC17: titles as YAML scalars, and whether they read back the same."""
    scalar = table(s, d, "extracted").select("page_id", "title", tx.yaml_scalar("title").alias("scalar"))
    return scalar.select("page_id", "scalar", (tx.yaml_unscalar(F.col("scalar")) == F.trim(F.coalesce("title", F.lit("")))).alias("round_trip"))


# Chunks -----------------------------------------------------------------------------------------------------------

_COUNTED = "@TOKENS(text, @RULE))"


@query(f"SELECT parent_id, token_count AS stored, {_COUNTED} AS counted FROM parents WHERE token_count IS DISTINCT FROM {_COUNTED}")
def parent_count_errors(s: SparkSession, d: str) -> DataFrame:
    """STR20: parents whose stored size is wrong."""
    p = table(s, d, "parents").select("parent_id", F.col("token_count").alias("stored"), token_count("text").alias("counted"))
    return p.where(~F.col("stored").cast("long").eqNullSafe(F.col("counted")))


@query(f"SELECT chunk_id, token_count AS stored, {_COUNTED} AS counted FROM children WHERE token_count IS DISTINCT FROM {_COUNTED}")
def child_count_errors(s: SparkSession, d: str) -> DataFrame:
    """STR20: children whose stored size is wrong."""
    c = table(s, d, "children").select("chunk_id", F.col("token_count").alias("stored"), token_count("text").alias("counted"))
    return c.where(~F.col("stored").cast("long").eqNullSafe(F.col("counted")))


def _distribution(name: str) -> str:
    return f"""WITH t AS (SELECT version, {_COUNTED} AS v FROM {name}), r AS (SELECT version, v, row_number() OVER (PARTITION BY version ORDER BY v) AS k, count(*) OVER (PARTITION BY version) AS n FROM t)
        SELECT version, max(n) AS n, median(v) AS median, max(CASE WHEN k = greatest(1, CAST(floor(n * 0.95) AS BIGINT)) THEN v END) AS p95, max(v) AS max FROM r GROUP BY version"""


@query(_distribution("parents"))
def parent_sizes(s: SparkSession, d: str) -> DataFrame:
    """AGG10: sizes of parents by version."""
    return report.distribution(table(s, d, "parents").select("version", token_count("text").alias("tokens")), "tokens", ["version"])


@query(_distribution("children"))
def child_sizes(s: SparkSession, d: str) -> DataFrame:
    """AGG10: sizes of children by version."""
    return report.distribution(table(s, d, "children").select("version", token_count("text").alias("tokens")), "tokens", ["version"])


@query("SELECT version, count(*) AS n, max(token_count) AS max, round(avg(token_count), 2) AS mean, median(token_count) AS median FROM children GROUP BY version")
def token_summary(s: SparkSession, d: str) -> DataFrame:
    """AGG11."""
    c = table(s, d, "children").groupBy("version").agg(F.count(F.lit(1)).alias("n"), F.max("token_count").alias("max"), F.round(F.avg("token_count"), 2).alias("mean"), F.median("token_count").alias("median"))
    return c


@query(
    """SELECT 'parent' AS kind, parent_id AS id, 'over_limit' AS fault FROM parents WHERE token_count > 2048 UNION ALL SELECT 'child', chunk_id, 'over_limit' FROM children WHERE token_count > 256
    UNION ALL SELECT 'parent', parent_id, 'short' FROM parents WHERE token_count < 50"""
)
def stored_limit_faults(s: SparkSession, d: str) -> DataFrame:
    """FLT12, FLT13, by the stored sizes."""
    p, c = table(s, d, "parents"), table(s, d, "children")
    parts = [
        p.where(F.col("token_count") > SITE.parent_limit).select(F.lit("parent").alias("kind"), F.col("parent_id").alias("id"), F.lit("over_limit").alias("fault")),
        c.where(F.col("token_count") > SITE.child_limit).select(F.lit("child").alias("kind"), F.col("chunk_id").alias("id"), F.lit("over_limit").alias("fault")),
        p.where(F.col("token_count") < SITE.short_parent).select(F.lit("parent").alias("kind"), F.col("parent_id").alias("id"), F.lit("short").alias("fault")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT parent_id, count(*) AS children FROM children GROUP BY parent_id HAVING count(*) > 1")
def multi_child_parents(s: SparkSession, d: str) -> DataFrame:
    """AGG9."""
    return table(s, d, "children").groupBy("parent_id").agg(F.count(F.lit(1)).alias("children")).where("children > 1")


@query("SELECT version, mod, chapter, page, count(*) AS parents, CAST(sum(token_count) AS BIGINT) AS tokens FROM parents GROUP BY ALL HAVING count(*) > 1")
def multi_parent_pages(s: SparkSession, d: str) -> DataFrame:
    """AGG9."""
    return table(s, d, "parents").groupBy("version", "mod", "chapter", "page").agg(F.count(F.lit(1)).alias("parents"), F.sum("token_count").alias("tokens")).where("parents > 1")


@query("SELECT chunk_id, section || chr(10) || chr(10) || text AS embedding_input, len(regexp_extract_all(section || chr(10) || chr(10) || text, @RULE)) AS input_tokens FROM children")
def embedding_inputs(s: SparkSession, d: str) -> DataFrame:
    """PRJ3, FLT12."""
    c = table(s, d, "children").select("chunk_id", F.concat("section", F.lit("\n\n"), "text").alias("embedding_input"))
    return c.withColumn("input_tokens", token_count("embedding_input"))


@query("SELECT md5(text) AS digest, count(*) AS copies, count(DISTINCT version) AS versions, min(parent_id) AS first_id FROM parents GROUP BY text HAVING count(*) > 1")
def repeated_parents(s: SparkSession, d: str) -> DataFrame:
    """AGG14: texts that stand under several ids."""
    p = table(s, d, "parents").groupBy(F.md5("text").alias("digest")).agg(F.count(F.lit(1)).alias("copies"), F.countDistinct("version").alias("versions"), F.min("parent_id").alias("first_id"))
    return p.where("copies > 1")


@query(
    f"""WITH {_BODIES}, pl AS (SELECT page_id, title, unnest(string_split(body, chr(10))) AS raw, generate_subscripts(string_split(body, chr(10)), 1) AS line_no FROM rs WHERE skip_reason IS NULL),
    pt AS (SELECT page_id, title, line_no, trim(raw, ' ') AS line FROM pl WHERE trim(raw, ' ') <> ''), pv AS (SELECT *, length(regexp_extract(line, '^(#{{1,6}}) ', 1)) AS level FROM pt),
    pb AS (SELECT *, sum(CASE WHEN level BETWEEN 1 AND 2 THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY line_no) AS block FROM pv),
    pp AS (SELECT page_id, block, any_value(title) AS title, string_agg(line, chr(10) ORDER BY line_no) AS text, max(CASE WHEN level = 2 THEN regexp_replace(line, '^#{{1,6}} ', '') END) AS h2 FROM pb GROUP BY page_id, block)
    SELECT page_id AS page, CAST(row_number() OVER (PARTITION BY page_id ORDER BY block) AS INTEGER) AS part, CASE WHEN coalesce(h2, '') <> '' THEN title || ' > ' || h2 ELSE title END AS section, text, {_COUNTED} AS token_count FROM pp"""
)
def chunk_parents(s: SparkSession, d: str) -> DataFrame:
    """CHK1, PRJ6, WIN1: parents of every cleaned page."""
    return chunk.parent_sections(_clean(s, d))


@query()
def chunk_children(s: SparkSession, d: str) -> DataFrame:
    """CHK2, CHK4: children of every cleaned page; tested by exact coverage."""
    return chunk.children(chunk.parent_sections(_clean(s, d)), SITE.child_limit, SITE.child_overlap)


@query(
    """WITH st AS (SELECT c.chunk_id, c.parent_id, strpos(p.text, c.text) - 1 AS start FROM children c JOIN parents p USING (parent_id)),
    ln AS (SELECT parent_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM parents),
    offs AS (SELECT parent_id, trim(line, ' ') AS line, k, coalesce(sum(length(line) + 1) OVER (PARTITION BY parent_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM ln),
    hd AS (SELECT parent_id, pos, length(regexp_extract(line, '^(#{1,6}) ', 1)) AS level, trim(regexp_replace(line, '^#{1,6} ', ''), ' ') AS heading FROM offs WHERE length(regexp_extract(line, '^(#{1,6}) ', 1)) >= 3),
    nr AS (SELECT s.chunk_id, h.pos, h.level, h.heading FROM st s JOIN hd h ON h.parent_id = s.parent_id AND h.pos <= s.start),
    lv AS (SELECT a.chunk_id, a.pos, a.heading FROM nr a WHERE NOT EXISTS (SELECT 1 FROM nr b WHERE b.chunk_id = a.chunk_id AND b.pos > a.pos AND b.level <= a.level)),
    sb AS (SELECT chunk_id, string_agg(heading, ' > ' ORDER BY pos) AS sub FROM lv GROUP BY chunk_id)
    SELECT s.chunk_id, concat_ws(' > ', p.section, sb.sub) AS path FROM st s JOIN parents p USING (parent_id) LEFT JOIN sb USING (chunk_id)"""
)
def child_sections(s: SparkSession, d: str) -> DataFrame:
    """CHK3, JN14, WIN7: the headings that stand above each child."""
    p = table(s, d, "parents").select("parent_id", "text", "section")
    c = table(s, d, "children").select("chunk_id", "parent_id", F.col("text").alias("piece")).join(p.select("parent_id", "text"), "parent_id")
    starts = c.select("chunk_id", "parent_id", F.expr("locate(piece, text) - 1").alias("start"))
    return chunk.sub_sections(starts, p).select("chunk_id", "path")


# Index ------------------------------------------------------------------------------------------------------------


@query("SELECT chunk_id, parent_id FROM children c WHERE NOT EXISTS (SELECT 1 FROM parents p WHERE p.parent_id = c.parent_id AND p.token_count >= 50)")
def children_of_short_parents(s: SparkSession, d: str) -> DataFrame:
    """JN6: children without a parent among those of a report's size."""
    return index.orphans(table(s, d, "parents").where("token_count >= 50"), table(s, d, "children").select("chunk_id", "parent_id")).select("chunk_id", "parent_id")


@query("SELECT parent_id FROM parents p WHERE NOT EXISTS (SELECT 1 FROM children c WHERE c.parent_id = p.parent_id AND c.embedding IS NOT NULL AND len(c.embedding) = 64)")
def parents_without_vectors(s: SparkSession, d: str) -> DataFrame:
    """JN7: parents without a child that has a vector of full length."""
    full = table(s, d, "children").where("embedding IS NOT NULL AND size(embedding) = 64").select("parent_id")
    return index.childless(table(s, d, "parents").select("parent_id"), full)


@query(
    """SELECT c.chunk_id, c.parent_id, strpos(p.text, c.text) AS position, length(c.text) AS chars, CAST(octet_length(encode(c.text)) AS BIGINT) AS bytes, starts_with(c.chunk_id, c.parent_id || ':c') AS right_prefix
    FROM children c JOIN parents p USING (parent_id)"""
)
def child_positions(s: SparkSession, d: str) -> DataFrame:
    """JN8, JN9, STR19: where each child stands in its parent, with lengths in characters and bytes."""
    p = table(s, d, "parents").select("parent_id", F.col("text").alias("whole"))
    c = table(s, d, "children").select("chunk_id", "parent_id", "text").join(p, "parent_id")
    return c.select(
        "chunk_id", "parent_id", F.expr("CAST(locate(text, whole) AS BIGINT)").alias("position"), F.length("text").cast("long").alias("chars"), F.octet_length("text").cast("long").alias("bytes"), F.col("chunk_id").startswith(F.concat("parent_id", F.lit(":c"))).alias("right_prefix")
    )


_NORM = "sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))))"


@query(
    f"""SELECT chunk_id, CASE WHEN embedding IS NULL THEN 'missing' WHEN len(embedding) <> 64 THEN 'dim' WHEN len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) > 0 THEN 'finite'
    WHEN abs({_NORM} - 1) > 0.0001 THEN 'norm' END AS fault FROM children WHERE fault IS NOT NULL"""
)
def vector_faults(s: SparkSession, d: str) -> DataFrame:
    """VEC1, VEC3."""
    return index.vector_faults(table(s, d, "children"), SITE)


@query(f"SELECT label, count(*) AS n, round(max(abs({_NORM} - 1)), 6) AS worst FROM embeddings GROUP BY label")
def norm_deviation(s: SparkSession, d: str) -> DataFrame:
    """VEC1, AGG17."""
    return table(s, d, "embeddings").groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.max(F.abs(ve.norm("embedding") - 1)), 6).alias("worst"))


@query("SELECT model_name, model_revision, count(*) AS n, min(version) AS first_version FROM children GROUP BY ALL")
def model_pairs(s: SparkSession, d: str) -> DataFrame:
    """IDX4, AGG12, AGG13."""
    return table(s, d, "children").groupBy("model_name", "model_revision").agg(F.count(F.lit(1)).alias("n"), F.min("version").alias("first_version"))


@query("SELECT version FROM parents UNION SELECT version FROM children")
def indexed_versions(s: SparkSession, d: str) -> DataFrame:
    """SET1."""
    return table(s, d, "parents").select("version").union(table(s, d, "children").select("version")).distinct()


_OWN = "title, section, source_url, token_count"
_BYTES = "coalesce(CAST(octet_length(encode(CAST({0} AS VARCHAR))) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"


@query("SELECT parent_id AS key, sha256(" + " || ".join(_BYTES.format(c) for c in index.PARENT_COLUMNS) + ") AS digest FROM parents")
def row_digests(s: SparkSession, d: str) -> DataFrame:
    """AGG16, a row at a time."""
    return index.row_digests(table(s, d, "parents"), "parent_id", index.PARENT_COLUMNS)


@query(
    "WITH g AS (SELECT sha256("
    + " || ".join(_BYTES.format(c) for c in index.PARENT_COLUMNS)
    + """) AS digest FROM parents) SELECT count(*) AS n, CAST(sum(CAST(('0x' || substring(digest, 1, 15)) AS BIGINT)) AS VARCHAR) || '-' || CAST(sum(CAST(('0x' || substring(digest, 16, 15)) AS BIGINT)) AS VARCHAR) AS fingerprint FROM g"""
)
def table_fingerprint(s: SparkSession, d: str) -> DataFrame:
    """AGG16: of the whole table, without a sort."""
    return index.fingerprint(table(s, d, "parents"), "parent_id", index.PARENT_COLUMNS)


_STEPS = "v AS (SELECT version, lag(version) OVER (ORDER BY list_transform(string_split(version, '.'), lambda x: TRY_CAST(x AS INTEGER)), version) AS before FROM (SELECT DISTINCT version FROM parents WHERE version IS NOT NULL))"
_PART = "concat_ws(':', mod, chapter, regexp_replace(page, '-[0-9a-z]+$', ''), regexp_extract(parent_id, ':(p[0-9]+)$', 1))"
_ALL_CHANGES = f"""{_STEPS}, p AS (SELECT *, {_PART} AS k FROM parents), e AS (SELECT *, CAST(row_number() OVER (PARTITION BY version, k ORDER BY parent_id) AS INTEGER) AS copy FROM p),
    o AS (SELECT v.version AS version, k, copy, title, section, text FROM e JOIN v ON e.version = v.before), n AS (SELECT e.version AS version, k, copy, title, section, text FROM e JOIN v ON e.version = v.version WHERE before IS NOT NULL),
    c AS (SELECT coalesce(o.version, n.version) AS version, coalesce(o.k, n.k) AS k, coalesce(o.copy, n.copy) AS copy, CASE WHEN o.k IS NULL THEN 'inserted' WHEN n.k IS NULL THEN 'deleted'
    WHEN (o.title, o.section, o.text) IS DISTINCT FROM (n.title, n.section, n.text) THEN 'updated' ELSE 'unchanged' END AS change FROM o FULL JOIN n ON o.version = n.version AND o.k = n.k AND o.copy = n.copy)"""


def _steps(parents: DataFrame) -> DataFrame:
    """``version`` and the one ``before`` it, by the numbers in them, of a table's few versions."""
    from pyspark.sql import Window as W

    numbers = F.transform(F.split("version", r"\."), lambda x: x.try_cast("int"))
    return parents.select("version").where("version IS NOT NULL").distinct().withColumn("before", F.lag("version").over(W.orderBy(numbers, "version"))).where("before IS NOT NULL")


@query(f"WITH {_ALL_CHANGES} SELECT version, k, copy, change FROM c")
def version_changes(s: SparkSession, d: str) -> DataFrame:
    """IDX7, IDX8, JN11: what an update of each version by the next one would do, for every section.

    Pages that differ in the suffix only are told apart by ``copy``, their order within the version.
    """
    from pyspark.sql import Window as W

    p = table(s, d, "parents")
    steps = F.broadcast(_steps(p))
    k = F.concat_ws(":", "mod", "chapter", F.regexp_replace("page", "-[0-9a-z]+$", ""), F.regexp_extract("parent_id", ":(p[0-9]+)$", 1))
    p = p.select("parent_id", "version", k.alias("k"), "title", "section", "text")
    p = p.withColumn("copy", F.row_number().over(W.partitionBy("version", "k").orderBy("parent_id")))
    old = p.withColumnRenamed("version", "before").join(steps, "before").drop("before")
    return index.classify(old, p.join(steps, "version"), ["version", "k", "copy"], ["title", "section", "text"])


@query(f"WITH {_ALL_CHANGES} SELECT version, change, count(*) AS n FROM c GROUP BY version, change")
def change_counts(s: SparkSession, d: str) -> DataFrame:
    """IDX7 to IDX9, HLP3: of every version and every section."""
    return report.counts_by(version_changes(s, d), "version", "change")


@query(f"WITH {_STEPS} SELECT v.version, mod, chapter, page FROM parents p JOIN v ON p.version = v.before EXCEPT SELECT version, mod, chapter, page FROM parents")
def dropped_pages(s: SparkSession, d: str) -> DataFrame:
    """SET2: pages of each version that the next lacks."""
    p = table(s, d, "parents").select("version", "mod", "chapter", "page")
    old = p.withColumnRenamed("version", "before").join(F.broadcast(_steps(p)), "before")
    return old.select("version", "mod", "chapter", "page").subtract(p)


@query(f"WITH {_STEPS} SELECT v.version, mod, chapter FROM parents p JOIN v ON p.version = v.before INTERSECT SELECT version, mod, chapter FROM parents")
def lasting_chapters(s: SparkSession, d: str) -> DataFrame:
    """SET3: chapters of each version that the next still has."""
    p = table(s, d, "parents").select("version", "mod", "chapter")
    old = p.withColumnRenamed("version", "before").join(F.broadcast(_steps(p)), "before")
    return old.select("version", "mod", "chapter").intersect(p)


@query(
    """SELECT c.chunk_id, c.title IS NOT DISTINCT FROM p.title AND c.source_url IS NOT DISTINCT FROM p.source_url AND c.version IS NOT DISTINCT FROM p.version AND c.mod IS NOT DISTINCT FROM p.mod AS same, c.section = p.section AS same_section
    FROM children c JOIN parents p USING (parent_id)"""
)
def child_provenance(s: SparkSession, d: str) -> DataFrame:
    """JN4, JN12: each child's provenance against its parent's."""
    own = ["title", "source_url", "version", "mod"]
    p = table(s, d, "parents").select("parent_id", "section", *own).alias("p")
    c = table(s, d, "children").select("chunk_id", "parent_id", "section", *own).alias("c")
    same = clean.reduce_and([F.col(f"c.{x}").eqNullSafe(F.col(f"p.{x}")) for x in own])
    return c.join(p, F.col("c.parent_id") == F.col("p.parent_id")).select("chunk_id", same.alias("same"), (F.col("c.section") == F.col("p.section")).alias("same_section"))


_FIELDS = ["title", "source_url", "version", "mod", "chapter", "page", "section"]


@query(
    "WITH d AS (SELECT c.chunk_id AS key, list_filter([" + ", ".join(f"CASE WHEN c.{x} IS DISTINCT FROM p.{x} THEN '{x}' END" for x in _FIELDS) + """], lambda x: x IS NOT NULL) AS f FROM children c JOIN parents p USING (parent_id))
    SELECT key, array_to_string(f, ',') AS differing FROM d WHERE len(f) > 0 UNION ALL SELECT chunk_id, 'missing' FROM children c WHERE NOT EXISTS (SELECT 1 FROM parents p WHERE p.parent_id = c.parent_id)"""
)
def child_differences(s: SparkSession, d: str) -> DataFrame:
    """JN4, IDX3: every child row against the row that its parent would give it, field by field."""
    c = table(s, d, "children").select("chunk_id", "parent_id", *_FIELDS)
    made = c.select("chunk_id", "parent_id").join(table(s, d, "parents").select("parent_id", *_FIELDS), "parent_id")
    return index.row_differences(c, made, "chunk_id", _FIELDS).select("key", F.array_join("differing", ",").alias("differing"))


@query("SELECT p.parent_id, count(DISTINCT e.page_id) AS pages FROM parents p LEFT JOIN extracted e ON e.source = p.source_url GROUP BY p.parent_id")
def parent_pages(s: SparkSession, d: str) -> DataFrame:
    """JN12: the extracted pages behind each parent."""
    pages = table(s, d, "extracted").groupBy("source").agg(F.countDistinct("page_id").alias("n"))
    return table(s, d, "parents").select("parent_id", "source_url").join(pages, F.col("source_url") == F.col("source"), "left").select("parent_id", F.coalesce("n", F.lit(0)).alias("pages"))


_BLANK = "{0} IS NULL OR trim({0}, ' ') = '' OR contains({0}, chr(0))"
_SHAPE = " OR ".join(_BLANK.format(c) for c in index.PARENT_COLUMNS if c != "token_count") + " OR coalesce(token_count, 0) <= 0"
_VECTOR = f"embedding IS NULL OR len(embedding) <> 64 OR len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) > 0 OR abs({_NORM} - 1) > 0.0001"
_AUDIT = {
    "parents of bad shape": f"SELECT count(*) FROM parents WHERE {_SHAPE}",
    "children of bad shape": f"SELECT count(*) FROM children WHERE {_SHAPE} OR {_BLANK.format('chunk_id')}",
    "repeated parents": "SELECT count(*) FROM (SELECT parent_id FROM parents GROUP BY parent_id HAVING count(*) > 1)",
    "repeated children": "SELECT count(*) FROM (SELECT chunk_id FROM children GROUP BY chunk_id HAVING count(*) > 1)",
    "orphans": "SELECT count(*) FROM children c WHERE NOT EXISTS (SELECT 1 FROM parents p WHERE p.parent_id = c.parent_id)",
    "childless parents": "SELECT count(*) FROM parents p WHERE NOT EXISTS (SELECT 1 FROM children c WHERE p.parent_id = c.parent_id)",
    "misplaced children": "SELECT count(*) FROM children c JOIN parents p USING (parent_id) WHERE NOT coalesce(contains(p.text, c.text), false) OR NOT starts_with(c.chunk_id, c.parent_id || ':c')",
    "faulty vectors": f"SELECT count(*) FROM children WHERE {_VECTOR}",
    "models": "SELECT count(*) FROM (SELECT DISTINCT model_name, model_revision FROM children)",
    "versions of one table only": "SELECT count(*) FROM (SELECT version FROM (SELECT DISTINCT version FROM parents UNION ALL SELECT DISTINCT version FROM children) GROUP BY version HAVING count(*) = 1)",
}


@query(" UNION ALL ".join(f"SELECT '{k}' AS \"check\", n = {int(k == 'models')} AS ok, CAST(n AS VARCHAR) AS detail FROM ({v.replace('SELECT count(*) FROM', 'SELECT count(*) AS n FROM', 1)})" for k, v in _AUDIT.items()))
def index_audit(s: SparkSession, d: str) -> DataFrame:
    """IDX2, IDX3, JN6 to JN9, AGG14, VER1, VER2: every check of the tables, with what it counts."""
    return index.audit(table(s, d, "parents"), table(s, d, "children"), SITE)


@query(
    f"""WITH f AS (SELECT chunk_id, CASE WHEN embedding IS NULL THEN 'missing' WHEN len(embedding) <> 64 THEN 'dim' WHEN len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) > 0 THEN 'finite'
    WHEN abs({_NORM} - 1) > 0.0001 THEN 'norm' END AS fault FROM children), r AS (SELECT fault, chunk_id, CAST(row_number() OVER (PARTITION BY fault ORDER BY chunk_id) AS INTEGER) AS rank, count(*) OVER (PARTITION BY fault) AS n FROM f WHERE fault IS NOT NULL)
    SELECT fault, chunk_id, rank, n FROM r WHERE rank <= 5"""
)
def first_vector_faults(s: SparkSession, d: str) -> DataFrame:
    """ORD4: the first five ids of each fault, as a report lists them."""
    return report.first_of(index.vector_faults(table(s, d, "children"), SITE), "fault", "chunk_id")


@query(f"SELECT version, heading_level, count(*) AS n, CAST(sum(tokens) AS BIGINT) AS tokens FROM (SELECT version, length(regexp_extract(string_split(text, chr(10))[1], '^(#{{1,6}}) ', 1)) AS heading_level, {_COUNTED} AS tokens FROM parents) GROUP BY ALL")
def functions_in_sql(s: SparkSession, d: str) -> DataFrame:
    """2.13: the engine's functions, called from SQL."""
    from docloom.functions.registry import register

    register(s)
    table(s, d, "parents").createOrReplaceTempView("docloom_parents")
    return s.sql("SELECT version, CAST(heading_level(split(text, '\\n')[0]) AS BIGINT) AS heading_level, count(*) AS n, sum(token_count(text)) AS tokens FROM docloom_parents GROUP BY ALL")


@query()
def realigned_headings(s: SparkSession, d: str) -> DataFrame:
    """HTM5, WIN3: each page's headings put onto its text again; tested on small pages."""
    lines = line_array("markdown")
    found = F.transform(F.filter(lines, lambda x: tx.level_of(x) > 0), lambda x: F.struct(tx.level_of(x).alias("level"), tx.content_of(x).alias("text")))
    pages = table(s, d, "extracted").select("page_id", line_array("text").alias("lines"), found.alias("headings"))
    return pages.withColumn("a", tx.aligned("lines", "headings")).select("page_id", "a.matched", "a.missed", F.size("headings").alias("headings"))


# Neighbours -------------------------------------------------------------------------------------------------------

_DISTANCE = "1 - list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])) / (sqrt(list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[]))) * sqrt(list_dot_product(CAST(c.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[]))))"
_NEAR = f"SELECT q.vec_id AS query, c.vec_id AS neighbour, {_DISTANCE} AS distance FROM embeddings q, embeddings c WHERE q.vec_id % 100 = 0"


def _near(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "embeddings").select("vec_id", "embedding")
    return knn.exact_top_k(e.where("vec_id % 100 = 0"), e, "vec_id", "embedding", 5)


@query(f"WITH n AS ({_NEAR}) SELECT query, neighbour, round(distance, 6) AS distance, CAST(row_number() OVER (PARTITION BY query ORDER BY distance, neighbour) AS INTEGER) AS rank FROM n QUALIFY rank <= 5")
def nearest_vectors(s: SparkSession, d: str) -> DataFrame:
    """ORD5, ORD6, JN10, VEC2: the five nearest rows, of all, for every query whose id is divisible by 100."""
    return _near(s, d).withColumn("distance", F.round("distance", 6))


@query(f"WITH n AS ({_NEAR}), m AS (SELECT *, min(distance) OVER (PARTITION BY query) AS least FROM n) SELECT query, neighbour FROM m WHERE distance - least <= 1e-6")
def nearest_ties(s: SparkSession, d: str) -> DataFrame:
    """ORD7: the whole tie set of the nearest rows, however many they are."""
    e = table(s, d, "embeddings").select("vec_id", "embedding")
    return knn.nearest_ties(e.where("vec_id % 100 = 0"), e, "vec_id", "embedding").select("query", "neighbour")


# Streams ----------------------------------------------------------------------------------------------------------


@query("SELECT CAST(date_trunc('day', CAST(fetched_at AS TIMESTAMP)) AS DATE) AS day, version, error IS NULL AS ok, count(*) AS n FROM fetch_manifest GROUP BY ALL")
def streamed_outcomes(s: SparkSession, d: str) -> DataFrame:
    """The captures as a stream: a windowed aggregate by event time, run until nothing new is there."""
    from uuid import uuid4

    from docloom.shared import shared_dir
    from docloom.streaming import incremental as st

    base = f"{shared_dir(s)}/stream-{uuid4().hex}"
    # a pattern, since a stream wants folders or patterns and the table may be one file
    arriving = st.read_arriving(s, f"{d}/fetch_manifest.parque[t]", "version string, fetched_at string, error string")
    q = st.run_to_table(st.daily_outcomes(arriving), f"{base}/out", f"{base}/checkpoint", lambda x: x.select(F.to_date("w.start").alias("day"), "version", "ok", "n"))
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return s.read.parquet(f"{base}/out")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
