import json

import pytest
from pyspark.sql import types as T

from docloom.errors import InputError
from docloom.sources import readers, writers
from docloom.streaming import incremental


def test_manifest(spark, tmp_path):
    entries = [{"url": "u1", "chapter": "c", "page_slug": "p", "local_path": "f", "http_status": 200, "fetched_at": "t", "error": None}, {"url": "u2", "http_status": None, "error": "timeout"}]
    (tmp_path / "m.json").write_text(json.dumps({"version": "1", "mod": "M", "mod_slug": "m", "source": "s", "fetched_at": "t", "urls": entries}, indent=1))
    rows = readers.read_manifest(spark, str(tmp_path)).orderBy("url").collect()
    assert [(r.version, r.url, r.chapter, r.http_status, r.error) for r in rows] == [("1", "u1", "c", 200, None), ("1", "u2", None, None, "timeout")]


SCHEMA = T.StructType([T.StructField("id", T.StringType(), False), T.StructField("n", T.IntegerType(), False), T.StructField("note", T.StringType())])


@pytest.mark.parametrize(("lines", "fault"), [('{"id":"a","n":1}\n\n{"id":"b","n":2}', "blank"), ('{"id":"a","n":1}\n{broken', "not a record"), ('{"id":"a"}', "missing: n"), ('{"id":"a","n":1}\n{"id":"a","n":2}', "repeated"), ("", "no lines")])
def test_json_lines_contract(spark, tmp_path, lines, fault):
    (tmp_path / "x.jsonl").write_text(lines)
    with pytest.raises(InputError, match=fault):
        readers.read_json_lines(spark, str(tmp_path), SCHEMA, "id")


def test_json_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"id":"a","n":1,"note":null}\n{"id":"b","n":2,"note":"ü"}\n')
    assert {(r.id, r.n, r.note) for r in readers.read_json_lines(spark, str(tmp_path), SCHEMA, "id").collect()} == {("a", 1, None), ("b", 2, "ü")}


def test_markdown_round_trip(spark, tmp_path):
    df = spark.createDataFrame([('An "Odd: one"', "https://u", "## A\nx\n---\ny")], "title string, source string, body string")
    text = df.select(writers.markdown_of()).first()[0]
    folder = tmp_path / "1.2" / "m" / "c"
    folder.mkdir(parents=True)
    (folder / "page.md").write_text(text)
    row = readers.read_markdown(spark, str(tmp_path)).first()
    assert (row.version, row.mod, row.chapter, row.page, row.title, row.source_url) == ("1.2", "m", "c", "page", 'An "Odd: one"', "https://u")
    assert row.body == '# An "Odd: one"\n\n## A\nx\n---\ny\n'


def test_robots_and_sitemaps(spark):
    robots = spark.createDataFrame([("User-agent: *\r\n SiteMap: https://h/a.xml\nsitemap:https://h/b.xml\nDisallow: /",)], "body string")
    assert [r.sitemap for r in readers.robots_sitemaps(robots).collect()] == ["https://h/a.xml", "https://h/b.xml"]
    good = '<?xml version="1.0"?>\n<urlset xmlns="x"><url><loc> https://h/1?a=1&amp;b=2 </loc></url><url><loc></loc></url></urlset>'
    df = spark.createDataFrame([(200, good), (200, "<sitemapindex><sitemap><loc>https://h/s.xml</loc></sitemap></sitemapindex>"), (404, good), (200, "<html></html>"), (200, None)], "http_status int, body string")
    assert df.where(readers.is_sitemap()).count() == 2
    locs = readers.sitemap_locations(df.where(readers.is_sitemap())).collect()
    assert {(r["loc"], r.is_index) for r in locs} == {("https://h/1?a=1&b=2", False), ("https://h/s.xml", True)}


def test_fetch(spark):
    def fetcher(url):
        if url.endswith("x"):
            raise OSError("reset")
        return (404, "no", None) if url.endswith("4") else (200, "page", None)

    urls = spark.createDataFrame([(f"https://h{i % 2}/{k}",) for i, k in enumerate("ab4x")], "url string")
    rows = {r.url[-1]: (r.http_status, r.body, r.error) for r in readers.fetch_pages(urls, fetcher, interval=0.0).collect()}
    assert rows == {"a": (200, "page", None), "b": (200, "page", None), "4": (404, None, "HTTP 404"), "x": (None, None, "reset")}


def test_replacing_a_version(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = lambda *x: spark.createDataFrame([(v,) for v in x], "x int")
    writers.replace_version(rows(1, 2), root, "1.20")
    writers.replace_version(rows(3), root, "1.21")
    writers.replace_version(rows(4), root, "1.20")
    with pytest.raises(InputError):
        writers.replace_version(rows(), root, "1.20")
    got = spark.read.schema("x int, version string").parquet(root).collect()
    assert {(r.x, r.version) for r in got} == {(4, "1.20"), (3, "1.21")}


def test_clean_stream(spark, data, tmp_path):
    from docloom.operators.clean import clean_pages
    from docloom.config import Config
    from docloom.shared import table

    columns = ["page_id", "title", "source", "markdown", "recipes"]
    pages = table(spark, data, "extracted").select(*columns)
    arriving = tmp_path / "in"
    pages.repartition(3).write.parquet(str(arriving))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pages.schema.fields)
    q = incremental.clean_stream(incremental.read_arriving(spark, str(arriving), schema), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    want = clean_pages(pages, Config())
    assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0


def test_page_files_and_loose_lines(spark, tmp_path):
    folder = tmp_path / "pages" / "1" / "m"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text('{"id": "a",\n "n": 1}')
    (folder / "b.json").write_text('{"id": "b"}')
    (folder / "_report.json").write_text('{"id": "no page"}')
    (folder / "note.txt").write_text("no page")
    rows = readers.read_page_files(spark, str(tmp_path / "pages"), SCHEMA).orderBy("id").collect()
    assert [(r.id, r.n, r.path.rsplit("/", 1)[1]) for r in rows] == [("a", 1, "a.json"), ("b", None, "b.json")]
    (tmp_path / "x.jsonl").write_text('{"id":"a","n":1}\n\n  \n{"id":"a"}\n')
    assert [(r.id, r.n) for r in readers.read_loose_json_lines(spark, str(tmp_path / "x.jsonl"), SCHEMA).collect()] == [("a", 1), ("a", None)]


def test_nested_sitemaps(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    index = lambda *u: "<sitemapindex>" + "".join(f"<sitemap><loc>{x}</loc></sitemap>" for x in u) + "</sitemapindex>"
    urls = lambda *u: "<urlset>" + "".join(f"<url><loc>{x}</loc></url>" for x in u) + "</urlset>"
    site = {"h://r": index("h://i", "h://s"), "h://i": index("h://r", "h://i", "h://s", "h://t"), "h://s": urls("h://1", "h://1", "h://2"), "h://t": urls("h://2"), "h://bad": "<html>", "h://lone": urls()}

    def fetcher(url):
        with open(log / url.rsplit("/", 1)[1], "a") as f:
            f.write("x")
        return (200, site[url], None) if url in site else (404, None, None)

    seeds = lambda *u: spark.createDataFrame([(x,) for x in u], "url string")
    got = sorted((r.sitemap, r["loc"]) for r in readers.sitemap_pages(seeds("h://r", None, "h://r"), fetcher, interval=0).collect())
    assert got == [("h://s", "h://1"), ("h://s", "h://1"), ("h://s", "h://2"), ("h://t", "h://2")]
    assert {p.name: p.read_text() for p in log.iterdir()} == dict.fromkeys("rist", "x")
    assert readers.sitemap_pages(seeds("h://lone"), fetcher, interval=0).count() == 0
    for wrong in ("h://bad", "h://none"):
        with pytest.raises(InputError, match="no sitemap"):
            readers.sitemap_pages(seeds(wrong), fetcher, interval=0)
    with pytest.raises(InputError):
        readers.sitemap_pages(seeds(), fetcher)


def test_readable_pages(spark):
    df = spark.createDataFrame([('A: "b"', "u", None, None, "x\n|y", "c"), (None, None, "h", 200, None, None)], "title string, source string, hostname string, http_status int, text string, chapter string")
    rows = df.select(writers.readable_of().alias("t"), writers.index_row("title", "chapter", "text").alias("line")).collect()
    assert rows[0].t == '---\ntitle: "A: \\"b\\""\nsource: u\nhostname: ""\nhttp_status: ""\ntext_length: 4\n---\n\n# A: "b"\n\nx\n|y\n'
    assert rows[1].t == '---\ntitle: ""\nsource: ""\nhostname: h\nhttp_status: 200\ntext_length: 0\n---\n\n# \n\n\n'
    assert [r.line for r in rows] == ['| A: "b" | c | x \\|y |', "|  |  |  |"]
