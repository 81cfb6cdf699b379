import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docloom.config import checked_version
from docloom.errors import InputError
from docloom.functions import text as tx
from docloom.functions import urls as ur
from docloom.functions import vectors as ve
from docloom.functions.html import page_parts, read_page
from docloom.functions.tokens import token_count
from docloom.operators import report


def test_versions_of_addresses(spark):
    rows = [("https://h/1.21.10/a/b",), ("https://h/1.21.1/",), ("https://h/1.21.1/index/",), ("https://h/1.21.1/a/b/",), (None,), ("no address",)]
    df = spark.createDataFrame(rows, "url string").withColumn("version", F.lit("1.21.1"))
    assert [r.url for r in df.where(ur.in_version("url", "version")).collect()] == ["https://h/1.21.1/a/b/"]


@pytest.mark.parametrize(("url", "want"), [("https://h:8/1/getting-started/?q=1", ("other", "getting-started")), ("https://h/1/a/b/c", ("b", "c")), ("https://h/1/", ("other", ""))])
def test_path_elements(spark, url, want):
    df = spark.createDataFrame([(url, "1")], "url string, version string")
    assert tuple(df.select(ur.chapter_of("url", "version"), ur.slug_of("url", "version")).first()) == want


def test_small_text_functions(spark):
    df = spark.createDataFrame([("a　 b\n", 'An "x: y" \\', "pg://u:p@h/d", "A|b\nc", "Big Mod 2!")], "a string, b string, c string, d string, e string")
    row = df.select(tx.blank_collapsed("a"), tx.yaml_scalar("b"), tx.yaml_unscalar(tx.yaml_scalar("b")), ur.mask_secrets("c"), tx.table_cell("d"), ur.slugify("e")).first()
    assert tuple(row) == ("a b", '"An \\"x: y\\" \\\\"', 'An "x: y" \\', "pg://***:***@h/d", "A\\|b c", "big-mod-2")


@pytest.mark.parametrize("bad", ["", ".", "..", "a/b", "a b", "a\\b", "ü", None, 3, "a\n"])
def test_bad_versions(bad):
    with pytest.raises(InputError):
        checked_version(bad)


def test_token_rule(spark):
    df = spark.createDataFrame([("ab_1 c,\t字\U0001f600  ",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(token_count("t")).collect()] == [6, 0, None]


def test_vectors(spark):
    rows = [([1.0, 0.0],), ([0.6, 0.8],), (None,), ([1.0],), ([float("nan"), 0.0],), ([2.0, 0.0],), ([None, 1.0],), ([float("inf"), 0.0],)]
    df = spark.createDataFrame(rows, "v array<float>")
    assert [r[0] for r in df.select(ve.fault("v", 2, 1e-4)).collect()] == [None, None, "missing", "dim", "finite", "norm", "finite", "finite"]
    pair = spark.createDataFrame([([1.0, 0.0], [0.6, 0.8])], "a array<float>, b array<float>")
    assert abs(pair.select(ve.cosine_distance("a", "b")).first()[0] - 0.4) < 1e-6


def test_html():
    page = "<title>T &amp; x</title><nav><a href=n>Nav</a></nav><article><h1>T</h1><p>one <b>two<p>three<br>four<script>x</script><h2>Sub</h2><ul><li>a<li><a href='/q'>link</a></ul></article><p>foot"
    title, text, heads, density, target = read_page(page)
    assert title == "T & x" and text.split("\n") == ["T", "one two", "three", "four", "Sub", "a", "link"]
    assert heads == [(1, "T"), (2, "Sub")] and 0 < density < 0.5 and target is None
    assert read_page("<article><h1>Old</h1><p>See <a href='/new'>New page</a></article>")[4] == "/new"
    assert read_page(None) == (None, None, [], None, None) and read_page("")[1] == ""


def test_html_column(spark):
    df = spark.createDataFrame([("<article><h1>A</h1>b</article>",), (None,)], "h string").select(page_parts("h").alias("p")).select("p.*")
    assert [(r.text, r.headings) for r in df.collect()][0][0] == "A\nb"


@given(st.lists(st.integers(0, 60), min_size=1, max_size=80))
@settings(max_examples=12, deadline=None)
def test_distribution(spark, values):
    row = report.distribution(spark.createDataFrame([(v,) for v in values], "v int"), "v").first()
    s = sorted(values)
    assert (row.n, row.median, row.p95, row["max"]) == (len(s), float(np.median(s)), s[max(1, int(len(s) * 0.95)) - 1], s[-1])


def test_alignment(spark):
    df = spark.createDataFrame([(["T", "A", "B", "A "], [(1, "T"), (2, "A"), (2, "Z"), (3, "A")]), (["x"], []), ([], [(1, "x")]), (None, None)], "l array<string>, h array<struct<level: int, text: string>>")
    rows = [r[0] for r in df.select(tx.aligned("l", "h")).collect()]
    assert rows[0].marked == ["# T", "## A", "B", "### A"] and (rows[0].matched, rows[0].missed) == (3, ["Z"])
    assert rows[1].matched == 0 and rows[2].missed == ["x"] and rows[3] is None


def test_functions_in_sql(spark):
    from docloom.functions.registry import register

    register(spark)
    row = spark.sql("SELECT token_count('a, b'), heading_level('## x'), heading_content('## x'), slugify('A b!'), unit_norm(array(0.6F, 0.8F), 1e-4)").first()
    assert tuple(row) == (3, 2, "x", "a-b", True)
    got = spark.sql("SELECT * FROM chunk_text('one two three four five', 2, 0)").collect()
    assert "".join(r.chunk for r in got) == "one two three four five" and len(got) == 3


def test_links_are_resolved(spark):
    df = spark.createDataFrame([("https://h/a/b", "../c"), ("https://h/a", None)], "b string, h string")
    assert [r[0] for r in df.select(tx.resolved("b", "h")).collect()] == ["https://h/c", None]


def test_report_sections(spark):
    text = report.markdown(spark.createDataFrame([("a|b\nc", 1), (None, 2), ("z", 3)], "k string, n int"), "Faults", 2)
    assert text.startswith("## Faults\n\n| k | n |\n| --- | --- |\n| a\\|b c | 1 |") and text.endswith("and 1 more\n")


def test_dispositions(spark):
    from docloom.operators.fetch import disposition

    sites = spark.createDataFrame([("1", ["https://h/1/gone/"])], "version string, exclude array<string>")
    rows = [("https://h/1/gone", "x", 0.0, "excluded_by_sources"), ("https://h/1/a", " ", 0.0, "extraction_error"), ("https://h/1/a-index/", "x", 0.0, "url_ends_with_index"), ("https://h/1/b", "x", 0.6, "short_text_high_link_density"), ("https://h/1/c", "x" * 200, 0.6, "output"), ("https://h/1/d", "x", 0.5, "output"), (None, "x", None, "output")]
    df = spark.createDataFrame([("1", u, t, d, w) for u, t, d, w in rows], "version string, source string, text string, density double, want string")
    assert all(r.disposition == r.want for r in disposition(df, sites, density="density").collect())


def test_settings(tmp_path):
    from docloom.errors import SettingsError
    from docloom.sources import settings

    (tmp_path / "s.json").write_text('{"version": "1", "mod": "M", "entry_url": "u"}')
    assert settings.load_site(str(tmp_path / "s.json"))["exclude"] == []
    (tmp_path / "bad.json").write_text('{"version": "1", "mod": ""}')
    for bad in ("bad.json", "none.json"):
        with pytest.raises(InputError):
            settings.load_site(str(tmp_path / bad))
    (tmp_path / ".env").write_text("A='x'\n# c\nB=${B}\nC=secret\n")
    assert settings.load_settings(str(tmp_path / ".env"), ["A", "C"], {"C": "shell"}) == {"A": "x", "C": "shell"}
    with pytest.raises(SettingsError, match="^not set: B, D$"):
        settings.load_settings(str(tmp_path / ".env"), ["B", "C", "D"], {})
    assert settings.discover_sitemap("https://h/", ["https://h/no.xml"], lambda u: u.endswith("/sitemap_index.xml")) == "https://h/sitemap_index.xml"
    with pytest.raises(InputError):
        settings.discover_sitemap("https://h", [], lambda u: False)


def test_content_scenes_and_recipe_boxes_in_text():
    notes = '[{"contentTemplateId": "n1"}, {"contentTemplateId": "gone"}]'.replace('"', "&quot;")
    page = f"<article><p>outside</p><div id=page-content><p>in</p><div data-scene-in-world-annotations='{notes}'></div><div class='recipe-container x'>Recipe<div>deep</div></div><p>end</p></div><p>after</p></article><template id=n1>a <b>note</b></template>"
    assert read_page(page)[1] == "in\na note\nend"


def icon(name):
    return f"<img aria-description='{name}'>"


def test_recipes_from_boxes(spark):
    from docloom.operators.recipes import recipes

    def box(label, station, *parts):
        return f"<div class='recipeBoxLayout'><div>{icon(station)}<span>{label}</span></div>{''.join(f'<div>{p}</div>' for p in parts)}</div>"

    grid = "".join(f"<div class='ingredient-box'>{x}</div>" for x in (icon("Bar") + icon("Other"), "", icon("Cap"), icon("Bar")))
    three = "".join(f"<div class='ingredient-box'>{icon(x)}</div>" for x in "TBA")
    slots = f"<div class='x-top'>{icon('Plate')}</div><div class='x-result'>{icon('Die')}</div><div class='x-middle'></div>"
    page = "<article>" + box("Crafting (Shapeless)", "Table", grid, "&rarr;", icon("Rod")) + box("Smithing", "Smithing Table", three, "", icon("Sword")) + box("Inscriber", "Inscriber", slots) + box("", "Kiln", icon("Ore"), "", icon("Bar")) + "</article>" + box("out", "of", "the", "article", "x")
    rows = recipes(spark.createDataFrame([(1, page), (2, None), (3, "<p>none")], "page_id long, html string")).orderBy("box").collect()
    assert [(r.label, r.station, r.shapeless, r.result, r.failed) for r in rows] == [("Crafting (Shapeless)", "Table", True, "Rod", False), ("Smithing", "Smithing Table", False, "Sword", False), ("Inscriber", "Inscriber", False, "Die", False), ("", "Kiln", False, "Bar", True)]
    assert [tuple(x) for x in rows[0].ingredients] == [("Bar", 2), ("Cap", 1)] and rows[0].slots is None
    assert [tuple(x) for x in rows[1].slots] == [("template", "T"), ("base", "B"), ("addition", "A")] and rows[1].ingredients is None
    assert [tuple(x) for x in rows[2].slots] == [("top", "Plate")]


def test_mask_secrets(spark):
    cases = {
        "db://u:p@h/x": "db://***:***@h/x", "no secrets": "no secrets", "a://u:p@q@h b://v:w@k c": "a://***:***@h b://***:***@k c", "https://h/a:b@c": "https://h/a:b@c", "https://u@h/": "https://u@h/",
        "pass hunter2 and hunter22": "pass *** and ***", "x://:p@h": "x://:p@h", "": "", None: None, "a://b": "a://b", "s://u:p/w@h": "s://***:***@h",
    }
    df = spark.createDataFrame([(k,) for k in cases], "c string")
    got = {r.c: r.m for r in df.withColumn("m", ur.mask_secrets("c", ("hunter2", "hunter22", ""))).collect()}
    assert got == cases


def test_distribution_without_groups(spark):
    from docloom.operators.report import distribution

    df = spark.createDataFrame([(i % 700, None) for i in range(3000)] + [(100_000, None), (None, None)], "v long, w long")
    values = sorted([i % 700 for i in range(3000)] + [100_000])
    r = distribution(df, "v").first()
    assert (r.n, r.median, r.p95, r.max) == (3001, values[1500], values[int(3001 * 0.95) - 1], 100_000)
    assert distribution(df.where("v IS NULL"), "v").count() <= 1


def test_assembled_reports(spark):
    rows = spark.createDataFrame([("a", 1)], "k string, n int")
    text = report.assembled("Cleaning", {"Rules": rows, "Errors": rows.limit(0)})
    assert text.startswith("# Cleaning\n\n## Rules\n\n| k | n |") and text.endswith("## Errors\n\nnone\n")


def test_broadcasts_are_bounded(spark):
    from docloom import shared

    hinted = lambda df, **k: "broadcast" in shared.small(df, **k)._jdf.queryExecution().logical().toString().lower()
    df = spark.range(10).withColumn("s", F.repeat(F.lit("x"), 1000))
    assert hinted(df) and hinted(df.limit(0)) and not hinted(df, limit=9)
    wide = shared.BROADCAST_BYTES
    shared.BROADCAST_BYTES = 9_000
    try:
        assert not hinted(df) and hinted(df.drop("s"))
    finally:
        shared.BROADCAST_BYTES = wide
