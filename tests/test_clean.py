import pytest

from docloom.config import Config
from docloom.operators import clean

SCHEMA = "page_id long, title string, source string, markdown string, recipes array<struct<label: string, station: string, shapeless: boolean, ingredients: array<struct<name: string, count: int>>, slots: array<struct<slot: string, name: string>>, result: string>>"
CONFIG = Config(site_name="Version x")


def recipe(result, items=None, slots=None, label="Crafting", station="Table"):
    return {"label": label, "station": station, "shapeless": False, "ingredients": [{"name": n, "count": k} for n, k in items] if items is not None else None, "slots": [{"slot": s, "name": n} for s, n in slots] if slots is not None else None, "result": result}


def pages(spark, *rows):
    return spark.createDataFrame([{"page_id": i, "title": t, "source": "u", "markdown": m, "recipes": r} for i, (t, m, r) in enumerate(rows)], SCHEMA)


def lines(spark, title, text, recipes=None, config=CONFIG):
    out = clean.ruled_lines(pages(spark, (title, text, recipes)), config).orderBy("line_no").collect()
    return [r.out_line for r in out if r.rule is None], {r.out_line: r.rule for r in out if r.rule}


@pytest.mark.parametrize(
    ("title", "text", "kind", "left"),
    [
        ("Energy", "# Energy\nBody", "A", ["Body"]),
        ("Energy", "EnergyThe net", "B", ["The net"]),
        ("Energy", "Energy accepting", None, ["Energy accepting"]),
        ("Energy", "Intro\n# Energy\ny", "C", ["Intro", "y"]),
        ("Energy", "Version x\n# Energy\ny", None, ["Version x", "# Energy", "y"]),
        ("Energy", "Energy", "A", []),
        (None, "a\nb", None, ["a", "b"]),
        ("", "", None, [""]),
        ("Energy", None, None, [""]),
    ],
)
def test_title_rule(spark, title, text, kind, left):
    row = clean.first_lines(pages(spark, (title, text, None)), CONFIG).first()
    assert (row.r1_type, row.lines) == (kind, left)


def test_labels_go_with_their_marks(spark):
    assert lines(spark, "T", "## Recipe\n Charger\nRecursive Recipes")[0] == ["Recursive Recipes"]


@pytest.mark.parametrize(
    ("text", "left"),
    [("A crystal.RecipeCrafting Charger", "A crystal."), ("See Recipe", "See Recipe"), ("RecipeCrafting", "RecipeCrafting"), ("A.Recipes  Crafting", "A.Recipes  Crafting"), ("Settings/Recipes", "Settings/")],
)
def test_glued_labels_of_one_line_pages(spark, text, left):
    assert lines(spark, "T", text)[0] == [left]


def test_glued_labels_stay_on_longer_pages(spark):
    assert lines(spark, "T", "x\nSettings/Recipes")[0] == ["x", "Settings/Recipes"]


def test_lines_of_recipe_names(spark):
    r = [recipe("Iron Ingot", [("Gold", 1)])]
    left, gone = lines(spark, "T", "a\nIron IngotGold\nIron Ingot, Gold\nGold", r)
    assert left == ["a", "Iron Ingot, Gold", "Gold"] and gone == {"Iron IngotGold": "R5"}


def test_names_that_are_made_of_each_other():
    assert clean.made_of("aaab" * 200, ["a", "aa", "aaa", "b"]) and not clean.made_of("a" * 2000 + "c", ["a", "aa", "aaa"])
    assert clean.made_of("x\\Ey", ["x\\E", "y"]) and not clean.made_of("ab", ["ab"]) and not clean.made_of("", ["a"])


def test_cleaning_and_chunking_shuffle_nothing(spark, data):
    from docloom.operators import chunk
    from docloom.shared import table

    cleaned = clean.clean_pages(table(spark, data, "extracted"), CONFIG)
    for df in (cleaned, chunk.children(chunk.parent_sections(cleaned))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort" not in plan


def test_heading_levels(spark):
    text = "x\n## A\na\n# B\nb\n## C\nc\n### D\nd"
    assert [x for x in lines(spark, "T", text)[0] if x[0] == "#"] == ["## A", "## B", "### C", "#### D"]


def test_empty_sections(spark):
    left, gone = lines(spark, "T", "t\n## A\n### B\n## C\nx")
    assert left == ["t", "## C", "x"] and gone == {"## A": "R7", "### B": "R7"}


def test_suspects(spark):
    rows = clean.page_lines(pages(spark, ("T", "x\nRecipe\nPressing\n- item\nz", None)), CONFIG).collect()
    assert {r.word for r in rows if r.is_suspect} == {"x", "Pressing"}


def test_recipes_follow_and_blank_pages_are_skipped(spark):
    r = [recipe("Rod", [("Bar", 2), ("Cap", 1)], label="Crafting", station="Table"), recipe("Die", slots=[("top", "Plate")], label="Press", station="Inscriber")]
    out = clean.clean_pages(pages(spark, ("T", "# T\nbody", r), ("T", "# T\n  ", None), (None, "x", None)), CONFIG).orderBy("page_id").collect()
    assert out[0].body == "body\n## Recipes\n- Crafting [Table]: 2 × Bar, 1 × Cap → Rod\n- Press [Inscriber]: top Plate → Die"
    assert [o.skip_reason for o in out] == [None, "empty_body", "missing_title_or_source"] and out[1].body is None and out[0].short_body


def test_no_pages(spark):
    assert clean.clean_pages(pages(spark), CONFIG).count() == 0


def test_cleaning_twice_changes_nothing(spark, data):
    from docloom.shared import table

    raw = table(spark, data, "extracted").select("page_id", "title", "source", "markdown", "recipes")
    once = clean.clean_pages(raw, CONFIG).where("body IS NOT NULL").selectExpr("page_id", "title", "source", "body AS markdown", "CAST(NULL AS array<struct<label: string, station: string, shapeless: boolean, ingredients: array<struct<name: string, count: int>>, slots: array<struct<slot: string, name: string>>, result: string>>) AS recipes")
    config = Config(labels=("No such label",))
    twice = clean.clean_pages(once, config)
    moved = once.join(twice, "page_id").where("markdown <> body").count()
    again = clean.clean_pages(twice.withColumnRenamed("body", "markdown").join(once.select("page_id", "recipes"), "page_id"), config)
    assert twice.join(again.select("page_id", again.body.alias("b2")), "page_id").where("body <> b2").count() == 0 and moved <= once.count()


def test_cleaning_figures(spark):
    some = pages(spark, ("T", "# T\nbody\nRecipe\nodd", None), ("T", "Site\nT\nbody", None), (None, None, None))
    got = {(r.section, r.item): r.n for r in clean.cleaning_figures(some, Config(site_name="Site")).collect()}
    assert got == {("pages", "output"): 2, ("pages", "missing_title_or_source"): 1, ("title", "A"): 1, ("title", "none"): 2, ("lines", "R4a"): 1, ("lines", "suspect"): 2, ("pages with", "short body"): 2, ("pages with", "site name first"): 1}
    assert clean.cleaning_figures(some.limit(0), Config()).count() == 0
