"""Residue, repeated lines, main body, quality, splitting: small cases and whole-table comparisons."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docloom.llm import queries as q
from docloom.llm.lines import normal
from docloom.llm.mainbody import body_lines, evidence, main_body
from docloom.llm.quality import FUNCTION_WORDS, measure, text_quality
from docloom.llm.repeated import mine, without_repeated
from docloom.llm.residue import find_residue, line_residue
from docloom.llm.splitting import boundaries, pieces, split_oversized

PAGE = "page_id long, text string, markdown string, title string, mod string, http_status int, hostname string, body string, residue_lines string"


def pages(spark, *texts, **more):
    rows = [{"page_id": i, "text": t, "markdown": more.get("markdown"), "title": more.get("title"), "mod": "Mod", "http_status": more.get("status"), "hostname": more.get("host", "h"), "body": "clash", "residue_lines": "clash"} for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, PAGE)


# residue


@pytest.mark.parametrize(
    "line",
    ["sorry, the page you asked mod for does not exist.", "404 not found", "{{ guide.rod.title }}", "lorem ipsum dolor sit amet", "undefined", "bitte javascript aktivieren, um rod zu sehen.", "找不到頁面 1/a 請返回首頁", "<%= a.b %> costs ${c.d} to run, see %e_f%", "todo write something about rod", "foo bar asdf test"],
)
def test_residue_lines(line):
    assert line_residue(line, ("rod", "mod"))[0] >= 0.6


@pytest.mark.parametrize(
    "line", ["a red 404 lamp on the filter means that the pattern for rods was not found in the frame next to it.", "type {{amount}} into the label of an empty rack and the whole line will wait for so many stacks.", "dark mode on mod works best with scripts allowed", "error handling in the rail network needs two switches", ""]
)
def test_mentions_are_no_residue(line):
    assert line_residue(line, ("rod", "mod"))[0] < 0.5


@pytest.mark.parametrize("line", ["wait 30 minutes", "access to the reader", "the owner of the reader", "seite 3", "seconds", "none", "upstream", "text for the reader", "error", "forbidden", "loading", "a todo list", "nan bread", "search or sort", "unavailable"])
def test_everyday_words_are_no_residue(line):
    assert line_residue(line, ("mod",))[0] == 0


def test_messages_broken_over_lines(spark):
    message = "Rod not\nfound on\nthis server"
    rows = find_residue(pages(spark, message, f"{message}\nA pump moves water, steam, and oil from one tank to the next, as long as it has power, and it stops when it has none.")).orderBy("page_id").collect()
    assert rows[0].is_residue and rows[0].residue_lines == [] and rows[0].residue_coverage > 0.8
    assert not rows[1].is_residue and 0.05 < rows[1].residue_coverage < 0.5


def test_find_residue(spark):
    df = pages(spark, "Title\r\nUNDEFINED\r\n[object Object]", None, "", "A long honest sentence about pumps and their pipes.", "x" * 300_000, "Title\r\nUNDEFINED\r\n[object Object]", status=200)
    rows = find_residue(df).orderBy("page_id").collect()
    assert [r.is_residue for r in rows] == [True, False, False, False, False, True]
    assert rows[0].residue_lines == [2, 3] and rows[0].residue_kinds == ["value", "value"] and 0 < rows[0].residue_coverage < 1 and rows[1].residue_coverage == 0
    assert find_residue(df.limit(0)).count() == 0
    assert find_residue(df.select("text")).where("is_residue").count() == 2
    with pytest.raises(ValueError):
        find_residue(df, text="residue_lines")


# repeated lines


def brute_force(rows, least=10, words=3):
    seen, out = {}, []
    for page, host, text in rows:
        for n, line in enumerate((text or "").split("\n"), 1):
            if host and len(re.findall(r"[^\W\d_]+", line)) >= words:
                key = (re.sub(r"^www\.", "", host.strip().lower()), re.sub(r"[\W\d_]+", "", line.lower()))
                seen.setdefault(key, set()).add(page)
                out.append((key, page, n))
    return {(p, n) for k, p, n in out if len(seen[k]) >= least}


def test_repeated_lines_against_brute_force(spark):
    rng = random.Random(5)
    stock = ["Share this page now", "SHARE this, page: now!", "Home", "All rights are reserved", "two words", "A B C", "", "Home"]
    rows = [(i % 50, rng.choice(["H.test", "www.h.test", "other", None, "h.test"]), "\n".join(rng.choice(stock) if rng.random() < 0.7 else f"own line {rng.random()} here" for _ in range(8))) for i in range(60)]
    rows += [(99, "h.test", None), (100, "h.test", ""), (None, "h.test", "Share this page now")]
    df = spark.createDataFrame(rows, "page_id long, hostname string, text string")
    lines = mine(df, "page_id", "hostname", "text").lines.where("words >= 3").select("page", "n")
    assert {(r.page, r.n) for r in lines.collect()} == brute_force([r for r in rows if r[0] is not None])


def test_sequences_of_short_lines(spark):
    menu = "Home\nAbout us\nHelp"
    rows = [(i, "h", f"{menu}\nText {'abcdefghijkl'[i]} of its own") for i in range(12)] + [(20 + i, "g", f"Home\nx{'abcdefghijkl'[i]}\nHelp") for i in range(12)]
    df = spark.createDataFrame(rows, "page_id long, hostname string, text string").withColumn("clean_text", F.lit("clash"))
    df = df.withColumn("_page", F.lit("kept")).withColumn("_gone", F.lit("kept")).withColumn("k", F.lit("kept"))
    out = {r.page_id: r for r in without_repeated(df, "page_id", "hostname", "text").collect()}
    assert out[0]["_page"] == out[0]["_gone"] == out[0].k == "kept"
    assert out[0].clean_text == "Text a of its own" and out[0].n_removed == 3
    assert out[20].clean_text == "Home\nxa\nHelp" and out[20].n_removed == 0
    found = mine(df, "page_id", "hostname", "text").sequences.collect()
    assert {(r.source, r.k, r.support) for r in found} == {("h", 3, 12)}


def sequences_by_brute_force(rows, least, words, gap):
    """Maximal frequent sequences: (host, lines) to their pages."""
    lines = {p: [(i, re.sub(r"[\W\d_]+", "", x.lower()), len(re.findall(r"[^\W\d_]+", x))) for i, x in enumerate(t.split("\n")) if re.search(r"[^\W\d_]", x)] for p, h, t in rows}
    host = {p: h for p, h, _ in rows}
    alone = {}
    for p, ls in lines.items():
        for pos, (_, x, w) in enumerate(ls):
            alone.setdefault((host[p], x, w >= words), set()).add(p)
    seen = {}
    for p, ls in lines.items():
        kept = [(pos, x, w) for pos, (_, x, w) in enumerate(ls) if len(alone[host[p], x, w >= words]) >= least]
        for i in range(len(kept)):
            for j in range(i + 1, len(kept) + 1):
                if j > i + 1 and kept[j - 1][0] - kept[j - 2][0] > gap + 1:
                    break
                seen.setdefault((host[p], tuple((x, w >= words) for _, x, w in kept[i:j])), [set(), sum(w for _, _, w in kept[i:j])])[0].add(p)
    good = {k: v[0] for k, v in seen.items() if len(v[0]) >= least and v[1] >= words}
    inner = {(h, part) for (h, s), pages in good.items() for part in (s[1:], s[:-1]) if part and len(good.get((h, part), ())) == len(pages)}
    return {(h, len(s), len(p)) for (h, s), p in good.items() if (h, s) not in inner}


@pytest.mark.parametrize("gap", [0, 1])
def test_sequences_of_any_length(spark, gap):
    rng = random.Random(3)
    legal = [f"Legal line {x} of the house" for x in "abcdefghijklmnopq"]
    rows = []
    for i in range(40):
        block = legal[: rng.choice([17, 9, 4])]
        if i % 3 == 0:
            block = block[:2] + [f"title {''.join(rng.choices('xyz', k=9))}"] + block[2:]
        rows.append((i, rng.choice("hg"), "\n".join([f"own {''.join(rng.choices('rstu', k=9))} here", *block, "Share", "", "1 2", "Print", f"end {''.join(rng.choices('rstu', k=9))}"])))
    df = spark.createDataFrame(rows, "page_id long, hostname string, text string")
    mined = mine(df, "page_id", "hostname", "text", min_pages=5, gap=gap)
    got = [(r.source, r.k, r.support) for r in mined.sequences.collect()]
    assert max(k for _, k, _ in got) >= 17 and set(got) == sequences_by_brute_force(rows, 5, 3, gap)
    lines = mined.lines.collect()
    assert len(lines) == len({(r.page, r.n) for r in lines}) and {(r.page, r.n) for r in lines} >= brute_force(rows, 5)


def test_repeated_lines_of_nothing(spark):
    df = spark.createDataFrame([], "page_id long, hostname string, text string")
    assert mine(df, "page_id", "hostname", "text").lines.count() == 0
    assert without_repeated(df, "page_id", "hostname", "text").count() == 0


# main body

ARTICLE = """Home / Forum / Help
You are here: Guides / Pump
On this page
Usage
Pump
A pump moves water, steam, and oil from one tank to the next, as long as it has power, and it stops when it has none.
Usage
Place it on a pipe, connect a lever, and wait until the first bucket is full, which takes a while at low speed.
Related pages
Big Tank
Small Valve
Recipe
© 2020 Mod contributors. All trademarks belong to their owners.
Spread the word about Mod"""
MARKED = ARTICLE.replace("\nPump\n", "\n# Pump\n").replace("\nUsage\nPlace", "\n## Usage\nPlace").replace("\nRecipe\n", "\n## Recipe\n")


def test_main_body():
    body, other = body_lines(ARTICLE, MARKED, "Pump")
    assert body == [5, 6, 7, 8, 12] and other == [1, 2, 3, 4, 9, 10, 11, 13, 14]


def test_main_body_without_marks_or_title():
    body, _ = body_lines(ARTICLE, None, None)
    assert {5, 6, 7, 8, 12} <= {*body} and not {1, 2, 9, 10, 11, 13, 14} & {*body}


#: Pages in words of their own, as sites of other kinds have them: "-" lines are no body, "#" lines are headings.
OTHER_PAGES = [
    """- Home
- Products | Pricing | Docs | Blog
- You are here: Docs > Storage > Compaction
# Compaction
+ Compaction merges small files into larger ones, which makes scans faster, and drops rows that were deleted earlier.
+ It runs in the background, once an hour by default, and can be paused while a backup is taken.
## Cookies
+ The console keeps a session cookie, a theme cookie, and a consent cookie, each for a year, and they hold no personal data.
+ Delete them in the browser, reload, and log in again, if the console shows an old account after an upgrade.
## Limits
+ Files per merge: 64
+ Threads: 4
- Was this page helpful? Yes No
- Last updated on 2023-04-11 by the docs team
- Read next
- Merge Policies
- Table Layouts
- © 2023 Kiln Systems, Inc. All rights reserved.
- Privacy Policy
- Terms of Use""",
    """- Skip to content
- Sign in
- Register
# Best sourdough for beginners
- By Anna Holt · 7 min read · 2314 views
+ Mix flour, water, and salt, then let the dough rest for an hour, covered with a towel, in a warm place.
+ Fold it four times, wait until it has doubled, and bake it in a hot pot, lid on, for half an hour.
+ 500 g flour
+ 350 g water
+ 10 g salt
- Share this recipe with a friend
- Sign up for our newsletter and never miss a bake
- 12 comments
- Advertisement
- We and our partners use cookies to improve this site. Manage your consent.
- Reproduced with permission, no guarantee of results""",
    """- Startseite
- Suche
# Pumpen warten
+ Vor der Wartung wird die Pumpe vom Netz getrennt, entleert und mindestens zehn Minuten lang abgekühlt.
+ Danach prüft man die Dichtung, tauscht das Öl und schreibt die Stunden in das Heft.
- Diese Seite verwendet Cookies, Einstellungen
- Zuletzt bearbeitet 2022-01-03
- Datenschutz, Impressum
- Alle Rechte vorbehalten""",
]


def as_page(listing):
    rows = [x.split(" ", 1) for x in listing.split("\n")]
    return "\n".join(x for _, x in rows), "\n".join(f"{k} {x}" if k[0] == "#" else x for k, x in rows), {i for i, (k, _) in enumerate(rows, 1) if k == "-"}


def test_pages_of_other_sites():
    hit = found = true = 0
    for listing in OTHER_PAGES:
        text, marked, want = as_page(listing)
        got = {*body_lines(text, marked, None)[1]}
        hit, found, true = hit + len(got & want), found + len(got), true + len(want)
    assert hit >= 0.9 * true and hit >= 0.95 * found


def test_the_tree_decides_where_evidence_is_open():
    """An article on cookies keeps its sentences; the same evidence among furniture goes with it."""
    text, marked, _ = as_page(OTHER_PAGES[0])
    lines = [normal(x) for x in text.split("\n")]
    console = next(i for i, x in enumerate(lines, 1) if x.startswith("the console keeps"))
    body, _ = body_lines(text, marked, None)
    alone, _ = body_lines("\n".join(["Home", "Log in", lines[console - 1], "Privacy Policy", "All rights reserved"] + ["Sign in to reply"] * 6 + ["word, " * 200]), None, None)
    assert evidence(lines[console - 1]) > 0.3 and console in body and 12 in alone
    off, _ = body_lines(text, marked, None, share=0.0, max_density=0.0)
    assert off != body


def test_main_body_edge_cases(spark):
    df = pages(spark, ARTICLE, None, "", "Home\nHelp\nForum", "word, " * 50_000, ARTICLE)
    rows = main_body(df.drop("body")).orderBy("page_id").collect()
    assert rows[0].body_lines == rows[5].body_lines and rows[1].body is None and rows[1].body_lines == []
    assert rows[2].body == "" and rows[3].body_lines == [] and rows[4].body_lines == [1]
    assert main_body(df.drop("body").limit(0)).count() == 0
    assert main_body(df).first().body != "clash"
    assert main_body(df.drop("body").withColumn("_r", F.lit("kept"))).first()["_r"] == "kept"


# quality

PROSE = "When the power runs out, the pump stops and waits for the next bucket of water. It was added so that a small tank could feed the main line."


@pytest.mark.parametrize(
    "text",
    [PROSE, PROSE.upper(), re.sub("[.,]", "", PROSE.lower()), "- When the power runs out, the pump stops and waits.\n- It was added so that a tank could feed it.", "anna: When the power runs out, it stops.\nben: Then you have to wait for it.", PROSE.replace(" the ", "\nthe "), "如果控制器沒有閘門，整個模組就會停止吸收。把終端放在旁邊，它會自動過濾。", "每個匯流排都需要先冷卻粉塵，然後才能充能495個接口。自從第129版以後，控制器不再移動齒輪，而是分配晶體與晶體。如果粉塵沒有接口，整個頻道就會停止儲存。\n每個終端都需要先替換配方。", "Wenn der Tank leer ist, übernimmt ein Speicher die Last von den Geräten."],
)
def test_prose(text):
    assert measure(text, FUNCTION_WORDS)[10] > 0.5


@pytest.mark.parametrize(
    "text",
    [
        "| a | 1 | x |\n|---|---|---|\n| b | 2 | y |", "Pump,12,iron,3.5,yes\nTank,13,tin,4.5,no", "Pump      12   iron\nTank      13   tin", "1. Big Pump\n2. Small Tank\n3. Old Valve", "[12:00:01] [Net/WARN]: a.b@1f\n[12:00:02] [Net/WARN]: c.d@2e",
        "\n".join(f"Name of the {a}\n  made by {b}\n  weight is {i}\n" for i, (a, b) in enumerate([("pump", "Ann"), ("tank", "Bob"), ("rod", "Cid"), ("lamp", "Dan")])),
        "00000000  20 41 0a cd 01\n00000010  d0 0f 3f f1 cb", '{"a":{"id":1,"v":[1,2]}}', "Zul vel kre kroas zal gar fil noa. Huz flu gre dre cro bra.", "$+~~$1]<<=^<#bb[#1{^[#1$@", "- Craft [Table]: 5 × Crate, 1 × Rod → Antenna", "",
    ],
)
def test_no_prose(text):
    assert measure(text, FUNCTION_WORDS)[10] <= 0.5


def test_text_quality(spark):
    docs = spark.createDataFrame([(1, PROSE, 0.5), (2, None, 0.5), (3, "", 0.5), (4, "1 2 3", 0.5), (5, PROSE * 2000, 0.5), (1, PROSE, 0.5)], "doc_id long, text string, prose_share double")
    words = spark.createDataFrame([("en", "Pump"), (None, None), ("en", "pump")], "lang string, word string")
    rows = text_quality(docs, words).orderBy("doc_id").collect()
    assert [r.is_prose for r in rows] == [True, True, None, False, False, True]
    assert rows[0] == rows[1] and rows[0].n_words == 29 and abs(rows[0].mean_word_length - sum(map(len, re.findall("[a-z]+", PROSE.lower()))) / 29) < 1e-9
    assert rows[2].n_words is None and rows[3].n_words == 0 and rows[0].common_words > 0.5 and rows[0].punctuated_lines == 1
    assert text_quality(docs.limit(0), words).count() == 0 and text_quality(docs, words.limit(0)).count() == 6
    with pytest.raises(ValueError):
        from docloom.llm.quality import word_set

        word_set(words, bound=0)


# splitting


@given(st.text(alphabet="ab .,\n字!\t", max_size=400), st.integers(4, 40), st.integers(0, 3))
@settings(max_examples=150, deadline=None)
def test_pieces_make_up_the_text(text, limit, overlap):
    ps = pieces(text, limit, overlap)
    n = len(boundaries(text)[0])
    assert "".join(text[own:end] for _, own, end, _ in ps) == text
    assert all(len(boundaries(text[s:e])[0]) == k <= limit for s, _, e, k in ps)
    assert (len(ps) == 1) == (n <= limit)
    assert all(len(boundaries(text[s:own])[0]) <= overlap for s, own, _, _ in ps)


def test_cuts_at_the_strongest_boundary():
    text = "a b c. d e f\n\ng h, i j. k l"
    (_, _, first, _), (_, second, _, _) = pieces(text, 12, 0)[:2]
    assert text[:first] == "a b c. d e f\n\n" and second == first


def test_split_oversized(spark):
    df = spark.createDataFrame([("a", "one two. three four", 7), ("a", "one two. three four", 7), ("b", None, 7), ("c", "", 7), ("d", "w " * 30_000, 7)], "id string, text string, piece_no int")
    rows = split_oversized(df, "text", 4, 1).collect()
    by = {k: sorted([(r.piece_no, r.n_pieces, r.piece) for r in rows if r.id == k], key=lambda x: x[0]) for k in "abcd"}
    assert by["b"] == [(1, 1, None)] and by["c"] == [(1, 1, "")] and len(by["a"]) == 4
    assert all(r.piece_tokens <= 4 for r in rows) and len(by["d"]) == by["d"][0][1]
    assert split_oversized(df.limit(0), "text", 4, 1).count() == 0
    for bad in ((4, 4), (4, -1)):
        with pytest.raises(ValueError):
            split_oversized(df, "text", *bad)


# whole tables


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_against_sql(spark, data, name):
    from oracle import connect, rows_of, sql_rows

    assert rows_of(q.queries()[name](spark, data)) == sql_rows(connect(data), q.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(q.queries()) - set(q.oracle_sql())))
def test_runs(spark, data, name):
    df = q.queries()[name](spark, data)
    assert df.count() > 0 and len(df.columns) == len(set(df.columns))
