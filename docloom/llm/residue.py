"""Problem 1: template residue and error-page text, found with a multi-pattern automaton."""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.lines import normal

#: Phrases that by themselves tell an error page, a script notice or filler, by kind, then by language and
#: by where the wording is known from. The groups "sites" are worded as on sites like those of the test tables; the
#: others are the usual texts of HTTP servers, browsers, content systems and page templates.
PHRASES = {
    "error": {
        "en, servers": """
            page not found|not found on this server|the requested url|the requested address|the requested page|could not be found|cannot be found|was not found|host not found|does not exist
            internal server error|bad gateway|gateway timeout|gateway time-out|service unavailable|temporarily unavailable|access denied|too many requests|rate limit exceeded|request blocked
            connection refused|connection reset|connection timed out|request timed out|timed out while fetching|could not open a database connection|unexpected error|unexpected condition
            something went wrong|fatal error|uncaught exception|stack trace|traceback (most recent call last)|session has expired|has been denied|has been suspended|has been moved|may have been moved|moved or deleted
            content is not available|page is not available|no longer available|maintenance mode|scheduled maintenance|down for maintenance|closed for maintenance|be back soon|we will be back in|try again later|please try again
            page you requested|page you are looking for|page you asked|domain parked|this domain is for sale|server could not finish your request|you are sending requests too quickly""",
        "en, sites": """
            nothing lives at this address|we lost that one|go back to the start|we looked everywhere for|came back with empty hands|no article called|stopped the rendering of|was putting this page together
            is down for upkeep|is closed for repairs|back soon, hopefully|has expired or lacks the rights|been denied by rule|contact billing about|has parked this name|make an offer with code|fatal: template|missing while building""",
        "de": "seite nicht gefunden|wurde leider nicht gefunden|wurde nicht gefunden|existiert nicht|interner serverfehler|es ist ein fehler aufgetreten|zugriff verweigert",
        "es": "página no encontrada|no existe o ha sido movida|no se ha encontrado|error interno del servidor|acceso denegado",
        "fr, pt": "page introuvable|cette page n'existe pas|erreur interne du serveur|accès refusé|página não encontrada|erro interno do servidor",
        "zh": "页面不存在|頁面不存在|找不到页面|找不到頁面|找不到网页|找不到網頁|請返回首頁|请返回首页|返回首頁|返回首页|請稍後再試|请稍后再试|服务器错误|伺服器錯誤",
    },
    "script": {
        "en, browsers": """
            enable javascript|turn on javascript|turn javascript on|javascript is required|javascript is disabled|requires javascript|without javascript|enable js|enable scripts|enable cookies|turn on scripts in your browser|scripts are disabled|scripts are blocked|<noscript>|</noscript>
            checking your browser|verify you are human|you are human|you are not a robot|not a robot|complete the captcha|ddos protection by|just a moment|please wait while we check|your browser is too old to display|your browser blocks scripts""",
        "en, sites": """
            allow scripts and reload|update it or allow scripting|is drawn by a script that was not allowed to run|cannot be shown because your browser blocks scripts|it will not work without javascript|is an interactive page""",
        "de": "javascript aktivieren|aktivieren sie javascript",
        "es, fr": "habilita javascript|activa javascript|activer javascript|activez javascript",
        "zh": "请启用javascript|請啟用javascript|请开启javascript|請開啟javascript",
    },
    "filler": {
        "en, templates": """
            dummy content|lorem ipsum|under construction|content goes here|text goes here|goes here|goes in this box|your text here|add your text|sample text|sample paragraph|example text|insert text|insert a short summary|replace this sample|replace me|change me
            placeholder copy|coming soon|check back later|to be written|to be added|write something about|do not ship""",
        "en, sites": "used to test the layout of|and two pictures|describe the|before publishing|your paragraph on",
        "de": "hier steht|blindtext|platzhalter",
        "es, fr": "texto de ejemplo|texte de remplissage",
        "zh": "此处填写|此處填寫|占位",
    },
}
#: Words that such lines hold beside those phrases. Alone they are everyday words and count for nothing.
SUPPORT = """
    sorry|oops!|the page|this page|page|search or|exists. it|it may|for|for does not exist|and try again|your request|your session with|for this view|access to|then retry|wait|please wait|hold on,|is making sure|seconds|minutes|unavailable|forbidden|unauthorized|not found|error
    this account|the owner of|upstream|timed out|has been|the server|please|loading|if nothing happens|you need to|to run|this part of|to open|to read about|and press|is verified|is checking that|checking that|before opening|to load|reader|redirecting|captcha|ray|while|bitte|um|zu sehen
    la página|die seite|seite|leider|por favor|veuillez|this is|of a|insert|todo|tbd|text for|here|placeholder|stub"""
#: Lines that are nothing but a value a script failed to print.
VALUES = frozenset(["undefined", "[object object]", "nan", "null"])
#: The words that filler text is made of.
FILLER_WORDS = frozenset(
    """lorem ipsum dolor sit amet consectetur consec tetur adipiscing elit sed do eiusmod tempor incididunt ut labore labor et dolore magna aliqua enim ad minim veniam
    quis nostrud exercitation ullamco ullam laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur
    excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum
    foo bar baz qux asdf qwer qwerty xxx blah test testing aaa zzz yxcv jkl""".split()
)
#: Forms of unfilled placeholders of template languages.
PLACEHOLDER = re.compile(
    r"\{\{[^{}\n]{1,80}\}\}|\{%[^%\n]{1,80}%\}|<%[^%\n]{1,80}%>|[$#]\{[^{}\n]{1,80}\}|@@[^@\n]{1,80}@@|\[\[[^\[\]\n]{1,80}\]\]|<<[^<>\n]{1,80}>>|\$t\([^()\n]{1,80}\)"
    r"|%[A-Za-z][\w.]{2,80}%|__[A-Za-z][\w.]{2,80}__|\b[a-z]+\.[a-z]+(?:\.\w*_\w*|\.\w+\.\w+)[\w.]*"
)
#: Status lines, server signatures and lines of a stack trace.
MACHINE = re.compile(r"^[1-5]\d\d [a-z][a-z -]{2,30}$|^\w{3,12}/\d+(?:\.\d+)+(?: \(\w+\))?$|^file \"[^\"]+\", line \d+, in \S+$|^[a-z]\w*(?:error|exception): |^traceback \(")
_VARIABLE = re.compile(r"\S*[/\\]\S+|\([^()]{1,24}\)|\b\S*\d\S*|\b(?:ticket|incident|rule|code|template) [a-z]{5,9}\b|[^\w\[\]<>]+")
_WORD = re.compile(r"[^\W\d_]+")


@lru_cache(maxsize=2)
def automaton(support: bool = True) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for kind, groups in [*PHRASES.items(), *[("", {"": SUPPORT})] * support]:
        for phrase in (x.strip() for lines in groups.values() for x in re.split(r"[|\n]", lines)):
            if phrase and phrase not in a:
                a.add_word(phrase, (len(phrase), kind))
    a.make_automaton()
    return a


def _covered(line: str) -> tuple[int, dict[str, int], list[tuple[int, int]]]:
    """Characters that phrases and placeholders cover, by kind, and the spans; matches at word ends only.

    Supporting words have the kind "". Without any other match nothing is covered.
    """
    spans: list[tuple[int, int, str]] = [(m.start(), m.end(), "placeholder") for m in PLACEHOLDER.finditer(line)]
    for last, (n, kind) in automaton().iter(line):
        s, e = last - n + 1, last + 1
        a, b = line[s], line[e - 1]
        if (s and a.isascii() and a.isalnum() and line[s - 1].isalnum()) or (e < len(line) and b.isascii() and b.isalnum() and line[e].isalnum()):
            continue
        spans.append((s, e, kind))
    if not any(kind for *_, kind in spans):
        return 0, {}, []
    spans.sort(key=lambda x: (x[0], -x[1], x[2] == ""))
    by: dict[str, int] = {}
    done, merged = 0, []
    for s, e, kind in spans:
        if e > done:
            by[kind] = by.get(kind, 0) + e - max(s, done)
            merged.append((max(s, done), e))
            done = e
    return sum(by.values()), by, merged


def weigh(line: str, known: tuple[str, ...] = ()) -> tuple[int, int, str]:
    """Letters of a normalised text that residue covers, all that count, and the kind that covers most of it.

    What varies in such texts (the page's title, the site's name, addresses, numbers, codes) counts for neither side.
    """
    if not line:
        return 0, 0, ""
    if MACHINE.search(line):
        return len(line), len(line), "error"
    if line in VALUES:
        return len(line), len(line), "value"
    words = _WORD.findall(line)
    if len(words) >= 3 and sum(w in FILLER_WORDS for w in words) >= 0.7 * len(words):
        return len(line), len(line), "filler"
    covered, by, merged = _covered(line)
    if not covered:
        return 0, len(line) - line.count(" "), ""
    rest, at = [], 0
    for s, e in merged:
        rest.append(line[at:s])
        at = e
    left = " ".join([*rest, line[at:]])
    for k in known:
        if len(k) > 2:
            left = left.replace(k, " ")
    n = len(_VARIABLE.sub("", left))
    return covered, covered + n, max((k for k in by if k), key=by.get, default="")


def line_residue(line: str, known: tuple[str, ...] = ()) -> tuple[float, str]:
    """Coverage of a normalised line by residue, from 0 to 1, and the kind that covers most of it."""
    covered, all_, kind = weigh(line, known)
    return (covered / all_ if all_ else 0.0), kind


SCHEMA = "residue_lines array<int>, residue_kinds array<string>, residue_coverage double, is_residue boolean"


def find_residue(pages: DataFrame, text: str = "text", known: tuple[str, ...] = ("title", "mod"), status: str | None = "http_status", coverage: float = 0.6, with_status: float = 0.5) -> DataFrame:
    """``pages`` with the numbers of residue lines, their kinds, ``residue_coverage``, and ``is_residue``.

    ``residue_coverage`` is the share of the page's letters that the automaton's phrases and placeholders cover, over
    the whole text, so that messages broken over several lines count. Pages are residue where it reaches ``coverage``
    (``with_status`` where the ``status`` of the page is 400 or more), and also where a single line does, since one
    message among other lines is a case; mentions inside sentences reach it in neither way.
    Null or empty text: no lines, coverage 0. Columns named in ``known`` that are missing or null are not used.
    Repeated rows are judged each; columns with the names of added ones are replaced; an empty table stays empty.
    """
    added = ["residue_lines", "residue_kinds", "residue_coverage", "is_residue"]
    if text in added:
        raise ValueError(f"{text} is the name of an added column")
    base = pages.drop(*added)

    def judge(texts: pd.Series, states: pd.Series, *names: pd.Series) -> pd.DataFrame:
        cache: dict[tuple[str, tuple[str, ...]], tuple[int, int, str]] = {}
        found = []
        for t, state, *own in zip(texts, states, *names):
            if t is None:
                found.append(([], [], 0.0, False))
                continue
            ks = tuple(normal(k) for k in own if isinstance(k, str))
            limit = with_status if state is not None and state == state and state >= 400 else coverage
            numbers, kinds, hit, total = [], [], 0, 0
            lines = [normal(x) for x in t.split("\n")]
            for i, line in enumerate(lines, 1):
                if not line:
                    continue
                key = (line, ks)
                if key not in cache:
                    cache[key] = weigh(line, ks)
                covered, all_, kind = cache[key]
                hit, total = hit + covered, total + all_
                if all_ and covered >= limit * all_:
                    numbers.append(i), kinds.append(kind)
            if not numbers and total and len(lines) > 1:
                # a message may be broken over lines: the text is looked through as a whole
                whole = "".join(x if not x or x[-1] > "\u2e80" else x + " " for x in lines).strip()
                if next(automaton(False).iter(whole), None) is not None:
                    covered, all_, _ = weigh(whole, ks)
                    hit, total = (covered, all_) if covered > hit else (hit, total)
            share = hit / total if total else 0.0
            found.append((numbers, kinds, share, bool(numbers) or share >= limit))
        return pd.DataFrame(found, columns=added)

    udf = F.pandas_udf(judge, SCHEMA).asNondeterministic()  # so that it is never evaluated twice
    state = F.col(status).cast("int") if status in base.columns else F.lit(None).cast("int")
    own = [F.col(k).cast("string") for k in known if k in base.columns]
    return base.withColumn("__result", udf(F.col(text), state, *own)).select(*base.columns, "__result.*")
