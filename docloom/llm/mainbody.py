"""Problem 6: the main body of a page, by tree scoring."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.lines import heading_marks, normal

#: Entries of site menus, in lower case.
MENU = """about|archive|blocks|blog|community|contact|contact us|cookies|copy link|discord|donate|downloads|edit|faq|feed|forum|forums|gallery|guide|guides|help|history of changes|home|imprint|impressum|index|items|jump to content|jump to navigation
log in|log out|login|machines|main page|menu|mod list|my account|navigation|news|next|page tools|previous|privacy|privacy policy|profile|random page|recent changes|register|release notes|rss|search|servers|settings page|share|shop|sign in|sign up|site map|sitemap
skip to content|skip to main content|start|subscribe|support|tags|terms|terms of use|toggle menu|toggle navigation|toggle sidebar|to top|back to top|tools|top|translations|view history|watch|what links here|wiki home|startseite|suche|anmelden|inicio|buscar|首页|首頁|登录|登入|搜索|搜尋"""
#: Words of site furniture (accounts, rights, consent, sharing, adverts, authorship, counters), in English,
#: German, Spanish, French and Chinese. How many of a line's words they are is evidence, not proof.
FURNITURE = """
©|copyright|copyrighted|trademark|trademarks|licence|license|licensed|cc-by|warranty|rights reserved|all rights|disclaimer|affiliated|unaffiliated|endorsed|guarantee|own risk|attribution|share alike|reuse|reused|reproduced|written consent|permission|fan-made|unofficial|shared under|open licence|open license|unless a page|states otherwise|says otherwise|their owners|its authors|identification only|fair copying
cookie|cookies|consent|opt out|tracking|privacy|gdpr|your device|session data|accept all|reject all|essential only|your choice|preferences|statistics|partners|store small files|stores small files|terms|terms of use|house rules|you accept|you agree
log in|login|logged in|log out|sign in|sign up|signed in|register|registered|password|account|guest|welcome|member|members|already have|new here|queued|membership
subscribe|subscriber|newsletter|digest|no spam|spam|inbox|never miss|put your address|your email|once a week|one mail|weekly|mailing list|follow us|readers|sign me
share|shares|share this|spread the word|tell others|tell a friend|send to a friend|on to a friend|bookmark|embed|print|print it|tweet|retweet|pin it|repost|copy link|liked it|found this|channel|post to
comment|comments|reply|replies|view|views|likes|watchers|min read|minute read|minutes read|rate|watch
sponsored|advertisement|advert|ads|ad filter|ad blocker|promoted|donate|chip in|patreon|supporters|run by volunteers|rent a|rent an|hosted by|server hosting
written by|edited by|posted by|authored by|published by|reviewed by|reviewed for|translated by|maintained by|compiled from|last edited|last updated|last modified|last changed|updated on|page keeper|on duty|wardens|contributors|contributor|volunteers|editors|council|author|authors|guide team
need help|help room|was this|helpful|spotted a mistake|report it|report this|have a question|feedback|ask in|ask a question|useful|improve this page
works best with|got it|this banner|dark mode|comment box|comment section|theme and language
next page|previous page|back to|you are here|previous|next|read more|see these next|related|tags|categories|filed under|hide this|expand|collapse
diese seite|verwendet|anmeldung|anmelden|teilen|datenschutz|impressum|alle rechte vorbehalten|zuletzt bearbeitet|kommentare|werbung|abonnieren|einverstanden|zustimmen|einstellungen
derechos reservados|compartir|iniciar sesión|suscríbete|comentarios|política de privacidad|publicidad|aceptar|galletas|tous droits réservés|partager|se connecter|s'abonner|commentaires|mentions légales|confidentialité
版权所有|版權所有|保留所有权利|保留所有權利|隐私|隱私|登录|登入|注册|註冊|分享|评论|評論|订阅|訂閱|广告|廣告|上一页|上一頁|下一页|下一頁|相关文章|相關文章|免责声明|免責聲明
"""
#: Words that furniture is as likely to hold as what stands in an article's place.
WEAK = frozenset("page pages site website wiki desk board crew box javascript scripts browser banner".split())
#: Captions of link lists that repeat the page's own headings, and of those that name other pages.
TOC_CAPTIONS = frozenset(["on this page", "contents", "table of contents", "jump to", "in this article", "inhalt", "auf dieser seite", "contenido", "目录", "目錄"])
LINK_CAPTIONS = frozenset(["related pages", "readers also opened", "more like this", "popular now", "related articles", "related links", "recommended", "trending", "most read", "latest pages", "external links", "see these next", "you may also like", "you might also like", "read next", "ähnliche artikel", "artículos relacionados", "相关文章", "相關文章"])
AD_CAPTIONS = frozenset(["sponsored", "advertisement", "promoted", "anzeige", "partner content"])
CAPTIONS = TOC_CAPTIONS | LINK_CAPTIONS | AD_CAPTIONS
#: Labels of recipe blocks, which belong to the body wherever they stand.
LABELS = frozenset(["recipe", "recipes", "crafting", "crafting (shapeless)", "smelting", "pressing", "charging", "smithing", "throw in water"])
_LETTERS = re.compile(r"[^a-z一-鿿]+")
_MENU = {_LETTERS.sub("", x) for x in re.split(r"[|\n]", MENU)}
_MENU_RUN = re.compile(f"(?:{'|'.join(sorted(_MENU, key=len, reverse=True))})+")
_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*|©")
_CJK = re.compile(r"[㐀-鿿]")
_TERMS = {x for x in re.split(r"[|\n]", FURNITURE) if x}
_ONE, _MORE, _CHINESE = {x for x in _TERMS if " " not in x}, {x for x in _TERMS if " " in x}, [x for x in _TERMS if _CJK.search(x)]
_ENDS = (".", "!", "?", "。", "！", "？", ":", ";", "”", '"')
_NAME = re.compile(r"^[A-Z][\w'’-]*( (of|the|and|in|de|[A-Z][\w'’-]*)){0,5}$")
_STEP = re.compile(r"\s[|/·›»•>«‹]\s|[←→]|\s»|«\s")
_COUNT = re.compile(r"^(?:\W*\d+ (?:min(?:ute)?s? read|views?|replies|reply|comments?|likes|shares|watchers|members online)\W*)+$|^\w+ \(\d+\)$")
_YEAR = re.compile(r"(?:©|\(c\)|copyright|^)\W*(?:19|20)\d\d(?:\s?[-–]\s?(?:19|20)?\d\d)?\b|\b(?:19|20)\d\d-\d\d-\d\d\b|\((?:19|20)\d\d\)$|\bsince (?:19|20)\d\d$")


def evidence(line: str, site: frozenset[str] = frozenset()) -> float:
    """How likely a normalised line is a link, prompt or notice of the site, from 0 to 1.

    Menu entries are links for certain. Elsewhere the share of a line's words that are site furniture or the site's own
    name counts, and arrows, separators, counters and years add to it; names alone are open, sentences are not.
    """
    letters = _LETTERS.sub("", line)
    if not letters:
        return 0.0 if line else 0.0
    if len(letters) < 400 and _MENU_RUN.fullmatch(letters):
        return 1.0
    if _COUNT.match(line) or line.rstrip(":") in CAPTIONS:
        return 1.0
    words = _WORD.findall(line)
    n = len(words)
    if not n or n > 60:
        return 0.0
    hit = [w in _ONE for w in words]
    weak = sum(w in WEAK for w in words)
    for k in (2, 3):
        for i in range(n - k + 1):
            if " ".join(words[i : i + k]) in _MORE:
                hit[i : i + k] = [True] * k
    own = sum(w in site for w in words)
    chinese = sum(line.count(x) * len(x) for x in _CHINESE) / max(1, len(_CJK.findall(line)))
    share = max((sum(hit) + own + weak / 2) / n, chinese)
    score = 2 * share
    if sum(hit) > 1 or own and any(hit):
        score += 0.15
    steps = len(_STEP.findall(line))
    if steps and n <= 24:
        score += 0.15 if line.endswith(".") else 0.35
        first = _LETTERS.sub("", _STEP.split(line, maxsplit=1)[0])
        # a path from a menu's entry, or arrows at both ends
        score += 0.45 * (first in _MENU or first in site or _MENU_RUN.fullmatch(first) is not None or (steps > 1 and line[0] in "←«" and line[-1] in "→»"))
    if (head := line.split(":", 1)[0]) != line and (head in _ONE or head in _MORE):
        score += 0.6
    if _YEAR.search(line):
        score += 0.3
    return min(1.0, score)


@dataclass
class Node:
    """A container of the page's tree: the page, a section under a heading, or a block of lines."""

    level: int
    lines: list[int] = field(default_factory=list)
    points: float = 0.0
    letters: int = 0
    links: float = 0.0

    @property
    def density(self) -> float:
        return self.links / self.letters if self.letters else 0.0

    @property
    def score(self) -> float:
        return self.points * (1 - self.density)


def listed(raw: list[str], lines: list[str], marks: list[int], title: str, links: list[float]) -> None:
    """Raises the evidence of the entries below captions of link lists.

    Entries of a table of contents stand once more on the page, at their sections; entries of other lists are names
    that don't. A list ends at the next heading, the next furniture and the first line of another kind.
    """
    times = Counter(x for x in lines if x)
    left = Counter()
    i, n = 0, len(lines)
    while i < n:
        x = lines[i].rstrip(":")
        if x not in CAPTIONS:
            i += 1
            continue
        toc, room = x in TOC_CAPTIONS, 60 if x in TOC_CAPTIONS else 1 if x in AD_CAPTIONS else 8
        links[i] = 1.0
        left.clear()
        i += 1
        while i < n and room:
            y = lines[i]
            if y:
                if marks[i] or y == title or links[i] >= 0.5 or len(y) > 90 or (y in LABELS and not (toc and y in ("recipe", "recipes"))):
                    break
                if toc and 2 * (left[y] + 1) > times[y]:
                    break
                if not toc and x not in AD_CAPTIONS and not (" " in y and times[y] < 2 and _NAME.match(raw[i].strip(" *-–—•|·\t\r\xa0"))):
                    break
                left[y] += 1
                links[i], room = ENTRY, room - 1
            i += 1


#: Evidence of an entry below a caption: a name alone would be open.
ENTRY = 0.8
#: Evidence by which a line must differ from the block before it to begin another one.
STEP = 0.4
#: Link density from which no score keeps a block.
LINKS = 0.65


def blocks(lines: list[str], marks: list[int], links: list[float]) -> tuple[list[Node], list[list[Node]], list[Node]]:
    """The page's tree: its blocks of lines, the containers above each, innermost last, and all containers.

    A block ends at a heading and where the evidence of the next line is far from the block's: lines of middling
    evidence stay with those before them.
    """
    page = Node(0)
    path, out, above, containers = [page], [], [], [page]
    block = None
    for i, x in enumerate(lines):
        if not x:
            continue
        if marks[i] and links[i] < 0.5:
            while len(path) > 1 and path[-1].level >= marks[i]:
                path.pop()
            path.append(Node(marks[i]))
            containers.append(path[-1])
            block = None
        if block is None or abs(block.density - links[i]) > STEP:
            block = Node(9)
            out.append(block), above.append(path[:])
        k = len(x)
        # a paragraph's own points, for length and commas; headings and short lines have none
        points = 0.0 if marks[i] or k < 25 else min(k / 100, 3) + min(sum(map(x.count, ",，、")), 6)
        block.lines.append(i)
        for c in (block, *path):
            c.letters += k
            c.links += k * links[i]
        block.points += points
        path[-1].points += points
        for c in path[:-1]:
            c.points += points / 2
    return out, above, containers


def body_lines(text: str, markdown: str | None, title: str | None, site: frozenset[str] = frozenset(), max_density: float = 0.5, share: float = 0.2) -> tuple[list[int], list[int]]:
    """Numbers of the body's lines and of the others, blank lines in neither.

    The lines form a tree: sections by heading level, in them blocks of lines of like evidence. Each line gives points
    for its length and its commas to its block and its section, and half to each container above; a node's score is its
    points less its link density, the share of its letters weighted by the lines' evidence. Blocks are siblings of the
    best container's: each is kept if its density, with half as much weight on its section's, stays below
    ``max_density``, or if its score reaches ``share`` of the best container's and it isn't mostly links.
    ``site`` holds the words of the site's name.
    """
    raw = text.split("\n")
    lines = [normal(x) for x in raw]
    marks = heading_marks(raw, markdown)
    name = normal(title) if title else "\0"
    links = [0.0 if not x or x == name or (marks[i] and x.rstrip(":") not in CAPTIONS) else evidence(x, site) for i, x in enumerate(lines)]
    listed(raw, lines, marks, name, links)
    out, above, containers = blocks(lines, marks, links)
    best = max((c.score for c in containers), default=0.0)
    body = []
    for b, path in zip(out, above):
        density = (2 * b.density + path[-1].density) / 3
        if density < max_density or (b.density < LINKS and b.score > 0 and b.score >= share * best):
            body += b.lines
    kept = set(body)
    return [i + 1 for i in sorted(kept)], [i + 1 for i, x in enumerate(lines) if x and i not in kept]


SCHEMA = "body_lines array<int>, other_lines array<int>, body string"
_NO_NAME = frozenset("www com net org wiki docs guide help learn test example notes".split())


def site_words(*names: str | None) -> frozenset[str]:
    """Words of a site's names or hostname that tell it from others."""
    return frozenset(w for x in names if isinstance(x, str) for w in re.findall(r"[^\W\d_]{4,}", x.lower()) if w not in _NO_NAME)


def main_body(pages: DataFrame, text: str = "text", markdown: str = "markdown", title: str = "title", site: tuple[str, ...] = ("hostname", "mod")) -> DataFrame:
    """``pages`` with the numbers of the lines of the main body and of the rest, and the body's text.

    ``site`` names columns with the site's name or hostname; those that are missing or null are not used.
    Null text: no lines and null body. Empty text: no lines, empty body. Null or mismatched markdown: no headings.
    Null title: no line is known to be the title. Pages without any body keep none. Each row is judged alone, so
    repeated rows give the same. Columns named like added ones are replaced. An empty table stays empty.
    """
    added = ["body_lines", "other_lines", "body"]
    if {text, markdown, title} & {*added}:
        raise ValueError("an input column has the name of an added one")
    base = pages.drop(*added)

    def judge(texts: pd.Series, marks: pd.Series, titles: pd.Series, *names: pd.Series) -> pd.DataFrame:
        found = []
        for t, m, h, *own in zip(texts, marks, titles, *names):
            if t is None:
                found.append(([], [], None))
                continue
            body, other = body_lines(t, m, h, site_words(*own))
            raw = t.split("\n")
            found.append((body, other, "\n".join(raw[i - 1] for i in body)))
        return pd.DataFrame(found, columns=added)

    udf = F.pandas_udf(judge, SCHEMA).asNondeterministic()  # so that it is never evaluated twice
    own = [F.col(c).cast("string") for c in site if c in base.columns]
    return base.withColumn("__result", udf(F.col(text), F.col(markdown), F.col(title), *own)).select(*base.columns, "__result.*")
