"""Problem 9: text quality statistics of each document, and whether it is natural prose."""

from __future__ import annotations

import re
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Function words that common-word tables tend to leave out, per language.
FUNCTION_WORDS = frozenset(
    """a an the and or but nor so yet if of to in on at by for from with without within into onto over under above below between behind beside near next inside outside through across along until unless while when whenever where because since after before once
    is are was were be been being am do does did has have had can could may might must shall should will would not no never only even still just than then there here this that these those it its he she they them their his her you your we our i me my who whom whose which what why how
    as up down out off all any both each every either neither few more most other some such same own too very once twice enough rather instead also often
    der die das den dem des ein eine einen einem einer und oder aber auch auf aus bei bis für im in ist kann man mit nach nicht nur oft ohne seit sind von vom war wenn wie wird zu zum zur am an als dass damit neben hinter zwischen über unter vor ihr braucht mehr jeder jede jedes sich es sie er wir
    el la los las un una unos unas y o pero de del al a en por para con sin sobre entre desde hasta cuando si que como más menos muy ya no se su sus es son está fue ser hay cada este esta antes después también detrás junto falta""".split()
)
_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_CJK = re.compile(r"[぀-ヿ㐀-鿿가-힯]")
#: Characters that carry grammar in Chinese and Japanese sentences, and their stops.
_CJK_GRAMMAR = re.compile(r"[的了在是不就會会而把被與与和或及從从自以個个它們们這这那後后並并每如果沒没有也都很可要用來来對对於于のはがをにでとも]")
_CJK_STOP = re.compile(r"[。！？，；]")
_INVISIBLE = re.compile(r"[​‌‍⁠﻿­]")
_ENTITY = re.compile(r"&(?:[a-z]{2,8}|#\d{1,6});")
_BULLET = re.compile(r"^\s*(?:[-*•+–—·▪►]|\d{1,4}[.)]|\[[ xX]?\]|[a-zA-Z][.)])\s+")
_NUMBER = re.compile(r"\d[\d.,:]*")
_MACHINE = re.compile(r"^\s*(?:\[\d\d:\d\d|\d{4}-\d\d-\d\d|[0-9a-f]{6,}\s|\{|\}|<[/a-z!?]|at [\w.$]+\(|(?:DEBUG|INFO|WARN|ERROR|FATAL)\b)|→|=>|\w+=\S+ \w+=|[{}]\s*$|[!-~]{40,}")
_DELIMITERS = "|\t;,"
_ENDS = tuple(".!?…:;。！？\"”'’)»")
MIN_COMMON = 0.2
#: Lines of a list at least, its words a line at most, and the autocorrelation from which lengths or indents recur.
LIST_LINES, SHORT, RECURRING = 6, 6, 0.6


def periodic(x: np.ndarray) -> float:
    """The highest autocorrelation of a sequence over all lags up to half its length, 0 for fewer than 4 values."""
    if len(x) < 4:
        return 0.0
    d = x - x.mean()
    v = float(d @ d)
    if v < 1e-9:
        return 1.0
    whole = np.fft.irfft(np.abs(np.fft.rfft(d, 2 * len(d))) ** 2)[1 : len(d) // 2 + 1] / v
    # the overlap shrinks with the lag: what is left of it is what counts
    return float((whole * len(d) / (len(d) - np.arange(1, len(whole) + 1))).max())


def list_like(run: list[str]) -> bool:
    """Whether plain lines are entries of a list or of records: many short ones, few with a stop, lengths or indents that recur."""
    if len(run) < LIST_LINES or sum(x.rstrip().endswith(_ENDS) for x in run) > 0.2 * len(run):
        return False
    if sum(len(x.split()) for x in run) > SHORT * len(run) or any(_CJK.search(x) for x in run):
        return False
    indent = np.array([len(x) - len(x.lstrip(" \t")) for x in run], float)
    return periodic(np.array([len(x.strip()) for x in run], float)) >= RECURRING or (indent.any() and periodic(indent) >= RECURRING)


def columns_alike(lines: list[str]) -> list[bool]:
    """Lines that have the same number (2 or more) of one delimiter, or the same column gaps, as a neighbour."""
    marks = []
    for x in lines:
        m = {("n", d, x.count(d)) for d in _DELIMITERS if x.count(d) >= (3 if d == "," else 2)}
        mixed = x.count(";") + x.count(",") + x.count("\t")
        if mixed >= 3 and len(x.split()) <= mixed + 6:
            m.add(("m", "", mixed))
        m |= {("g", "", g.end()) for g in re.finditer(r"\S(?: {2,})(?=\S)", x)}
        marks.append(m)
    out = []
    for i, m in enumerate(marks):
        near = (marks[i - 1] if i else set()) | (marks[i + 1] if i + 1 < len(marks) else set())
        out.append(bool(m & near))
    return out


def prose_like(block: str, common: frozenset[str]) -> bool:
    """Whether a line or paragraph reads as running sentences, by its common words and its symbols."""
    n = len(block)
    cjk = len(_CJK.findall(block))
    if cjk * 3 >= sum(map(str.isalpha, block)) and cjk >= 4:
        return len(_CJK_GRAMMAR.findall(block)) >= 0.08 * cjk and (_CJK_STOP.search(block) is not None or cjk >= 12)
    words = _WORD.findall(block)
    if not words:
        return False
    letters = sum(map(len, words))
    if letters < 0.6 * n or len(_NUMBER.findall(block)) > 0.2 * len(words):
        return False
    return sum(w in common for w in words) >= MIN_COMMON * len(words)


def measure(text: str, common: frozenset[str]) -> tuple:
    """The statistics of one text, in the order of ``SCHEMA``."""
    clean = _ENTITY.sub(" ", _INVISIBLE.sub("", text).replace(" ", " "))
    low = clean.lower()
    words = _WORD.findall(low)
    n = len(clean)
    letters = sum(map(len, words))
    solid = sum(map(len, clean.split()))
    alnum = sum(map(str.isalnum, clean))
    lines = [x for x in low.split("\n") if x.strip()]
    ends = sum(x.rstrip().endswith(_ENDS) for x in lines)
    hits = sum(w in common for w in words)
    length = np.array([len(x) for x in lines], dtype=float)
    indent = np.array([len(x) - len(x.lstrip(" \t")) for x in lines], dtype=float)
    alike = columns_alike(lines)
    bullets = [_BULLET.match(x) is not None for x in lines]
    steady = periodic(length)
    period = periodic(indent) if indent.any() else 0.0

    # runs of plain lines make up paragraphs; rows of tables, list items and machine output stand alone
    prose = other = 0
    run: list[str] = []

    def flush() -> None:
        nonlocal prose, other
        if run:
            block = " ".join(run)
            k = sum(len(x) for x in run)
            if list_like(run):
                other += k
            elif prose_like(block, common):
                prose += k
            else:
                # one paragraph may hold both: judge its sentences
                for s in re.split(r"(?<=[.!?。！？])\s*", block):
                    if prose_like(s, common):
                        prose += len(s)
                    else:
                        other += len(s)
            run.clear()

    for x, table, item in zip(lines, alike, bullets):
        if _MACHINE.search(x):
            flush()
            other += len(x)
        elif table and not (x.rstrip().endswith(_ENDS) and prose_like(x, common)):
            flush()
            other += len(x)
        elif item:
            flush()
            body = _BULLET.sub("", x).strip()
            sentence = prose_like(body, common) and len(_WORD.findall(body)) >= 6 and body.endswith(_ENDS)
            if sentence:
                prose += len(x)
            else:
                other += len(x)
        else:
            run.append(x)
    flush()
    total = prose + other
    return (
        len(words),
        letters / len(words) if words else 0.0,
        (solid - alnum) / solid if solid else 0.0,
        ends / len(lines) if lines else 0.0,
        hits / len(words) if words else 0.0,
        len(lines),
        sum(alike) / len(lines) if lines else 0.0,
        sum(bullets) / len(lines) if lines else 0.0,
        steady,
        period,
        prose / total if total else 0.0,
        n,
    )


SCHEMA = "n_words long, mean_word_length double, symbol_ratio double, punctuated_lines double, common_words double, n_lines long, table_lines double, list_lines double, line_length_correlation double, indent_correlation double, prose_share double, n_clean_chars long"


def word_set(words: DataFrame, column: str = "word", bound: int = 100_000) -> frozenset[str]:
    """The words of a table of common words in lower case, with the fixed function words.

    Raises ``ValueError`` beyond ``bound`` rows: the set goes into every task.
    """
    found = words.select(F.lower(column).alias("w")).where("w is not null").distinct().limit(bound + 1).collect()
    if len(found) > bound:
        raise ValueError(f"more than {bound} common words")
    return FUNCTION_WORDS | {r.w for r in found}


def text_quality(documents: DataFrame, words: DataFrame, text: str = "text", least_prose: float = 0.5) -> DataFrame:
    """``documents`` with the statistics of ``SCHEMA`` and ``is_prose``.

    ``is_prose`` holds where at least ``least_prose`` of the characters stand in running sentences. Rows of tables
    (the same delimiters or column gaps as in the next row), items of lists, runs of short lines without stops whose
    lengths or indents recur (autocorrelation over all lags) and lines of machine output don't;
    paragraphs do if enough of their words are common ones and not too many are numbers or symbols.
    Null text gives null statistics and null ``is_prose``; a text without words has zeros and is no prose.
    Repeated rows give the same; columns named like added ones are replaced; an empty table stays empty.
    """
    common = word_set(words)
    added = [x.split()[0] for x in SCHEMA.split(", ")]
    if text in [*added, "is_prose"]:
        raise ValueError(f"{text} is the name of an added column")
    base = documents.drop(*added, "is_prose")

    def judge(texts: pd.Series) -> pd.DataFrame:
        rows = [measure(t, common) if t is not None else (None,) * len(added) for t in texts]
        out = pd.DataFrame(rows, columns=added)
        return out.astype({x: "Int64" if x.startswith("n_") else "Float64" for x in added})

    udf = F.pandas_udf(judge, SCHEMA).asNondeterministic()  # so that it is never evaluated twice
    return base.withColumn("__result", udf(text)).select(*base.columns, "__result.*", (F.col("__result.prose_share") >= least_prose).alias("is_prose"))
