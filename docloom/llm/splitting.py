"""Problem 3: splitting oversized items at natural boundaries by recursive bisection."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.tokens import TOKEN, token_count

_TOKEN = re.compile(TOKEN)
#: Strength of the boundary in front of a token, by what stands between it and the one before.
PARAGRAPH, LINE, SENTENCE, CLAUSE, GAP, NONE = 5, 4, 3, 2, 1, 0
_SENTENCE_END = frozenset(".!?。！？…")
_CLAUSE_END = frozenset(",;:，；：、)]")
_CLOSING = frozenset("\"'”’)]»」』")


def boundaries(text: str) -> tuple[list[int], list[int], list[int]]:
    """Start and end of every token and the strength of the boundary in front of it."""
    starts, ends, strength = [], [], []
    end, last, before = 0, "", ""
    for m in _TOKEN.finditer(text):
        s, e = m.span()
        gap = text[end:s]
        if last in _CLOSING and before in _SENTENCE_END:
            last = before
        if "\n" in gap:
            k = PARAGRAPH if gap.count("\n") > 1 else LINE
        elif last in _SENTENCE_END and (gap or last in "。！？"):
            k = SENTENCE
        elif last in _CLAUSE_END and (gap or last in "，；：、"):
            k = CLAUSE
        else:
            k = GAP if gap else NONE
        starts.append(s), ends.append(e), strength.append(k)
        end, before, last = e, last, text[e - 1]
    return starts, ends, strength


def cuts(strength: list[int], limit: int) -> list[int]:
    """Token positions at which to cut so that no piece has more than ``limit`` tokens.

    Each span is cut at the strongest boundary in its middle half, of several equally strong ones at that
    nearest to the midpoint, and halves that are still too large are cut again.
    """
    found, todo = [], [(0, len(strength))]
    while todo:
        lo, hi = todo.pop()
        n = hi - lo
        if n <= limit:
            continue
        mid, reach = lo + n / 2, max(1, n // 4)
        a, b = max(lo + 1, int(mid) - reach), min(hi - 1, int(mid) + reach)
        at = max(range(a, b + 1), key=lambda i: (strength[i], -abs(i - mid)))
        found.append(at)
        todo += [(lo, at), (at, hi)]
    return sorted(found)


def pieces(text: str, limit: int, overlap: int) -> list[tuple[int, int, int, int]]:
    """(start, own start, end, tokens) of each piece; the spans from own start to end make up ``text``.

    A piece begins up to ``overlap`` tokens before its own start, at the strongest boundary in that reach.
    """
    starts, ends, strength = boundaries(text)
    if len(starts) <= limit:
        return [(0, 0, len(text), len(starts))]
    at = [0, *cuts(strength, limit - overlap), len(starts)]
    out = []
    for i, (lo, hi) in enumerate(zip(at, at[1:])):
        first = lo
        if i and overlap:
            first = max(range(max(at[i - 1], lo - overlap), lo), key=lambda k: (min(strength[k], SENTENCE), -k), default=lo)
        own = starts[lo] if i else 0
        end = starts[hi] if hi < len(starts) else len(text)
        out.append((starts[first] if i else 0, own, end, hi - first))
    return out


PIECE = "piece_no int, n_pieces int, start long, own_start long, end long, piece string, piece_tokens long"


def split_oversized(items: DataFrame, text: str, limit: int, overlap: int = 32) -> DataFrame:
    """Every item of ``items`` with its pieces, one row a piece, the columns of ``PIECE`` added.

    Sizes are in tokens of the public rule, recounted from the text. An item within ``limit`` is one piece and
    never leaves the JVM; only oversized texts go to Python, a few at a time. Offsets are in code points.
    Null text: one piece with null text and 0 tokens. Empty text: one empty piece. Repeated rows are split each.
    Columns of ``items`` that have the name of an added column are replaced. An empty table gives an empty result.
    ``overlap`` must be below ``limit``.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and below limit")
    added = [x.split()[0] for x in PIECE.split(", ")]
    if text in added:
        raise ValueError(f"{text} is the name of an added column")
    base = items.drop(*added)
    keep = base.columns
    sized = base.withColumn("piece_tokens", F.coalesce(token_count(text), F.lit(0).cast("long")))

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, t in enumerate(batch[text]):
                ps = pieces(t, limit, overlap)
                rows += [(i, k + 1, len(ps), s, own, e, t[s:e].rstrip() if e < len(t) else t[s:e], n) for k, (s, own, e, n) in enumerate(ps)]
            p = pd.DataFrame(rows, columns=["_i", *added])
            yield pd.concat([batch[keep].iloc[p["_i"]].reset_index(drop=True), p[added]], axis=1)

    whole = sized.where(F.col("piece_tokens") <= limit).select(
        *keep,
        F.lit(1).alias("piece_no"),
        F.lit(1).alias("n_pieces"),
        F.lit(0).cast("long").alias("start"),
        F.lit(0).cast("long").alias("own_start"),
        F.coalesce(F.length(text), F.lit(0)).cast("long").alias("end"),
        F.col(text).alias("piece"),
        "piece_tokens",
    )
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields), PIECE])
    cut = sized.where(F.col("piece_tokens") > limit).select(*keep).mapInPandas(split, schema)
    return whole.unionByName(cut)
