"""Line normalisation shared by the page operators."""

from __future__ import annotations

import re

_BLANKS = re.compile(r"[\s ​‌‍﻿⁠]+")
_TRIM = " *-–—•|·"


def normal(line: str) -> str:
    """Lower case, white space collapsed, bullets and dashes at both ends cut off."""
    return _BLANKS.sub(" ", line).strip(_TRIM).lower()


def heading_marks(text: list[str], markdown: str | None) -> list[int]:
    """Heading level of each line of a text from the markdown that has the same lines; 0 for none.

    Null markdown, or one with another number of lines, marks nothing.
    """
    if markdown is None:
        return [0] * len(text)
    marked = markdown.split("\n")
    if len(marked) != len(text):
        return [0] * len(text)
    out = []
    for m in marked:
        s = m.lstrip()
        n = len(s) - len(s.lstrip("#"))
        out.append(n if 0 < n <= 6 and s[n : n + 1] in (" ", "") else 0)
    return out
