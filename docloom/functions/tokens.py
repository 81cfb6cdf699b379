"""Token rule and text predicates as JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the public token rule.
TOKEN = r"[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\r\n]"


def token_count(text: str | Column) -> Column:
    """Tokens of ``text`` as BIGINT; null for null."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_count(c, F.lit(TOKEN)).cast("long")


def line_array(text: str | Column) -> Column:
    """Lines of ``text``, split at LF; blank lines count."""
    c = F.col(text) if isinstance(text, str) else text
    return F.split(c, "\n", -1)
