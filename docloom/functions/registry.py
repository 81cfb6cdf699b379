"""The engine's functions under names for SQL."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from docloom.functions.tokens import TOKEN

#: SQL functions: the optimizer puts their bodies in place of the calls.
SQL_FUNCTIONS = {
    "token_count(t STRING) RETURNS BIGINT": f"RETURN CAST(regexp_count(t, r'{TOKEN}') AS BIGINT)",
    "heading_level(line STRING) RETURNS INT": "RETURN length(regexp_extract(line, r'^(#{1,6}) ', 1))",
    "heading_content(line STRING) RETURNS STRING": "RETURN regexp_replace(line, r'^#{1,6} ', '')",
    "slugify(t STRING) RETURNS STRING": "RETURN regexp_replace(regexp_replace(lower(t), '[^a-z0-9]+', '-'), '^-+|-+$', '')",
    "unit_norm(v ARRAY<FLOAT>, tolerance DOUBLE) RETURNS BOOLEAN": "RETURN abs(sqrt(aggregate(v, 0D, (s, x) -> s + CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) - 1) <= tolerance",
}


class ChunkText:
    """A table function: the chunks of a text, as (piece, start, end, chunk)."""

    def eval(self, text: str, limit: int, overlap: int) -> Iterator[tuple[int, int, int, str]]:
        from docloom.operators.chunk import child_spans

        for k, (s, e) in enumerate(child_spans(text, limit, overlap) if text else [], 1):
            yield k, s, e, text[s:e]


def register(spark: SparkSession) -> None:
    """Make the functions and the table function ``chunk_text`` known to the session."""
    for head, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} {body}")
    spark.udtf.register("chunk_text", udtf(ChunkText, returnType="piece int, start int, end int, chunk string"))
