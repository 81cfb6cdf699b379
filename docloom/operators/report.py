"""Figures of reports, as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.shared import durable

#: Ranges of values that ranks are counted in.
RANGES = 1024


def distribution(rows: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """n, median, p95, max of a column, per group.

    p95 is the value of rank floor(0.95 n), at least 1, in ascending order: exact, from counts of distinct values, so
    that no group is collected into one task.
    """
    by = by or []
    counts = durable(rows.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("c")))
    # ranks within ranges of values, and behind them the counts of the ranges below: no task has all values of a group
    low, high = counts.agg(F.min("v"), F.max("v")).first()
    width = max((float(high) - float(low)) / RANGES, 1e-9) if low is not None else 1.0
    counts = counts.withColumn("range", F.least(F.floor((F.col("v") - F.lit(low)) / F.lit(width)), F.lit(RANGES)).cast("int"))
    below = W.partitionBy(*by, *([] if by else [F.lit(0)])).orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*by, *([] if by else [F.lit(0)]))
    totals = counts.groupBy(*by, "range").agg(F.sum("c").alias("t"))  # at most RANGES + 1 rows a group
    totals = totals.select(*(F.col(x).alias(f"_{x}") for x in by), F.col("range").alias("_range"), F.coalesce(F.sum("t").over(below), F.lit(0)).alias("before"), F.sum("t").over(whole).alias("n"))
    same = F.col("range") == F.col("_range")
    for x in by:
        same = same & F.col(x).eqNullSafe(F.col(f"_{x}"))
    ranked = counts.join(totals, same).withColumn("upto", F.col("before") + F.sum("c").over(W.partitionBy(*by, "range").orderBy("v")))

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("upto") >= rank, F.col("v")))

    n = F.col("n")
    low, high = F.floor((n + 1) / 2), F.floor(n / 2) + 1
    p95 = F.greatest(F.lit(1), F.floor(n * F.lit(0.95)))
    return ranked.groupBy(*by).agg(F.max("n").alias("n"), ((at(low) + at(high)) / 2).alias("median"), at(p95).alias("p95"), F.max("v").alias("max"))


def counts_by(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def reconciliation(rows: DataFrame, by: list[str], column: str, parts: list[str], total: str = "total") -> DataFrame:
    """Counts of the values of a column side by side with their total, per group."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias(total), *(F.count_if(F.col(column) == p).alias(p) for p in parts))


def first_of(rows: DataFrame, by: str, key: str, n: int = 5) -> DataFrame:
    """The first ``n`` keys of each group, as a report lists them, with the group's size."""
    w = W.partitionBy(by)
    ranked = rows.select(by, key).withColumn("rank", F.row_number().over(w.orderBy(key)))
    few = ranked.where(F.col("rank") <= n)
    return few.join(counts_by(rows, by), by)


def markdown(rows: DataFrame, title: str, limit: int = 40) -> str:
    """A report's section: a table of up to ``limit`` rows, and how many more there are if there are more."""
    found = rows.limit(limit + 1).collect()
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    lines = [f"## {title}", "", "| " + " | ".join(rows.columns) + " |", "|" + " --- |" * len(rows.columns)]
    lines += ["| " + " | ".join(map(cell, r)) + " |" for r in found[:limit]]
    if len(found) > limit:
        lines += ["", f"and {rows.count() - limit} more"]
    return "\n".join(lines) + "\n"


def assembled(title: str, sections: dict[str, DataFrame], limit: int = 40) -> str:
    """A stage's report: its title and a section for each table, in their order; a table without rows says so."""
    parts = [f"# {title}\n"]
    for name, rows in sections.items():
        parts.append(markdown(rows, name, limit) if not rows.isEmpty() else f"## {name}\n\nnone\n")
    return "\n".join(parts)
