"""Problem 8: mixing sources to target weights by iterative proportional fitting."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.functions.tokens import token_count
from docloom.shared import durable, small

#: Topics are the last words of titles, hashed into this many classes, so that the table of cells is bounded.
TOPICS = 32
#: Languages that are cells of their own.
LANGUAGES = ("en", "de", "es", "zh")
#: Rows that share one run of the sampling; larger sources are sampled in more runs.
BUCKET_ROWS = 500_000
#: Starts of the sampling that are tried for each source.
STARTS = 32
#: Documents of each source and power of two of their tokens that may change in the repair, for more and for fewer uses.
REPAIR = 48
#: Sources that a table of targets may have; cells are at most this times languages times topics.
MAX_SOURCES = 10_000


def name_key(c: str) -> Column:
    """Source names in lower case without outer blanks."""
    return F.lower(F.trim(F.col(c)))


def rake(cells: pd.DataFrame, goals: pd.Series, rounds: int = 50) -> np.ndarray:
    """Tokens to draw from each cell (columns source, lang, topic, tokens, repeats).

    The cells' tokens are scaled in turn to the languages' and the topics' shares of the corpus and to each source's
    goal, never above ``repeats`` times what a cell has. The sources' goals come last and are met exactly.
    """
    x = cells["tokens"].to_numpy(float).copy()
    cap = x * cells["repeats"].to_numpy(float)
    total = float(goals.sum())
    codes = {c: pd.factorize(cells[c]) for c in ("source", "lang", "topic")}
    aims = {c: np.bincount(codes[c][0], cells["tokens"]) for c in ("lang", "topic")}
    aims = {c: a / a.sum() * total for c, a in aims.items()}
    aims["source"] = goals.reindex(codes["source"][1]).to_numpy(float)

    def scale(x: np.ndarray, c: str) -> np.ndarray:
        code, names = codes[c]
        now = np.bincount(code, x, len(names))
        return np.minimum(cap, x * np.divide(aims[c], now, out=np.ones_like(now), where=now > 0)[code])

    for _ in range(rounds):
        for c in ("lang", "topic", "source"):
            x = scale(x, c)
    for _ in range(200):  # what capped cells can't give, the source's other cells do
        new = scale(x, "source")
        if np.allclose(new, x, rtol=1e-12, atol=1e-9):
            break
        x = new
    return x


def repair(choice: pd.DataFrame) -> pd.DataFrame:
    """Changes (_row, _turn) of single uses that bring a source's tokens, one after the other, nearest to its goal.

    ``choice`` has _row, _h (its order among equals), _tokens, _turn (1 for one use more, -1 for one fewer), _now and _goal of one source. Each
    document changes once at most; the search ends where no single change and no pair of opposite ones helps.
    """
    choice = choice.sort_values(["_tokens", "_turn", "_h", "_row"])
    left = float(choice["_goal"].iloc[0]) - float(choice["_now"].iloc[0])
    # a document that may change in both ways stands twice
    step = (choice["_tokens"] * choice["_turn"]).to_numpy(float)
    row, free, taken = choice["_row"].to_numpy(), np.ones(len(choice), bool), []

    def take(i: int) -> None:
        nonlocal left
        taken.append(i)
        free[row == row[i]] = False
        left -= step[i]

    while free.any():
        at = np.flatnonzero(free)
        i = at[np.abs(left - step[at]).argmin()]
        if abs(left - step[i]) < abs(left) - 1e-9:
            take(i)
            continue
        more, fewer = at[step[at] > 0], at[step[at] < 0]
        if not len(more) or not len(fewer) or abs(left) < 1:
            break
        gap = np.abs(left - step[more][:, None] - step[fewer][None, :])
        gap[row[more][:, None] == row[fewer][None, :]] = np.inf
        i, j = np.unravel_index(gap.argmin(), gap.shape)
        if gap[i, j] >= abs(left) - 1e-9:
            break
        take(more[i])
        take(fewer[j])
    return pd.DataFrame({"_row": row[taken], "_turn": choice["_turn"].to_numpy()[taken]})


@dataclass
class Mix:
    """``uses``: key, source, tokens, uses of each document; ``shares``: a row for each target."""

    uses: DataFrame
    shares: DataFrame


def mix(documents: DataFrame, targets: DataFrame, key: str, text: str, source: str = "source", lang: str = "lang", title: str = "title", seed: int = 17) -> Mix:
    """How often to use each document so that sources come near their ``target_share`` of all tokens.

    ``targets`` has source, target_share, max_repeats. All tokens are those of documents with a source. The goal of a
    source is its share of them, or all it has ``max_repeats`` times if that is less. Cell weights come from ``rake``
    over source, language and topic; a document of a cell of weight w is used floor(w) times and once more with the
    probability of the rest, drawn by systematic sampling along the source's
    documents by size, with the start, of ``STARTS``, that comes nearest to the goal; what is left is made up by single uses more or fewer of up to ``REPAIR`` documents of
    each size class (``repair``). ``shares`` reports tokens, goal and what was reached.

    Sources are compared in lower case without outer blanks. Documents with null source, or one that is no target,
    are used 0 times; null text has 0 tokens; null language or title make a cell of their own. Repeated rows count and
    are used each. Targets of one name are added up (the largest ``max_repeats`` holds); null shares and repeats
    are 0. Empty tables give empty results.
    """
    if key in ("source", "tokens", "uses"):
        raise ValueError(f"{key} is the name of an added column")
    wanted = targets.where(F.col("source").isNotNull()).groupBy(name_key("source").alias("_s")).agg(F.min("source").alias("name"), F.sum(F.coalesce("target_share", F.lit(0.0))).alias("share"), F.max(F.coalesce("max_repeats", F.lit(0))).alias("repeats"))
    rows = wanted.limit(MAX_SOURCES + 1).toPandas()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} targets")
    code = F.lower(F.trim(F.col(lang)))
    language = F.when(code.isin(*LANGUAGES), code).when(code.isNull(), F.lit("none")).otherwise(F.lit("other"))
    word = F.lower(F.regexp_extract(F.col(title), r"(\S+)\s*$", 1))
    topic = F.when(F.col(title).isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(word), F.lit(TOPICS))).cast("int")
    sized = durable(
        documents.select(
            F.col(key).alias("_key"), name_key(source).alias("_s"), language.alias("_lang"), topic.alias("_topic"), F.coalesce(token_count(text), F.lit(0).cast("long")).alias("_tokens")
        )
    )
    spark = sized.sparkSession
    total = sized.where("_s IS NOT NULL").agg(F.coalesce(F.sum("_tokens"), F.lit(0))).first()[0]
    names = F.broadcast(spark.createDataFrame(rows[["_s"]], "_s string"))  # at most MAX_SOURCES rows
    cells = sized.join(names, "_s").groupBy(F.col("_s").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic")).agg(F.sum("_tokens").alias("tokens")).toPandas()
    cells = cells.sort_values(["source", "lang", "topic"], ignore_index=True)
    rows = rows.set_index("_s")
    cells["repeats"] = rows["repeats"].reindex(cells["source"]).to_numpy()
    have = cells.groupby("source")["tokens"].sum().reindex(rows.index).fillna(0)
    goals = np.minimum(rows["share"] * total, rows["repeats"] * have)
    cells["weight"] = rake(cells, goals) / np.maximum(cells["tokens"].to_numpy(float), 1) if len(cells) else []
    weights = spark.createDataFrame(cells[["source", "lang", "topic", "weight", "repeats"]], "_s string, _lang string, _topic int, _w double, _max int")
    # cells are bounded by MAX_SOURCES, languages and topics, whatever the documents
    joined = sized.join(F.broadcast(weights) if len(cells) <= 200_000 else weights, ["_s", "_lang", "_topic"], "left")
    # systematic sampling: along the documents of a source by size, one more use wherever the sum of the weights passes
    # a whole number; large sources in hashed parts, each with a start of its own
    parts = F.lit(max(1, -(-sized.count() // BUCKET_ROWS)))
    part = joined.withColumn("_part", F.pmod(F.xxhash64("_key"), parts).cast("int")).withColumn("_w", F.coalesce("_w", F.lit(0.0)))
    upto = F.sum("_w").over(W.partitionBy("_s", "_part").orderBy("_tokens", "_key", "_lang", "_topic").rowsBetween(W.unboundedPreceding, 0))
    own = F.pmod(F.xxhash64("_s", "_part", F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    summed = durable(part.select(F.monotonically_increasing_id().alias("_row"), "_key", "_s", "_tokens", "_w", F.coalesce("_max", F.lit(0)).alias("_max"), (upto + own).alias("_sum")))

    def drawn(start: Column) -> Column:
        # 1e-9 keeps sums of whole weights whole
        n = F.floor(F.col("_sum") + start + 1e-9) - F.floor(F.col("_sum") - F.col("_w") + start + 1e-9)
        return F.when(F.col("_w") > 0, F.least(n, F.col("_max"))).otherwise(0).cast("int")

    # every start gives a sample with these weights; each source takes the one that comes nearest to its goal
    tried = [k / STARTS for k in range(STARTS)]
    sums = summed.where("_w > 0").groupBy("_s").agg(*(F.sum(F.col("_tokens") * drawn(F.lit(o))).alias(f"r{k}") for k, o in enumerate(tried))).toPandas().set_index("_s")
    off = sums.sub(goals.reindex(sums.index), axis=0).abs().to_numpy() if len(sums) else np.zeros((0, STARTS))
    best = pd.DataFrame({"_s": list(sums.index), "_o": [tried[i] for i in off.argmin(1)] if len(sums) else []})
    starts = F.broadcast(spark.createDataFrame(best, "_s string, _o double"))  # at most MAX_SOURCES rows
    joined = summed.join(starts, "_s", "left")
    n = drawn(F.coalesce("_o", F.lit(0.0)))
    first = durable(joined.select("_row", "_key", "_s", "_tokens", "_max", n.alias("_uses")))
    # what the sampling is off by is repaired with single uses of a bounded choice of documents of every size
    choice = first.where("_max > 0 AND _tokens > 0").withColumn("_turn", F.explode(F.array(F.lit(1), F.lit(-1)))).where("(_turn = 1 AND _uses < _max) OR (_turn = -1 AND _uses > 0)")
    few = W.partitionBy("_s", "_turn", F.floor(F.log2("_tokens"))).orderBy("_h", "_key", "_row")
    choice = choice.withColumn("_h", F.xxhash64("_key", F.lit(seed))).withColumn("_r", F.row_number().over(few)).where(F.col("_r") <= REPAIR)
    off = first.groupBy("_s").agg(F.sum(F.col("_tokens") * F.col("_uses")).alias("_now"))
    aims = F.broadcast(spark.createDataFrame(pd.DataFrame({"_s": list(goals.index), "_goal": goals.to_numpy(float)}), "_s string, _goal double"))  # at most MAX_SOURCES rows
    moves = choice.join(off, "_s").join(aims, "_s").groupBy("_s").applyInPandas(repair, "_row long, _turn int")
    moved = first.join(small(durable(moves)), "_row", "left").withColumn("_uses", F.col("_uses") + F.coalesce("_turn", F.lit(0)))
    uses = moved.select(F.col("_key").alias(key), F.col("_s").alias("source"), F.col("_tokens").alias("tokens"), F.col("_uses").alias("uses"))
    reached = uses.where("uses > 0").groupBy("source").agg(F.sum(F.col("tokens") * F.col("uses")).alias("reached"))
    out = rows.reset_index().assign(tokens=have.to_numpy().astype("int64"), goal=goals.to_numpy(), total=total)
    known = spark.createDataFrame(out[["_s", "name", "share", "repeats", "tokens", "goal", "total"]], "_s string, name string, target_share double, max_repeats int, tokens long, goal double, total long")
    shares = known.join(reached, known["_s"] == reached["source"], "left").select(
        F.col("name").alias("source"),
        "target_share",
        "max_repeats",
        "tokens",
        (F.col("max_repeats") * F.col("tokens") >= F.col("target_share") * F.col("total")).alias("reachable"),
        "goal",
        F.coalesce("reached", F.lit(0)).alias("reached_tokens"),
        (F.coalesce("reached", F.lit(0)) / F.col("total")).alias("reached_share"),
    )
    return Mix(uses, shares)
