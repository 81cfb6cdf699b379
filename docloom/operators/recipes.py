"""Recipes from the cells of pages' recipe boxes, by grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.html import recipe_cells

#: Stations whose inputs have named slots in the page, and those whose three inputs have these slots.
SLOTTED, ORDERED, SLOTS = ("Inscriber",), ("Smithing Table",), ("template", "base", "addition")
SHAPELESS, RESULT = "Shapeless", "result"


def recipes(pages: DataFrame, page: str = "page_id", html: str = "html") -> DataFrame:
    """page, box, label, station, shapeless, ingredients, slots, result, failed: a row for each recipe box.

    Part 0 of a box names the label and, by its first icon, the station. A slotted station's second part has a cell
    for each slot, one of them the result; otherwise, with four parts or more, the second part holds the inputs, one a
    grid cell (its first icon; the whole part is one where there is no grid), and the last part the result. Inputs are
    counted by name in the order of their first appearance. A box that lacks any of these has ``failed``.
    """
    cells = pages.select(F.col(page).alias("page"), F.explode(recipe_cells(html)).alias("c")).select("page", "c.*")
    key = ["page", "box"]
    icon = F.col("icon").isNotNull()
    heads = cells.groupBy(*key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when((F.col("part") == 0) & F.col("text").isNotNull(), F.struct("pos", "text")))), lambda x: x["text"]), " ").alias("label"),
        F.min_by("icon", F.when((F.col("part") == 0) & icon, F.col("pos"))).alias("station"),
        (F.max("part") + 1).alias("parts"),
    )
    firsts = cells.where(icon).groupBy(*key, "part", "cell", "grid").agg(F.min_by(F.struct("icon", "slot"), "pos").alias("i"), F.min("pos").alias("pos"))
    one = firsts.join(heads.select(*key, "station", "parts"), key)
    slotted = F.col("station").isin(*SLOTTED) & (F.col("parts") >= 2)
    plain = ~slotted & (F.col("parts") >= 4)

    by_slot = one.where(slotted & (F.col("part") == 1)).groupBy(*key, "cell").agg(F.min_by("i", "pos").alias("i"), F.min("pos").alias("pos"))
    ordered = F.transform(F.array_sort(F.collect_list(F.when(F.col("i.slot") != RESULT, F.struct("pos", "i")))), lambda x: F.struct(x["i"]["slot"].alias("slot"), x["i"]["icon"].alias("name")))
    slots = by_slot.groupBy(*key).agg(ordered.alias("own_slots"), F.max(F.when(F.col("i.slot") == RESULT, F.col("i.icon"))).alias("slot_result"))

    inputs = one.where(plain & (F.col("part") == 1)).groupBy(*key, "grid").agg(F.min_by("i.icon", "pos").alias("name"), F.min("pos").alias("pos"))
    counted = inputs.groupBy(*key, "name").agg(F.count(F.lit(1)).cast("int").alias("count"), F.min("pos").alias("pos"))
    counted = counted.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "name", "count"))), lambda x: F.struct(x["name"].alias("name"), x["count"].alias("count"))).alias("counts"))
    in_order = inputs.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "name"))), lambda x: x["name"]).alias("names"))
    results = one.where(plain & (F.col("part") == F.col("parts") - 1)).groupBy(*key).agg(F.min_by("i.icon", "pos").alias("plain_result"))

    out = heads
    for part in (slots, counted, in_order, results):
        out = out.join(part, key, "left")
    three = F.col("station").isin(*ORDERED) & (F.size("names") == len(SLOTS))
    named = F.transform("names", lambda x, i: F.struct(F.array(*map(F.lit, SLOTS))[i].alias("slot"), x.alias("name")))
    own = F.when(slotted, F.col("own_slots")).when(plain & three, named)
    out = out.select(
        "page", "box", "label", "station", F.contains("label", F.lit(SHAPELESS)).alias("shapeless"), F.when(plain & ~F.coalesce(three, F.lit(False)), F.col("counts")).alias("ingredients"), own.alias("slots"),
        F.when(slotted, F.col("slot_result")).otherwise(F.col("plain_result")).alias("result"),
    )
    lacks = (F.coalesce("label", F.lit("")) == "") | F.col("station").isNull() | F.col("result").isNull() | (F.greatest(F.size("ingredients"), F.size("slots")) < 1)
    return out.withColumn("failed", F.coalesce(lacks, F.lit(True)))
