"""A page's whole layout from raw regions: what is dropped, what belongs together, and the reading order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed
from . import ordering, regions as rg

PAGE = ("book", "page")


def sidebar_groups(regions: DataFrame, groups: DataFrame) -> DataFrame:
    """(book, page, id, grp): `groups`, and a group of its own for each kept sidebar that is in none, numbered on."""
    base = groups.groupBy(*PAGE).agg((F.max("grp") + 1).alias("_next"))
    alone = regions.where("dropped is null and kind = 'sidebar'").select(*PAGE, "id").join(groups, [*PAGE, "id"], "left_anti")
    order = Window.partitionBy(*PAGE).orderBy("id")
    numbered = alone.join(base, list(PAGE), "left").withColumn("grp", F.coalesce("_next", F.lit(0)) + F.row_number().over(order) - 1)
    return groups.select(*PAGE, "id", F.col("grp").cast("int").alias("grp")).unionByName(numbered.select(*PAGE, "id", F.col("grp").cast("int").alias("grp")))


def note_groups(regions: DataFrame, groups: DataFrame, notes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The groups with the margin notes of a side put into one group each, and those groups (book, page, grp).

    All regions of a group that a note was in go with the note."""
    base = groups.groupBy(*PAGE).agg((F.max("grp") + 1).alias("_next"))
    side = F.when(F.col("side") == "left", 0).otherwise(1)
    fresh = notes.join(base, list(PAGE), "left").select(*PAGE, "id", (F.coalesce("_next", F.lit(0)) + side).cast("int").alias("_note"))
    touched = fresh.join(groups, [*PAGE, "id"]).groupBy(*PAGE, "grp").agg(F.min("_note").alias("_note"))
    moved = groups.join(touched, [*PAGE, "grp"]).select(*PAGE, "id", "_note")
    into = fresh.select(*PAGE, "id", "_note").unionByName(moved).groupBy(*PAGE, "id").agg(F.min("_note").alias("grp"))
    rest = groups.select(*PAGE, "id", "grp").join(into, [*PAGE, "id"], "left_anti")
    return rest.unionByName(into), into.select(*PAGE, "grp").distinct()


def build_layout(regions: DataFrame, pages: DataFrame, frames: DataFrame, rules: rg.RegionRules = rg.RegionRules(), placement: str = "inline", notes: bool = False) -> DataFrame:
    """(book, page, id, kind, box, dropped, grp, ord) of raw regions (book, page, id, kind, box).

    `pages` has book, page, width, height, content and columns, `frames` book, page, frame_id and box. Dropped regions
    keep their reason and have no order; with `notes`, margin notes come after everything else on their page."""
    raw = regions.select(*PAGE, "id", "kind", "box").withColumn("dropped", F.lit(None).cast("string"))
    # each step reads the one before it several times: without a cut between them the plan would double with every step
    kept = checkpointed(rg.dedupe(rg.filter_regions(raw, pages, rules), rules.inside))
    used, in_frames = map(checkpointed, rg.used_frames(kept, frames))
    groups = sidebar_groups(kept, in_frames.select(*PAGE, "id", F.col("grp").cast("int").alias("grp")))
    tail = None
    if notes:
        groups, tail = note_groups(kept, checkpointed(groups), rg.margin_notes(kept, pages, rules))
        tail = checkpointed(tail)
    grouped = checkpointed(kept.join(groups, [*PAGE, "id"], "left"))
    order = ordering.order_regions(grouped, pages, used, placement, tail)
    return grouped.join(order, [*PAGE, "id"], "left").select(*PAGE, "id", "kind", "box", "dropped", "grp", "ord")
