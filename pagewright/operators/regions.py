"""Which regions of a page stay, and which belong together."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import geometry as g

# Labels of the page layout model by the kinds they stand for; all others are text.
LABELS_OF_KIND = {
    "title": ("paragraph_title", "doc_title"), "table": ("table",), "figure": ("image", "chart", "seal"), "ornament": ("header_image", "footer_image"),
    "caption": ("figure_title", "table_title", "chart_title", "vision_footnote"), "header": ("header",), "footer": ("footer",), "page_number": ("number",),
}
TEXT_KINDS = ("text", "title", "sidebar", "caption")
MAIN_KINDS = (*TEXT_KINDS, "table")
NOTE_KINDS = ("text", "sidebar")
PAGE = ("book", "page")


@dataclass(frozen=True)
class RegionRules:
    """What is dropped: kinds, regions at the page's edge, outside its content or too small."""

    drop_kinds: tuple[str, ...] = ("header", "footer", "page_number", "ornament", "figure")
    keep_inside: float = 0.5
    edge_touch: float = 0.01
    min_area: float = 0.0004
    clip: bool = True
    min_ink: float = 0.003
    inside: float = 0.7
    note_width: float = 0.3
    note_tolerance: float = 0.02


def kind_of(label: Column) -> Column:
    """The kind that a model's label stands for; unknown labels are text."""
    pairs = [F.lit(x) for kind, labels in LABELS_OF_KIND.items() for name in labels for x in (name, kind)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), label), F.lit("text"))


def drop_reason(kind: Column, b: Column, content: Column, page_width: Column, page_height: Column, rules: RegionRules = RegionRules()) -> Column:
    """Why a region is dropped, null where it stays; the first reason that holds."""
    ex, ey = page_width * rules.edge_touch, page_height * rules.edge_touch
    at_edge = (b["x0"] <= ex) | (b["y0"] <= ey) | (b["x1"] >= page_width - ex) | (b["y1"] >= page_height - ey)
    reason = F.when(kind.isin(*rules.drop_kinds), F.concat(F.lit("kind:"), kind))
    if rules.edge_touch:
        reason = reason.when(at_edge, "edge")
    return reason.when(g.overlap_ratio(b, content) < rules.keep_inside, "margin").when(g.area(b) < page_width * page_height * rules.min_area, "tiny")


def filter_regions(regions: DataFrame, pages: DataFrame, rules: RegionRules = RegionRules()) -> DataFrame:
    """`regions` with `dropped` filled and the boxes of those that stay clipped to the page's content.

    `pages` has book, page, width, height and content; where `regions` has an `ink` share, near-empty ones other
    than tables are dropped too. Regions that were dropped before keep their reason, those of unknown pages stay."""
    sheet = pages.select(*PAGE, F.col("width").alias("_w"), F.col("height").alias("_h"), F.col("content").alias("_content"))
    out = regions.join(sheet, list(PAGE), "left")
    reason = drop_reason(F.col("kind"), F.col("box"), F.col("_content"), F.col("_w"), F.col("_h"), rules)
    out = out.withColumn("dropped", F.coalesce("dropped", F.when(F.col("_content").isNotNull(), reason)))
    if rules.clip:
        out = out.withColumn("box", F.when(F.col("dropped").isNull() & F.col("_content").isNotNull(), g.intersection(F.col("box"), F.col("_content"))).otherwise(F.col("box")))
    if "ink" in regions.columns:
        empty = F.col("dropped").isNull() & (F.col("kind") != "table") & (F.col("ink") < rules.min_ink)
        out = out.withColumn("dropped", F.when(empty, "empty").otherwise(F.col("dropped")))
    return out.drop("_w", "_h", "_content")


def containers(regions: DataFrame, inside: float = 0.7) -> DataFrame:
    """(book, page, id, parts) of the kept regions that hold two or more regions of their kind."""
    kept = regions.where("dropped is null and box is not null").select(*PAGE, "id", "kind", "box")
    part = kept.select(*PAGE, "kind", F.col("id").alias("part"), F.col("box").alias("part_box"))
    pairs = kept.join(part, [*PAGE, "kind"]).where((F.col("id") != F.col("part")) & (g.overlap_ratio(F.col("part_box"), F.col("box")) >= inside))
    return pairs.groupBy(*PAGE, "id").agg(F.count("*").alias("parts")).where("parts >= 2")


def common_areas(boxes: np.ndarray) -> np.ndarray:
    """The area that each two boxes have in common; a box's own area on the diagonal."""
    low, high = np.maximum(boxes[:, None, :2], boxes[None, :, :2]), np.minimum(boxes[:, None, 2:], boxes[None, :, 2:])
    return np.clip(high - low, 0, None).prod(2)


def nested_reasons(regions: list[tuple[str, float, float, float, float]], inside: float = 0.7) -> list[str | None]:
    """Why each of a page's kept regions (kind, x0, y0, x1, y1), in order, goes: containers of two or more of their
    kind first, then, one region after another, the smaller one nested in it."""
    n = len(regions)
    common = common_areas(np.array([r[1:] for r in regions], float).reshape(n, 4))
    size, kinds = np.diag(common), np.array([r[0] for r in regions], object)
    # holds[j, i]: region j holds region i
    holds = (common >= inside * size[None, :]) & (size[None, :] > 0) & (kinds[:, None] == kinds[None, :]) & ~np.eye(n, dtype=bool)
    container = holds.sum(1) >= 2
    gone = container.copy()
    for j, i in zip(*np.nonzero(holds & ~container[:, None] & (size[None, :] <= size[:, None]))):
        gone[i] |= not gone[j]
    return ["container" if c else "duplicate" if g else None for c, g in zip(container, gone)]


def dedupe(regions: DataFrame, inside: float = 0.7) -> DataFrame:
    """`regions` (book, page, id, kind, box, dropped) with containers and duplicates dropped. The second pass
    depends on order, so each page's kept regions, some tens of rows, are one array."""
    columns = regions.select(*PAGE, "id", "kind", "box", "dropped")
    open_ones = columns.where("dropped is null and box is not null")

    @F.pandas_udf("array<string>")
    def reasons(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: nested_reasons([(r["kind"], *(r["box"][c] for c in ("x0", "y0", "x1", "y1"))) for r in p], inside))

    per_page = open_ones.groupBy(*PAGE).agg(F.sort_array(F.collect_list(F.struct("id", "kind", "box"))).alias("_r"))
    done = per_page.withColumn("_why", reasons("_r")).select(*PAGE, F.explode(F.arrays_zip("_r", "_why")).alias("z"))
    done = done.select(*PAGE, "z._r.id", "z._r.kind", "z._r.box", F.col("z._why").alias("dropped"))
    return columns.where("dropped is not null or box is null").unionByName(done)


def merged_boxes(boxes: list[tuple[float, float, float, float]], pad: float = 0.0) -> list[tuple[float, float, float, float]]:
    """Boxes that overlap, after padding, united until none do; touching is no overlap. A union may reach boxes that
    neither part did, so this is no search for connected components."""
    at = np.array(boxes, float).reshape(-1, 4)
    while len(at):
        wide = at + np.array([-pad, -pad, 0, 0]) + np.array([0, 0, pad, pad])
        meets = (np.maximum(at[:, None, :2], wide[None, :, :2]) < np.minimum(at[:, None, 2:], wide[None, :, 2:])).all(2)
        meets = np.tril(meets, -1)  # of two boxes the earlier one is padded
        meets |= meets.T
        np.fill_diagonal(meets, True)
        leader = meets.argmax(1)  # the first box that each one meets
        if (leader == np.arange(len(at))).all():
            return [tuple(map(float, b)) for b in at]
        groups = [at[leader == k] for k in np.unique(leader)]
        at = np.array([[*g[:, :2].min(0), *g[:, 2:].max(0)] for g in groups])
    return []


def merge_frames(frames: DataFrame) -> DataFrame:
    """(book, page, frame_id, box): the frames of each page, overlapping ones united, numbered from 0."""

    box_type = "array<struct<x0:double,y0:double,x1:double,y1:double>>"

    @F.pandas_udf(box_type)
    def united(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: [dict(zip(("x0", "y0", "x1", "y1"), b)) for b in merged_boxes([tuple(f["box"][c] for c in ("x0", "y0", "x1", "y1")) for f in p])])

    per_page = frames.where("box is not null").groupBy(*PAGE).agg(F.sort_array(F.collect_list(F.struct("frame_id", "box"))).alias("_f"))
    return per_page.select(*PAGE, F.posexplode(united("_f")).alias("frame_id", "box"))


def used_frames(regions: DataFrame, frames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The frames that are used, (book, page, frame_id, box), numbered anew from 0, and (book, page, id, grp): the frame that
    each kept region's centre lies in, the first of several. A frame is not used that pictures cover (dropped ones
    count), that a table or figure fills, or that holds no text."""
    pictures = regions.where(F.col("kind").isin("figure", "ornament")).select(*PAGE, F.col("box").alias("picture"))
    covered = frames.join(pictures, list(PAGE), "left").groupBy(*PAGE, "frame_id").agg(F.first("box").alias("box"), F.sum(F.coalesce(g.area(g.intersection(F.col("box"), F.col("picture"))), F.lit(0.0))).alias("covered"))
    clear = merge_frames(covered.where(F.col("covered") < 0.3 * g.area(F.col("box"))))
    kept = regions.where("dropped is null and box is not null").select(*PAGE, "id", "kind", F.col("box").alias("region_box"))
    inside = clear.join(kept, list(PAGE)).where(g.contains(F.col("box"), g.centre_x(F.col("region_box")), g.centre_y(F.col("region_box"))))
    filled = F.max((F.col("kind").isin("table", "figure") & (g.area(F.col("region_box")) > 0.6 * g.area(F.col("box")))).cast("int"))
    used = inside.groupBy(*PAGE, "frame_id", "box").agg(filled.alias("filled"), F.max(F.col("kind").isin(*TEXT_KINDS).cast("int")).alias("has_text")).where("filled = 0 and has_text = 1")
    numbered = used.withColumn("grp", F.row_number().over(Window.partitionBy(*PAGE).orderBy("frame_id")) - 1).select(*PAGE, "frame_id", "box", "grp")
    groups = inside.select(*PAGE, "id", "frame_id").join(numbered.drop("box"), [*PAGE, "frame_id"]).groupBy(*PAGE, "id").agg(F.min("grp").alias("grp"))
    return numbered.select(*PAGE, F.col("grp").alias("frame_id"), "box"), groups


def frame_groups(regions: DataFrame, frames: DataFrame) -> DataFrame:
    """(book, page, id, grp): the used frame that each kept region's centre lies in."""
    return used_frames(regions, frames)[1]


def margin_notes(regions: DataFrame, pages: DataFrame, rules: RegionRules = RegionRules()) -> DataFrame:
    """(book, page, id, side, ord): narrow text blocks wholly left or right of the main text, top to bottom.

    The main text reaches from the left edge of the leftmost wide region to the right edge of the rightmost one;
    a page without wide regions has no notes."""
    sheet = pages.select(*PAGE, g.width(F.col("content")).alias("_cw"))
    kept = regions.where("dropped is null and box is not null").join(sheet, list(PAGE)).withColumn("_w", g.width(F.col("box")))
    wide = kept.where(F.col("kind").isin(*MAIN_KINDS) & (F.col("_w") > rules.note_width * F.col("_cw")))
    main = wide.groupBy(*PAGE).agg(F.min("box.x0").alias("_left"), F.max("box.x1").alias("_right"))
    narrow = kept.where(F.col("kind").isin(*NOTE_KINDS) & (F.col("_w") <= rules.note_width * F.col("_cw"))).join(main, list(PAGE))
    slack = F.col("_cw") * rules.note_tolerance
    sides = F.filter(F.array(F.when(F.col("box.x1") <= F.col("_left") + slack, "left"), F.when(F.col("box.x0") >= F.col("_right") - slack, "right")), lambda s: s.isNotNull())
    order = Window.partitionBy(*PAGE, "side").orderBy("box.y0", "id")
    return narrow.withColumn("side", F.explode(sides)).select(*PAGE, "id", "side", (F.row_number().over(order) - 1).alias("ord"))


def latest_regions(regions: DataFrame) -> DataFrame:
    """Regions delivered more than once under one region_id, once: the one with the highest score, nulls last."""
    best = Window.partitionBy("region_id").orderBy(F.col("score").desc_nulls_last(), "id")
    return regions.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n")

