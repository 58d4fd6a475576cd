"""Lines into paragraphs, and paragraphs over column and page breaks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import reconcile as r
from ..functions import text as t


def _at(sorted_values: Column, share: Column) -> Column:
    """The element of a sorted array that stands at a share of its size, rounded down."""
    return F.get(sorted_values, share.cast("int"))


def paragraph_breaks(lines: DataFrame, keys: list[str], hanging: bool = False) -> DataFrame:
    """`lines` (keys, line_no, text, box, par) with `breaks`: whether a paragraph begins there.

    A bullet always begins one; nothing else does inside a sentence; a numbered item does after one. Else, where
    all lines of the region have a box, a wide gap, an indent or a short line before it decides, and otherwise a
    change of `par`. With `hanging`, lines at the left edge begin entries, unless the first line is indented.
    Null texts count as empty; the first line of a region never breaks."""
    region = Window.partitionBy(*keys)
    order = region.orderBy("line_no")
    out = lines.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("_prev", F.lag("text").over(order)).withColumn("_pbox", F.lag("box").over(order)).withColumn("_ppar", F.lag("par").over(order))
    out = out.withColumn("_n", F.count("*").over(region)).withColumn("_geo", F.count("box").over(region) == F.col("_n"))
    gap = F.col("box.y0") - F.col("_pbox.y1")
    out = out.withColumn("_h", F.median(F.col("box.y1") - F.col("box.y0")).over(region)).withColumn("_g", F.coalesce(F.median(F.greatest(F.lit(0.0), gap)).over(region), F.lit(0.0)))
    out = out.withColumn("_h", F.when(F.col("_h") == 0, 1.0).otherwise(F.col("_h")))
    out = out.withColumn("_x0", F.sort_array(F.collect_list("box.x0").over(region))).withColumn("_x1", F.sort_array(F.collect_list("box.x1").over(region)))
    left, right = _at(F.col("_x0"), F.floor(F.col("_n") / 10)), _at(F.col("_x1"), F.floor(F.col("_n") * 9 / 10))
    h, g = F.col("_h"), F.col("_g")
    by_place = (gap > F.greatest(1.8 * g, g + 0.5 * h)) | (F.col("box.x0") - left > 0.9 * h) | (right - F.col("_pbox.x1") > 2.0 * h)
    normal = F.when(t.is_bullet(F.col("text")), True).when(~t.ends_sentence(F.col("_prev")), False).when(t.is_item(F.col("text")), True).when(F.col("_geo"), by_place).otherwise(~F.col("par").eqNullSafe(F.col("_ppar")))
    if hanging:
        first_x0 = F.first("box.x0").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        entry = (F.col("box.x0") - left < 0.5 * h) & ~F.regexp_replace("_prev", r"[\s\p{Z}]+$", "").rlike("[-–]$")
        out = out.withColumn("_entries", F.col("_geo") & (first_x0 - left < 0.6 * h))
        normal = F.when(F.col("_entries"), entry).otherwise(normal)
    breaks = F.when(F.col("_prev").isNull(), False).otherwise(F.coalesce(normal, F.lit(False)))
    made = ("_prev", "_pbox", "_ppar", "_n", "_geo", "_h", "_g", "_x0", "_x1", "_entries")
    return out.withColumn("breaks", breaks).drop(*made)


def paragraphs(lines: DataFrame, keys: list[str], hanging: bool = False, known: frozenset[str] | None = None) -> DataFrame:
    """`keys`, par_no, text, n_lines: the paragraphs of each region. Lines are cleaned and blank ones dropped first.
    With `known` words (a checked, bounded list) joins are decided by it."""
    cleaned = lines.withColumn("text", t.clean(F.col("text"))).where("text <> ''")
    broken = paragraph_breaks(cleaned, keys, hanging).withColumn("par_no", F.sum(F.col("breaks").cast("int")).over(Window.partitionBy(*keys).orderBy("line_no")).cast("int"))
    pieces = broken.groupBy(*keys, "par_no").agg(F.sort_array(F.collect_list(F.struct("line_no", "text")))["text"].alias("_pieces"))
    return pieces.select(*keys, "par_no", joined(F.col("_pieces"), known).alias("text"), F.size("_pieces").alias("n_lines"))


def joined(pieces: Column, known: frozenset[str] | None = None) -> Column:
    """An array of pieces as one text, in SQL without a word list and in Arrow batches with one."""
    if known is None:
        return t.fold(pieces)

    @F.pandas_udf("string")
    def by_words(batch: pd.Series) -> pd.Series:
        return batch.map(lambda p: r.join_all(list(p), known.__contains__))

    return by_words(pieces)


def single_line(lines: DataFrame, keys: list[str], known: frozenset[str] | None = None) -> DataFrame:
    """`keys`, text: titles and captions, all lines as one."""
    cleaned = lines.withColumn("text", t.clean(F.col("text"))).where("text <> ''")
    pieces = cleaned.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("line_no", "text")))["text"].alias("_pieces"))
    return pieces.select(*keys, joined(F.col("_pieces"), known).alias("text"))


def continuation_islands(items: DataFrame, keys: tuple[str, ...] = ("book",)) -> DataFrame:
    """`items` (book, seq, type, text, grp, standalone) of type para and heading with `island`: the seq of the item in
    which the text that an item belongs to begins.

    Texts flow on within a book's main text, or within what else `keys` part, and within each group. A paragraph goes on with the paragraph before it in
    its flow unless that ends a sentence, a heading stands between, or it stands alone itself."""
    flow = Window.partitionBy(*keys, "grp").orderBy("seq")
    kept = items.where(F.col("type").isin("para", "heading"))
    before_type, before_text = F.lag("type").over(flow), F.lag("text").over(flow)
    goes_on = (F.col("type") == "para") & (before_type == "para") & ~F.coalesce("standalone", F.lit(False)) & t.should_continue(before_text, F.col("text"))
    marked = kept.withColumn("_start", F.when(F.coalesce(goes_on, F.lit(False)), None).otherwise(F.col("seq")))
    return marked.withColumn("island", F.last("_start", ignorenulls=True).over(flow.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_start")


def merge_continuations(items: DataFrame, known: frozenset[str] | None = None, keys: tuple[str, ...] = ("book",)) -> DataFrame:
    """`items` with paragraphs that go on joined, at the place of their first piece; seq is unique within `keys`."""
    islands = continuation_islands(items, keys)
    pieces = islands.groupBy(*keys, "grp", "island").agg(F.sort_array(F.collect_list(F.struct("seq", "text")))["text"].alias("_pieces"))
    first = islands.where("seq = island").join(pieces.where("size(_pieces) > 1").select(*keys, F.col("island").alias("seq"), "_pieces"), [*keys, "seq"], "left")
    text = F.when(F.col("_pieces").isNotNull(), joined(F.col("_pieces"), known)).otherwise(F.col("text"))
    merged = first.withColumn("text", text).select(*items.columns)
    return merged.unionByName(items.where(~F.coalesce(F.col("type").isin("para", "heading"), F.lit(False))))
