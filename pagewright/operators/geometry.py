"""Rectangles as column expressions. A box is a struct of x0, y0, x1, y1; a null box gives nulls."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F



@dataclass(frozen=True)
class Margins:
    """Shares of the page that are cut off; `inner` is at the spine."""

    top: float = 0.05
    bottom: float = 0.05
    inner: float = 0.04
    outer: float = 0.05

    def __post_init__(self) -> None:
        if any(not 0 <= m < 0.5 for m in (self.top, self.bottom, self.inner, self.outer)):
            raise ValueError("a margin must be at least 0 and under 0.5")


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(x0.cast("double").alias("x0"), y0.cast("double").alias("y0"), x1.cast("double").alias("x1"), y1.cast("double").alias("y1"))


def width(b: Column) -> Column:
    return F.when(b.isNotNull(), F.greatest(F.lit(0.0), b["x1"] - b["x0"]))


def height(b: Column) -> Column:
    return F.when(b.isNotNull(), F.greatest(F.lit(0.0), b["y1"] - b["y0"]))


def area(b: Column) -> Column:
    return width(b) * height(b)


def centre_x(b: Column) -> Column:
    return (b["x0"] + b["x1"]) / 2


def centre_y(b: Column) -> Column:
    return (b["y0"] + b["y1"]) / 2


def intersection(a: Column, b: Column) -> Column:
    """The common part; inverted, so with area 0, where there is none."""
    both = a.isNotNull() & b.isNotNull()
    return F.when(both, box(F.greatest(a["x0"], b["x0"]), F.greatest(a["y0"], b["y0"]), F.least(a["x1"], b["x1"]), F.least(a["y1"], b["y1"])))


def union(a: Column, b: Column) -> Column:
    both = a.isNotNull() & b.isNotNull()
    return F.when(both, box(F.least(a["x0"], b["x0"]), F.least(a["y0"], b["y0"]), F.greatest(a["x1"], b["x1"]), F.greatest(a["y1"], b["y1"])))


def union_of(b: Column) -> Column:
    """Aggregate: the least box around all boxes of a group."""
    return box(F.min(b["x0"]), F.min(b["y0"]), F.max(b["x1"]), F.max(b["y1"]))


def overlap_ratio(a: Column, b: Column) -> Column:
    """The share of `a` that `b` covers; 0 where `a` has no area."""
    return F.coalesce(F.try_divide(area(intersection(a, b)), area(a)), F.lit(0.0))


def contains(b: Column, x: Column, y: Column) -> Column:
    """Whether a point lies in the box, its edges included."""
    return x.between(b["x0"], b["x1"]) & y.between(b["y0"], b["y1"])


def rounded(b: Column) -> Column:
    """Whole coordinates, halves to the even neighbour."""
    return F.when(b.isNotNull(), F.struct(*(F.bround(b[c]).cast("int").alias(c) for c in ("x0", "y0", "x1", "y1"))))


def content_box(page_width: Column, page_height: Column, side: Column, m: Margins = Margins()) -> Column:
    """The page inside its margins; a right page has the spine at its left."""
    left = F.when(side == "right", F.lit(m.inner)).otherwise(F.lit(m.outer))
    right = F.when(side == "right", F.lit(m.outer)).otherwise(F.lit(m.inner))
    return box(page_width * left, page_height * m.top, page_width * (1 - right), page_height * (1 - m.bottom))


def side_of(page: Column, first_page_side: Column) -> Column:
    """Left or right by the parity of the page; skipped pages count."""
    other = F.when(first_page_side == "right", "left").otherwise("right")
    return F.when(F.pmod(page, F.lit(2)) == 1, first_page_side).otherwise(other)


def printed_page(page: Column, offset: Column) -> Column:
    return page + offset


def same_row(a: Column, b: Column) -> Column:
    """Whether two boxes share at least half of the lower one's height."""
    shared = F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
    return shared >= 0.5 * F.least(a["y1"] - a["y0"], b["y1"] - b["y0"])
