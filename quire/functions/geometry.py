"""Boxes as column expressions. Doubles; nulls give nulls; nothing is rounded."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Slack at the page's edge and the least size of a box, in points; the least overlap of a match.
PAGE_SLACK = 0.5
LEAST_SIZE = 0.5
MATCH_OVERLAP = 0.75


def is_finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


@dataclass
class Interval:
    low: Column
    high: Column
    changed: Column
    valid: Column


def expand(low: Column, high: Column, limit: Column, least: float = LEAST_SIZE) -> Interval:
    """An interval without extent grown to ``least`` around its place, inside 0..limit; one with extent stays.

    ``valid`` is false for a place outside the limits or limits that are too close; the bounds are null then.
    """
    flat = ~(high > low)
    ok = ~flat | ((low >= 0) & (low <= limit) & (limit >= least))
    a = F.greatest(F.lit(0.0), low - least / 2)
    b = F.least(limit, a + least)
    a = F.when(b - a < least, F.greatest(F.lit(0.0), b - least)).otherwise(a)
    ok = ok & (~flat | (b > a))
    return Interval(F.when(ok, F.when(flat, a).otherwise(low)), F.when(ok, F.when(flat, b).otherwise(high)), flat, ok)


def page_box(left: Column, top: Column, right: Column, bottom: Column, width: Column, height: Column) -> dict[str, Column]:
    """A parser's box sorted, clamped to its page and grown if flat.

    ``problem`` names the first reason for which a box is rejected; its bounds are null then.
    """
    x0, x1, y0, y1 = F.least(left, right), F.greatest(left, right), F.least(top, bottom), F.greatest(top, bottom)
    outside = (x0 < -PAGE_SLACK) | (y0 < -PAGE_SLACK) | (x1 > width + PAGE_SLACK) | (y1 > height + PAGE_SLACK)
    inside = lambda v, limit: F.least(F.greatest(v, F.lit(0.0)), limit)
    cx0, cx1, cy0, cy1 = inside(x0, width), inside(x1, width), inside(y0, height), inside(y1, height)
    ex, ey = expand(cx0, cx1, width), expand(cy0, cy1, height)
    problem = (
        F.when(left.isNull() | top.isNull() | right.isNull() | bottom.isNull(), "invalid_box")
        .when(~(is_finite(left) & is_finite(top) & is_finite(right) & is_finite(bottom)), "non_finite")
        .when(width.isNull() | height.isNull(), "unknown_page")
        .when(outside, "outside_page")
        .when(~(ex.valid & ey.valid), "not_expandable")
    )
    good = problem.isNull()
    return {
        "x0": F.when(good, ex.low), "y0": F.when(good, ey.low), "x1": F.when(good, ex.high), "y1": F.when(good, ey.high),
        "clamped": good & ((cx0 != x0) | (cx1 != x1) | (cy0 != y0) | (cy1 != y1)),
        "expanded": good & (ex.changed | ey.changed),
        "problem": problem,
    }


def block_box(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column) -> dict[str, Column]:
    """A block's box under the strict rule: neither sorted nor clamped; flat sides are grown."""
    ex, ey = expand(x0, x1, width), expand(y0, y1, height)
    problem = (
        F.when(x0.isNull() | y0.isNull() | x1.isNull() | y1.isNull(), "invalid_box")
        .when(~(is_finite(x0) & is_finite(y0) & is_finite(x1) & is_finite(y1)), "non_finite")
        .when((x1 < x0) | (y1 < y0), "inverted")
        .when((x0 < 0) | (y0 < 0) | (x1 > width) | (y1 > height), "outside_page")
        .when(~(ex.valid & ey.valid), "not_expandable")
    )
    good = problem.isNull()
    return {
        "x0": F.when(good, ex.low), "y0": F.when(good, ey.low), "x1": F.when(good, ex.high), "y1": F.when(good, ey.high),
        "expanded": good & ((x1 == x0) | (y1 == y0)), "problem": problem,
    }


def from_thousandths(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column) -> dict[str, Column]:
    """A box in thousandths of the page as page units; null bounds if it is flat, inverted or outside 0..1000."""
    ok = is_finite(x0) & is_finite(y0) & is_finite(x1) & is_finite(y1) & (x0 >= 0) & (y0 >= 0) & (x1 <= 1000) & (y1 <= 1000) & (x1 > x0) & (y1 > y0)
    ok = F.coalesce(ok, F.lit(False))
    return {
        "x0": F.when(ok, x0 * width / 1000), "y0": F.when(ok, y0 * height / 1000), "x1": F.when(ok, x1 * width / 1000), "y1": F.when(ok, y1 * height / 1000),
        "valid": ok,
    }


def overlap(a: list[Column], b: list[Column]) -> Column:
    """Intersection over union of two boxes ``x0, y0, x1, y1``; 0 where they do not overlap."""
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    shared = w * h
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - shared
    return F.when((w <= 0) | (h <= 0) | (union <= 0), 0.0).otherwise(shared / union)


def label_box(x: Column, y: Column, font: Column, length: Column, width: Column, height: Column) -> dict[str, Column]:
    """The box of a label on its page as shares of the page, from its baseline and the number of its characters."""
    across = F.greatest(font, F.least(F.lit(240.0), length * font * 0.6))
    return {
        "x0": F.greatest(F.lit(0.0), x / width),
        "y0": F.greatest(F.lit(0.0), (height - (y + font)) / height),
        "x1": F.least(F.lit(1.0), (x + across) / width),
        "y1": F.least(F.lit(1.0), (height - (y - F.greatest(F.lit(1.0), font * 0.25))) / height),
    }


def image_dpi(px_width: Column, px_height: Column, width: Column, height: Column) -> Column:
    return F.least(px_width / (width / 72), px_height / (height / 72))


def scan_like(text_characters: Column, images: Column, px_width: Column, px_height: Column, width: Column, height: Column, tolerance: float = 0.05) -> Column:
    """Whether a page is one image in its own proportions, without text."""
    page = width / height
    return (text_characters == 0) & (images == 1) & (F.abs(px_width / px_height - page) / page <= tolerance)


def polygon_box(points: Column) -> dict[str, Column]:
    """The box around an array of ``[x, y]`` points."""
    xs, ys = F.transform(points, lambda p: F.get(p, 0)), F.transform(points, lambda p: F.get(p, 1))
    return {"x0": F.array_min(xs), "y0": F.array_min(ys), "x1": F.array_max(xs), "y1": F.array_max(ys)}
