"""Geometry of boxes as column expressions. A box is a struct<x, y, w, h>; all functions stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

Box = Column


def box(x: Column, y: Column, w: Column, h: Column) -> Box:
    """A box; null if any side is."""
    sides = [F.lit(v) if not isinstance(v, Column) else v for v in (x, y, w, h)]
    known = sides[0].isNotNull() & sides[1].isNotNull() & sides[2].isNotNull() & sides[3].isNotNull()
    return F.when(known, F.struct(*[v.alias(n) for v, n in zip(sides, "xywh", strict=True)]))


def side(b: Box, name: str) -> Column:
    """A side of a box, 0 where it is missing."""
    return F.coalesce(b.getField(name).cast("double"), F.lit(0.0))


def to_int(value: Column) -> Column:
    """Rounded half to even, as contract boxes are."""
    return F.bround(value).cast("int")


def rounded(x: Column, y: Column, w: Column, h: Column) -> Box:
    """An integer box; negative extents become 0."""
    return box(to_int(x), to_int(y), F.greatest(F.lit(0), to_int(w)), F.greatest(F.lit(0), to_int(h)))


def from_corners(corners: Column, scale_x=1.0, scale_y=1.0, offset_x=0.0, offset_y=0.0, order: str = "clip") -> Box:
    """Box of [x0, y0, x1, y1]. ``order``: "clip" leaves inverted corners empty, "swap" swaps them axis by axis."""

    def of(c: Column) -> Box:
        x0, y0, x1, y1 = (F.try_element_at(c, F.lit(i + 1)).cast("double") for i in range(4))
        if order == "swap":
            x0, x1, y0, y1 = F.least(x0, x1), F.greatest(x0, x1), F.least(y0, y1), F.greatest(y0, y1)
        known = (F.size(c) >= 4) & x0.isNotNull() & y0.isNotNull() & x1.isNotNull() & y1.isNotNull()
        return F.when(known, rounded(x0 * scale_x + offset_x, y0 * scale_y + offset_y, (x1 - x0) * scale_x, (y1 - y0) * scale_y))

    return let(corners, of)


def from_points(points: Column, scale_x=1.0, scale_y=1.0, offset_x=0.0, offset_y=0.0) -> Box:
    """Bounding box of a list of [x, y] points."""
    axis = lambda i: F.transform(points, lambda p: p[i].cast("double"))
    ends = F.struct(*[f(axis(i)).alias(f"{n}{k}") for i, n in enumerate("xy") for k, f in enumerate((F.array_min, F.array_max))])
    return let(ends, lambda e: rounded(e["x0"] * scale_x + offset_x, e["y0"] * scale_y + offset_y, (e["x1"] - e["x0"]) * scale_x, (e["y1"] - e["y0"]) * scale_y))


def from_polygon(numbers: Column, **scales) -> Box:
    """Bounding box of a flat polygon [x0, y0, x1, y1, ...] of at least four points."""
    points = lambda n: F.transform(F.sequence(F.lit(0), F.floor(F.size(n) / 2).cast("int") - 1), lambda i: F.slice(n, i * 2 + 1, 2))
    return let(numbers, lambda n: F.when(F.size(n) >= 8, from_points(points(n), **scales)))


def from_any(value: Column, **scales) -> Box:
    """Box of a flat number list: corners, or a polygon when it has eight numbers or more."""
    return let(value, lambda v: F.when(F.size(v) >= 8, from_polygon(v, **scales)).otherwise(from_corners(v, order="swap", **scales)))


def from_open(value: Column, scale_x=1.0, scale_y=1.0, offset_x=0.0, offset_y=0.0) -> Box:
    """Box of an open value (VARIANT): an object with x, y, w and h, a flat list of corners or of a polygon, or a list of points; null if it is none of these.

    Points without two numbers are left out.
    """
    scales = {"scale_x": scale_x, "scale_y": scale_y, "offset_x": offset_x, "offset_y": offset_y}
    numbers = lambda p: F.transform(F.try_variant_get(p, "$", "array<variant>"), lambda n: F.try_variant_get(n, "$", "double"))
    whole = lambda p: F.get(p, F.lit(0)).isNotNull() & F.get(p, F.lit(1)).isNotNull()

    def of_map(m: Column) -> Box:
        known = m["x"].isNotNull() & m["y"].isNotNull() & m["w"].isNotNull() & m["h"].isNotNull()
        return F.when(known, rounded(m["x"] * scale_x + offset_x, m["y"] * scale_y + offset_y, m["w"] * scale_x, m["h"] * scale_y))

    def of_list(flat: Column) -> Box:
        return F.when((F.size(flat) >= 4) & F.forall(flat, lambda n: n.isNotNull()), from_any(flat, **scales))

    def of_points(points: Column) -> Box:
        return F.when(F.size(points) > 0, from_points(points, **scales))

    def of(v: Column) -> Box:
        sides = F.struct(*[F.try_variant_get(v, f"$.{name}", "double").alias(name) for name in "xywh"])
        points = F.filter(F.transform(F.try_variant_get(v, "$", "array<variant>"), numbers), whole)
        return F.coalesce(let(sides, of_map), let(F.try_variant_get(v, "$", "array<double>"), of_list), let(points, of_points))

    return let(value, of)


def scale_factor(target: Column, source: Column) -> Column:
    """target / source, 1 where either is missing or 0."""
    return F.when((source > 0) & (target > 0), target / source).otherwise(F.lit(1.0))


def right(b: Box) -> Column:
    return side(b, "x") + side(b, "w")


def bottom(b: Box) -> Column:
    return side(b, "y") + side(b, "h")


def center_x(b: Box) -> Column:
    return side(b, "x") + side(b, "w") / 2.0


def center_y(b: Box) -> Column:
    return side(b, "y") + side(b, "h") / 2.0


def center_inside(inner: Box, outer: Box) -> Column:
    """Whether the centre of ``inner`` is in ``outer``, borders included."""
    cx, cy = center_x(inner), center_y(inner)
    return (cx >= side(outer, "x")) & (cx <= right(outer)) & (cy >= side(outer, "y")) & (cy <= bottom(outer))


def intersection(a: Box, b: Box) -> Column:
    w = F.least(right(a), right(b)) - F.greatest(side(a, "x"), side(b, "x"))
    h = F.least(bottom(a), bottom(b)) - F.greatest(side(a, "y"), side(b, "y"))
    return F.when((w > 0) & (h > 0), w * h).otherwise(F.lit(0.0))


def touching(a: Box, b: Box) -> Column:
    """Whether two boxes have an area in common: four comparisons that spare most pairs of a page the measures."""
    return (a["x"] < right(b)) & (b["x"] < right(a)) & (a["y"] < bottom(b)) & (b["y"] < bottom(a))


def area(b: Box) -> Column:
    return side(b, "w") * side(b, "h")


def _measured(a: Box, b: Box, measure) -> Column:
    """``measure`` of boxes that meet, 0 for others.

    It is called, not inlined: in a join's condition the nested terms, written out, make a method that the JVM does not compile for its size.
    """
    meet = (side(a, "x") < right(b)) & (side(b, "x") < right(a)) & (side(a, "y") < bottom(b)) & (side(b, "y") < bottom(a))
    return F.when(meet, let(F.struct(a.alias("a"), b.alias("b")), lambda p: measure(p["a"], p["b"]))).otherwise(F.lit(0.0))


def iou(a: Box, b: Box) -> Column:
    """Intersection over union; 0 for empty unions."""

    def of(a: Box, b: Box) -> Column:
        both = intersection(a, b)
        union = area(a) + area(b) - both
        return F.when(union > 0, both / union).otherwise(F.lit(0.0))

    return _measured(a, b, of)


def overlap(a: Box, b: Box) -> Column:
    """Intersection over the smaller area, areas being 1 at least."""
    one = F.lit(1.0)
    return _measured(a, b, lambda a, b: intersection(a, b) / F.least(F.greatest(one, area(a)), F.greatest(one, area(b))))


def center_distance(a: Box, b: Box) -> Column:
    """Distance of centres (sum over both axes) in units of the longest side."""
    longest = F.greatest(F.lit(1.0), side(a, "w"), side(a, "h"), side(b, "w"), side(b, "h"))
    return (F.abs(center_x(a) - center_x(b)) + F.abs(center_y(a) - center_y(b))) / longest


def _axis_overlap(a0: Column, a1: Column, b0: Column, b1: Column, shorter: Column) -> Column:
    common = F.least(a1, b1) - F.greatest(a0, b0)
    return F.when(common > 0, common / F.greatest(F.lit(1.0), shorter)).otherwise(F.lit(0.0))


def vertical_overlap(a: Box, b: Box) -> Column:
    return _axis_overlap(side(a, "y"), bottom(a), side(b, "y"), bottom(b), F.least(side(a, "h"), side(b, "h")))


def horizontal_overlap(a: Box, b: Box) -> Column:
    return _axis_overlap(side(a, "x"), right(a), side(b, "x"), right(b), F.least(side(a, "w"), side(b, "w")))


# When a box goes on another, beside it or below.
BESIDE_SHARE, BELOW_SHARE, REACH, REACH_SIZES = 0.45, 0.35, 48.0, 2.5
BACK, BACK_SIZES, RISE, RISE_SIZES = 6.0, 0.5, 4.0, 0.25


def _reach(*sizes: Column) -> Column:
    return F.greatest(F.lit(REACH), *[s * REACH_SIZES for s in sizes])


def right_on_line(a: Box, b: Box) -> Column:
    """Whether ``b`` goes on to the right of ``a`` on the same line."""
    gap = side(b, "x") - right(a)
    back = -F.greatest(F.lit(BACK), F.least(side(a, "w"), side(b, "w")) * BACK_SIZES)
    return (vertical_overlap(a, b) >= BESIDE_SHARE) & gap.between(back, _reach(side(a, "h"), side(b, "h")))


def on_next_line(a: Box, b: Box) -> Column:
    """Whether ``b`` goes on below ``a``."""
    gap = F.greatest(F.lit(0.0), side(b, "y") - bottom(a))
    near = F.abs(center_x(b) - center_x(a)) <= _reach(side(a, "w"), side(b, "w"))
    not_above = side(b, "y") >= side(a, "y") - F.greatest(F.lit(RISE), side(a, "h") * RISE_SIZES)
    return not_above & (gap <= _reach(side(a, "h"), side(b, "h"))) & ((horizontal_overlap(a, b) >= BELOW_SHARE) | near)


def quad_points(b: Box) -> Column:
    """The four corners, clockwise from the upper left, to three decimals."""
    x0, y0, x1, y1 = side(b, "x"), side(b, "y"), right(b), bottom(b)
    return F.array(*[F.struct(F.bround(x, 3).alias("x"), F.bround(y, 3).alias("y")) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))])


def pdf_rect(b: Box, source_w: Column, source_h: Column, page_w: Column, page_h: Column) -> Column:
    """A layout box in page points, clipped to the page; the page's own units if the layout has no size."""
    fx, fy = scale_factor(page_w, source_w), scale_factor(page_h, source_h)
    zero = F.lit(0.0)
    x0, y0 = F.greatest(zero, side(b, "x") * fx), F.greatest(zero, side(b, "y") * fy)
    x1, y1 = F.least(page_w.cast("double"), right(b) * fx), F.least(page_h.cast("double"), bottom(b) * fy)
    three = lambda v: F.bround(v, 3)
    return F.struct(
        three(x0).alias("x"), three(y0).alias("y"), three(x1 - x0).alias("w"), three(y1 - y0).alias("h"),
        three(x0).alias("x0"), three(y0).alias("y0"), three(x1).alias("x1"), three(y1).alias("y1"),
    )


def page_margin(b: Box, page_height: Column, share: float = 0.12) -> Column:
    """Whether the centre lies in the top or bottom ``share`` of a page of known height."""
    c = center_y(b)
    return F.coalesce((page_height > 0) & ((c <= page_height * share) | (c >= page_height * (1 - share))), F.lit(False))


def union_box(b: Box) -> Column:
    """Aggregate: the box around all boxes of a group."""
    x0, y0 = F.min(b.getField("x")), F.min(b.getField("y"))
    x1, y1 = F.max(b.getField("x") + b.getField("w")), F.max(b.getField("y") + b.getField("h"))
    return F.struct(x0.alias("x"), y0.alias("y"), (x1 - x0).alias("w"), (y1 - y0).alias("h"))
