"""Rectangles as columns: structs with x0, y0, x1, y1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIDES = ("x0", "y0", "x1", "y1")


def rect(x0, y0, x1, y1) -> Column:
    return F.struct(*[(F.col(v) if isinstance(v, str) else v).cast("double").alias(n) for n, v in zip(SIDES, (x0, y0, x1, y1))])


def _s(r: Column, n: str) -> Column:
    return r.getField(n)


def width(r: Column) -> Column:
    return _s(r, "x1") - _s(r, "x0")


def height(r: Column) -> Column:
    return _s(r, "y1") - _s(r, "y0")


def area(r: Column) -> Column:
    return F.greatest(width(r), F.lit(0.0)) * F.greatest(height(r), F.lit(0.0))


def centre(r: Column) -> tuple[Column, Column]:
    return (_s(r, "x0") + _s(r, "x1")) / 2, (_s(r, "y0") + _s(r, "y1")) / 2


def intersection(a: Column, b: Column) -> Column:
    return F.struct(*[(F.greatest if n.endswith("0") else F.least)(_s(a, n), _s(b, n)).alias(n) for n in SIDES])


def union(a: Column, b: Column) -> Column:
    return F.struct(*[(F.least if n.endswith("0") else F.greatest)(_s(a, n), _s(b, n)).alias(n) for n in SIDES])


def intersects(a: Column, b: Column) -> Column:
    return (_s(a, "x0") < _s(b, "x1")) & (_s(b, "x0") < _s(a, "x1")) & (_s(a, "y0") < _s(b, "y1")) & (_s(b, "y0") < _s(a, "y1"))


def contains_point(r: Column, x: Column, y: Column, slack: float = 0.0) -> Column:
    return x.between(_s(r, "x0") - slack, _s(r, "x1") + slack) & y.between(_s(r, "y0") - slack, _s(r, "y1") + slack)


def grown(r: Column, by: float) -> Column:
    return F.struct(*[(_s(r, n) + (-by if n.endswith("0") else by)).alias(n) for n in SIDES])


def hull(r: Column) -> Column:
    """Aggregate: the box around all rectangles of a group."""
    return F.struct(*[(F.min if n.endswith("0") else F.max)(_s(r, n)).alias(n) for n in SIDES])


def side(r: Column, page_width: Column, full: float = 0.6) -> Column:
    """Column that a box stands in: left, right, or full width."""
    return F.when(width(r) > page_width * full, "F").when(centre(r)[0] < page_width * 0.5, "L").otherwise("R")


def points(pixels: Column) -> Column:
    """Pixels at 300 per inch as points."""
    return pixels / 300 * 72


def half_even(c: Column, digits: int) -> Column:
    return F.bround(c, digits)
