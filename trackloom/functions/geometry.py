"""Box geometry as column expressions. A box is a struct with x1, y1, x2, y2."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def box(x1: str = "x1", y1: str = "y1", x2: str = "x2", y2: str = "y2") -> Column:
    return F.struct(F.col(x1).alias("x1"), F.col(y1).alias("y1"), F.col(x2).alias("x2"), F.col(y2).alias("y2"))


def width(b: Column) -> Column:
    return b["x2"] - b["x1"]


def height(b: Column) -> Column:
    return b["y2"] - b["y1"]


def area(b: Column) -> Column:
    """Never negative, also for boxes whose corners are out of order."""
    return F.greatest(F.lit(0.0), width(b)) * F.greatest(F.lit(0.0), height(b))


def centre_x(b: Column) -> Column:
    return (b["x1"] + b["x2"]) / 2


def centre_y(b: Column) -> Column:
    return (b["y1"] + b["y2"]) / 2


def intersection(a: Column, b: Column) -> Column:
    across = F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])
    down = F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])
    return F.greatest(F.lit(0.0), across) * F.greatest(F.lit(0.0), down)


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0 for boxes without area."""
    both = intersection(a, b)
    union = area(a) + area(b) - both
    return F.when(union > 0, both / union).otherwise(F.lit(0.0))


def gap(a: Column, b: Column) -> Column:
    """Distance between the nearest edges, 0 where boxes touch or overlap."""
    across = F.greatest(F.lit(0.0), a["x1"] - b["x2"], b["x1"] - a["x2"])
    down = F.greatest(F.lit(0.0), a["y1"] - b["y2"], b["y1"] - a["y2"])
    return F.sqrt(across * across + down * down)


def centre_distance(a: Column, b: Column) -> Column:
    dx, dy = centre_x(a) - centre_x(b), centre_y(a) - centre_y(b)
    return F.sqrt(dx * dx + dy * dy)


def containment(inner: Column, outer: Column) -> Column:
    """The part of inner's area that lies in outer; 0 if inner has none."""
    return F.when(area(inner) > 0, intersection(inner, outer) / area(inner)).otherwise(F.lit(0.0))


def is_inside(inner: Column, outer: Column, same_from: float = 0.45) -> Column:
    """Whether inner lies wholly in outer and the two aren't the same object boxed twice."""
    whole = F.abs(intersection(inner, outer) - area(inner)) <= 1e-9 * area(inner)
    return (area(inner) > 0) & (iou(inner, outer) < same_from) & whole


def relative_pose(inner: Column, outer: Column, eps: float = 1e-6) -> Column:
    """Centre and area of inner in units of outer."""
    w, h = F.greatest(F.lit(eps), width(outer)), F.greatest(F.lit(eps), height(outer))
    return F.struct(
        ((centre_x(inner) - outer["x1"]) / w).alias("rx"),
        ((centre_y(inner) - outer["y1"]) / h).alias("ry"),
        (area(inner) / (w * h)).alias("ra"),
    )


def displacement_ratio(a: Column, b: Column) -> Column:
    """The larger of the moves along each axis, in units of the mean box side on it."""
    across = F.abs(centre_x(b) - centre_x(a)) / F.greatest(F.lit(1e-6), (width(a) + width(b)) / 2)
    down = F.abs(centre_y(b) - centre_y(a)) / F.greatest(F.lit(1e-6), (height(a) + height(b)) / 2)
    return F.greatest(across, down)


def clamped(b: Column, w: float, h: float) -> Column:
    """The box within a frame of w by h."""
    return F.struct(
        F.least(F.greatest(b["x1"], F.lit(0.0)), F.lit(w - 1.0)).alias("x1"),
        F.least(F.greatest(b["y1"], F.lit(0.0)), F.lit(h - 1.0)).alias("y1"),
        F.least(F.greatest(b["x2"], F.lit(0.0)), F.lit(float(w))).alias("x2"),
        F.least(F.greatest(b["y2"], F.lit(0.0)), F.lit(float(h))).alias("y2"),
    )
