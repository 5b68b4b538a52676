"""Closed axis-parallel rectangles as columns minx, miny, maxx, maxy: the kernel stays in generated code.

Every function takes a prefix (or a struct path ending in a dot) for each rectangle and returns a Column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIDES = ("minx", "miny", "maxx", "maxy")


def side(name: str, prefix: str = "") -> Column:
    return F.col(f"{prefix}{name}")


def width(p: str = "") -> Column:
    return side("maxx", p) - side("minx", p)


def height(p: str = "") -> Column:
    return side("maxy", p) - side("miny", p)


def area(p: str = "") -> Column:
    return width(p) * height(p)


def perimeter(p: str = "") -> Column:
    return (width(p) + height(p)) * 2


def intersects(a: str, b: str) -> Column:
    """Touching counts."""
    return (side("minx", a) <= side("maxx", b)) & (side("minx", b) <= side("maxx", a)) & (side("miny", a) <= side("maxy", b)) & (side("miny", b) <= side("maxy", a))


def contains(a: str, b: str) -> Column:
    return (side("minx", a) <= side("minx", b)) & (side("maxx", a) >= side("maxx", b)) & (side("miny", a) <= side("miny", b)) & (side("maxy", a) >= side("maxy", b))


def intersection(a: str, b: str) -> dict[str, Column]:
    """Sides of the common rectangle, by name."""
    return {s: (F.greatest if s.startswith("min") else F.least)(side(s, a), side(s, b)) for s in SIDES}


def shared_area(a: str, b: str) -> Column:
    c, zero = intersection(a, b), F.lit(0)
    return F.greatest(c["maxx"] - c["minx"], zero) * F.greatest(c["maxy"] - c["miny"], zero)


def iou(a: str, b: str) -> Column:
    """Intersection over union; null for two rectangles without area."""
    i = shared_area(a, b)
    return F.try_divide(i.cast("double"), (area(a) + area(b) - i).cast("double"))


def distance(a: str, b: str) -> Column:
    """Euclidean distance; 0 where they meet."""
    zero = F.lit(0)
    dx = F.greatest(side("minx", a) - side("maxx", b), side("minx", b) - side("maxx", a), zero).cast("double")
    dy = F.greatest(side("miny", a) - side("maxy", b), side("miny", b) - side("maxy", a), zero).cast("double")
    return F.sqrt(dx * dx + dy * dy)


def grown(d: float | int, p: str = "") -> dict[str, Column]:
    """Sides of the rectangle with a square buffer of d."""
    return {s: side(s, p) - d if s.startswith("min") else side(s, p) + d for s in SIDES}


def scaled(factor: float, p: str = "") -> dict[str, Column]:
    """Sides of the rectangle scaled about its centre."""
    cx, cy = (side("minx", p) + side("maxx", p)) / 2, (side("miny", p) + side("maxy", p)) / 2
    return {s: c + (side(s, p) - c) * F.lit(factor) for s, c in zip(SIDES, (cx, cy, cx, cy))}


def compactness(p: str = "") -> Column:
    """Polsby-Popper ratio."""
    return F.try_divide(4 * F.pi() * area(p).cast("double"), perimeter(p).cast("double") * perimeter(p).cast("double"))


def rint(c: Column, digits: int) -> Column:
    """Round half even after scaling, as array libraries do."""
    return F.rint(c * 10**digits) / 10**digits
