"""Web-mercator tiles and reprojection between longitude/latitude, web mercator and the Swiss grid."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.functions import rect

#: Half the side of the web-mercator square, in metres.
HALF = 20037508.342789244


def mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    return lon * (HALF / 180), F.log(F.tan(F.radians(lat) / 2 + math.pi / 4)) * (HALF / math.pi)


def from_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    return x * (180 / HALF), F.degrees(2 * F.atan(F.exp(y * (math.pi / HALF))) - math.pi / 2)


#: Fixed values of the survey: the ellipsoids (half axis, squared eccentricity), the origin in degrees, its grid
#: coordinates, and the shift from the world's centre to the grid's.
BESSEL, WORLD = (6377397.155, 0.006674372230614), (6378137.0, 0.0066943799901413165)
ORIGIN, GRID, SHIFT = (46 + 57 / 60 + 8.66 / 3600, 7 + 26 / 60 + 22.5 / 3600), (2_600_000.0, 1_200_000.0), (674.374, 15.056, 405.346)


def _sphere() -> tuple[float, float, float, float]:
    """Radius, scale, origin and offset of the sphere that the ellipsoid is laid on."""
    (a, e2), p = BESSEL, math.radians(ORIGIN[0])
    e = math.sqrt(e2)
    scale = math.sqrt(1 + e2 / (1 - e2) * math.cos(p) ** 4)
    b0 = math.asin(math.sin(p) / scale)
    offset = math.log(math.tan(math.pi / 4 + b0 / 2)) - scale * math.log(math.tan(math.pi / 4 + p / 2)) + scale * e / 2 * math.log((1 + e * math.sin(p)) / (1 - e * math.sin(p)))
    return a * math.sqrt(1 - e2) / (1 - e2 * math.sin(p) ** 2), scale, b0, offset


def shifted(lon: Column, lat: Column, old: tuple[float, float], new: tuple[float, float], shift: tuple[float, float, float]) -> tuple[Column, Column]:
    """Radians on another ellipsoid whose centre lies `shift` away: by way of geocentric coordinates, at height 0."""
    n = old[0] / F.sqrt(1 - old[1] * F.sin(lat) * F.sin(lat))
    x, y, z = n * F.cos(lat) * F.cos(lon) + shift[0], n * F.cos(lat) * F.sin(lon) + shift[1], n * (1 - old[1]) * F.sin(lat) + shift[2]
    a, e2 = new
    b, away = a * math.sqrt(1 - e2), F.hypot(x, y)
    turn = F.atan2(z * a, away * b)
    up = F.atan2(z + e2 / (1 - e2) * b * F.pow(F.sin(turn), 3), away - e2 * a * F.pow(F.cos(turn), 3))
    return F.atan2(y, x), up


def oblique(lon: Column, lat: Column) -> tuple[Column, Column]:
    """East and north of radians on the grid's ellipsoid: laid on a sphere, which is turned and unrolled."""
    radius, scale, b0, offset = _sphere()
    e = math.sqrt(BESSEL[1])
    s = scale * F.log(F.tan(lat / 2 + math.pi / 4)) - scale * e / 2 * F.log((1 + e * F.sin(lat)) / (1 - e * F.sin(lat))) + offset
    b, along = 2 * (F.atan(F.exp(s)) - math.pi / 4), scale * (lon - math.radians(ORIGIN[1]))
    turned = F.atan2(F.sin(along), math.sin(b0) * F.tan(b) + math.cos(b0) * F.cos(along))
    height = math.cos(b0) * F.sin(b) - math.sin(b0) * F.cos(b) * F.cos(along)
    return turned * radius + GRID[0], F.log((1 + height) / (1 - height)) * (radius / 2) + GRID[1]


def from_oblique(east: Column, north: Column) -> tuple[Column, Column]:
    """Radians on the grid's ellipsoid; the latitude by seven steps of a fixed point, far below a millimetre."""
    radius, scale, b0, offset = _sphere()
    e = math.sqrt(BESSEL[1])
    turned, height = (east - GRID[0]) / radius, 2 * (F.atan(F.exp((north - GRID[1]) / radius)) - math.pi / 4)
    b = F.asin(math.cos(b0) * F.sin(height) + math.sin(b0) * F.cos(height) * F.cos(turned))
    along = F.atan2(F.sin(turned), math.cos(b0) * F.cos(turned) - math.sin(b0) * F.tan(height))
    base, lat = (F.log(F.tan(b / 2 + math.pi / 4)) - offset) / scale, b
    for _ in range(7):
        lat = 2 * F.atan(F.exp(base + e * F.log(F.tan(F.asin(e * F.sin(lat)) / 2 + math.pi / 4)))) - math.pi / 2
    return along / scale + math.radians(ORIGIN[1]), lat


def swiss(lon: Column, lat: Column) -> tuple[Column, Column]:
    """East and north in the Swiss grid of degrees in the world system."""
    return oblique(*shifted(F.radians(lon), F.radians(lat), WORLD, BESSEL, tuple(-v for v in SHIFT)))


def from_swiss(east: Column, north: Column) -> tuple[Column, Column]:
    """Longitude and latitude in degrees of the world system."""
    lon, lat = shifted(*from_oblique(east, north), BESSEL, WORLD, SHIFT)
    return F.degrees(lon), F.degrees(lat)


def projected(df: DataFrame, system: str) -> DataFrame:
    """df with its bounds, in longitude and latitude, as the bounds of their corners in 'swiss' or 'mercator'."""
    project = {"swiss": swiss, "mercator": mercator}[system]
    corners = [project(F.col(x).cast("double"), F.col(y).cast("double")) for x in ("minx", "maxx") for y in ("miny", "maxy")]
    ends = {s: (F.least if s.startswith("min") else F.greatest)(*(c[s.endswith("y")] for c in corners)) for s in rect.SIDES}
    return df.select(*(ends[c].alias(c) if c in ends else F.col(c) for c in df.columns))


def tile_cover(df: DataFrame, zoom: int, id_col: str) -> DataFrame:
    """id, x, y, tile_id and the bounds (web mercator, metres) of every tile that the rectangle meets."""
    side = 2 * HALF / (1 << zoom)
    last = F.lit((1 << zoom) - 1).cast("long")
    at = lambda v: F.least(F.greatest(F.floor(v / F.lit(side)).cast("long"), F.lit(0).cast("long")), last)
    x = df.select(id_col, *rect.SIDES, F.explode(F.sequence(at(F.col("minx") + HALF), at(F.col("maxx") + HALF))).alias("x"))
    xy = x.select(id_col, "x", F.explode(F.sequence(at(HALF - F.col("maxy")), at(HALF - F.col("miny")))).alias("y"))
    name = F.format_string("(%d, %d, %d)", "x", "y", F.lit(zoom))
    return xy.select(id_col, "x", "y", name.alias("tile_id"), (F.col("x") * side - HALF).alias("minx"), (HALF - (F.col("y") + 1) * side).alias("miny"), ((F.col("x") + 1) * side - HALF).alias("maxx"), (HALF - F.col("y") * side).alias("maxy"))


def parse_title(title: Column) -> dict[str, Column]:
    """x, y, z (and year, null if absent) of titles such as '(x, y, z)' or '(year, x, y, z)'."""
    numbers = F.transform(F.regexp_extract_all(title, F.lit(r"(-?\d+)"), 1), lambda s: s.cast("long"))
    four = F.size(numbers) == 4
    pick = lambda k: F.when(four, F.element_at(numbers, k + 1)).otherwise(F.element_at(numbers, k))
    return {"year": F.when(four, F.element_at(numbers, 1)), "x": pick(1), "y": pick(2), "z": pick(3)}


def random_year(id_: Column, low: int, high: int, seed: int = 0) -> Column:
    """A year in [low, high) that depends on the id and the seed alone."""
    return (F.lit(low) + F.pmod(F.xxhash64(id_, F.lit(seed)), F.lit(high - low))).cast("int")
