"""Well-known binary for polygons, points and their collections, without other libraries."""

from __future__ import annotations

import struct

POINT, LINE, POLYGON, MULTIPOINT, MULTILINE, MULTIPOLYGON, COLLECTION = range(1, 8)
NAMES = {POINT: "Point", LINE: "LineString", POLYGON: "Polygon", MULTIPOINT: "MultiPoint", MULTILINE: "MultiLineString", MULTIPOLYGON: "MultiPolygon", COLLECTION: "GeometryCollection"}
KINDS = {v: k for k, v in NAMES.items()}


def dumps(geometry: dict) -> bytes:
    """A GeoJSON geometry as little-endian binary; further ordinates than two are dropped."""
    kind = KINDS[geometry["type"]]
    head = struct.pack("<BI", 1, kind)
    points = lambda ps: struct.pack("<I", len(ps)) + b"".join(struct.pack("<2d", p[0], p[1]) for p in ps)
    if kind == COLLECTION:
        parts = geometry["geometries"]
        return head + struct.pack("<I", len(parts)) + b"".join(dumps(g) for g in parts)
    c = geometry["coordinates"]
    if kind == POINT:
        return head + struct.pack("<2d", *(c[:2] or (float("nan"), float("nan"))))
    if kind == LINE:
        return head + points(c)
    if kind == POLYGON:
        return head + struct.pack("<I", len(c)) + b"".join(points(r) for r in c)
    return head + struct.pack("<I", len(c)) + b"".join(dumps({"type": NAMES[kind - 3], "coordinates": p}) for p in c)


def loads(data: bytes) -> dict:
    return _read(memoryview(data), 0)[0]


def _read(data, at: int) -> tuple[dict, int]:
    e = "<" if data[at] else ">"
    kind = struct.unpack_from(f"{e}I", data, at + 1)[0]
    ordinates = 2 + (kind & 0xE0000000 != 0 or 1000 <= kind % 10000 < 3000) + (kind & 0xC0000000 == 0xC0000000 or 3000 <= kind % 10000)
    if kind & 0x20000000:
        at += 4  # an embedded reference system
    kind, at = (kind & 0xFFFF) % 1000, at + 5

    def point(at):
        return list(struct.unpack_from(f"{e}2d", data, at)), at + 8 * ordinates

    def count(at):
        return struct.unpack_from(f"{e}I", data, at)[0], at + 4

    def line(at):
        n, at = count(at)
        out = []
        for _ in range(n):
            p, at = point(at)
            out.append(p)
        return out, at

    if kind == POINT:
        c, at = point(at)
        return {"type": "Point", "coordinates": [] if c[0] != c[0] else c}, at
    if kind == LINE:
        c, at = line(at)
        return {"type": "LineString", "coordinates": c}, at
    n, at = count(at)
    parts = []
    for _ in range(n):
        part, at = line(at) if kind == POLYGON else _read(data, at)
        parts.append(part)
    if kind == POLYGON:
        return {"type": "Polygon", "coordinates": parts}, at
    if kind == COLLECTION:
        return {"type": "GeometryCollection", "geometries": parts}, at
    return {"type": NAMES[kind], "coordinates": [p["coordinates"] for p in parts]}, at


def rectangle(minx: float, miny: float, maxx: float, maxy: float) -> bytes:
    ring = [[minx, miny], [maxx, miny], [maxx, maxy], [minx, maxy], [minx, miny]]
    return dumps({"type": "Polygon", "coordinates": [ring]})


def bounds(data: bytes) -> tuple[float, float, float, float] | None:
    """minx, miny, maxx, maxy; None for an empty geometry."""
    points = []

    def walk(c):
        if c and isinstance(c[0], (int, float)):
            points.append(c)
        else:
            for x in c:
                walk(x)

    def visit(g):
        for part in g.get("geometries", ()):
            visit(part)
        walk(g.get("coordinates", []))

    visit(loads(data))
    if not points:
        return None
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    return min(xs), min(ys), max(xs), max(ys)
