"""The spatial operators on polygons: a `geometry` column (well-known binary) beside its bounds.

Shapes are laid over a grid by their bounds and gathered by cell; crowded cells, which are counted first, in pages of
about PAGE shapes. Two pages of a cell meet in one call: one goes into a packed R-tree, the other is probed against it,
so a shape is read once a page and not once a pair. Convex shapes are clipped by one another, others are prepared
and overlaid. Very wide areas are cut into pieces first.
Unions are an aggregate whose buffers are partial unions, made before and after the exchange. Call
`tesserae.functions.polygons.register` first.

Rows with a null or empty geometry have no bounds and meet nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.functions import rect
from tesserae.operators import spatial
from tesserae.operators.components import connected_components
from tesserae.storage import drop, store

#: Shapes of a page; how much wider than asked for the cells are in which shapes meet, as each shape travels once for
#: every cell that it lies in, and the same for a table that meets itself; levels of a union's tree, and how much wider a
#: level's cells are.
PAGE, SPREAD, OWN_SPREAD, LEVELS, FAN = 256, 4, 8, 4, 8
#: Points of a piece of an area, and its width in cells.
POINTS, WIDE = 256, 16
#: Negative segments ask for sharp corners, up to that many times the distance away.
MITRE = -5


def geo(name: str, *args) -> Column:
    return F.call_function(f"geo_{name}", *(F.col(a) if isinstance(a, str) else a for a in args))


def area(geometry: str = "geometry") -> Column:
    return geo("area", geometry)


def with_bounds(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """df with minx, miny, maxx, maxy of its geometry; rows with empty geometry go."""
    b = df.withColumn("__b", F.explode(F.array(geo("bounds", geometry)))).where("__b IS NOT NULL")  # so that they are made once
    return b.withColumns({s: F.col("__b")[k] for k, s in enumerate(rect.SIDES)}).drop("__b")


def grown(df: DataFrame, columns: list[str], distance: float, segments: int = 16) -> DataFrame:
    """The columns, geometry and bounds of df with its shapes grown, or shrunk by a negative distance; what
    vanishes goes."""
    return with_bounds(df.select(*columns, geo("buffer", "geometry", F.lit(float(distance)), F.lit(segments)).alias("geometry")))


# --- meetings ----------------------------------------------------------------------------------------


def _laid(df: DataFrame, id_col: str, cell: float, keys: list[str]) -> DataFrame:
    """Keys, cell and its hash __h, __id and geometry, a row for each cell that a shape's bounds meet."""
    at = lambda c: F.floor(F.col(c) / F.lit(float(cell))).cast("long")
    slim = df.select(F.col(id_col).cast("long").alias("__id"), "geometry", *rect.SIDES, *(F.col(k).alias(f"__k{n}") for n, k in enumerate(keys))).where(" AND ".join(f"{s} IS NOT NULL" for s in (*rect.SIDES, *(f"__k{n}" for n in range(len(keys))))))
    laid = slim.withColumn("__cx", F.explode(F.sequence(at("minx"), at("maxx")))).withColumn("__cy", F.explode(F.sequence(at("miny"), at("maxy"))))
    return laid.drop(*rect.SIDES).withColumn("__h", F.hash(*(f"__k{n}" for n in range(len(keys))), "__cx", "__cy"))


def _crowds(laid: DataFrame) -> DataFrame:
    """The cells with more than PAGE shapes, and the pages that each is dealt to. Cells are counted by a hash, which is all
    that travels; one that shares it with others is at most dealt to more pages than it needs."""
    return laid.groupBy("__h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > PAGE).select("__h", F.ceil(F.col("n") / PAGE).alias("__pages"))


def _pages(laid: DataFrame, crowded: DataFrame, group: list[str]) -> DataFrame:
    """Keys, cell, number and shapes of every page of the crowded cells: shapes are dealt to pages by identifier, which are
    gathered apart, so a town spreads over many tasks."""
    page = F.pmod(F.xxhash64("__id"), F.coalesce("__pages", F.lit(1)))
    return laid.join(crowded, "__h").withColumn("__page", page).groupBy(*group, "__page").agg(F.collect_list(F.struct("__id", "geometry")).alias("__shapes"))


def _quiet(laid: DataFrame, crowded: DataFrame | None, group: list[str]) -> DataFrame:
    """Keys, cell and shapes of every other cell. Rows travel flat and once, to where their cell is met."""
    rest = laid if crowded is None else laid.join(crowded, "__h", "left_anti")
    return rest.drop("__h").repartition(*group).groupBy(*group).agg(F.collect_list(F.struct("__id", "geometry")).alias("__shapes"))


def _meet(met: DataFrame, theirs: str, mode: str, cell: float, same: Column, least: float = 0) -> DataFrame:
    return met.select(F.inline(geo("meet", "__shapes", theirs, F.lit(mode), "__cx", "__cy", F.lit(float(cell)), same, F.lit(float(least)))))


def meetings(left: DataFrame, right: DataFrame, left_id: str, right_id: str, cell: float, mode: str = "intersects", keys: list[tuple[str, str]] = ()) -> DataFrame:
    """l, r (identifiers), shared, area_l, area_r, geometry of all pairs that agree in keys and meet by the mode:
    'intersects', 'contains' (l holds r), 'shared' (with the common area), 'touch' (more than a point in common), 'clip' (geometry
    is the common part) or 'take' (geometry is r's). Identifiers are unique in their tables."""
    wide, group = SPREAD * cell, [*(f"__k{n}" for n in range(len(keys))), "__cx", "__cy"]
    a, b = _laid(left, left_id, wide, [x for x, _ in keys]), _laid(right, right_id, wide, [y for _, y in keys])
    counts = _crowds(a).withColumn("__s", F.lit("a")).unionByName(_crowds(b).withColumn("__s", F.lit("b")))
    crowded, path = store(counts.groupBy("__h").agg(*(F.max(F.when(F.col("__s") == s, F.col("__pages"))).alias(f"__{s}") for s in ("a", "b"))), "crowded")
    town = not crowded.isEmpty()
    theirs = lambda d: d.withColumnsRenamed({"__shapes": "__theirs"})
    some = crowded if town else None
    met = _meet(_quiet(a, some, group).join(theirs(_quiet(b, some, group)), group), "__theirs", mode, wide, F.lit(0))
    if not town:
        drop(left.sparkSession, path)
        return met
    of = lambda s: crowded.select("__h", F.col(f"__{s}").alias("__pages"))
    pages = _pages(a, of("a"), group).join(theirs(_pages(b, of("b"), group)).drop("__page"), group)
    return met.unionByName(_meet(pages, "__theirs", mode, wide, F.lit(0)))


def held(areas: DataFrame, shapes: DataFrame, area_id: str, id_col: str, cell: float) -> DataFrame:
    """id, once, of the shapes that lie in one of the areas. Of a rectangle bounds tell, and shapes stay where they are."""
    box = F.col("geometry") == geo("rectangle", *rect.SIDES)
    ids = spatial.pairs(areas.where(box).select(area_id, *rect.SIDES), shapes.select(id_col, *rect.SIDES), cell, predicate=rect.contains).select(F.col(f"r.{id_col}").alias(id_col))
    others = areas.where(~box)
    if not others.isEmpty():
        ids = ids.union(meetings(others, shapes, area_id, id_col, cell, "contains").select(F.col("r").alias(id_col)))
    return ids.distinct()


def self_meetings(df: DataFrame, id_col: str, cell: float, mode: str = "shared", same: list[str] = (), least: float = 0) -> DataFrame:
    """meetings of a table with itself, l >= r, a row with itself included; it is laid over the grid once, and a cell that
    isn't crowded is met where it was gathered, without a join. Of 'shared' meetings, those whose intersection over union
    is surely below `least` may be left out."""
    wide, group = OWN_SPREAD * cell, [*(f"__k{n}" for n in range(len(same))), "__cx", "__cy"]
    laid = _laid(df, id_col, wide, list(same))
    crowded, path = store(_crowds(laid), "crowded")
    town = not crowded.isEmpty()
    met = _meet(_quiet(laid, crowded if town else None, group), "__shapes", mode, wide, F.lit(2), least)
    if not town:
        drop(df.sparkSession, path)
        return met
    pages = _pages(laid, crowded, group)
    both = pages.join(pages.withColumnsRenamed({"__page": "__other", "__shapes": "__theirs"}), group).where("__page >= __other")
    return met.unionByName(_meet(both, "__theirs", mode, wide, F.when(F.col("__page") == F.col("__other"), 2).otherwise(1), least))


def pieces(areas: DataFrame, id_col: str, side: float, points: int = 0) -> DataFrame:
    """of (the area's identifier), geometry, piece (a number) and bounds of areas cut into pieces of at most `side`, or
    of at most that many points."""
    cut = areas.select(F.col(id_col).alias("of"), F.posexplode(geo("subdivide", "geometry", F.lit(float(side)), F.lit(points))).alias("__n", "geometry"))
    return with_bounds(cut.withColumn("piece", F.xxhash64("of", "__n")).drop("__n"))


def pieces_near(areas: DataFrame, id_col: str, near: DataFrame, side: float) -> DataFrame:
    """pieces of areas; those wider than `side` are cut at the lines of a grid and only in cells where `near` has shapes: a
    wide area then costs what lies in it, and one that is narrow travels to no cell. Areas of many points are cut into
    simpler ones first."""
    at = lambda c: F.floor(F.col(c) / F.lit(float(side))).cast("long")
    cut = pieces(areas, id_col, side, POINTS)
    wide = F.greatest(rect.width(), rect.height()) > side
    narrow = cut.where(~wide).select("of", "piece", "geometry", *rect.SIDES)
    if cut.where(wide).isEmpty():
        return narrow
    there = near.select(F.explode(F.sequence(at("minx"), at("maxx"))).alias("cx"), "miny", "maxy").select("cx", F.explode(F.sequence(at("miny"), at("maxy"))).alias("cy")).distinct()
    cells = there.select("cx", "cy", *(((F.col(c) + k) * float(side)).alias(s) for s, c, k in (("minx", "cx", 0), ("miny", "cy", 0), ("maxx", "cx", 1), ("maxy", "cy", 1))))
    met = spatial.area_pairs(cells, cut.where(wide), side)
    inside = rect.contains("l.", "r.")
    part = F.when(inside, F.col("r.geometry")).otherwise(geo("polygonal", geo("intersection", F.col("r.geometry"), geo("rectangle", *(F.col(f"l.{s}") for s in rect.SIDES)))))
    return narrow.unionByName(with_bounds(met.select(F.col("r.of").alias("of"), F.xxhash64("r.piece", "l.cx", "l.cy").alias("piece"), part.alias("geometry"))))


def iou(met: str = "") -> Column:
    """Intersection over union of a 'shared' meeting; null for two shapes without area."""
    s, a, b = (F.col(f"{met}{c}") for c in ("shared", "area_l", "area_r"))
    return F.when(a + b - s > 0, s / (a + b - s))


def iou_edges(df: DataFrame, id_col: str, threshold: float, cell: float, same: list[str] = ()) -> DataFrame:
    """src >= dst, iou of pairs (a row with itself included) with at least the threshold."""
    scored = self_meetings(df, id_col, cell, "shared", same, threshold).select(F.col("l").alias("src"), F.col("r").alias("dst"), iou().alias("iou"))
    return scored.where(F.col("iou") >= threshold)


# --- unions ------------------------------------------------------------------------------------------


def union_of(geometry: str = "geometry") -> Column:
    """Aggregate: the union of a group's shapes."""
    return geo("union_of", geometry)


def union_parts(df: DataFrame, by: list[str], cell: float) -> DataFrame:
    """by, cx, cy, geometry: the union of each group, cut at the lines of a grid. Parts don't overlap, so areas
    can be summed and overlays done part by part, and no task holds more than a cell of a group."""
    at = lambda c: F.floor(F.col(c) / F.lit(cell)).cast("long")
    laid = df.select(*by, "geometry", *rect.SIDES, F.explode(F.sequence(at("minx"), at("maxx"))).alias("cx")).select("*", F.explode(F.sequence(at("miny"), at("maxy"))).alias("cy"))
    box = [(F.col(c) * cell).cast("double") for c in ("cx", "cy")] + [((F.col(c) + 1) * cell).cast("double") for c in ("cx", "cy")]
    parts = laid.select(*by, "cx", "cy", geo("clip", "geometry", *box).alias("geometry"))
    return parts.groupBy(*by, "cx", "cy").agg(union_of().alias("geometry")).where(area() > 0)  # a filter before would make every cut twice


def union_by(df: DataFrame, by: list[str], cell: float) -> DataFrame:
    """by, geometry: the union of each group as one geometry. Parts are united by cell of their lower left corner,
    then by cells FAN times as wide, level by level, so that a task holds one cell's parts at a time; groups that lie in
    one cell, which are looked for first, are whole after one level. Where
    areas or overlays are all that is needed, `union_parts` never builds the whole."""
    level = df.select(*by, "geometry", *(F.floor(F.col(c) / F.lit(cell)).cast("long").alias(n) for c, n in (("minx", "__x"), ("miny", "__y"))))
    ends = level.groupBy(*by).agg(*(f(c).alias(f"{c}{n}") for c in ("__x", "__y") for n, f in ((0, F.min), (1, F.max))))
    wide, path = store(ends.where("__x0 < __x1 OR __y0 < __y1").select(*by), "wide")
    if wide.isEmpty():
        drop(df.sparkSession, path)
        return df.groupBy(*by).agg(union_of().alias("geometry"))
    rows, same = level.alias("a"), [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by]
    one = rows.join(wide.alias("b"), same, "left_anti").groupBy(*by).agg(union_of().alias("geometry"))
    level = rows.join(wide.alias("b"), same, "left_semi")
    for _ in range(LEVELS):
        level = level.groupBy(*by, "__x", "__y").agg(union_of().alias("geometry")).withColumns({n: F.floor(F.col(n) / FAN).cast("long") for n in ("__x", "__y")})
    return one.unionByName(level.groupBy(*by).agg(union_of().alias("geometry")))


def union_area(df: DataFrame, by: list[str], cell: float) -> DataFrame:
    """by, area of each group's union."""
    return union_parts(df, by, cell).groupBy(*by).agg(F.sum(area()).alias("area"))


def dissolve_first(df: DataFrame, by: str, order: list[Column | str], columns: list[str], more: list[Column] = ()) -> DataFrame:
    """A row for each group: the union of its shapes and, of each column, the first non-null value in order.
    Columns are looked at one by one, so a row may mix sources. `more` are further aggregates."""
    rank = F.struct(*order)
    firsts = (F.min_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(c) for c in columns)
    return df.groupBy(by).agg(*firsts, *more, union_of().alias("geometry"))


# --- overlays ----------------------------------------------------------------------------------------


def single_parts(df: DataFrame) -> DataFrame:
    """A row for each part of a collection; the other columns repeat. Empty geometries go."""
    others = [c for c in df.columns if c != "geometry"]
    return df.select(*others, F.explode(geo("parts", "geometry")).alias("geometry")).select(*df.columns)


def difference(left: DataFrame, right: DataFrame, id_col: str, cell: float) -> DataFrame:
    """left with its geometry less everything of right that it meets; rows left empty go."""
    areas = right.select("geometry").withColumn("__area", F.xxhash64("geometry"))
    cut = pieces_near(areas, "__area", left, WIDE * cell)
    hits = meetings(left, cut, id_col, "piece", cell, "take").groupBy("l").agg(union_of().alias("__taken"))
    joined = left.join(hits, F.col(id_col) == F.col("l"), "left").drop("l")
    out = joined.withColumn("geometry", F.when(F.col("__taken").isNull(), F.col("geometry")).otherwise(geo("polygonal", geo("difference", "geometry", "__taken"))))
    return out.drop("__taken").where(~geo("isempty", "geometry"))


def intersection(left: DataFrame, right: DataFrame, left_id: str, right_id: str, cell: float, keys: list[tuple[str, str]] = ()) -> DataFrame:
    """l, r, geometry of the common parts that have area."""
    return meetings(left, right, left_id, right_id, cell, "clip", keys).select("l", "r", "geometry")


def clipped_to(left: DataFrame, areas: DataFrame, left_id: str, area_id: str, cell: float) -> DataFrame:
    """left with its geometry and bounds cut to each of the areas, of (the area's identifier) and the areas' other columns: a row
    for each left shape and area that share an area.

    Pieces of areas that are few enough are sent to every task, and a shape whose bounds lie within one piece's is cut where
    it stands; only what pieces have parted travels, to be put together again. Where pieces are many, shapes meet them by cell."""
    columns = [c for c in areas.columns if c not in (area_id, "geometry", *rect.SIDES)]
    named = areas.select(F.col(area_id).alias("of"), *columns).distinct()
    others = [c for c in left.columns if c not in ("geometry", *rect.SIDES)]
    whole = pieces(areas, area_id, WIDE * cell, POINTS).dropDuplicates(["piece"])
    if whole.count() > spatial.SMALL_AREAS:
        cut = pieces_near(areas, area_id, left, WIDE * cell)
        met = meetings(left, cut, left_id, "piece", cell, "clip").select("l", F.col("r").alias("piece"), "geometry")
        parts = met.join(cut.select("piece", "of"), "piece").groupBy("l", "of").agg(union_of().alias("geometry"))
        return with_bounds(left.drop("geometry", *rect.SIDES).join(parts.withColumnRenamed("l", left_id), left_id).join(named, "of"))
    met = spatial.area_pairs(left, whole.join(F.broadcast(named), "of"), cell)
    common = geo("polygonal", geo("intersection", F.col("l.geometry"), F.col("r.geometry"))).alias("geometry")
    fits = rect.contains("r.", "l.")
    row = [*(F.col(f"l.{c}") for c in others), *(F.col(f"r.{c}") for c in ("of", *columns)), common]
    alone = with_bounds(met.where(fits).select(*row))
    parted = with_bounds(met.where(~fits).select(*row)).groupBy(left_id, "of").agg(*(F.first(c).alias(c) for c in (*others, *columns) if c != left_id), union_of().alias("geometry"))
    return alone.unionByName(with_bounds(parted))


def overlap_sum(objects: DataFrame, layer: DataFrame, id_col: str, layer_id: str, cell: float) -> DataFrame:
    """id, ratio: the sum, over the layer's shapes, of the share of the object that each covers. It can pass 1
    where the layer overlaps itself."""
    cut = pieces_near(layer, layer_id, objects, WIDE * cell)
    sums = meetings(objects, cut, id_col, "piece", cell, "shared").groupBy(F.col("l").alias(id_col)).agg(F.sum(F.try_divide("shared", "area_l")).alias("ratio"))
    return objects.select(id_col).join(sums, id_col, "left").select(id_col, F.coalesce("ratio", F.lit(0.0)).alias("ratio"))


def nearest(left: DataFrame, areas: DataFrame, id_col: str, start: float, side: float | None = None) -> DataFrame:
    """id, distance from each shape to the nearest of the areas, which are cut into pieces of `side` first (16 times
    the start if none is given); 0 where they meet. Without areas there are no rows."""
    cut = pieces(areas.select("geometry").withColumn("__area", F.xxhash64("geometry")), "__area", side or 16 * start).select("piece", "geometry", *rect.SIDES)
    near = spatial.nearest(left.select(id_col, "geometry", *rect.SIDES), cut, id_col, "piece", start, geo("distance", F.col("l.geometry"), F.col("r.geometry")))
    return near.groupBy(F.col(f"l.{id_col}").alias(id_col)).agg(F.min("distance").alias("distance"))


# --- merging -----------------------------------------------------------------------------------------


def _components(edges: DataFrame, id_col: str) -> DataFrame:
    return connected_components(edges).select(F.col("node").alias(id_col), F.col("component").alias("group_id"))


def group_detections(df: DataFrame, id_col: str, threshold: float, cell: float, same: list[str] = ("year_det",)) -> DataFrame:
    """df with group_id, the least id of the component of overlapping rows; null if a row overlaps nothing, not even
    itself. A group_id from an earlier step is replaced."""
    df = df.drop("group_id")
    return df.join(overlap_groups(df, id_col, threshold, cell, same), id_col, "left")


def overlap_groups(df: DataFrame, id_col: str, threshold: float, cell: float, same: list[str] = ("year_det",)) -> DataFrame:
    """id, group_id of the rows that overlap something, if only themselves: what `group_detections` adds."""
    return _components(iou_edges(df, id_col, threshold, cell, list(same)), id_col)


def proximity_groups(df: DataFrame, id_col: str, distance: float, cell: float, same: list[str] = (), segments: int = 2, square: bool = False) -> DataFrame:
    """id, group_id: components of shapes that share more than a point once grown; group_id is the smallest id.
    Square growth keeps corners sharp."""
    return _touching(grown(df, [id_col, *same], distance, MITRE if square else segments), id_col, cell, same)


def _touching(wide: DataFrame, id_col: str, cell: float, same: list[str]) -> DataFrame:
    met = self_meetings(wide, id_col, cell, "touch", list(same))
    return _components(met.select(F.col("l").alias("src"), F.col("r").alias("dst")), id_col)


def closing(df: DataFrame, id_col: str, distance: float, cell: float, segments: int = 2, same: list[str] = (), shrink: float | None = None, single: bool = False) -> DataFrame:
    """Proximity merge: grown by distance, united where the grown shapes share more than a point, shrunk
    again. A result in several parts stays one row unless single parts are asked for; what vanishes goes."""
    wide, _ = store(grown(df, [id_col, *same], distance, segments), "grown")  # read by the meetings and by the union
    united = union_by(wide.join(_touching(wide, id_col, cell, same), id_col), ["group_id", *same], cell)
    shrunk = grown(united, ["group_id", *same], -float(distance if shrink is None else shrink), segments).drop(*rect.SIDES)
    return single_parts(shrunk) if single else shrunk


def repaired(df: DataFrame, correct: bool = True) -> DataFrame:
    """df with valid geometries. Without `correct` an invalid one raises when its row is computed."""
    valid = geo("isvalid", "geometry")
    fixed = geo("makevalid", "geometry") if correct else F.when(F.assert_true(valid, F.lit("invalid geometry")).isNull(), F.col("geometry"))
    return df.withColumn("geometry", F.when(valid, F.col("geometry")).otherwise(fixed))


def away_from(points: DataFrame, areas: DataFrame, shrink: float, cell: float, id_col: str) -> DataFrame:
    """Rows whose centroid lies outside the areas, shrunk first (large waters without their shores)."""
    inner = grown(areas, [], -float(shrink), 16).withColumn("__area", F.xxhash64("geometry"))
    centres = with_bounds(points.select(id_col, geo("centroid", "geometry").alias("geometry")))
    held = meetings(centres, pieces_near(inner, "__area", centres, WIDE * cell), id_col, "piece", cell).select(F.col("l").alias(id_col)).distinct()
    return points.join(held, id_col, "left_anti")
