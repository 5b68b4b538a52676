"""Overlays of rectangle layers: pieces, clips, union and difference areas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.functions import rect
from tesserae.operators import spatial
from tesserae.storage import drop, store


def intersection(left: DataFrame, right: DataFrame, cell: float, keys: list[tuple[str, str]] = (), drop_flat: bool = True) -> DataFrame:
    """l, r and the sides of their common part; parts without area are dropped, as polygons-only
    overlays do."""
    out = spatial.pairs(left, right, cell, keys).select("l", "r", *(c.alias(s) for s, c in rect.intersection("l.", "r.").items()))
    return out.where(rect.area() > 0) if drop_flat else out


def clip_to_tiles(objects: DataFrame, tiles: DataFrame, cell: float, factor: float = 0.99, keys: list[tuple[str, str]] = ()) -> DataFrame:
    """Objects cut to tiles that are scaled about their centres."""
    shrunk = tiles.select(*(c for c in tiles.columns if c not in rect.SIDES), *(c.alias(s) for s, c in rect.scaled(factor).items()))
    return intersection(objects, shrunk, cell, keys)


#: Rectangles in a cell up to which their union is one expression over an array.
CROWD = 64


def _covered(rects: str) -> Column:
    """Area of the union of a sorted array of (miny, maxy, minx, maxx): strips between neighbouring x edges, and
    in each the merged y intervals."""
    xs = F.array_sort(F.array_distinct(F.concat(F.transform(rects, lambda r: r["minx"]), F.transform(rects, lambda r: r["maxx"]))))
    zero = F.lit(0).cast("long")

    def strip(x0: Column, x1: Column) -> Column:
        inside = F.filter(rects, lambda r: (r["minx"] <= x0) & (r["maxx"] >= x1))
        merge = lambda s, r: F.struct((s["sum"] + F.greatest(r["maxy"] - F.greatest(r["miny"], s["reach"]), zero)).alias("sum"), F.greatest(s["reach"], r["maxy"]).alias("reach"))
        return F.aggregate(inside, F.struct(zero.alias("sum"), F.lit(-(2**62)).alias("reach")), merge)["sum"] * (x1 - x0)

    steps = F.zip_with(F.slice(xs, 1, F.size(xs) - 1), F.slice(xs, 2, F.size(xs) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    many = F.aggregate(steps, zero, lambda t, s: t + strip(s["a"], s["b"]))
    one = F.element_at(rects, 1)
    return F.when(F.size(rects) == 1, (one["maxx"] - one["minx"]) * (one["maxy"] - one["miny"])).otherwise(many)


def union_area(df: DataFrame, by: list[str], cell: int) -> DataFrame:
    """by, area of the union of each group's rectangles, whose bounds are whole numbers.

    Rectangles are cut at grid lines, so that each cell is a small problem whatever the group's size. Up to
    CROWD rectangles of a cell are united in one expression; in a more crowded cell, which isn't gathered (such cells
    are counted first, so df is read twice),
    every strip between two neighbouring x edges sums the merged y intervals by window functions."""
    at = lambda c: F.floor(F.col(c) / F.lit(cell)).cast("long")
    inner = lambda c: F.floor((F.col(c) - 1) / F.lit(cell)).cast("long")  # noqa: E731  the far edge belongs to the cell before
    cut = df.where(rect.area() > 0).select(*by, *(F.col(s).cast("long").alias(s) for s in rect.SIDES), F.explode(F.sequence(at("minx"), inner("maxx"))).alias("cx")).withColumn("cy", F.explode(F.sequence(at("miny"), inner("maxy"))))
    inside = cut.select(*by, "cx", "cy", F.greatest("minx", F.col("cx") * cell).alias("minx"), F.greatest("miny", F.col("cy") * cell).alias("miny"), F.least("maxx", (F.col("cx") + 1) * cell).alias("maxx"), F.least("maxy", (F.col("cy") + 1) * cell).alias("maxy"))
    group = [*by, "cx", "cy"]
    crowded, path = store(inside.groupBy(*group).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > CROWD).drop("__n"), "crowded")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in group]
    town = not crowded.isEmpty()
    quiet = inside.alias("a").join(crowded.alias("b"), same, "left_anti") if town else inside
    few = quiet.repartition(*group).groupBy(*group).agg(F.sort_array(F.collect_set(F.struct("miny", "maxy", "minx", "maxx"))).alias("rects"))
    if not town:
        drop(df.sparkSession, path)
        return few.select(*by, _covered("rects").alias("part")).groupBy(*by).agg(F.sum("part").alias("area"))
    crowd = inside.alias("a").join(crowded.alias("b"), same, "left_semi").distinct()
    edges = crowd.select(*group, F.explode(F.array("minx", "maxx")).alias("x")).distinct()
    strips = edges.withColumn("x1", F.lead("x").over(Window.partitionBy(*group).orderBy("x"))).where("x1 IS NOT NULL")
    runs = crowd.join(strips, group).where((F.col("minx") <= F.col("x")) & (F.col("maxx") >= F.col("x1"))).select(*group, "x", "x1", "miny", "maxy")
    before = Window.partitionBy(*group, "x").orderBy("miny", "maxy").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.col("maxy") - F.greatest(F.col("miny"), F.coalesce(F.max("maxy").over(before), F.col("miny"))), F.lit(0)) * (F.col("x1") - F.col("x"))
    parts = few.select(*by, _covered("rects").alias("part")).union(runs.select(*by, fresh.alias("part")))
    return parts.groupBy(*by).agg(F.sum("part").alias("area"))


def difference_area(left: DataFrame, right: DataFrame, id_col: str, cell: int) -> DataFrame:
    """id, area and left_area: what each left rectangle keeps when all right ones are taken away. Only
    the right rectangles that a left one meets are united, cut to it."""
    hits, _ = store(intersection(left, right, cell).select(F.col(f"l.{id_col}").alias(id_col), *rect.SIDES), "hits")
    lost = union_area(hits, [id_col], 4 * cell).withColumnRenamed("area", "lost")
    return left.select(id_col, rect.area().alias("area")).join(lost, id_col, "left").select(id_col, "area", (F.col("area") - F.coalesce("lost", F.lit(0))).alias("left_area"))


def overlap_sum(objects: DataFrame, layer: DataFrame, id_col: str, cell: float) -> DataFrame:
    """id, ratio: the sum, over the layer's rectangles, of the share of the object that each covers. It can
    pass 1 where the layer overlaps itself."""
    met = spatial.pairs(objects, layer, cell)
    share = F.coalesce(F.try_divide(rect.shared_area("l.", "r.").cast("double"), rect.area("l.").cast("double")), F.lit(0.0))
    sums = met.groupBy(F.col(f"l.{id_col}").alias(id_col)).agg(F.sum(share).alias("ratio"))
    return objects.select(id_col).join(sums, id_col, "left").select(id_col, F.coalesce("ratio", F.lit(0.0)).alias("ratio"))


def overlap_sums(objects: DataFrame, layers: DataFrame, id_col: str, cell: float, key: str, values: list[str]) -> DataFrame:
    """id and, for each of the values, the sum over the layers' rectangles of that key of the share of the object that each
    covers: one meeting for all of them. Objects that meet none have no row."""
    met = spatial.pairs(objects, layers.where(F.col(key).isin(values)), cell)
    share = F.coalesce(F.try_divide(rect.shared_area("l.", "r.").cast("double"), rect.area("l.").cast("double")), F.lit(0.0))
    one = met.select(F.col(f"l.{id_col}").alias(id_col), F.col(f"r.{key}").alias("__key"), share.alias("__share"))
    return one.groupBy(id_col).agg(*(F.coalesce(F.sum(F.when(F.col("__key") == v, F.col("__share"))), F.lit(0.0)).alias(v) for v in values))
