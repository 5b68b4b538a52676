"""Raster operators on chunk and pixel tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sample(points: DataFrame, cells: DataFrame, size: int, value: str = "elevation") -> DataFrame:
    """points (x, y) with the raster's value in their cell; null outside. An equi-join on the cell."""
    at = points.withColumn("tx", F.floor(F.col("x") / size).cast("long")).withColumn("ty", F.floor(F.col("y") / size).cast("long"))
    return at.join(cells.select("tx", "ty", value), ["tx", "ty"], "left").drop("tx", "ty")


def grey(df: DataFrame, green: str = "g", coefficients: tuple[float, float, float] = (0.2990, 0.5870, 0.1140)) -> DataFrame:
    """df with grey, cut to a whole number as an 8-bit band is."""
    r, g, b = coefficients
    return df.withColumn("grey", F.floor(F.col("r") * r + F.col(green) * g + F.col("b") * b + 1e-9).cast("int"))


def bands(df: DataFrame, n: int) -> DataFrame:
    """df with grey repeated in n bands, rows and columns kept as they are."""
    return df.withColumn("bands", F.array_repeat("grey", n))


def cumulative(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """by, value, n, cdf: the histogram of each group and its cumulated share."""
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    up, all_ = Window.partitionBy(*by).orderBy(value), Window.partitionBy(*by)
    return counts.select(*by, value, "n", (F.sum("n").over(up) / F.sum("n").over(all_)).alias("cdf"))


def match_histogram(source: DataFrame, reference: DataFrame, by: list[str], value: str, each: list[str] = ()) -> DataFrame:
    """each, by, value, matched: the value at which the reference's cumulated share is the source value's, linear
    between neighbouring reference values and held at its ends. Whole-number images take it cut to a whole number.
    `each` names columns of the source alone, such as the image that is matched; a band without reference has no
    rows. Both sides are histograms when they meet, and are merged in the order of their shares: one pass over as many rows as they have values."""
    s = cumulative(source, [*each, *by], value).select(*each, *by, F.col(value).alias("v"), "cdf", F.lit(None).cast("struct<v: double, cdf: double>").alias("ref"))
    r = cumulative(reference, by, value).select(*by, F.struct(F.col(value).cast("double").alias("v"), "cdf").alias("ref"))
    groups = s.select(*each, *by).distinct()
    both = s.unionByName(groups.join(r, by).select(*each, *by, F.lit(None).cast(dict(s.dtypes)["v"]).alias("v"), F.col("ref.cdf").alias("cdf"), "ref"))
    w = Window.partitionBy(*each, *by).orderBy("cdf", F.col("ref").isNull())  # of equal shares the reference comes first
    low = F.last("ref", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    high = F.first("ref", ignorenulls=True).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    near = both.withColumns({"low": low, "high": high}).where("ref IS NULL AND (low IS NOT NULL OR high IS NOT NULL)")
    between = (F.col("high.v") - F.col("low.v")) / (F.col("high.cdf") - F.col("low.cdf")) * (F.col("cdf") - F.col("low.cdf")) + F.col("low.v")
    matched = F.when(F.col("low").isNull(), F.col("high.v")).when(F.col("high").isNull() | (F.col("low.cdf") == F.col("cdf")), F.col("low.v")).otherwise(between)
    return near.select(*each, *by, F.col("v").alias(value), matched.alias("matched"))


def mosaic(chunks: DataFrame) -> DataFrame:
    """One chunk per place: the first of the ordered sources wins. The place is the chunk's corner on the ground, or in its
    own image where chunks have no georeference."""
    place = ["x0", "y0"] if {"x0", "y0"} <= set(chunks.columns) else ["row0", "col0"]
    w = Window.partitionBy(*(["band"] if "band" in chunks.columns else []), *place).orderBy("source")
    return chunks.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def catalogue(chunks: DataFrame) -> DataFrame:
    """source and the extent of its chunks, in pixels and, where they are georeferenced, on the ground: the index that
    a virtual raster is."""
    ground = {"x0", "y0", "dx", "dy"} <= set(chunks.columns)
    more = (F.min("x0").alias("minx"), F.min(F.col("y0") - F.col("h") * F.col("dy")).alias("miny"), F.max(F.col("x0") + F.col("w") * F.col("dx")).alias("maxx"), F.max("y0").alias("maxy")) if ground else ()
    return chunks.groupBy("source").agg(F.min("row0").alias("row0"), F.min("col0").alias("col0"), F.max(F.col("row0") + F.col("h")).alias("row1"), F.max(F.col("col0") + F.col("w")).alias("col1"), *more)


def cubic_weight(t: Column) -> Column:
    """Weight of a pixel at a distance, by the cubic with a = -1/2."""
    a, t = -0.5, F.abs(t)
    near = (a + 2) * t * t * t - (a + 3) * t * t + 1
    far = a * t * t * t - 5 * a * t * t + 8 * a * t - 4 * a
    return F.when(t <= 1, near).when(t < 2, far).otherwise(0.0)
