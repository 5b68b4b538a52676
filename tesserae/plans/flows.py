"""The processing steps from raw detections to an assessed layer, as DataFrame functions on rectangles."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.config import Artifacts, Assess, Enrich, Fuse, Merge, Years
from tesserae.functions import rect
from tesserae.operators import fusion, matching, merging, overlay, raster, reports, selection, spatial, tiling
from tesserae.storage import exists, store

CELL = 256


# --- preparation -------------------------------------------------------------------------------------


def area_of_interest(region: DataFrame, footprint: DataFrame, canton: str, year: int, cell: float, system: str | None = None) -> DataFrame:
    """The region cut to the images' footprint, with where and when. With a system ('swiss' or 'mercator') both
    come in longitude and latitude and are projected first."""
    if system is not None:
        region, footprint = (tiling.projected(d, system) for d in (region, footprint))
    cut = overlay.intersection(region, footprint, cell).select(*rect.SIDES)
    return cut.withColumn("canton", F.lit(canton)).withColumn("flight_year", F.lit(year).cast("int"))


def categories(spark: SparkSession, text: str) -> DataFrame:
    """CATEGORY, label_class from a JSON object {id: {name, supercategory}}: classes count from 1 by id."""
    parsed = spark.createDataFrame([(text,)], "t string").select(F.explode(F.from_json("t", "map<string, struct<name: string, supercategory: string, id: int>>")).alias("id", "c"))
    from pyspark.sql import Window

    place = F.row_number().over(Window.orderBy(F.coalesce("c.id", F.col("id").try_cast("int")), "id"))
    return parsed.select(F.col("c.name").alias("CATEGORY"), place.cast("int").alias("label_class"))  # a row for each category


def labels(raw: DataFrame, category_field: str | None, topic: str) -> DataFrame:
    """Distinct shapes (within their year, if there is one), with CATEGORY and SUPERCATEGORY."""
    key = [*rect.SIDES, *(["year"] if "year" in raw.columns else [])]
    typed = raw.withColumn("year", F.col("year").cast("int")) if "year" in raw.columns else raw
    named = typed.withColumn("CATEGORY", F.col(category_field) if category_field else F.lit(topic)).withColumn("SUPERCATEGORY", F.lit(topic))
    return merging.first_rows(named, key, ["CATEGORY"]).select(*key, "CATEGORY", "SUPERCATEGORY")


def with_false_labels(own: DataFrame, false: DataFrame, category_field: str | None, topic: str) -> DataFrame:
    """own and a second label set, marked by tag; a shape that is in both stays own."""
    both = own.withColumn("tag", F.lit("own")).unionByName(labels(false, category_field, topic).withColumn("tag", F.lit("FP")), allowMissingColumns=True)
    key = [*rect.SIDES, *(["year"] if "year" in both.columns else [])]
    return merging.first_rows(both, key, [F.col("tag").desc()])


def check_years(first: DataFrame, second: DataFrame, what: str) -> None:
    """Both or neither have a year."""
    if ("year" in first.columns) != ("year" in second.columns):
        raise ValueError(f"{what}: one table has a year and the other has none")


def empty_tiles(aoi: DataFrame, id_col: str, zoom: int, year: int | tuple[int, int] | None = None, seed: int = 0) -> DataFrame:
    """Distinct tiles of areas in web mercator, with a fixed year or one drawn by tile from [low, high)."""
    tiles = merging.first_rows(tiling.tile_cover(aoi, zoom, id_col).drop(id_col), ["tile_id"], ["x"])
    if year is None:
        return tiles
    return tiles.withColumn("year", tiling.random_year(F.col("tile_id"), *year, seed) if isinstance(year, tuple) else F.lit(year).cast("int"))


def filtered_tiles(tiles: DataFrame, waters: DataFrame | None, dem: DataFrame | None, shrink: int = 420, elevation_max: float = 1000, cell: float = 400, dem_size: int = 400, or_all: bool = False) -> DataFrame:
    """Tiles whose centre lies in no water (shrunk, so that shores stay) and below the elevation. With `or_all`
    a filter that leaves no tile is not applied."""
    at = tiles.withColumn("x", (F.col("minx") + F.col("maxx")) / 2).withColumn("y", (F.col("miny") + F.col("maxy")) / 2)
    if waters is not None:
        inner = waters.select(*(c.alias(s) for s, c in rect.grown(-shrink).items())).where("minx < maxx AND miny < maxy")
        centres = at.select("tile_id", F.col("x").alias("minx"), F.col("y").alias("miny"), F.col("x").alias("maxx"), F.col("y").alias("maxy"))
        at = at.join(spatial.pairs(centres, inner, cell).select("l.tile_id").distinct(), "tile_id", "left_anti")
    if dem is not None:
        at = raster.sample(at, dem, dem_size).where(F.col("elevation") < elevation_max)
    left = at.drop("x", "y")
    return selection.or_else(left, tiles) if or_all else left


# --- detections --------------------------------------------------------------------------------------


def merge_within_year(raw: DataFrame, tiles: DataFrame, settings: Merge = Merge(), id_col: str = "det_id", cell: float = CELL) -> DataFrame:
    """Detections that tiles have cut made whole: rows inside a tile pass, the others merge with their
    neighbours of the year (and dataset, if those stay apart); mean score and class by covered area come
    from all raw rows that the result meets. Rows above the score stay."""
    same = ["year_det", *(["dataset"] if settings.keep_datasets_apart else [])]
    inside, across = merging.split_by_tile(raw, tiles, id_col, 400, settings.distance)
    groups = merging.proximity_groups(across, id_col, cell, settings.distance, same)
    merged = merging.merged_rectangles(across, groups, id_col, same).withColumnRenamed("group_id", "merge_id")
    voted = merging.vote(merged, raw, "merge_id", cell, [(c, c) for c in same])
    whole = merged.join(voted, "merge_id").select(F.col("merge_id").alias(id_col), *same, "score", "det_class", *rect.SIDES)
    every = whole.unionByName(inside.select(id_col, *same, "score", "det_class", *rect.SIDES))
    unique = merging.first_rows(every, [*rect.SIDES, *same], [F.col("score").desc(), id_col])
    return unique.where(F.col("score") > settings.score)


def fuse_models(dets: DataFrame, settings: Fuse = Fuse(), id_col: str = "merged_id", cell: float = CELL) -> DataFrame:
    return fusion.model_fusion(dets, id_col, settings.n_models, cell, settings.iou, settings.presence, settings.score, settings.small, settings.most, settings.area_max)


def fuse_years(dets: DataFrame, settings: Years = Years(), id_col: str = "merged_id", cell: float = CELL) -> DataFrame:
    return fusion.year_fusion(dets, id_col, cell, settings.iou, settings.grow)


def without_artifacts(dets: DataFrame, tiles: DataFrame, settings: Artifacts = Artifacts(), id_col: str = "group_id", cell: float = 400) -> tuple[DataFrame, DataFrame]:
    """Real detections and tile-shaped ones."""
    split = merging.artifacts(dets, tiles, id_col, cell, settings.area_min, settings.area_max, settings.iou, settings.years_max)
    return split.where("NOT is_artifact").drop("iou", "is_artifact"), split.where("is_artifact")


def filter_and_enrich(dets: DataFrame, aoi: DataFrame, dem: DataFrame, layers: dict[str, DataFrame], settings: Enrich = Enrich(), id_col: str = "det_id", cell: float = CELL, dem_size: int = 400) -> DataFrame:
    """Detections cut to the areas of interest, below the canton's elevation, with enough valid area, enough
    of it left or a compact shape; then shares of layers and the distance to the crop rotation areas.

    A detection that two areas cut counts as two parts, each with its own shares. Numbers are rounded to
    three digits at the end."""
    rows = dets.where("tag <> 'FN' OR tag IS NULL") if "tag" in dets.columns else dets
    met = spatial.area_pairs(rows, aoi, cell)
    common = rect.intersection("l.", "r.")
    parts = met.select(*(F.col(f"l.{c}").alias(c) for c in rows.columns if c not in rect.SIDES), rect.area("l.").alias("original_area"), F.col("r.canton").alias("canton"), *(c.alias(s) for s, c in common.items())).where(rect.area() > 0)
    parts = parts.withColumn("det_part_id", F.concat_ws("-", id_col, "canton", "minx", "miny"))
    centred = parts.withColumn("x", (F.col("minx") + F.col("maxx")) / 2).withColumn("y", (F.col("miny") + F.col("maxy")) / 2)
    limit = F.lit(None).cast("double")
    for canton, metres in settings.elevation.items():
        limit = F.when(F.col("canton") == canton, F.lit(float(metres))).otherwise(limit)
    low = raster.sample(centred, dem, dem_size).drop("x", "y").where((F.col("elevation") != 0) & (F.col("elevation") < limit))
    taken = None
    for key in settings.exclude:
        taken = layers[key].select(*rect.SIDES) if taken is None else taken.union(layers[key].select(*rect.SIDES))
    left = overlay.difference_area(low, taken, "det_part_id", cell).select("det_part_id", F.col("left_area").cast("double").alias("valid_area")) if taken is not None else low.select("det_part_id", rect.area().cast("double").alias("valid_area"))
    shaped = low.join(left, "det_part_id").where(F.col("valid_area") > settings.area)
    shaped = shaped.withColumn("area_ratio", rect.rint(F.col("valid_area") / F.col("original_area"), 2)).withColumn("compactness", rect.rint(rect.compactness(), 2))
    out = shaped.where((F.col("area_ratio") > settings.area_ratio) | (F.col("compactness") > settings.compactness))
    for key in settings.overlap:
        share = overlay.overlap_sum(out, layers[key], "det_part_id", cell).select("det_part_id", rect.rint(F.col("ratio"), 3).alias(key))
        out = out.join(share, "det_part_id")
    if "sda" in layers:
        out, _ = store(out, "enriched")  # the nearest join reads it in every round
        near = spatial.nearest(out.select("det_part_id", *rect.SIDES), layers["sda"].select(*rect.SIDES), "det_part_id", "minx", 1000)
        out = out.join(near.groupBy(F.col("l.det_part_id").alias("det_part_id")).agg(rect.rint(F.min("distance"), 3).alias("distance_sda")), "det_part_id", "left")
    return out


def renamed(df: DataFrame, names: list[tuple[str, str]]) -> DataFrame:
    """Columns renamed by a mapping table, where they occur."""
    return df.withColumnsRenamed({a: b for a, b in names if a in df.columns})


# --- assessment and reports --------------------------------------------------------------------------


def assess(dets: DataFrame, truth: DataFrame, tiles: DataFrame | None, classes: DataFrame, settings: Assess = Assess(), cell: float = CELL) -> dict[str, DataFrame]:
    """tagged rows, metrics by class, averages (by dataset too, where both sides name one), geometric metrics and
    calibration."""
    if tiles is not None:
        cut = lambda d: overlay.clip_to_tiles(d, tiles, cell).select(*(F.col(f"l.{c}").alias(c) for c in d.columns if c not in rect.SIDES), *rect.SIDES)
        truth, dets = cut(truth), cut(dets)
    if settings.ignore_year:
        dets, truth = dets.withColumn("year_det", F.lit(0)), truth.withColumn("year_label", F.lit(0))
    tags = matching.tagged(dets, truth, cell, settings.iou, settings.area_min)
    by_class = matching.class_metrics(matching.class_counts(tags, classes))
    scored = tags.where("tag IN ('TP', 'FP', 'wrong class')").join(dets.select("det_id", "score"), "det_id").withColumn("is_right", F.col("tag") == "TP")
    out = {
        "tagged": tags, "by_class": by_class, "average": matching.averages(by_class, settings.method), "calibration": matching.calibration(scored),
        "geometric": matching.geometric_metrics(dets.withColumn("k", F.lit(1)), truth.withColumn("k", F.lit(1)), ["k"], int(cell)).drop("k"),
    }
    if "dataset" in dets.columns and "dataset" in truth.columns:
        each = matching.class_counts(matching.with_dataset(tags, dets, truth), classes, ["dataset"])
        out["by_dataset"] = matching.averages(matching.class_metrics(each), settings.method, ["dataset"])
    return out


def write_assessment(tables: dict[str, DataFrame], folder: str, overwrite: bool = True) -> None:
    """Metrics as CSV, a folder for each table; the tagged rows as Parquet with their final columns."""
    for name, df in tables.items():
        if name == "tagged":
            write(selection.final(df, ["tag", "det_id", "label_id", "iou", "det_class", "label_class"]), f"{folder}/{name}", overwrite)
        else:
            matching.write_metrics(df, f"{folder}/{name}", overwrite)


def charts(dets: DataFrame, elevation: str | None = "elevation") -> dict[str, DataFrame]:
    """The tables behind the charts of an untagged result."""
    out = {"first_year": reports.gap_filled(dets, "first_year"), "last_year": reports.gap_filled(dets, "last_year"), "lifespan": reports.lifespans(dets), "count_years": reports.gap_filled(dets, "count_years")}
    if elevation in dets.columns:
        out["elevation"] = reports.elevation_bins(dets, elevation)
    return out


def write(df: DataFrame, path: str, overwrite: bool = True, by_year: str | None = None) -> None:
    """Parquet, a folder for each year if asked for; left alone if it is there and not to be replaced."""
    out = df.write.mode("overwrite" if overwrite else "ignore")
    (out.partitionBy(by_year) if by_year else out).parquet(path)


def compile_years(spark: SparkSession, root: str, years: list[int]) -> DataFrame:
    """Rows of the years that are there, one frame; only their folders are read. Years without a folder are named in a
    warning."""
    missing = [y for y in years if not exists(spark, f"{root.rstrip('/')}/year={y}")]
    if missing:
        warnings.warn(f"no detections of {', '.join(map(str, missing))} below {root}", stacklevel=2)
    df = spark.read.option("basePath", root).parquet(root)
    return df.where(F.col("year").isin(years))
