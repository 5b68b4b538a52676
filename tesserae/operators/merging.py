"""Merging detections that tiling has cut, within one year."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesserae.functions import rect
from tesserae.operators import spatial
from tesserae.operators.components import connected_components


def within_tile(df: DataFrame, tiles: DataFrame, id_col: str, cell: float, grow: int) -> DataFrame:
    """Ids of rows whose grown rectangle lies inside a tile, whatever the tile's year."""
    grown = df.select(id_col, *(c.alias(s) for s, c in rect.grown(grow).items()))
    return spatial.pairs(tiles, grown, cell, predicate=rect.contains).select(F.col(f"r.{id_col}").alias(id_col)).distinct()


def split_by_tile(df: DataFrame, tiles: DataFrame, id_col: str, cell: float, grow: int) -> tuple[DataFrame, DataFrame]:
    """Rows wholly inside a tile, and the others."""
    inside = within_tile(df, tiles, id_col, cell, grow)
    return df.join(inside, id_col, "left_semi"), df.join(inside, id_col, "left_anti")


def proximity_groups(df: DataFrame, id_col: str, cell: float, grow: int, same: list[str]) -> DataFrame:
    """id, group_id: components of grown rectangles that overlap or share an edge. Meeting in a corner
    alone does not join, as the union would stay in parts."""
    grown = df.select(id_col, *same, *(c.alias(s) for s, c in rect.grown(grow).items()))
    c = rect.intersection("l.", "r.")
    edge = (c["maxx"] > c["minx"]) | (c["maxy"] > c["miny"])
    met = spatial.self_pairs(grown, id_col, cell, same, columns=[id_col]).where(edge)
    found = connected_components(met.select(F.col(f"l.{id_col}").alias("src"), F.col(f"r.{id_col}").alias("dst")))
    return found.select(F.col("node").alias(id_col), F.col("component").alias("group_id"))


def merged_rectangles(df: DataFrame, groups: DataFrame, id_col: str, by: list[str]) -> DataFrame:
    """A row for each group: the bounds of its members."""
    return df.join(groups, id_col).groupBy("group_id", *by).agg(*((F.min if s.startswith("min") else F.max)(s).alias(s) for s in rect.SIDES), F.count(F.lit(1)).alias("parts"))


def vote(merged: DataFrame, raw: DataFrame, merged_id: str, cell: float, keys: list[tuple[str, str]]) -> DataFrame:
    """merged_id, score, det_class: the mean score of all raw rows that meet a merged one, and the class
    that covers most area among them, ties to the smaller class."""
    met = spatial.pairs(merged, raw, cell, keys).select(F.col(f"l.{merged_id}").alias(merged_id), F.col("r.score").alias("score"), F.col("r.det_class").alias("det_class"), rect.area("r.").alias("area"))
    return voted(met, merged_id)


def voted(met: DataFrame, merged_id: str) -> DataFrame:
    """merged_id, score, det_class from a row (merged_id, score, det_class, area) for each raw row that a merged one meets:
    sums by class, which are combined before they travel, give both."""
    by_class = met.groupBy(merged_id, "det_class").agg(F.sum("area").alias("area"), F.sum("score").alias("total"), F.count("score").alias("n"))
    return by_class.groupBy(merged_id).agg(F.try_divide(F.sum("total"), F.sum("n")).alias("score"), F.max_by("det_class", F.struct("area", -F.col("det_class"))).alias("det_class"))


def artifacts(df: DataFrame, tiles: DataFrame, id_col: str, cell: float, area_min: int, area_max: int, iou_min: float, years_max: int = 2) -> DataFrame:
    """df with iou (best overlap with a tile, 2 digits, null unless a candidate) and is_artifact: of tile-like
    size, seen in few years, and of a tile's shape. The overlap is rounded before it is compared."""
    candidate = (rect.area() > area_min) & (rect.area() < area_max) & (F.col("count_years") <= years_max)
    met = spatial.pairs(df.where(candidate), tiles, cell).select(F.col(f"l.{id_col}").alias(id_col), rect.iou("l.", "r.").alias("iou"))
    best = met.groupBy(id_col).agg(F.max("iou").alias("iou")).withColumn("iou", rect.rint(F.col("iou"), 2))
    return df.join(best, id_col, "left").withColumn("is_artifact", F.coalesce(F.col("iou") >= iou_min, F.lit(False)))


def first_rows(df: DataFrame, subset: list[str], order: list) -> DataFrame:
    """One row of each key, the first in order."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*subset).orderBy(*order))).where("__n = 1").drop("__n")
