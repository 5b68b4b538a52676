"""Object identity: groups by overlap, presence, scores, fusion across models and years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.functions import rect
from tesserae.operators import spatial
from tesserae.operators.components import connected_components
from tesserae.storage import store


def iou_edges(df: DataFrame, id_col: str, threshold: float, cell: float, same: list[str] = ("year_det",)) -> DataFrame:
    """src >= dst, iou of pairs (a row with itself included) with at least the threshold."""
    met = spatial.self_pairs(df, id_col, cell, list(same), columns=[id_col])
    return met.select(F.col(f"l.{id_col}").alias("src"), F.col(f"r.{id_col}").alias("dst"), rect.iou("l.", "r.").alias("iou")).where(F.col("iou") >= threshold)


def group_detections(df: DataFrame, id_col: str, threshold: float, cell: float, same: list[str] = ("year_det",)) -> DataFrame:
    """df with group_id, the least id of the component of overlapping rows; null if a row overlaps
    nothing, not even itself. A group_id from an earlier step is replaced."""
    df = df.drop("group_id")
    found = connected_components(iou_edges(df, id_col, threshold, cell, same))
    return df.join(found.select(F.col("node").alias(id_col), F.col("component").alias("group_id")), id_col, "left")


def presence(df: DataFrame, n_models: int) -> DataFrame:
    """df with count_dets, presence (share of the models that saw the group, at most 1) and
    merged_score."""
    counts = df.where("group_id IS NOT NULL").groupBy("group_id").agg(F.count(F.lit(1)).alias("count_dets"))
    joined = df.join(counts, "group_id", "left")
    share = F.coalesce(F.least(F.col("count_dets") / F.lit(n_models), F.lit(1.0)), F.lit(0.0))
    return joined.withColumn("presence", share).withColumn("merged_score", F.col("score") * F.col("presence"))


def best_in_group(df: DataFrame, id_col: str) -> DataFrame:
    """The row with the best merged score of each group, ties to the smaller id; ungrouped rows go."""
    order = Window.partitionBy("group_id").orderBy(F.col("merged_score").desc(), id_col)
    return df.where("group_id IS NOT NULL").withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def best_by_presence(df: DataFrame, n_models: int, id_col: str) -> DataFrame:
    """best_in_group of presence, for rows that all have a group: they travel once, to where their group is counted."""
    counted = df.withColumn("count_dets", F.count(F.lit(1)).over(Window.partitionBy("group_id")))
    share = F.least(F.col("count_dets") / F.lit(n_models), F.lit(1.0))
    return best_in_group(counted.withColumn("presence", share).withColumn("merged_score", F.col("score") * F.col("presence")), id_col)


def keep_or_remove(df: DataFrame, presence_min: float, score_min: float, small: int, most: int, sure: float = 0.5, area: Column | None = None) -> DataFrame:
    """df with status: 'kept', 'presence' or 'size', the first rule that removes a row. `area` is the rectangle's if none
    is given."""
    area = rect.area() if area is None else area
    seen = F.coalesce(F.col("presence") > presence_min, F.lit(False))
    sound = (F.col("merged_score") > score_min) & ((F.col("merged_score") > sure) | (area < small)) & (area < most)
    return df.withColumn("status", F.when(~seen, "presence").when(~F.coalesce(sound, F.lit(False)), "size").otherwise("kept"))


def second_overlap(df: DataFrame, id_col: str, cell: float, same: list[str] = ("year_det",)) -> DataFrame:
    """id, second_iou, top_id: for each row that meets another, the greatest share of it that another one
    covers and, independently, the greatest id it meets."""
    met = spatial.self_pairs(df, id_col, cell, list(same), strict=True, columns=[id_col])
    shared = rect.shared_area("l.", "r.").cast("double")
    a, b = F.col(f"l.{id_col}"), F.col(f"r.{id_col}")
    sides = met.select(F.explode(F.array(
        F.struct(a.alias("id"), b.alias("other"), F.try_divide(shared, rect.area("l.").cast("double")).alias("share")),
        F.struct(b.alias("id"), a.alias("other"), F.try_divide(shared, rect.area("r.").cast("double")).alias("share")))).alias("s"))
    return sides.groupBy(F.col("s.id").alias(id_col)).agg(F.max("s.share").alias("second_iou"), F.max("s.other").alias("top_id"))


def without_covered(df: DataFrame, second: DataFrame, id_col: str, most: float = 0.9) -> tuple[DataFrame, DataFrame]:
    """Rows that aren't covered by another, and the covered ones; both with second_iou and top_id."""
    joined = df.join(second, id_col, "left")
    stays = F.coalesce(F.col("second_iou") < most, F.lit(True))
    return joined.where(stays), joined.where(~stays)


def with_bonus(kept: DataFrame, covered: DataFrame, id_col: str, presence_min: float = 0.75, step: float = 0.1) -> DataFrame:
    """kept with merged_score raised by a step, up to 1, for each covered row with high presence that
    names it."""
    counts = covered.where(F.col("presence") >= presence_min).groupBy(F.col("top_id").alias(id_col)).agg(F.count(F.lit(1)).alias("__n"))
    joined = kept.join(counts, id_col, "left")
    raised = F.when(F.col("__n").isNull(), F.col("merged_score")).otherwise(F.least(F.lit(1.0), F.col("merged_score") + step * F.col("__n")))
    return joined.withColumn("merged_score", raised).drop("__n")


def dissolve_first(df: DataFrame, by: str, order: list, columns: list[str]) -> DataFrame:
    """A row for each group: the bounds of its union and, of each column, the first non-null value in
    order. Columns are looked at one by one, so a row may mix sources."""
    w = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = df.select(by, *rect.SIDES, *(F.first(c, ignorenulls=True).over(w).alias(c) for c in columns))
    return firsts.groupBy(by, *columns).agg(*((F.min if s.startswith("min") else F.max)(s).alias(s) for s in rect.SIDES))


def model_fusion(df: DataFrame, id_col: str, n_models: int, cell: float, threshold: float = 0.5, presence_min: float = 0.2, score_min: float = 0.1, small: int = 30_000, most: int = 60_000, area_max: int = 300_000) -> DataFrame:
    """Detections of several models made one layer: grouped by overlap within a year, scored by
    presence, reduced to the best row, filtered, freed of covered rows, with bonuses. The best rows are stored: they
    meet themselves and are read again for covered ones."""
    grouped = group_detections(df.where(rect.area() < area_max), id_col, threshold, cell)
    best = best_in_group(presence(grouped, n_models), id_col)
    kept, _ = store(keep_or_remove(best, presence_min, score_min, small, most).where("status = 'kept'").drop("status"), "fused")
    kept, covered = without_covered(kept, second_overlap(kept, id_col, cell), id_col)
    return with_bonus(kept, covered, id_col)


def year_fusion(df: DataFrame, id_col: str, cell: float, threshold: float, grow: int = 5) -> DataFrame:
    """Objects across years: grouped by overlap of grown rectangles whatever the year; the group's bounds
    are shrunk again. first_year, last_year, count_years and the best row's attributes."""
    grown = df.select(*(c for c in df.columns if c not in rect.SIDES), *(c.alias(s) for s, c in rect.grown(grow).items()))
    grouped = group_detections(grown, id_col, threshold, cell, same=[])
    years = grouped.groupBy("group_id").agg(F.min("year_det").alias("first_year"), F.max("year_det").alias("last_year"), F.count_distinct("year_det").alias("count_years"))
    one = dissolve_first(grouped, "group_id", [F.col("merged_score").desc(), F.col(id_col)], [id_col, "merged_score"])
    shrunk = one.select("group_id", id_col, "merged_score", *(c.alias(s) for s, c in rect.grown(-grow).items()))
    return shrunk.join(years, "group_id")
