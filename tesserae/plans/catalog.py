"""All detection queries, each an application of the operators to fixtures, with DuckDB SQL beside it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.config import BEST_THRESHOLDS
from tesserae.functions import rect
from tesserae.operators import fusion, matching, merging, overlay, raster, reports, spatial, tiling
from tesserae.plans.fixtures import frame, with_clause
from tesserae.storage import store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

CELL, IOU = 256, 0.5
#: Unions cut shapes at the lines of a wider grid, so that few are cut.
UNION_CELL = 1024
AREA = "({0}.maxx - {0}.minx) * ({0}.maxy - {0}.miny)"
MEETS = "{0}.minx <= {1}.maxx AND {1}.minx <= {0}.maxx AND {0}.miny <= {1}.maxy AND {1}.miny <= {0}.maxy"
SHARED = "greatest(least({0}.maxx, {1}.maxx) - greatest({0}.minx, {1}.minx), 0) * greatest(least({0}.maxy, {1}.maxy) - greatest({0}.miny, {1}.miny), 0)"


def sql_area(a: str) -> str:
    return AREA.format(a)


def sql_meets(a: str, b: str) -> str:
    return MEETS.format(a, b)


def sql_shared(a: str, b: str) -> str:
    return SHARED.format(a, b)


def sql_iou(a: str, b: str) -> str:
    return f"CAST({sql_shared(a, b)} AS DOUBLE) / ({sql_area(a)} + {sql_area(b)} - {sql_shared(a, b)})"


def sql_r6(x: str) -> str:
    return f"round_even(({x}) * 1e6, 0) / 1e6"


def r6(c):
    return rect.rint(F.col(c) if isinstance(c, str) else c, 6)


def query(sql: str):
    """Registers a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def det(spark, d):
    return frame(spark, d, "fx_det")


def labels(spark, d):
    return frame(spark, d, "fx_label")


# --- scans, filters, projections -------------------------------------------------------------------


@query(with_clause("fx_det") + f" SELECT dataset, count(*) AS n, CAST(sum({sql_area('d')}) AS BIGINT) AS total_area FROM fx_det d GROUP BY dataset")
def scan_union_dataset(spark, d):
    """One frame per dataset, each with its constant column, appended."""
    parts = [det(spark, d).where(F.col("dataset") == k).drop("dataset").withColumn("dataset", F.lit(k)) for k in ("trn", "val", "tst")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"), F.sum(rect.area()).alias("total_area"))


_thd = "CASE model " + " ".join(f"WHEN {k} THEN CAST({v} AS DOUBLE)" for k, v in BEST_THRESHOLDS.items()) + " END"


@query(with_clause("fx_det") + f" SELECT merged_id, model, {_thd} AS threshold FROM fx_det WHERE score > {_thd}")
def threshold_lookup(spark, d):
    known = spark.createDataFrame([*BEST_THRESHOLDS.items()], "model int, threshold double")
    return det(spark, d).join(F.broadcast(known), "model").where("score > threshold").select("merged_id", "model", "threshold")


@query(with_clause("fx_det") + " SELECT merged_id, score FROM fx_det WHERE score > 0.05")
def score_filter(spark, d):
    return det(spark, d).where(F.col("score") > 0.05).select("merged_id", "score")


@query(with_clause("fx_det") + " SELECT merged_id, CASE WHEN det_class = 0 THEN 'quarry' WHEN det_class = 1 THEN 'landfill' END AS category FROM fx_det")
def category_lookup(spark, d):
    """Class names by class id, without losing rows of unknown class."""
    names = spark.createDataFrame([("quarry", 1), ("landfill", 2)], "category string, label_class int")
    return det(spark, d).join(F.broadcast(names), F.col("label_class") == F.col("det_class") + 1, "left").select("merged_id", "category")


@query(with_clause("fx_det") + " SELECT site, year_det, merged_id FROM (SELECT *, row_number() OVER (PARTITION BY site, year_det ORDER BY score DESC, merged_id) AS n FROM fx_det) WHERE n = 1")
def distinct_first(spark, d):
    return merging.first_rows(det(spark, d), ["site", "year_det"], [F.col("score").desc(), "merged_id"]).select("site", "year_det", "merged_id")


# --- spatial joins -----------------------------------------------------------------------------------

_same_site = "a.site = b.site"
_det_label = f"SELECT a.merged_id, b.label_id FROM fx_det a JOIN fx_label b ON {_same_site} AND a.year_det = b.year_label AND {sql_meets('a', 'b')}"


@query(with_clause("fx_det", "fx_label") + " " + _det_label)
def sjoin_inner(spark, d):
    return spatial.pairs(det(spark, d), labels(spark, d), CELL, [("year_det", "year_label")]).select("l.merged_id", "r.label_id")


@query(with_clause("fx_det", "fx_label") + " " + _det_label)
def sjoin_dense(spark, d):
    """The inner join with its crowded cells split."""
    dets, truth = det(spark, d), labels(spark, d)
    dense = spatial.dense_cells(dets, truth, CELL, 100)
    return spatial.pairs(dets, truth, CELL, [("year_det", "year_label")], dense=dense).select("l.merged_id", "r.label_id")


@query(with_clause("fx_det", "fx_label", more=f"p AS ({_det_label})") + " SELECT d.merged_id, p.label_id FROM fx_det d LEFT JOIN p USING (merged_id)")
def sjoin_left(spark, d):
    return spatial.left_pairs(det(spark, d), labels(spark, d), "merged_id", CELL, keys=[("year_det", "year_label")]).select("l.merged_id", "r.label_id")


@query(with_clause("fx_det", "fx_label", more=f"p AS ({_det_label})") + " SELECT p.merged_id, l.label_id FROM fx_label l LEFT JOIN p USING (label_id)")
def sjoin_right(spark, d):
    return spatial.left_pairs(labels(spark, d), det(spark, d), "label_id", CELL, keys=[("year_label", "year_det")]).select("r.merged_id", "l.label_id")


_inside = (
    "SELECT DISTINCT d.merged_id, t.tile_id FROM fx_det d JOIN fx_tile t"
    " ON t.tx = CAST(floor((d.minx - 10) / 400) AS BIGINT) AND t.ty = CAST(floor((d.miny - 10) / 400) AS BIGINT)"
    " AND t.minx <= d.minx - 10 AND t.maxx >= d.maxx + 10 AND t.miny <= d.miny - 10 AND t.maxy >= d.maxy + 10"
)


@query(with_clause("fx_det", "fx_tile") + " " + _inside)
def sjoin_contains(spark, d):
    grown = det(spark, d).select("merged_id", *(c.alias(s) for s, c in rect.grown(10).items()))
    return spatial.pairs(frame(spark, d, "fx_tile"), grown, 400, predicate=rect.contains).select("r.merged_id", "l.tile_id")


@query(with_clause("fx_det", "fx_tile", more=f"p AS ({_inside})") + " SELECT merged_id FROM fx_det WHERE merged_id IN (SELECT merged_id FROM p)")
def within_tile_semi(spark, d):
    return merging.split_by_tile(det(spark, d), frame(spark, d, "fx_tile"), "merged_id", 400, 10)[0].select("merged_id")


@query(with_clause("fx_det", "fx_tile", more=f"p AS ({_inside})") + " SELECT merged_id FROM fx_det WHERE merged_id NOT IN (SELECT merged_id FROM p)")
def across_tile_anti(spark, d):
    return merging.split_by_tile(det(spark, d), frame(spark, d, "fx_tile"), "merged_id", 400, 10)[1].select("merged_id")


_self = f"FROM fx_det a JOIN fx_det b ON {_same_site} AND a.merged_id >= b.merged_id AND {sql_meets('a', 'b')}"


@query(with_clause("fx_det") + f" SELECT a.merged_id AS id_left, b.merged_id AS id_right {_self} AND a.year_det = b.year_det")
def self_join_pairs(spark, d):
    return spatial.self_pairs(det(spark, d), "merged_id", CELL, ["year_det"], columns=["merged_id"]).select(F.col("l.merged_id").alias("id_left"), F.col("r.merged_id").alias("id_right"))


@query(with_clause("fx_det") + f" SELECT a.site, count(*) AS n, CAST(sum(a.merged_id - b.merged_id) AS BIGINT) AS gap {_self} GROUP BY a.site")
def self_join_ignore_year(spark, d):
    met = spatial.self_pairs(det(spark, d), "merged_id", CELL, columns=["merged_id", "site"])
    return met.groupBy(F.col("l.site").alias("site")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l.merged_id") - F.col("r.merged_id")).alias("gap"))


_dist = "sqrt(power(CAST(greatest(l.minx - s.maxx, s.minx - l.maxx, 0) AS DOUBLE), 2) + power(CAST(greatest(l.miny - s.maxy, s.miny - l.maxy, 0) AS DOUBLE), 2))"


@query(with_clause("fx_label", "fx_layer", more=f"p AS (SELECT l.label_id, s.layer_id, {_dist} AS distance FROM fx_label l CROSS JOIN fx_layer s WHERE s.layer_key = 'sda')") + f" SELECT label_id, layer_id, {sql_r6('distance')} AS distance FROM (SELECT *, min(distance) OVER (PARTITION BY label_id) AS m FROM p) WHERE distance = m")
def nearest_join(spark, d):
    sda = frame(spark, d, "fx_layer").where("layer_key = 'sda'")
    return spatial.nearest(labels(spark, d), sda, "label_id", "layer_id", 2000).select("l.label_id", "r.layer_id", r6("distance").alias("distance"))


# --- overlap graphs and fusion -----------------------------------------------------------------------

_edges = f"e AS (SELECT a.merged_id AS src, b.merged_id AS dst, {sql_iou('a', 'b')} AS iou {_self} AND a.year_det = b.year_det WHERE {sql_iou('a', 'b')} >= {IOU})"
_any_edges = f"e AS (SELECT a.merged_id AS src, b.merged_id AS dst {_self} WHERE {sql_iou('a', 'b')} >= 0.8)"
_walk = "w AS (SELECT src AS a, src AS b FROM e UNION SELECT w.a, s.dst FROM w JOIN (SELECT src, dst FROM e UNION SELECT dst, src FROM e) s ON w.b = s.src), g AS (SELECT a AS merged_id, min(b) AS group_id FROM w GROUP BY a)"
_scored = "c AS (SELECT group_id, count(*) AS count_dets FROM g GROUP BY group_id), p AS (SELECT d.*, g.group_id, c.count_dets, least(c.count_dets / 5.0::DOUBLE, 1.0::DOUBLE) AS presence, d.score * least(c.count_dets / 5.0::DOUBLE, 1.0::DOUBLE) AS merged_score FROM fx_det d JOIN g USING (merged_id) JOIN c USING (group_id))"
_best = "b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY merged_score DESC, merged_id) AS n FROM p) WHERE n = 1)"
_status = f"st AS (SELECT *, CASE WHEN NOT presence > 0.2 THEN 'presence' WHEN NOT (merged_score > 0.1 AND (merged_score > 0.5 OR {sql_area('b')} < 30000) AND {sql_area('b')} < 60000) THEN 'size' ELSE 'kept' END AS status FROM b)"
_second = f"k AS (SELECT * FROM st WHERE status = 'kept'), m AS (SELECT a.merged_id AS x, b.merged_id AS y, CAST({sql_shared('a', 'b')} AS DOUBLE) AS s, {sql_area('a')} AS ax, {sql_area('b')} AS ay FROM k a JOIN k b ON {_same_site} AND a.year_det = b.year_det AND a.merged_id > b.merged_id AND {sql_meets('a', 'b')}), o AS (SELECT merged_id, max(share) AS second_iou, max(other) AS top_id FROM (SELECT x AS merged_id, y AS other, s / ax AS share FROM m UNION ALL SELECT y, x, s / ay FROM m) GROUP BY merged_id), ko AS (SELECT k.*, o.second_iou, o.top_id FROM k LEFT JOIN o USING (merged_id))"
_bonus = "bo AS (SELECT top_id AS merged_id, count(*) AS nb FROM ko WHERE second_iou >= 0.9 AND presence >= 0.75 GROUP BY top_id), f AS (SELECT ko.* EXCLUDE (merged_score), coalesce(nb, 0) AS nb, CASE WHEN nb IS NULL THEN ko.merged_score ELSE least(1.0::DOUBLE, ko.merged_score + 0.1::DOUBLE * nb) END AS merged_score FROM ko LEFT JOIN bo USING (merged_id) WHERE second_iou IS NULL OR second_iou < 0.9)"


def _grouped(spark, d):
    return fusion.group_detections(det(spark, d), "merged_id", IOU, CELL)


def _best_rows(spark, d):
    return fusion.best_in_group(fusion.presence(_grouped(spark, d), 5), "merged_id")


def _kept(spark, d):
    """Stored, as the kept rows meet themselves and are read again for covered ones."""
    return store(fusion.keep_or_remove(_best_rows(spark, d), 0.2, 0.1, 30_000, 60_000).where("status = 'kept'").drop("status"), "kept")[0]


@query(with_clause("fx_det", more=_edges) + f" SELECT src, dst, {sql_r6('iou')} AS iou FROM e")
def iou_pairs(spark, d):
    return fusion.iou_edges(det(spark, d), "merged_id", IOU, CELL).select("src", "dst", r6("iou").alias("iou"))


@query(with_clause("fx_det") + f" SELECT a.merged_id AS id_left, b.merged_id AS id_right, {sql_r6(f'CAST({sql_shared("a", "b")} AS DOUBLE) / ({sql_area("a")})')} AS share_left, {sql_r6(f'CAST({sql_shared("a", "b")} AS DOUBLE) / ({sql_area("b")})')} AS share_right {_self} AND a.year_det = b.year_det AND a.merged_id > b.merged_id")
def containment_pairs(spark, d):
    met = spatial.self_pairs(det(spark, d), "merged_id", CELL, ["year_det"], strict=True, columns=["merged_id"])
    shared = rect.shared_area("l.", "r.").cast("double")
    return met.select(F.col("l.merged_id").alias("id_left"), F.col("r.merged_id").alias("id_right"), r6(shared / rect.area("l.")).alias("share_left"), r6(shared / rect.area("r.")).alias("share_right"))


@query(with_clause("fx_det", more=f"{_edges}, {_walk}") + " SELECT merged_id, group_id FROM g")
def components_same_year(spark, d):
    return _grouped(spark, d).select("merged_id", "group_id")


@query(with_clause("fx_det", more=f"{_any_edges}, {_walk}") + " SELECT merged_id, group_id FROM g")
def components_any_year(spark, d):
    return fusion.group_detections(det(spark, d), "merged_id", 0.8, CELL, same=[]).select("merged_id", "group_id")


@query(with_clause("fx_det", more=f"{_edges}, {_walk}, {_scored}") + f" SELECT merged_id, group_id, count_dets, {sql_r6('presence')} AS presence, {sql_r6('merged_score')} AS merged_score FROM p")
def presence_score(spark, d):
    return fusion.presence(_grouped(spark, d), 5).select("merged_id", "group_id", "count_dets", r6("presence").alias("presence"), r6("merged_score").alias("merged_score"))


@query(with_clause("fx_det", more=f"{_edges}, {_walk}, {_scored}, {_best}") + f" SELECT group_id, merged_id, model, {sql_r6('merged_score')} AS merged_score FROM b")
def best_in_group(spark, d):
    return _best_rows(spark, d).select("group_id", "merged_id", "model", r6("merged_score").alias("merged_score"))


@query(with_clause("fx_det", more=f"{_edges}, {_walk}, {_scored}, {_best}, {_status}") + " SELECT merged_id, status FROM st")
def filter_keep_remove(spark, d):
    return fusion.keep_or_remove(_best_rows(spark, d), 0.2, 0.1, 30_000, 60_000).select("merged_id", "status")


@query(with_clause("fx_det", more=f"{_edges}, {_walk}, {_scored}, {_best}, {_status}, {_second}") + f" SELECT merged_id, {sql_r6('second_iou')} AS second_iou, top_id FROM o")
def under_other_max(spark, d):
    return fusion.second_overlap(_kept(spark, d), "merged_id", CELL).select("merged_id", r6("second_iou").alias("second_iou"), "top_id")


@query(with_clause("fx_det", more=f"{_edges}, {_walk}, {_scored}, {_best}, {_status}, {_second}, {_bonus}") + f" SELECT merged_id, {sql_r6('merged_score')} AS merged_score FROM f WHERE nb > 0")
def bonus_score(spark, d):
    kept = _kept(spark, d)
    stay, covered = fusion.without_covered(kept, fusion.second_overlap(kept, "merged_id", CELL), "merged_id")
    named = covered.where("presence >= 0.75").select(F.col("top_id").alias("merged_id")).distinct()
    return fusion.with_bonus(stay, covered, "merged_id").join(named, "merged_id", "left_semi").select("merged_id", r6("merged_score").alias("merged_score"))


@query(with_clause("fx_det", more=f"{_edges}, {_walk}, {_scored}, {_best}, {_status}, {_second}, {_bonus}") + f" SELECT merged_id, group_id, year_det, count_dets, {sql_r6('presence')} AS presence, {sql_r6('merged_score')} AS merged_score, {sql_r6('second_iou')} AS second_iou, minx, miny, maxx, maxy FROM f")
def model_fusion(spark, d):
    out = fusion.model_fusion(det(spark, d), "merged_id", 5, CELL)
    return out.select("merged_id", "group_id", "year_det", "count_dets", r6("presence").alias("presence"), r6("merged_score").alias("merged_score"), r6("second_iou").alias("second_iou"), *rect.SIDES)


_grown_edges = "gd AS (SELECT * REPLACE (minx - 5 AS minx, miny - 5 AS miny, maxx + 5 AS maxx, maxy + 5 AS maxy) FROM fx_det), " + _any_edges.replace("fx_det", "gd")


@query(with_clause("fx_det", more=f"{_grown_edges}, {_walk}, j AS (SELECT gd.*, g.group_id FROM gd JOIN g USING (merged_id))") + f" SELECT group_id, min(year_det) AS first_year, max(year_det) AS last_year, count(DISTINCT year_det) AS count_years, {sql_r6('max(score)')} AS score, min(minx) + 5 AS minx, min(miny) + 5 AS miny, max(maxx) - 5 AS maxx, max(maxy) - 5 AS maxy FROM j GROUP BY group_id")
def year_fusion(spark, d):
    scored = det(spark, d).withColumn("merged_score", F.col("score"))
    out = fusion.year_fusion(scored, "merged_id", CELL, 0.8)
    return out.select("group_id", "first_year", "last_year", "count_years", r6("merged_score").alias("score"), *rect.SIDES)


@query(with_clause("fx_det", more=f"{_edges}, {_walk}, j AS (SELECT fx_det.*, g.group_id, CASE WHEN score >= 0.3 THEN model END AS seen_by FROM fx_det JOIN g USING (merged_id))") + " SELECT group_id, arg_min(seen_by, (-score, merged_id)) FILTER (seen_by IS NOT NULL) AS seen_by, arg_min(dataset, (-score, merged_id)) AS dataset, min(minx) AS minx, max(maxx) AS maxx FROM j GROUP BY group_id")
def dissolve_first(spark, d):
    """First non-null of each column by falling score, column by column."""
    j = _grouped(spark, d).withColumn("seen_by", F.when(F.col("score") >= 0.3, F.col("model")))
    return fusion.dissolve_first(j, "group_id", [F.col("score").desc(), "merged_id"], ["seen_by", "dataset"]).select("group_id", "seen_by", "dataset", "minx", "maxx")


_near = "e AS (SELECT a.merged_id AS src, b.merged_id AS dst FROM fx_det a JOIN fx_det b ON a.site = b.site AND a.year_det = b.year_det AND a.dataset = b.dataset AND a.merged_id >= b.merged_id AND a.minx - 10 <= b.maxx + 10 AND b.minx - 10 <= a.maxx + 10 AND a.miny - 10 <= b.maxy + 10 AND b.miny - 10 <= a.maxy + 10 WHERE least(a.maxx, b.maxx) + 20 > greatest(a.minx, b.minx) OR least(a.maxy, b.maxy) + 20 > greatest(a.miny, b.miny))"
_merged = f"{_near}, {_walk}, mg AS (SELECT group_id, year_det, dataset, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy, count(*) AS parts FROM fx_det JOIN g USING (merged_id) GROUP BY group_id, year_det, dataset)"


@query(with_clause("fx_det", more=_merged) + " SELECT group_id, year_det, dataset, minx, miny, maxx, maxy, parts FROM mg")
def proximity_merge(spark, d):
    groups = merging.proximity_groups(det(spark, d), "merged_id", CELL, 10, ["year_det", "dataset"])
    return merging.merged_rectangles(det(spark, d), groups, "merged_id", ["year_det", "dataset"])


@query(with_clause("fx_det", more=f"{_merged}, vv AS (SELECT mg.group_id, r.score, r.model AS det_class, {sql_area('r')} AS area FROM mg JOIN fx_det r ON mg.year_det = r.year_det AND {sql_meets('mg', 'r')} AND r.minx // 1000 BETWEEN mg.minx // 1000 AND mg.maxx // 1000), v2 AS (SELECT group_id, det_class, sum(area) AS area FROM vv GROUP BY ALL)") + f" SELECT group_id, {sql_r6('avg(score)')} AS score, (SELECT det_class FROM v2 WHERE v2.group_id = vv.group_id ORDER BY area DESC, det_class LIMIT 1) AS det_class FROM vv GROUP BY group_id")
def class_vote(spark, d):
    """Mean score and most covered class; the model id plays the class, so that classes differ."""
    raw = det(spark, d).withColumn("det_class", F.col("model"))
    merged = proximity_merge(spark, d)
    return merging.vote(merged, raw, "group_id", CELL, [("year_det", "year_det")]).select("group_id", r6("score").alias("score"), "det_class")


_years = f"{_grown_edges}, {_walk}, yf AS (SELECT group_id, count(DISTINCT year_det) AS count_years, min(minx) + 5 AS minx, min(miny) + 5 AS miny, max(maxx) - 5 AS maxx, max(maxy) - 5 AS maxy FROM (SELECT gd.*, g.group_id FROM gd JOIN g USING (merged_id)) GROUP BY group_id)"
_art = f"{_years}, ca AS (SELECT * FROM yf WHERE {sql_area('yf')} > 20000 AND {sql_area('yf')} < 60000 AND count_years <= 2), ti AS (SELECT ca.group_id, round_even(max({sql_iou('ca', 't')}) * 100, 0) / 100 AS iou FROM ca JOIN fx_tile t ON t.tx BETWEEN ca.minx // 400 - 1 AND ca.maxx // 400 AND t.ty BETWEEN ca.miny // 400 - 1 AND ca.maxy // 400 AND {sql_meets('ca', 't')} GROUP BY ca.group_id)"


@query(with_clause("fx_det", more=f"{_years}") + f" SELECT group_id, {sql_area('yf')} AS area, count_years FROM yf WHERE {sql_area('yf')} > 20000 AND {sql_area('yf')} < 60000 AND count_years <= 2")
def artifact_candidates(spark, d):
    fused = year_fusion(spark, d).withColumn("area", rect.area())
    return fused.where("area > 20000 AND area < 60000 AND count_years <= 2").select("group_id", "area", "count_years")


@query(with_clause("fx_det", "fx_tile", more=_art) + " SELECT yf.group_id, ti.iou, coalesce(ti.iou >= 0.2, false) AS is_artifact FROM yf LEFT JOIN ti USING (group_id)")
def artifact_split(spark, d):
    return merging.artifacts(year_fusion(spark, d), frame(spark, d, "fx_tile"), "group_id", 400, 20_000, 60_000, 0.2).select("group_id", "iou", "is_artifact")


@query(with_clause("fx_det", more=_years.replace("count(DISTINCT year_det) AS count_years", "min(year_det) AS first_year, max(year_det) AS last_year")) + " SELECT first_year, last_year - first_year AS lifespan, count(*) AS n FROM yf GROUP BY ALL")
def lifespan_counts(spark, d):
    return reports.lifespans(year_fusion(spark, d))


# --- overlays and enrichment -------------------------------------------------------------------------


@query(with_clause("fx_det", "fx_aoi") + f" SELECT d.merged_id, a.canton, greatest(d.minx, a.minx) AS minx, greatest(d.miny, a.miny) AS miny, least(d.maxx, a.maxx) AS maxx, least(d.maxy, a.maxy) AS maxy FROM fx_det d JOIN fx_aoi a ON {sql_meets('d', 'a')} WHERE {sql_shared('d', 'a')} > 0")
def overlay_intersection(spark, d):
    """Detections cut to the areas of interest, two very wide rectangles."""
    met = spatial.area_pairs(det(spark, d), frame(spark, d, "fx_aoi"), CELL)
    out = met.select("l.merged_id", "r.canton", *(c.alias(s) for s, c in rect.intersection("l.", "r.").items()))
    return out.where(rect.area() > 0)


_hits = f"h AS (SELECT d.merged_id, greatest(d.minx, l.minx) AS minx, greatest(d.miny, l.miny) AS miny, least(d.maxx, l.maxx) AS maxx, least(d.maxy, l.maxy) AS maxy, {sql_area('d')} AS own FROM fx_det d JOIN fx_layer l ON l.layer_id // 2 = d.site AND {sql_meets('d', 'l')} WHERE {sql_shared('d', 'l')} > 0)"


@query(with_clause("fx_det", "fx_layer", more=f"{_hits}, u AS (SELECT merged_id, sum({sql_area('h')}) - CASE WHEN count(*) = 2 THEN greatest(min(maxx) - max(minx), 0) * greatest(min(maxy) - max(miny), 0) ELSE 0 END AS lost FROM h GROUP BY merged_id)") + f" SELECT d.merged_id, {sql_area('d')} AS area, CAST({sql_area('d')} - coalesce(u.lost, 0) AS BIGINT) AS left_area FROM fx_det d LEFT JOIN u USING (merged_id)")
def difference_area(spark, d):
    return overlay.difference_area(det(spark, d), frame(spark, d, "fx_layer"), "merged_id", CELL)


@query(with_clause("fx_det", "fx_tile") + " SELECT merged_id, tile_id, CAST((least(d.maxx, t.maxx - 2) - greatest(d.minx, t.minx + 2)) * (least(d.maxy, t.maxy - 2) - greatest(d.miny, t.miny + 2)) AS DOUBLE) AS area FROM fx_det d JOIN fx_tile t ON t.tx BETWEEN d.minx // 400 - 1 AND d.maxx // 400 AND t.ty BETWEEN d.miny // 400 - 1 AND d.maxy // 400 WHERE least(d.maxx, t.maxx - 2) > greatest(d.minx, t.minx + 2) AND least(d.maxy, t.maxy - 2) > greatest(d.miny, t.miny + 2)")
def clip_to_tile(spark, d):
    cut = overlay.clip_to_tiles(det(spark, d), frame(spark, d, "fx_tile"), 400)
    return cut.select("l.merged_id", "r.tile_id", F.rint(rect.area()).alias("area"))


def _sql_union(source: str, by: str) -> str:
    """Coordinate compression by group: covered unit cells between neighbouring edges."""
    return f"""xs AS (SELECT {by}, x, lead(x) OVER (PARTITION BY {by} ORDER BY x) AS x1 FROM (SELECT {by}, minx AS x FROM {source} UNION SELECT {by}, maxx FROM {source})),
ys AS (SELECT {by}, y, lead(y) OVER (PARTITION BY {by} ORDER BY y) AS y1 FROM (SELECT {by}, miny AS y FROM {source} UNION SELECT {by}, maxy FROM {source})),
cov AS (SELECT DISTINCT {by}, x, x1, y, y1 FROM {source} s JOIN xs USING ({by}) JOIN ys USING ({by}) WHERE x >= s.minx AND x1 <= s.maxx AND y >= s.miny AND y1 <= s.maxy)"""


@query(with_clause("fx_det", more=_sql_union("fx_det", "year_det, site")) + " SELECT year_det, CAST(sum((x1 - x) * (y1 - y)) AS BIGINT) AS area FROM cov GROUP BY year_det")
def union_area_by_year(spark, d):
    return overlay.union_area(det(spark, d), ["year_det"], UNION_CELL)


@query(with_clause("fx_det", "fx_layer") + f" SELECT d.merged_id, {sql_r6(f'coalesce(sum(CASE WHEN {sql_meets("d", "l")} THEN CAST({sql_shared("d", "l")} AS DOUBLE) / ({sql_area("d")}) END), 0)')} AS ratio FROM fx_det d LEFT JOIN fx_layer l ON l.layer_id // 2 = d.site AND l.layer_key = 'forests' GROUP BY d.merged_id")
def layer_overlap_sum(spark, d):
    forests = frame(spark, d, "fx_layer").where("layer_key = 'forests'")
    return overlay.overlap_sum(det(spark, d), forests, "merged_id", CELL).select("merged_id", r6("ratio").alias("ratio"))


_sampled = "s AS (SELECT d.*, e.elevation FROM fx_det d LEFT JOIN fx_dem e ON e.tx = CAST(floor((d.minx + d.maxx) / 2.0 / 400) AS BIGINT) AND e.ty = CAST(floor((d.miny + d.maxy) / 2.0 / 400) AS BIGINT))"


def _sampled_rows(spark, d, rows=None):
    centred = (det(spark, d) if rows is None else rows).withColumn("x", (F.col("minx") + F.col("maxx")) / 2).withColumn("y", (F.col("miny") + F.col("maxy")) / 2)
    return raster.sample(centred, frame(spark, d, "fx_dem"), 400)


@query(with_clause("fx_det", "fx_dem", more=_sampled) + " SELECT merged_id, elevation FROM s")
def dem_sample(spark, d):
    return _sampled_rows(spark, d).select("merged_id", "elevation")


@query(with_clause("fx_det", "fx_dem", more=_sampled) + " SELECT merged_id, elevation FROM s WHERE elevation <> 0 AND elevation < 900")
def elevation_filter(spark, d):
    return _sampled_rows(spark, d).where("elevation <> 0 AND elevation < 900").select("merged_id", "elevation")


_diff = ORACLE_SQL["difference_area"]


@query(_diff.replace(f" SELECT d.merged_id, {sql_area('d')} AS area", f", da AS (SELECT d.merged_id, d.minx, d.miny, d.maxx, d.maxy, {sql_area('d')} AS area", 1) + ") SELECT merged_id, round_even(CAST(left_area AS DOUBLE) / area * 100, 0) / 100 AS area_ratio, round_even(4 * pi() * area / power(CAST(2 * (maxx - minx + maxy - miny) AS DOUBLE), 2) * 100, 0) / 100 AS compactness FROM da WHERE left_area > 100 AND (round_even(CAST(left_area AS DOUBLE) / area * 100, 0) / 100 > 0.75 OR round_even(4 * pi() * area / power(CAST(2 * (maxx - minx + maxy - miny) AS DOUBLE), 2) * 100, 0) / 100 > 0.78)")
def shape_filter(spark, d):
    """Rows that keep enough of their area or are compact enough; both rounded before they are compared."""
    left = difference_area(spark, d).join(det(spark, d).select("merged_id", *rect.SIDES), "merged_id")
    shaped = left.where("left_area > 100").select("merged_id", rect.rint(F.col("left_area").cast("double") / F.col("area"), 2).alias("area_ratio"), rect.rint(rect.compactness(), 2).alias("compactness"))
    return shaped.where("area_ratio > 0.75 OR compactness > 0.78")


@query(with_clause("fx_det", "fx_dem", "fx_layer", more=f"{_sampled}, lk AS (SELECT d.merged_id, sum(CASE WHEN l.layer_key = 'waters' THEN CAST({sql_shared('d', 'l')} AS DOUBLE) / ({sql_area('d')}) ELSE 0 END) AS waters, sum(CASE WHEN l.layer_key = 'building_areas' THEN CAST({sql_shared('d', 'l')} AS DOUBLE) / ({sql_area('d')}) ELSE 0 END) AS building_areas FROM fx_det d LEFT JOIN fx_layer l ON l.layer_id // 2 = d.site AND {sql_meets('d', 'l')} GROUP BY d.merged_id)") + f" SELECT s.merged_id, a.canton, s.elevation, round_even(lk.waters * 1000, 0) / 1000 AS waters, round_even(lk.building_areas * 1000, 0) / 1000 AS building_areas FROM s JOIN fx_aoi a ON {sql_meets('s', 'a')} AND {sql_shared('s', 'a')} > 0 JOIN lk USING (merged_id) WHERE s.elevation <> 0 AND s.elevation < CASE a.canton WHEN 'ticino' THEN 900 ELSE 1100 END".replace("WITH RECURSIVE", "WITH RECURSIVE"))
def enrich(spark, d):
    """Filter and enrichment in one plan: area of interest, elevation, layer shares to three digits. Rows travel to their
    elevation and, beside that, once to all layers."""
    keys = ["waters", "building_areas"]
    met = spatial.area_pairs(det(spark, d).select("merged_id", *rect.SIDES), frame(spark, d, "fx_aoi"), CELL)
    inside = met.where(rect.shared_area("l.", "r.") > 0).select("l.*", "r.canton")
    out = _sampled_rows(spark, d, inside).where((F.col("elevation") != 0) & (F.col("elevation") < F.when(F.col("canton") == "ticino", 900).otherwise(1100)))
    shares = overlay.overlap_sums(det(spark, d), frame(spark, d, "fx_layer"), "merged_id", CELL, "layer_key", keys)
    out = out.select("merged_id", "canton", "elevation").join(shares, "merged_id", "left")
    return out.select("merged_id", "canton", "elevation", *(F.coalesce(rect.rint(F.col(k), 3), F.lit(0.0)).alias(k) for k in keys))


ORACLE_SQL["enrich"] = ORACLE_SQL["enrich"].replace("WITH RECURSIVE ", with_clause("fx_aoi") + ",\n", 1)


# --- matching and metrics ----------------------------------------------------------------------------

_met = f"me AS (SELECT a.merged_id AS det_id, b.label_id, a.det_class, b.label_class, a.year_det, b.year_label, {sql_iou('a', 'b')} AS iou FROM fx_det a JOIN fx_label b ON {_same_site} AND {sql_meets('a', 'b')}), sa AS (SELECT * FROM me WHERE year_det = year_label), be AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY det_id ORDER BY iou DESC, label_id) AS n FROM sa) WHERE n = 1), fo AS (SELECT * FROM (SELECT * EXCLUDE (n), row_number() OVER (PARTITION BY label_id, year_det ORDER BY iou DESC, det_id) AS n FROM be WHERE iou >= 0.25) WHERE n = 1)"
_tags = f"{_met}, tg AS (SELECT CASE WHEN label_class = det_class + 1 THEN 'TP' ELSE 'wrong class' END AS tag, det_id, label_id, round_even(iou * 1000, 0) / 1000 AS iou, det_class, label_class FROM fo UNION ALL SELECT 'FP', merged_id, NULL, NULL, det_class, NULL FROM fx_det WHERE (merged_id NOT IN (SELECT det_id FROM me) OR merged_id IN (SELECT det_id FROM sa)) AND merged_id NOT IN (SELECT det_id FROM fo) UNION ALL SELECT 'FN', NULL, label_id, NULL, NULL, label_class FROM fx_label WHERE (label_id NOT IN (SELECT label_id FROM me) OR label_id IN (SELECT label_id FROM sa)) AND label_id NOT IN (SELECT label_id FROM fo))"
_counts = f"{_tags}, k AS (SELECT 1 AS label_class UNION ALL SELECT 2), cm AS (SELECT k.label_class, count(*) FILTER (tag = 'TP' AND tg.label_class = k.label_class) AS tp, count(*) FILTER (tag IN ('FP', 'wrong class') AND tg.det_class + 1 = k.label_class) AS fp, count(*) FILTER (tag IN ('FN', 'wrong class') AND tg.label_class = k.label_class) AS fn FROM k CROSS JOIN tg GROUP BY k.label_class), mx AS (SELECT *, coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS precision, coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0) AS f1 FROM cm)"


def _tagged(spark, d):
    return matching.tagged(det(spark, d).withColumnRenamed("merged_id", "det_id"), labels(spark, d), CELL)


def _classes(spark, d):
    known = spark.createDataFrame([(1,), (2,)], "label_class int")
    return matching.class_metrics(matching.class_counts(_tagged(spark, d), known))


@query(with_clause("fx_det", "fx_label", more=_tags) + " SELECT det_id, label_id, iou FROM tg WHERE tag = 'TP'")
def match_tp(spark, d):
    return _tagged(spark, d).where("tag = 'TP'").select("det_id", "label_id", "iou")


@query(with_clause("fx_det", "fx_label", more=_tags) + " SELECT det_id, det_class FROM tg WHERE tag = 'FP'")
def match_fp(spark, d):
    return _tagged(spark, d).where("tag = 'FP'").select("det_id", "det_class")


@query(with_clause("fx_det", "fx_label", more=_tags) + " SELECT label_id, label_class FROM tg WHERE tag = 'FN'")
def match_fn(spark, d):
    return _tagged(spark, d).where("tag = 'FN'").select("label_id", "label_class")


@query(with_clause("fx_det", "fx_label", more=_tags) + " SELECT det_id, label_id, iou, det_class, label_class FROM tg WHERE tag = 'wrong class'")
def match_mismatch(spark, d):
    return _tagged(spark, d).where("tag = 'wrong class'").select("det_id", "label_id", "iou", "det_class", "label_class")


@query(with_clause("fx_det", "fx_label", more=_counts) + f" SELECT label_class, tp, fp, fn, {sql_r6('precision')} AS precision, {sql_r6('recall')} AS recall, {sql_r6('f1')} AS f1 FROM mx")
def metrics_by_class(spark, d):
    return _classes(spark, d).select("label_class", "tp", "fp", "fn", r6("precision").alias("precision"), r6("recall").alias("recall"), r6("f1").alias("f1"))


def _sql_average(p: str, r: str) -> str:
    return with_clause("fx_det", "fx_label", more=f"{_counts}, av AS (SELECT sum(tp) / sum(tp + fp + fn)::DOUBLE AS accuracy, {p} AS precision, {r} AS recall FROM mx)") + f" SELECT {sql_r6('accuracy')} AS accuracy, {sql_r6('precision')} AS precision, {sql_r6('recall')} AS recall, {sql_r6('coalesce(2 * precision * recall / nullif(precision + recall, 0), 0)')} AS f1 FROM av"


def _averages(spark, d, method):
    return matching.averages(_classes(spark, d), method).select(*(r6(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")))


@query(_sql_average("sum(tp) / sum(tp + fp)::DOUBLE", "sum(tp) / sum(tp + fn)::DOUBLE"))
def metrics_micro(spark, d):
    return _averages(spark, d, "micro-average")


@query(_sql_average("avg(precision)", "avg(recall)"))
def metrics_macro(spark, d):
    return _averages(spark, d, "macro-average")


@query(_sql_average("sum(precision * (tp + fn)) / sum(tp + fn) / count(*)", "sum(recall * (tp + fn)) / sum(tp + fn) / count(*)"))
def metrics_weighted(spark, d):
    return _averages(spark, d, "macro-weighted-average")


@query(with_clause("fx_det", "fx_label", more=_sql_union("fx_det", "dataset, site") + ", du AS (SELECT dataset, sum((x1 - x) * (y1 - y)) AS a FROM cov GROUP BY dataset), " + _sql_union("fx_label", "dataset, site").replace("xs AS", "xl AS").replace("ys AS", "yl AS").replace("cov AS", "covl AS").replace("JOIN xs", "JOIN xl").replace("JOIN ys", "JOIN yl") + ", lu AS (SELECT dataset, sum((x1 - x) * (y1 - y)) AS a FROM covl GROUP BY dataset), cb AS (SELECT a.dataset, a.site, greatest(a.minx, b.minx) AS minx, greatest(a.miny, b.miny) AS miny, least(a.maxx, b.maxx) AS maxx, least(a.maxy, b.maxy) AS maxy FROM fx_det a JOIN (SELECT DISTINCT site, dataset, minx, miny, maxx, maxy FROM fx_label) b ON a.site = b.site AND a.dataset = b.dataset WHERE least(a.maxx, b.maxx) > greatest(a.minx, b.minx) AND least(a.maxy, b.maxy) > greatest(a.miny, b.miny)), " + _sql_union("cb", "dataset, site").replace("xs AS", "xb AS").replace("ys AS", "yb AS").replace("cov AS", "covb AS").replace("JOIN xs", "JOIN xb").replace("JOIN ys", "JOIN yb") + ", bu AS (SELECT dataset, CAST(sum((x1 - x) * (y1 - y)) AS DOUBLE) AS a FROM covb GROUP BY dataset)") + f" SELECT dataset, {sql_r6('bu.a / (du.a + lu.a - bu.a)')} AS iou, {sql_r6('bu.a / du.a')} AS geom_precision, {sql_r6('bu.a / lu.a')} AS geom_recall, {sql_r6('(du.a - lu.a) / lu.a::DOUBLE')} AS area_error FROM du JOIN lu USING (dataset) JOIN bu USING (dataset)")
def geometric_metrics(spark, d):
    got = matching.geometric_metrics(det(spark, d), labels(spark, d).select("dataset", *rect.SIDES).distinct(), ["dataset"], UNION_CELL)
    return got.select("dataset", *(r6(c).alias(c) for c in ("iou", "geom_precision", "geom_recall", "area_error")))


_bins = "VALUES " + ", ".join(f"({a!r}::DOUBLE, {b!r}::DOUBLE)" for a, b in matching.BIN_EDGES)


@query(with_clause("fx_det", "fx_label", more=f"{_tags}, bi(lower, upper) AS ({_bins})") + f" SELECT lower, upper, count(*) AS n, {sql_r6('avg(CASE WHEN tag = $$TP$$ THEN 1.0::DOUBLE ELSE 0 END)')} AS share FROM tg JOIN fx_det d ON d.merged_id = tg.det_id JOIN bi ON score > lower AND score <= upper GROUP BY lower, upper")
def calibration_bins(spark, d):
    scored = _tagged(spark, d).where("det_id IS NOT NULL").join(det(spark, d).select(F.col("merged_id").alias("det_id"), "score"), "det_id")
    return matching.calibration(scored.withColumn("is_right", F.col("tag") == "TP")).withColumn("share", r6("share"))


# --- reports -----------------------------------------------------------------------------------------


@query(with_clause("fx_det", "fx_label", more=f"{_tags}, yr AS (SELECT tg.tag, coalesce(d.year_det, l.year_label) AS y FROM tg LEFT JOIN fx_det d ON d.merged_id = tg.det_id LEFT JOIN fx_label l ON l.label_id = tg.label_id), yy AS (SELECT CAST(generate_series AS INTEGER) AS y FROM generate_series(1992, 1998))") + " SELECT yy.y AS year, " + ", ".join(f"count(*) FILTER (tag = '{t}') AS \"{n}\"" for t, n in (("TP", "TP"), ("FP", "FP"), ("FN", "FN"), ("wrong class", "wrong"))) + " FROM yy LEFT JOIN yr ON yr.y = yy.y GROUP BY yy.y")
def pivot_tags(spark, d):
    """Tags by year over a fixed span of years; years without rows count 0."""
    t = _tagged(spark, d)
    t = matching.with_sides(t, det(spark, d).select(F.col("merged_id").alias("det_id"), "year_det"), labels(spark, d).select("label_id", "year_label"))
    t = t.select(F.when(F.col("tag") == "wrong class", "wrong").otherwise(F.col("tag")).alias("tag"), F.coalesce("year_det", "year_label").alias("year"))
    return reports.over_years(reports.pivot_counts(t, "year", "tag", ["TP", "FP", "FN", "wrong"]), "year", ["TP", "FP", "FN", "wrong"], 1992, 1999)


@query(with_clause("fx_det", more="c AS (SELECT site * 3 AS site3, count(*) AS n FROM fx_det GROUP BY site), se AS (SELECT unnest(generate_series((SELECT min(site3) FROM c), (SELECT max(site3) FROM c))) AS site3)") + " SELECT site3, coalesce(n, 0) AS n FROM se FULL JOIN c USING (site3)")
def gap_histogram(spark, d):
    return reports.gap_filled(det(spark, d).select((F.col("site") * 3).alias("site3")), "site3")


@query(with_clause("fx_dem") + " SELECT CAST(25 * round_even(elevation / 25, 0) AS BIGINT) AS bin, count(*) AS n FROM fx_dem GROUP BY bin")
def elevation_histogram(spark, d):
    return reports.elevation_bins(frame(spark, d, "fx_dem"), "elevation")


@query(with_clause("fx_det") + f" SELECT year_det, {sql_r6('median(score)')} AS median_score, median(CAST({sql_area('d')} AS DOUBLE)) AS median_area FROM fx_det d GROUP BY year_det")
def yearly_medians(spark, d):
    got = reports.yearly_medians(det(spark, d).withColumn("area", rect.area().cast("double")), "year_det", ["score", "area"])
    return got.withColumn("median_score", r6("median_score"))


@query(with_clause("fx_det", more="q AS (SELECT model, count(score) AS n, quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.5) AS median, quantile_cont(score, 0.75) AS q3 FROM fx_det GROUP BY model)") + f" SELECT q.model, any_value(n) AS n, {sql_r6('any_value(q1)')} AS q1, {sql_r6('any_value(median)')} AS median, {sql_r6('any_value(q3)')} AS q3, min(score) AS low, max(score) AS high FROM q JOIN fx_det d ON d.model = q.model AND score >= q1 - 1.5 * (q3 - q1) AND score <= q3 + 1.5 * (q3 - q1) GROUP BY q.model")
def boxplot_stats(spark, d):
    got = reports.box_statistics(det(spark, d), "model", "score")
    return got.select("model", "n", *(r6(c).alias(c) for c in ("q1", "median", "q3")), "low", "high")


@query(with_clause("fx_label") + " SELECT year_label, label_class, count(*) AS n FROM fx_label GROUP BY ALL")
def label_histogram(spark, d):
    return labels(spark, d).groupBy("year_label", "label_class").agg(F.count(F.lit(1)).alias("n"))


# --- tiles and rasters -------------------------------------------------------------------------------


@query(with_clause("fx_tile") + " SELECT tile_id, tx AS x, ty AS y, CAST(16 AS BIGINT) AS z, CAST(NULL AS BIGINT) AS year FROM fx_tile")
def tile_ids(spark, d):
    return frame(spark, d, "fx_tile").select("tile_id", *(c.alias(k) for k, c in tiling.parse_title(F.col("tile_id")).items()))


_side = 2 * tiling.HALF / (1 << 16)


@query(with_clause("fx_label", more=f"t AS (SELECT label_id, unnest(generate_series(CAST(floor((minx + {tiling.HALF!r}::DOUBLE) / {_side!r}::DOUBLE) AS BIGINT), CAST(floor((maxx + {tiling.HALF!r}::DOUBLE) / {_side!r}::DOUBLE) AS BIGINT))) AS x, miny, maxy FROM fx_label), u AS (SELECT label_id, x, unnest(generate_series(CAST(floor(({tiling.HALF!r}::DOUBLE - maxy) / {_side!r}::DOUBLE) AS BIGINT), CAST(floor(({tiling.HALF!r}::DOUBLE - miny) / {_side!r}::DOUBLE) AS BIGINT))) AS y FROM t)") + " SELECT label_id, x, y, concat('(', x, ', ', y, ', 16)') AS tile_id FROM u")
def tile_cover(spark, d):
    return tiling.tile_cover(labels(spark, d), 16, "label_id").select("label_id", "x", "y", "tile_id")


@query(with_clause("fx_pixel") + " SELECT image_id, pixel, CAST(floor(r * 0.299::DOUBLE + g * 0.587::DOUBLE + b * 0.114::DOUBLE + 1e-9) AS INTEGER) AS grey FROM fx_pixel")
def grey_band(spark, d):
    return raster.grey(frame(spark, d, "fx_pixel")).select("image_id", "pixel", "grey")


_bands = "bp AS (SELECT image_id, unnest(['r', 'g', 'b']) AS band, unnest([r, g, b]) AS value FROM fx_pixel)"
_image_cdf = "ih AS (SELECT image_id, band, value, count(*) AS n FROM bp GROUP BY ALL), ic AS (SELECT image_id, band, value, sum(n) OVER (PARTITION BY image_id, band ORDER BY value) / sum(n) OVER (PARTITION BY image_id, band)::DOUBLE AS cdf FROM ih)"
_pooled_cdf = "ph AS (SELECT band, value, count(*) AS n FROM bp GROUP BY ALL), pc AS (SELECT band, value, sum(n) OVER (PARTITION BY band ORDER BY value) / sum(n) OVER (PARTITION BY band)::DOUBLE AS cdf FROM ph)"


_interpolated = "lo AS (SELECT ic.image_id, ic.band, ic.value, ic.cdf, max(pc.cdf) FILTER (pc.cdf <= ic.cdf) AS c0, max(pc.value) FILTER (pc.cdf <= ic.cdf) AS v0, min(pc.cdf) FILTER (pc.cdf > ic.cdf) AS c1, min(pc.value) FILTER (pc.cdf > ic.cdf) AS v1 FROM ic JOIN pc USING (band) GROUP BY ALL)"


@query(with_clause("fx_pixel", more=f"{_bands}, {_image_cdf}, {_pooled_cdf}, {_interpolated}") + f" SELECT image_id, band, value, {sql_r6('CASE WHEN c0 IS NULL THEN v1 WHEN c1 IS NULL OR c0 = cdf THEN v0 ELSE (v1 - v0) / (c1 - c0) * (cdf - c0) + v0 END')} AS matched FROM lo")
def histogram_match(spark, d):
    """Every image's bands matched to those of all images pooled."""
    p = frame(spark, d, "fx_pixel").select("image_id", F.explode(F.create_map(F.lit("r"), "r", F.lit("g"), "g", F.lit("b"), "b")).alias("band", "value"))
    return raster.match_histogram(p, p, ["band"], "value", each=["image_id"]).withColumn("matched", r6("matched"))


@query(with_clause("fx_pixel", more="h AS (SELECT image_id, r AS value, count(*) AS n FROM fx_pixel GROUP BY ALL)") + f" SELECT image_id, value, n, {sql_r6('sum(n) OVER (PARTITION BY image_id ORDER BY value) / sum(n) OVER (PARTITION BY image_id)::DOUBLE')} AS cdf FROM h")
def band_cdf(spark, d):
    return raster.cumulative(frame(spark, d, "fx_pixel").select("image_id", F.col("r").alias("value")), ["image_id"], "value").withColumn("cdf", r6("cdf"))
