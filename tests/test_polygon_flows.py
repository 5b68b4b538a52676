"""The flows on octagons and other shapes, against areas worked out by hand."""

import math

import pytest
from pyspark.sql import functions as F

from tesserae import config
from tesserae.functions import polygons as functions
from tesserae.operators import polygons
from tesserae.plans import polygon_flows as flows
from tests.test_polygons import box, octagon, ring

OCTAGON = 8 * (math.sqrt(2) - 1)  # area of an octagon whose inner radius is 1


@pytest.fixture(scope="module")
def geo(spark):
    try:
        functions.register(spark)
    except RuntimeError as e:
        pytest.skip(str(e))
    return spark


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def areas(df, key):
    return {r[key]: r["a"] for r in df.select(key, polygons.area().alias("a")).collect()}


def test_merge_within_year(geo):
    tiles = table(geo, [(1, box(0, 0, 400, 400)), (2, box(400, 0, 800, 400))], "tile_no long, geometry binary")
    raw = table(geo, [
        (1, 2020, "trn", 0.9, 0, octagon(100, 100, 40)),  # inside a tile
        (2, 2020, "trn", 0.2, 1, box(350, 100, 399, 200)), (3, 2020, "trn", 0.6, 0, box(401, 100, 500, 200)),  # two halves of one
        (4, 2021, "trn", 0.5, 1, box(395, 300, 405, 310)),  # another year
        (5, 2020, "trn", 0.01, 0, octagon(600, 300, 30)), (6, 2020, "trn", 0.7, 0, None),
    ], "det_id long, year_det int, dataset string, score double, det_class int, geometry binary")
    got = {r["det_id"]: r for r in flows.merge_within_year(raw, tiles).withColumn("a", polygons.area()).collect()}
    assert set(got) == {1, 2, 4}
    assert got[1]["a"] == pytest.approx(OCTAGON * 1600) and got[1]["score"] == 0.9
    assert got[2]["score"] == pytest.approx(0.4) and got[2]["det_class"] == 0  # the mean, and the class of the larger half
    assert 14_800 < got[2]["a"] < 15_001  # the gap is closed, corners lose a little
    apart = flows.merge_within_year(raw.withColumn("dataset", F.when(F.col("det_id") == 3, "val").otherwise("trn")), tiles, config.Merge(keep_datasets_apart=True))
    assert {r["det_id"] for r in apart.collect()} == {1, 2, 3, 4}


def fused_input(spark):
    """Two models see an octagon alike, a third a shifted one; a small one lies within; one is seen once."""
    rows = [
        (1, 2020, 68, 0.9, octagon(1000, 1000, 100)), (2, 2020, 72, 0.8, octagon(1001, 1000, 100)), (3, 2020, 75, 0.7, octagon(1010, 1000, 100)),
        (4, 2020, 68, 0.6, octagon(1000, 1000, 30)), (5, 2020, 72, 0.9, octagon(1000, 1000, 30)),
        (6, 2020, 68, 0.9, octagon(5000, 5000, 100)), (7, 2021, 72, 0.9, octagon(1000, 1000, 100)),
        (8, 2020, 68, 0.9, ring((3000, 3000), (3200, 3200), (3200, 3000), (3000, 3200))), (9, 2020, 72, 0.8, ring((3000, 3000), (3200, 3200), (3200, 3000), (3000, 3200))),
        (10, 2020, 68, 0.9, octagon(9000, 9000, 400)),
    ]
    return table(spark, rows, "merged_id long, year_det int, model int, score double, geometry binary")


def test_fuse_models_and_components(geo):
    settings = config.Fuse(n_models=3, presence=0.4)
    got = {r["merged_id"]: r for r in flows.fuse_models(fused_input(geo), settings).withColumn("a", polygons.area()).collect()}
    assert set(got) == {1, 8}  # 4 and 5 lie under 1; 6, 7 are seen once; 10 is too large
    one, bow = got[1], got[8]
    assert one["count_dets"] == 3 and one["presence"] == 1.0 and one["a"] == pytest.approx(OCTAGON * 100**2)
    assert one["second_iou"] == pytest.approx((30 / 100) ** 2)  # of the best of 4 and 5, which has the presence 2/3: no bonus
    assert one["merged_score"] == pytest.approx(0.9)
    assert bow["a"] == pytest.approx(20_000) and bow["presence"] == pytest.approx(2 / 3)  # repaired: two triangles
    near = table(geo, [(1, 1, 2020, 0.5, octagon(0, 0, 50)), (2, 2, 2020, 0.9, octagon(104, 0, 50)), (3, 3, 2021, 0.9, octagon(0, 0, 50)), (4, 4, 2020, 0.3, octagon(500, 0, 50))], "merged_id long, group_id long, year_det int, merged_score double, geometry binary")
    merged = {r["group_id"]: r for r in flows.merge_components(polygons.with_bounds(near), threshold=0.001).withColumn("a", polygons.area()).collect()}
    assert set(merged) == {1, 3, 4} and merged[1]["merged_score"] == 0.9 and merged[1]["merged_id"] == 2
    assert merged[4]["a"] == pytest.approx(OCTAGON * 2500, rel=2e-3) and merged[1]["a"] > 2 * OCTAGON * 2500


def test_fuse_years(geo):
    rows = [(1, 2010, 0.4, "a", octagon(0, 0, 60)), (2, 2015, 0.9, None, octagon(3, 0, 60)), (3, 2015, 0.2, "c", octagon(1, 1, 60)), (4, 2011, 0.8, "d", octagon(400, 400, 40))]
    got = {r["group_id"]: r for r in flows.fuse_years(table(geo, rows, "merged_id long, year_det int, merged_score double, note string, geometry binary")).withColumn("a", polygons.area()).collect()}
    first = got[1]
    assert (first["first_year"], first["last_year"], first["count_years"], first["merged_id"], first["merged_score"], first["note"]) == (2010, 2015, 2, 2, 0.9, "a")
    assert OCTAGON * 3600 < first["a"] < OCTAGON * 3600 + 3.2 * 120 + 50
    assert (got[4]["first_year"], got[4]["count_years"]) == (2011, 1) and got[4]["a"] == pytest.approx(OCTAGON * 1600, rel=2e-3)


def test_artifacts(geo):
    tiles = table(geo, [(1, box(0, 0, 400, 400))], "tile_no long, geometry binary")
    rows = [(1, 1, box(10, 10, 400, 400)), (2, 1, octagon(200, 200, 200)), (3, 3, box(0, 0, 400, 400)), (4, 1, box(1000, 0, 1390, 400))]
    kept, gone = flows.without_artifacts(table(geo, rows, "group_id long, count_years int, geometry binary"), tiles, config.Artifacts(iou=0.9))
    assert {r["group_id"]: r["iou"] for r in gone.collect()} == {1: 0.95} and {r["group_id"] for r in kept.collect()} == {2, 3, 4}


def enrich_input(spark):
    dets = table(spark, [(1, None, octagon(200, 200, 100)), (2, "FP", octagon(1000, 200, 100)), (3, "FN", octagon(200, 200, 50)), (4, "TP", octagon(200, 900, 100)), (5, "TP", octagon(5000, 200, 50))], "det_id long, tag string, geometry binary")
    aoi = table(spark, [("vaud", box(0, 0, 1000, 2000)), ("ticino", box(1000, 0, 2000, 2000))], "canton string, geometry binary")
    dem = table(spark, [(x, y, 950.0 if y < 2 else 0.0) for x in range(6) for y in range(6)], "tx long, ty long, elevation double")
    layers = {"waters": table(spark, [(box(200, 0, 400, 400),), (box(300, 0, 400, 400),)], "geometry binary"), "forests": table(spark, [(box(0, 100, 2000, 200),)], "geometry binary"), "sda": table(spark, [(octagon(200, 700, 10),)], "geometry binary")}
    return dets, aoi, dem, layers


def test_filter_and_enrich(geo):
    dets, aoi, dem, layers = enrich_input(geo)
    out = flows.filter_and_enrich(dets, aoi, dem, layers, config.Enrich(elevation={"vaud": 4500.0, "ticino": 900.0}, exclude=("waters",), overlap=("forests",)))
    got = {r["det_id"]: r for r in out.withColumn("a", polygons.area()).collect()}
    full = OCTAGON * 100**2
    assert set(got) == {1, 2}  # 3 is a label, 4 lies at 0 m, 5 outside; the half of 2 in ticino is too high
    assert got[1]["a"] == pytest.approx(full / 2) and got[1]["area_ratio"] == 0.5 and got[1]["forests"] == 0.5
    assert got[1]["original_area"] == pytest.approx(full) and got[1]["valid_area"] == pytest.approx(full / 2)
    edge = 2 * 100 * (math.sqrt(2) - 1)
    assert got[1]["compactness"] == round(4 * math.pi * full / 2 / (4 * edge + 200) ** 2, 2)
    assert got[1]["distance_sda"] == pytest.approx(390.0, abs=1e-3)
    assert got[2]["canton"] == "vaud" and got[2]["area_ratio"] == 0.5 and got[2]["distance_sda"] > 700
    with pytest.raises(ValueError, match="no rows"):
        flows.filter_and_enrich(dets.where("det_id = 5"), aoi, dem, {}, config.Enrich())


def test_assess(geo):
    dets = table(geo, [(1, 2020, 0, 0.9, "trn", octagon(100, 100, 50)), (2, 2020, 0, 0.8, "trn", octagon(110, 100, 50)), (3, 2020, 1, 0.7, "val", octagon(500, 500, 50)), (4, 2020, 0, 0.6, "val", octagon(900, 900, 50)), (5, 2021, 0, 0.6, "val", octagon(1300, 1300, 50))], "det_id long, year_det int, det_class int, score double, dataset string, geometry binary")
    truth = table(geo, [(11, 2020, 1, "trn", octagon(101, 100, 50)), (12, 2020, 1, "val", octagon(500, 505, 50)), (13, 2020, 2, "val", octagon(2000, 2000, 50)), (14, 2020, 1, "val", octagon(1300, 1300, 50))], "label_id long, year_label int, label_class int, dataset string, geometry binary")
    classes = table(geo, [(1,), (2,)], "label_class int")
    got = flows.assess(dets, truth, None, classes)
    tags = sorted((r["tag"], r["det_id"], r["label_id"]) for r in got["tagged"].collect() if r["tag"] != "FN")
    assert tags == [("FP", 2, None), ("FP", 4, None), ("TP", 1, 11), ("wrong class", 3, 12)]
    assert sorted(r["label_id"] for r in got["tagged"].where("tag = 'FN'").collect()) == [13]
    best = next(r["iou"] for r in got["tagged"].where("tag = 'TP'").collect())
    assert best == pytest.approx(0.976, abs=0.003)
    g = got["geometric"].first()
    one = OCTAGON * 2500
    assert 0 < g["iou"] < g["geom_precision"] < 1 and g["geom_recall"] < 1 and abs(g["area_error"] * 4 * one) < 2 * one
    assert {r["dataset"] for r in got["by_dataset"].collect()} == {"trn", "val"}
    tiles = table(geo, [(1, box(0, 0, 600, 600)), (2, box(600, 0, 1200, 600))], "tile_no long, geometry binary")
    assert flows.assess(dets, truth, tiles, classes)["tagged"].where("tag = 'TP'").count() == 1
    small = flows.assess(dets, truth, None, classes, config.Assess(area_min=1e6))["tagged"]
    assert {r["tag"] for r in small.collect()} == {"small polygon"} and small.count() == 9


def test_empty_tables(geo):
    none = fused_input(geo).limit(0)
    assert flows.fuse_models(none).count() == 0 and flows.fuse_years(none.withColumn("merged_score", F.col("score"))).count() == 0


def test_groups_are_judged_without_shapes(geo, monkeypatch):
    """every row took its shape and all its columns to its group, three times."""
    from tesserae.operators import fusion

    seen, best = [], fusion.best_in_group
    monkeypatch.setattr(fusion, "best_in_group", lambda df, id_col: seen.append(df.columns) or best(df, id_col))
    assert {r["merged_id"] for r in flows.fuse_models(fused_input(geo), config.Fuse(n_models=3, presence=0.4)).collect()} == {1, 8}
    assert seen and "geometry" not in seen[0] and "minx" not in seen[0]
    rows = table(geo, [(1, 7, 0.9), (2, 7, 0.9), (3, 7, 0.2), (4, 4, 0.5)], "merged_id long, group_id long, score double")
    one = fusion.best_by_presence(rows, 2, "merged_id")
    assert sorted(map(tuple, one.select(*sorted(one.columns)).collect())) == sorted(map(tuple, best(fusion.presence(rows, 2), "merged_id").select(*sorted(one.columns)).collect()))


def test_years_go_with_their_union(geo):
    """years were counted apart and joined to the unions again, by way of a second join of rows and groups."""
    rows = [(1, 2010, 0.4, octagon(0, 0, 60)), (2, 2015, 0.9, octagon(3, 0, 60)), (3, None, 0.8, octagon(400, 400, 40))]
    out = flows.fuse_years(table(geo, rows, "merged_id long, year_det int, merged_score double, geometry binary"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join") <= 1 and dict(out.dtypes)["count_years"] == "bigint"
    assert {r["group_id"]: (r["first_year"], r["last_year"], r["count_years"]) for r in out.collect()} == {1: (2010, 2015, 2), 3: (None, None, 0)}
