"""Edge cases and properties that the fixtures don't reach."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tesserae.functions import rect, wkb
from tesserae.operators import fusion, matching, merging, overlay, raster, reports, selection, spatial, tiling
from tesserae.operators.components import connected_components

BOX = "id long, minx long, miny long, maxx long, maxy long"
box = st.tuples(st.integers(-30, 30), st.integers(-30, 30), st.integers(0, 15), st.integers(0, 15)).map(lambda b: (b[0], b[1], b[0] + b[2], b[1] + b[3]))
few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, boxes):
    return spark.createDataFrame([(i, *b) for i, b in enumerate(boxes)], BOX)


def meet(a, b):
    return a[0] <= b[2] and b[0] <= a[2] and a[1] <= b[3] and b[1] <= a[3]


@few
@given(st.lists(box, min_size=1, max_size=25), st.lists(box, min_size=1, max_size=25), st.sampled_from([1, 7, 100]))
def test_grid_join_equals_all_pairs(spark, left, right, cell):
    got = spatial.pairs(frame(spark, left), frame(spark, right), cell).select("l.id", F.col("r.id").alias("other")).collect()
    assert sorted(map(tuple, got)) == sorted((i, j) for i, a in enumerate(left) for j, b in enumerate(right) if meet(a, b))


@few
@given(st.lists(box, min_size=1, max_size=12), st.sampled_from([5, 64]))
def test_union_and_difference_areas(spark, boxes, cell):
    cells = {(x, y) for a, b, c, d in boxes for x in range(a, c) for y in range(b, d)}
    got = overlay.union_area(frame(spark, boxes).withColumn("k", F.lit(1)), ["k"], cell).collect()
    assert (got[0]["area"] if got else 0) == len(cells)
    other = frame(spark, boxes[: len(boxes) // 2])
    taken = {(x, y) for a, b, c, d in boxes[: len(boxes) // 2] for x in range(a, c) for y in range(b, d)}
    left = {r["id"]: r["left_area"] for r in overlay.difference_area(frame(spark, boxes), other, "id", cell).collect()}
    assert left == {i: len({(x, y) for x in range(a, c) for y in range(b, d)} - taken) for i, (a, b, c, d) in enumerate(boxes)}


@pytest.mark.parametrize("shape", ["path", "star", "random", "loops"])
def test_components(spark, shape):
    rng = random.Random(3)
    edges = {"path": [(i, i + 1) for i in range(60)], "star": [(0, i) for i in range(1, 60)] + [(70, 71)], "random": [(rng.randrange(80), rng.randrange(80)) for _ in range(60)], "loops": [(5, 5), (7, 7), (7, 6)]}[shape]
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    got = connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()
    assert sorted(map(tuple, got)) == sorted((x, find(x)) for x in up)


def test_touching_and_flat_rectangles(spark):
    df = frame(spark, [(0, 0, 10, 10), (10, 0, 20, 10), (10, 10, 20, 20), (5, 5, 5, 5)])
    met = {(r["a"], r["b"]): r["iou"] for r in spatial.self_pairs(df, "id", 4, strict=True).select(F.col("l.id").alias("a"), F.col("r.id").alias("b"), rect.iou("l.", "r.").alias("iou")).collect()}
    assert met == {(1, 0): 0.0, (2, 0): 0.0, (2, 1): 0.0, (3, 0): 0.0}
    groups = merging.proximity_groups(df.where("id < 3").withColumn("y", F.lit(1)), "id", 4, 0, ["y"]).collect()
    assert sorted(map(tuple, groups)) == [(0, 0), (1, 0), (2, 0)]
    corner = merging.proximity_groups(df.where("id IN (0, 2)").withColumn("y", F.lit(1)), "id", 4, 0, ["y"]).collect()
    assert sorted(map(tuple, corner)) == [(0, 0), (2, 2)]


def test_nearest_ties_and_empty_layer(spark):
    left, right = frame(spark, [(0, 0, 1, 1), (100, 0, 101, 1)]), frame(spark, [(-5, 0, -4, 1), (5, 0, 6, 1), (100, 0, 101, 1)])
    got = spatial.nearest(left, right, "id", "id", 1).select("l.id", F.col("r.id").alias("o"), "distance").collect()
    assert sorted(map(tuple, got)) == [(0, 0, 4.0), (0, 1, 4.0), (1, 2, 0.0)]
    assert spatial.nearest(left, right.where("false"), "id", "id", 1).count() == 0


def test_second_overlap_maxima_are_independent(spark):
    df = frame(spark, [(0, 0, 10, 10), (0, 0, 10, 10), (9, 0, 19, 10)]).withColumn("year_det", F.lit(1))
    got = {r["id"]: (r["second_iou"], r["top_id"]) for r in fusion.second_overlap(df, "id", 8).collect()}
    assert got[0] == (1.0, 2)


def test_bonus_is_capped(spark):
    kept = spark.createDataFrame([(1, 0.95), (2, 0.2)], "id long, merged_score double")
    covered = spark.createDataFrame([(1, 0.8), (1, 0.8), (2, 0.5)], "top_id long, presence double")
    assert {r["id"]: r["merged_score"] for r in fusion.with_bonus(kept, covered, "id").collect()} == {1: 1.0, 2: 0.2}


DET, LABEL = BOX.replace("id long", "det_id long") + ", det_class int, year_det int", BOX.replace("id long", "label_id long") + ", label_class int, year_label int"


def test_matching_quirks(spark):
    dets = spark.createDataFrame([(1, 0, 0, 10, 10, 0, 2000), (2, 0, 0, 10, 9, 0, 2000), (3, 50, 0, 60, 10, 0, 2001), (4, 90, 0, 99, 9, 1, 2000)], DET)
    labels = spark.createDataFrame([(11, 0, 0, 10, 10, 2, 2000), (12, 50, 0, 60, 10, 1, 2005), (13, 70, 0, 80, 10, 1, 2000)], LABEL)
    tags = sorted((r["tag"], r["det_id"] or 0, r["label_id"] or 0) for r in matching.tagged(dets, labels, 16).collect())
    assert tags == [("FN", 0, 13), ("FP", 2, 0), ("FP", 4, 0), ("wrong class", 1, 11)]  # 3 and 12 meet in other years only
    safe = {(r["tag"], r["det_id"], r["label_id"]) for r in matching.tagged(dets, labels, 16, year_safe=True).collect()}
    assert ("FP", 3, None) in safe and ("FN", None, 12) in safe
    none = matching.tagged(dets, labels.where("false"), 16)
    assert {r["tag"] for r in none.collect()} == {"FP"} and none.count() == 4
    small = matching.tagged(dets, labels, 16, area_min=85)
    assert {(r["det_id"], r["label_id"]) for r in small.where("tag = 'small polygon'").collect()} == {(4, None)}


def test_metrics_without_hits(spark):
    classes = spark.createDataFrame([(1,), (2,)], "label_class int")
    empty = spark.createDataFrame([], "tag string, det_class int, label_class int")
    m = matching.class_metrics(matching.class_counts(empty, classes))
    assert all(r["f1"] == 0 for r in m.collect())
    assert tuple(matching.averages(m).first()) == (None, 0.0, 0.0, 0.0)
    with pytest.raises(ValueError):
        matching.averages(m, "other")


def test_calibration_edges(spark):
    df = spark.createDataFrame([(0.0, True), (0.6000000000000001, True), (1.0, False), (0.1, True)], "score double, is_right boolean")
    got = {(r["lower"], r["n"], r["share"]) for r in matching.calibration(df).collect()}
    assert got == {(0.9, 1, 0.0), (0.0, 1, 1.0)}


def test_rounding(spark):
    got = spark.createDataFrame([(0.575,), (2.345,), (2.355,)], "x double").select(rect.rint(F.col("x"), 2)).collect()
    assert [r[0] for r in got] == [round(x * 100) / 100 for x in (0.575, 2.345, 2.355)]


def test_reports(spark):
    df = spark.createDataFrame([(1,), (4,), (4,), (None,)], "x int")
    assert sorted(map(tuple, reports.gap_filled(df, "x").collect())) == [(1, 1), (2, 0), (3, 0), (4, 2)]
    assert reports.gap_filled(df.where("false"), "x").count() == 0


def test_raster(spark):
    p = spark.createDataFrame([(10, 20, 30)], "r int, g int, b int")
    assert raster.bands(raster.grey(p), 3).first()["bands"] == [18, 18, 18]
    pts = spark.createDataFrame([(1.0, 1.0), (-1.0, 5.0)], "x double, y double")
    dem = spark.createDataFrame([(0, 0, 7.0)], "tx long, ty long, elevation double")
    assert {r["x"]: r["elevation"] for r in raster.sample(pts, dem, 4).collect()} == {1.0: 7.0, -1.0: None}
    chunks = spark.createDataFrame([("a", 0, 0, 2, 2), ("b", 0, 0, 2, 2), ("b", 0, 2, 2, 2)], "source string, row0 int, col0 int, h int, w int")
    assert {(r["source"], r["col0"]) for r in raster.mosaic(chunks).collect()} == {("a", 0), ("b", 2)}
    assert {tuple(r) for r in raster.catalogue(chunks).collect()} == {("a", 0, 0, 2, 2), ("b", 0, 0, 2, 4)}


def test_projections(spark):
    p = spark.createDataFrame([(7.438637, 46.951083)], "lon double, lat double")  # the old observatory in Berne
    e, n = p.select(*tiling.swiss(F.col("lon"), F.col("lat"))).first()
    assert abs(e - 2600000) < 2 and abs(n - 1200000) < 2
    lon, lat = p.select(*tiling.from_swiss(F.lit(e), F.lit(n))).first()
    assert abs(lon - 7.438637) < 2e-5 and abs(lat - 46.951083) < 2e-5
    x, y = p.select(*tiling.mercator(F.col("lon"), F.col("lat"))).first()
    lon, lat = p.select(*tiling.from_mercator(F.lit(x), F.lit(y))).first()
    assert abs(lon - 7.438637) < 1e-9 and abs(lat - 46.951083) < 1e-9
    title = spark.createDataFrame([("(2020, 3, 4, 16)",), ("(3, 4, 16)",)], "t string").select(*(c.alias(k) for k, c in tiling.parse_title(F.col("t")).items())).collect()
    assert [tuple(r) for r in title] == [(2020, 3, 4, 16), (None, 3, 4, 16)]
    years = spark.range(50).select(tiling.random_year(F.col("id"), 2010, 2015)).collect()
    assert {r[0] for r in years} == {*range(2010, 2015)}


def test_wkb_round_trip():
    square = {"type": "Polygon", "coordinates": [[[0.0, 0.0], [4.0, 0.0], [4.0, 3.0], [0.0, 0.0]]]}
    for g in (square, {"type": "Point", "coordinates": [1.0, 2.0]}, {"type": "MultiPolygon", "coordinates": [square["coordinates"]] * 2}, {"type": "GeometryCollection", "geometries": [square, {"type": "LineString", "coordinates": [[9.0, 9.0], [1.0, 1.0]]}]}, {"type": "MultiPoint", "coordinates": [[1.0, 2.0]]}):
        assert wkb.loads(wkb.dumps(g)) == g
    assert wkb.bounds(wkb.dumps(square)) == (0.0, 0.0, 4.0, 3.0)
    assert wkb.bounds(wkb.dumps({"type": "Point", "coordinates": []})) is None


def test_nearest_ends_on_rows_without_bounds(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0), (2, None, None, None, None), (3, 500.0, 500.0, 501.0, 501.0)], "id long, minx double, miny double, maxx double, maxy double")
    right = spark.createDataFrame([(7, 3.0, 0.0, 4.0, 1.0), (8, None, 1.0, 2.0, 3.0)], "rid long, minx double, miny double, maxx double, maxy double")
    got = sorted((r["l"]["id"], r["r"]["rid"], round(r["distance"], 6)) for r in spatial.nearest(left, right, "id", "rid", 1).collect())
    assert got == [(1, 7, 2.0), (3, 7, round((496.0**2 + 499.0**2) ** 0.5, 6))]
    assert spatial.nearest(left, right.where("rid = 8"), "id", "rid", 1).count() == 0
    assert spatial.nearest(left.where("id = 2"), right, "id", "rid", 1).count() == 0


@pytest.mark.parametrize("small", [10_000, 0])
def test_areas_of_any_size(spark, monkeypatch, small):
    monkeypatch.setattr(spatial, "SMALL_AREAS", small)
    rng = random.Random(3)
    box = lambda n: [(i, x := rng.randrange(-3000, 3000), y := rng.randrange(-3000, 3000), x + rng.choice([0, 3, 40, 900, 5000]), y + rng.choice([0, 5, 70, 2000])) for i in range(n)]
    schema = "id long, minx long, miny long, maxx long, maxy long"
    a, b = [*box(120), (900, None, None, None, None)], [*box(30), (901, None, None, None, None)]
    got = sorted((r["l"]["id"], r["r"]["id"]) for r in spatial.area_pairs(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), 16).collect())
    meets = lambda p, q: None not in p and None not in q and p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4]
    assert got == sorted((p[0], q[0]) for p in a for q in b if meets(p, q))


@pytest.mark.parametrize("crowd", [64, 3])
def test_union_area_of_crowded_cells(spark, monkeypatch, crowd):
    monkeypatch.setattr(overlay, "CROWD", crowd)
    rng = random.Random(5)
    rows = [(i % 3, x := rng.randrange(60), y := rng.randrange(60), x + rng.randrange(25), y + rng.randrange(25)) for i in range(120)]
    rows += rows[:10]
    got = {r["k"]: r["area"] for r in overlay.union_area(spark.createDataFrame(rows, "k int, minx int, miny int, maxx int, maxy int"), ["k"], 20).collect()}
    for k in range(3):
        assert got[k] == len({(u, v) for g, a, b, c, d in rows if g == k for u in range(a, c) for v in range(b, d)})


def test_quantiles(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    rows = [(int(g), float(v) if v > -1.5 else None) for g, v in zip(rng.integers(0, 4, 300), rng.normal(size=300).round(1))] + [(9, 2.0)]
    got = {r["g"]: r for r in reports.quantiles(spark.createDataFrame(rows, "g int, v double"), "g", "v", {"a": 0.25, "b": 0.5, "c": 0.9}).collect()}
    for g in (0, 1, 2, 3, 9):
        values = [v for k, v in rows if k == g and v is not None]
        assert got[g]["n"] == len(values) and [got[g][c] for c in "abc"] == pytest.approx(np.quantile(values, [0.25, 0.5, 0.9]).tolist())


def test_selections_and_guards(spark):
    df = spark.createDataFrame([(1, "a", None, "x"), (2, None, "b", "y"), (3, "c", "d", None)], "id int, p string, q string, tag string")
    assert [r["id"] for r in selection.without_values(df, "tag", ["x"]).orderBy("id").collect()] == [2, 3]
    assert [r["id"] for r in selection.without_class(df, "tag", "y").orderBy("id").collect()] == [1, 3]
    named = selection.coalesced(df, {"name": ("p", "q")})
    assert named.columns == ["id", "tag", "name"] and [r["name"] for r in named.orderBy("id").collect()] == ["a", "b", "c"]
    assert selection.final(df, ["tag", "key", "gone"], {"id": "key", "no": "x"}).columns == ["tag", "key"]
    assert selection.or_else(df.where("false"), df).count() == 3 and selection.or_else(df.limit(1), df).count() == 1
    selection.require_same_crs(a="EPSG:2056", b=2056)
    selection.require_same_count(df, [df.where("id = 1"), df.where("id > 1")], "split")
    for bad in (lambda: selection.require_rows(df.where("false"), "t"), lambda: selection.require_same_crs(a=2056, b=3857), lambda: selection.require_same_count(df, [df.limit(1)], "t"), lambda: selection.require_all_joined(df, "p", "t")):
        with pytest.raises(ValueError):
            bad()


def test_clip_by_year_in_the_file_name(spark):
    layer = spark.createDataFrame([(1, "/d/lakes_1999.shp", 0, 0, 10, 10), (2, "/d/lakes.shp", 0, 0, 10, 10), (3, "lakes-2004.shp", 50, 50, 60, 60)], "id int, file string, minx int, miny int, maxx int, maxy int")
    mask = spark.createDataFrame([(5, 5, 100, 55)], "minx int, miny int, maxx int, maxy int")
    got = sorted((r["id"], r["year"], r["minx"], r["miny"], r["maxx"], r["maxy"]) for r in selection.clipped_by_year(layer, mask, 16).collect())
    assert got == [(1, 1999, 5, 5, 10, 10), (3, 2004, 50, 50, 60, 55)]
