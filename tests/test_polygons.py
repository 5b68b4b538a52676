import math
import os
import subprocess
import sys
import zipfile
from pathlib import Path

import pyspark
import pytest
from pyspark.sql import functions as F

from tesserae.functions import polygons as functions
from tesserae.functions import wkb
from tesserae.operators import polygons


def ring(*points):
    return bytearray(wkb.dumps({"type": "Polygon", "coordinates": [[*map(list, points), list(points[0])]]}))


def box(a, b, c, d):
    return bytearray(wkb.rectangle(a, b, c, d))


@pytest.fixture(scope="module")
def geo(spark):
    try:
        functions.register(spark)
    except RuntimeError as e:
        pytest.skip(str(e))
    return spark


def frame(spark, shapes):
    return polygons.with_bounds(spark.createDataFrame([*enumerate(shapes)], "id long, geometry binary"))


def value(spark, expression, *shapes):
    names = ", ".join(f"g{i}" for i in range(len(shapes)))
    return spark.createDataFrame([tuple(shapes)], ", ".join(f"g{i} binary" for i in range(len(shapes)))).selectExpr(expression, *([names.split(", ")[0]] if names else [])).first()[0]


def test_scalars(geo):
    square, triangle = box(0, 0, 10, 10), ring((0, 0), (10, 0), (0, 10))
    assert value(geo, "geo_area(g0)", triangle) == 50
    assert value(geo, "geo_length(g0)", square) == 40
    assert value(geo, "geo_area(geo_intersection(g0, g1))", square, triangle) == 50
    assert value(geo, "geo_iou(g0, g1)", square, triangle) == 0.5
    assert value(geo, "geo_distance(g0, g1)", square, box(13, 14, 20, 20)) == 5
    assert value(geo, "geo_area(geo_buffer(g0, 10.0D, 16))", square) == pytest.approx(100 + 400 + math.pi * 100, rel=1e-2)
    assert value(geo, "geo_area(geo_buffer(g0, 10.0D, 2))", square) == pytest.approx(100 + 400 + 16 * 50 * math.sin(math.pi / 4) / 2, rel=1e-6)
    assert value(geo, "geo_area(geo_buffer(g0, 10.0D, -5))", square) == 900
    assert value(geo, "geo_bounds(geo_scale(g0, 0.5D))", square) == [2.5, 2.5, 7.5, 7.5]
    bow = ring((0, 0), (10, 10), (10, 0), (0, 10))
    assert value(geo, "geo_isvalid(g0)", bow) is False and value(geo, "geo_area(geo_makevalid(g0))", bow) == 50
    assert value(geo, "geo_area(g0)", None) is None


def test_joins_and_overlays(geo):
    left = frame(geo, [box(0, 0, 10, 10), ring((20, 0), (30, 0), (20, 10))])
    right = frame(geo, [box(5, 0, 15, 10), box(27, 7, 30, 10), box(7, 2, 8, 3)])
    got = polygons.meetings(left, right, "id", "id", 8).select("l", "r").collect()
    assert sorted(map(tuple, got)) == [(0, 0), (0, 2)]  # the triangle's bounds alone meet the third
    cut = polygons.difference(left, right, "id", 8).select("id", F.call_function("geo_area", F.col("geometry"))).collect()
    assert dict(map(tuple, cut)) == {0: 50.0, 1: 50.0}
    pieces = polygons.intersection(left, right, "id", "id", 8).select(F.call_function("geo_area", F.col("geometry"))).collect()
    assert sorted(r[0] for r in pieces) == [1.0, 50.0]
    union = polygons.union_by(right.withColumn("k", F.lit(1)), ["k"], 8).select(F.call_function("geo_area", F.col("geometry"))).first()[0]
    assert union == 109
    edges = polygons.iou_edges(right, "id", 0.005, 8).select("src", "dst").collect()
    assert sorted(map(tuple, edges)) == [(0, 0), (1, 1), (2, 0), (2, 2)]


def test_closing(geo):
    df = frame(geo, [box(0, 0, 100, 100), box(115, 0, 215, 100), box(400, 0, 500, 100)])
    got = {r[0]: r[1] for r in polygons.closing(df, "id", 10, 128).select("group_id", F.call_function("geo_area", F.col("geometry"))).collect()}
    assert set(got) == {0, 2} and got[2] == pytest.approx(10_000, rel=1e-3) and got[0] > 20_000


def test_repair_and_waters(geo):
    bow = frame(geo, [ring((0, 0), (10, 10), (10, 0), (0, 10)), box(0, 0, 1, 1)])
    assert polygons.repaired(bow).where("geo_isvalid(geometry)").count() == 2
    with pytest.raises(Exception, match="invalid geometry"):
        polygons.repaired(bow, correct=False).select(F.call_function("geo_area", F.col("geometry"))).collect()
    tiles, lake = frame(geo, [box(0, 0, 10, 10), box(90, 90, 110, 110)]), frame(geo, [box(0, 0, 200, 200)])
    assert [r["id"] for r in polygons.away_from(tiles, lake, 42, 64, "id").collect()] == [0]


def test_python_may_take_pyspark_from_a_zip(geo, tmp_path):
    """The jars aren't where the Python package is: the class path is asked from the JVM."""
    site = Path(pyspark.__file__).parent
    with zipfile.ZipFile(tmp_path / "pyspark.zip", "w") as z:
        for f in site.rglob("*"):
            if f.is_file() and "jars" not in f.relative_to(site).parts and f.suffix != ".pyc":
                z.write(f, f.relative_to(site.parent))
    code = (
        "import pyspark; assert '.zip' in pyspark.__file__\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "from tesserae.functions import polygons\n"
        "polygons.register(s); polygons.register(s)\n"
        "print('AREA', s.sql('SELECT geo_area(geo_rectangle(0D, 0D, 2D, 3D))').first()[0])\n"
    )
    env = {**os.environ, "SPARK_HOME": str(site), "PYTHONPATH": f"{tmp_path / 'pyspark.zip'}:{Path(__file__).resolve().parents[1]}"}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert "AREA 6.0" in done.stdout, done.stderr[-2000:]


def octagon(x, y, r):
    k = r * (math.sqrt(2) - 1)
    return ring((x - r, y - k), (x - k, y - r), (x + k, y - r), (x + r, y - k), (x + r, y + k), (x + k, y + r), (x - k, y + r), (x - r, y + k))


def brute_pairs(spark, shapes, others, function):
    a, b = (spark.createDataFrame([*enumerate(x)], f"{n} long, g{n} binary") for n, x in (("l", shapes), ("r", others)))
    return sorted(map(tuple, a.crossJoin(b).where(f"geo_{function}(gl, gr)").select("l", "r").collect()))


def test_meetings_of_pages_equal_all_pairs(geo, monkeypatch):
    """Many shapes of a few cells, so that pages meet pages; a shape in many cells is told once."""
    monkeypatch.setattr(polygons, "PAGE", 7)
    shapes = [octagon(37 * k % 101, 53 * k % 97, 3 + k % 9) for k in range(90)] + [octagon(50, 50, 60), ring((0, 0), (100, 0), (0, 100))]
    others = [octagon(41 * k % 103, 29 * k % 95, 2 + k % 7) for k in range(60)]
    left, right = frame(geo, shapes), frame(geo, others)
    for mode in ("intersects", "contains"):
        got = polygons.meetings(left, right, "id", "id", 16, mode).select("l", "r").collect()
        assert sorted(map(tuple, got)) == brute_pairs(geo, shapes, others, mode)
    met = polygons.self_meetings(left, "id", 16).collect()
    assert sorted((r["l"], r["r"]) for r in met) == [p for p in brute_pairs(geo, shapes, shapes, "intersects") if p[0] >= p[1]]
    assert all(r["shared"] <= min(r["area_l"], r["area_r"]) + 1e-9 for r in met)


def test_union_of_a_crowd_without_lists(geo):
    """Partial unions of one group in many tasks; a null shape changes nothing."""
    rows = geo.range(3000).repartition(7).selectExpr("id % 2 AS k", "geo_rectangle(double(id), 0D, double(id + 2), 1D) AS geometry").unionByName(geo.sql("SELECT 0L AS k, CAST(NULL AS BINARY) AS geometry"))
    plan = polygons.with_bounds(rows).groupBy("k").agg(polygons.union_of().alias("geometry"))
    assert "collect_list" not in plan._jdf.queryExecution().toString()
    assert {r["k"]: r["a"] for r in plan.select("k", polygons.area().alias("a")).collect()} == {0: 3000.0, 1: 3000.0}
    assert rows.where("geometry IS NULL").groupBy("k").agg(polygons.union_of().alias("geometry")).select(polygons.geo("isempty", "geometry")).first()[0]


def test_wide_areas_are_cut(geo):
    wide = frame(geo, [ring((0, 0), (1000, 0), (0, 1000)), box(-5, -5, 2000, 3)]).withColumnRenamed("id", "aid")
    cut = polygons.pieces(wide, "aid", 64)
    assert cut.where("maxx - minx > 64 OR maxy - miny > 64").count() == 0
    assert {r["of"]: pytest.approx(r["a"]) for r in cut.groupBy("of").agg(F.sum(polygons.area()).alias("a")).collect()} == {0: 500_000.0, 1: 2005 * 8.0}
    small = frame(geo, [box(490, 490, 510, 510), box(100, 100, 101, 101)])
    kept = {r["id"]: r["a"] for r in polygons.difference(small, wide.where("aid = 0"), "id", 8).select("id", polygons.area().alias("a")).collect()}
    assert kept == {0: pytest.approx(200.0)}
    shares = {r["id"]: r["ratio"] for r in polygons.overlap_sum(small, wide, "id", "aid", 8).collect()}
    assert shares == {0: pytest.approx(0.5), 1: pytest.approx(1.0)}


def test_dissolve_takes_firsts_column_by_column(geo):
    df = frame(geo, [octagon(0, 0, 10), octagon(5, 0, 10), octagon(100, 0, 10)]).selectExpr("id", "geometry", "CASE WHEN id < 2 THEN 1 ELSE 2 END AS g", "double(id) AS s", "CASE WHEN id = 0 THEN 'x' END AS seen")
    got = {r["g"]: r for r in polygons.dissolve_first(df, "g", [-F.col("s"), "id"], ["id", "seen"]).withColumn("a", polygons.area()).collect()}
    one = 8 * 100 * (math.sqrt(2) - 1)
    assert (got[1]["id"], got[1]["seen"], got[2]["id"], got[2]["seen"]) == (1, "x", 2, None)
    assert got[2]["a"] == pytest.approx(one) and one < got[1]["a"] < 2 * one


def test_cells_are_counted_by_a_hash(geo, monkeypatch):
    """the count of cells sent every key of each row."""
    seen, kept = [], polygons.store
    monkeypatch.setattr(polygons, "store", lambda df, name: seen.append(df) or kept(df, name))
    monkeypatch.setattr(polygons, "PAGE", 3)
    rows = geo.createDataFrame([(k, 2000 + k % 2, box(5 * k, 0, 5 * k + 12, 10)) for k in range(40)], "id long, year int, geometry binary")
    met = polygons.self_meetings(polygons.with_bounds(rows), "id", 10, "touch", ["year"])
    assert {r["l"] - r["r"] for r in met.collect()} == {0, 2} and met.count() == 40 + 38
    assert "Aggregate [__h#" in seen[0]._jdf.queryExecution().optimizedPlan().toString() and seen[0].count() > 0


def test_pairs_that_cannot_overlap_enough_are_left_out(geo):
    rows = polygons.with_bounds(geo.createDataFrame([(1, box(0, 0, 10, 10)), (2, box(5, 0, 15, 10)), (3, box(1, 0, 11, 10)), (4, box(0, 0, 100, 100))], "id long, geometry binary"))
    some = polygons.self_meetings(rows, "id", 100, "shared", least=0.4)
    assert {(r["l"], r["r"]) for r in some.collect() if r["l"] != r["r"]} == {(3, 1), (3, 2)}
    assert {(r["src"], r["dst"]) for r in polygons.iou_edges(rows, "id", 1 / 3, 100).collect() if r["src"] != r["dst"]} == {(2, 1), (3, 1), (3, 2)}


def test_sharp_growth_of_convex_shapes(geo):
    """convex shapes are grown without a buffer, whose results these are."""
    chamfered = ring((0, 0), (99, 0), (100, 1), (100, 100), (0, 100))
    shapes = [(1, octagon(500, 500, 60)), (2, box(0, 0, 30, 20)), (3, ring((0, 0), (50, 0), (100, 0), (100, 100), (0, 100))), (4, chamfered), (5, ring((0, 0), (1000, 0), (1000, 10)))]
    rows = geo.createDataFrame(shapes, "id long, geometry binary")
    area = lambda d, n: {r["id"]: r["a"] for r in rows.select("id", polygons.geo("area", polygons.geo("buffer", "geometry", F.lit(float(d)), F.lit(n))).alias("a")).collect()}
    grown, less, round_less = area(10, polygons.MITRE), area(-10, polygons.MITRE), area(-10, 16)
    assert grown[1] == pytest.approx(8 * (2**0.5 - 1) * 70**2, rel=1e-12) and grown[2] == 50 * 40 and grown[3] == pytest.approx(120 * 120, rel=1e-12)
    assert less[1] == round_less[1] == pytest.approx(8 * (2**0.5 - 1) * 50**2, rel=1e-12) and less[2] == 0 and less[3] == round_less[3] == 80 * 80
    assert less[4] == pytest.approx(6400, rel=1e-3)  # a side vanishes
    assert 5000 + 10 * 2010 < grown[5] < 5000 + 10 * 2010 + 12 * 100  # a corner that would reach too far is cut off
