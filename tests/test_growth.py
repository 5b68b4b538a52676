"""What queries need as tables grow: sessions of their own, few bytes a row, no task with more than its share."""

import pytest
from pyspark.sql import functions as F

from tesserae.plans import fixtures, layers

SF = "/root/testdata/sf0.001"


@pytest.fixture
def fresh(spark, monkeypatch):
    """A session that no query has run in."""
    monkeypatch.setattr(fixtures, "_built", {})
    return spark.newSession()


def test_clip_is_the_first_query_of_a_session(fresh):
    assert layers.polygon_clip_to_tile(fresh, SF).count() > 0


def test_self_pairs_travel_once(spark):
    """one exchange of the rows, whoever reads the result; two before."""
    from tesserae.operators import spatial

    rows = spark.range(500).select(F.col("id"), (F.col("id") % 7).alias("year"), *((F.col("id") * k % 3000 + w).alias(s) for s, k, w in (("minx", 37, 0), ("miny", 53, 0), ("maxx", 37, 150), ("maxy", 53, 150))))
    met = spatial.self_pairs(rows, "id", 256, ["year"], columns=["id"])
    plan = met._jdf.queryExecution().sparkPlan().toString() + met._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    own = rows.collect()
    meets = lambda a, b: a.minx <= b.maxx and b.minx <= a.maxx and a.miny <= b.maxy and b.miny <= a.maxy
    expected = sorted((a.id, b.id) for a in own for b in own if a.id >= b.id and a.year == b.year and meets(a, b))
    assert sorted(map(tuple, met.select("l.id", F.col("r.id").alias("o")).collect())) == expected


def test_crowded_self_pairs_are_joined(spark, monkeypatch):
    from tesserae.operators import spatial

    rows = spark.range(400).select(F.col("id"), *((F.when(F.col("id") < 200, F.col("id") % 90).otherwise(F.col("id") * k % 90000) + w).alias(s) for s, k, w in (("minx", 37, 0), ("miny", 53, 0), ("maxx", 37, 50), ("maxy", 53, 50))))
    pairs = lambda: sorted(map(tuple, spatial.self_pairs(rows, "id", 64).select("l.id", F.col("r.id").alias("o")).collect()))
    whole = pairs()
    monkeypatch.setattr(spatial, "CROWD", 50)
    assert pairs() == whole and len(whole) == len(set(whole)) > 400


def test_tags_without_a_side_are_dealt_out(spark):
    """rows whose detection or label is null went to one task of the join."""
    from tesserae.operators import matching

    tags = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("det_id"), F.when(F.col("id") % 2 == 1, F.col("id")).alias("label_id"))
    dets, labels = spark.range(4000).select(F.col("id").alias("det_id"), (F.col("id") * 2).alias("a")), spark.range(4000).select(F.col("id").alias("label_id"), (F.col("id") * 3).alias("b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        got = matching.with_sides(tags, dets, labels)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert max(sizes) < 1400
        rows = {(r.det_id, r.label_id): (r.a, r.b) for r in got.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(rows) == 4000 and all((a, b) == (d and 2 * d or (0 if d == 0 else None), n and 3 * n) for (d, n), (a, b) in rows.items())


def test_no_task_writes_a_whole_dataset(spark, tmp_path, monkeypatch):
    """each dataset was gathered in one task."""
    monkeypatch.setattr(layers, "scratch", lambda *_: str(tmp_path / "files"))
    got = layers.rows_per_file(spark, SF).first()
    assert (got.files, got.rows, got.average) == (3, 6000, 2000.0)
    assert all(len(list(folder.glob("*.parquet"))) > 1 for folder in (tmp_path / "files").glob("dataset=*"))


def test_union_reads_no_window_where_nothing_crowds(spark):
    """every branch of the union sent its rows again."""
    from tesserae.operators import overlay

    rows = spark.createDataFrame([(1, 0, 0, 10, 10), (1, 5, 5, 15, 15), (2, 0, 0, 3, 3)], "k int, minx long, miny long, maxx long, maxy long")
    got = overlay.union_area(rows, ["k"], 100)
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, got.collect())) == [(1, 175), (2, 9)]


def test_fixtures_stay_while_others_are_made_of_them(fresh):
    """what was held of the detections was forgotten once tiles were made of them, so every use made them again."""
    from tesserae.plans import catalog

    for name in ("fx_dem", "fx_tile", "fx_label"):
        fixtures.frame(fresh, SF, name)
    for df in (fixtures.frame(fresh, SF, "fx_det"), fixtures.frame(fresh, SF, "fx_tile"), catalog.clip_to_tile(fresh, SF), catalog.enrich(fresh, SF)):
        leaves = df.select("*")._jdf.queryExecution().withCachedData().collectLeaves()
        assert {leaves.apply(k).nodeName().split()[0] for k in range(leaves.size())} == {"InMemoryRelation"}


def test_tiles_read_distinct_corners(fresh):
    """every detection took four rows to its tiles."""
    from pyspark.sql import Row

    det = fixtures.frame(fresh, SF, "fx_det")
    at = [(r.minx // 400, r.miny // 400, r.maxx // 400, r.maxy // 400) for r in det.collect()]
    assert sorted((r.tx, r.ty) for r in fixtures.frame(fresh, SF, "fx_tile").collect()) == sorted({(x, y) for a, b, c, d in at for x in (a, c) for y in (b, d)})
    own = fresh.createDataFrame([Row(minx=-1, miny=0, maxx=399, maxy=400)] * 5)
    assert list(map(tuple, fixtures.SLIM["fx_tile", "fx_det"](own).collect())) == [(-400, 0, 0, 400)]


def test_layers_are_met_at_once(fresh):
    """detections travelled to each layer and to the areas of interest by themselves."""
    from tesserae.plans import catalog

    assert catalog.enrich(fresh, SF)._jdf.queryExecution().optimizedPlan().toString().count("Join") <= 4


def test_dealt_areas_are_not_broadcast(spark, monkeypatch):
    """areas dealt to 64 parts were sent to the driver and to every task, as the planner sees one part's size."""
    from tesserae.operators import spatial

    monkeypatch.setattr(spatial, "SMALL_AREAS", 1)
    rows = spark.range(60).select(F.col("id"), *(((F.col("id") * k) % 90 + w).alias(s) for s, k, w in (("minx", 7, 0), ("miny", 11, 0), ("maxx", 7, 5), ("maxy", 11, 5))))
    met = spatial.area_pairs(rows, rows, 4)
    assert "BroadcastHashJoin" not in met._jdf.queryExecution().executedPlan().toString()
    meets = lambda a, b: a.minx <= b.maxx and b.minx <= a.maxx and a.miny <= b.maxy and b.miny <= a.maxy
    own = rows.collect()
    assert sorted(map(tuple, met.select("l.id", F.col("r.id").alias("o")).collect())) == sorted((a.id, b.id) for a in own for b in own if meets(a, b))


def test_narrow_areas_are_not_cut(spark):
    """every area travelled to the cells near it, 64 times; only those wider than such a cell have to."""
    from tesserae.functions import polygons as geo
    from tesserae.operators import polygons

    geo.register(spark)
    shaped = lambda rows: polygons.with_bounds(layers._shapes(spark.createDataFrame(rows, "id long, minx long, miny long, maxx long, maxy long")).select("id", "geometry"))
    near, narrow, wide = shaped([(1, 0, 0, 10, 10), (2, 95, 95, 130, 130)]), shaped([(5, 5, 5, 60, 60), (6, 90, 90, 120, 100)]), shaped([(7, 0, 0, 5000, 20)])
    cut = polygons.pieces_near(narrow, "id", near, 100)
    assert "Join" not in cut._jdf.queryExecution().optimizedPlan().toString() and cut.count() == 2
    both = polygons.pieces_near(narrow.unionByName(wide), "id", near, 100)
    sizes = {r["of"]: (r["n"], round(r["a"])) for r in both.groupBy("of").agg(F.count(F.lit(1)).alias("n"), F.sum(polygons.area()).alias("a")).collect()}
    assert sizes == {5: (1, 3025), 6: (1, 300), 7: (2, 4000)}


def test_many_detections_are_stored(fresh, monkeypatch):
    """the shuffle that numbers detections stayed on disk as long as they were held, beside what was held."""
    few = sorted(map(tuple, fixtures.frame(fresh, SF, "fx_det").collect()))
    monkeypatch.setattr(fixtures, "_built", {})
    monkeypatch.setitem(fixtures.STORED, "fx_det", 1)
    many = fixtures.frame(fresh, SF, "fx_det")
    assert not many.storageLevel.useDisk and "Window" not in many._jdf.queryExecution().analyzed().toString()
    assert sorted(map(tuple, many.collect())) == few


def test_a_long_write_releases_its_shuffles(spark, monkeypatch):
    """shuffles of written tables stayed on disk until the driver happened to collect garbage."""
    from tesserae import storage

    asked = []
    monkeypatch.setattr(storage, "release", asked.append)
    storage.store(spark.range(3), "short")
    monkeypatch.setattr(storage, "RELEASE_S", 0)
    storage.store(spark.range(3), "long")
    assert asked == [spark]


def test_thin_areas_lie_on_cells_of_their_shape(spark):
    """F8: a row of pixels, 500 times as long as high, lay in cells as high as long, and each point met hundreds of rows there."""
    from tesserae.operators import spatial

    schema = "id long, minx long, miny long, maxx long, maxy long"
    strips = [(n, -70, n * 4, 1000, n * 4 + 4) for n in range(40)] + [(100 + n, n * 4, -300, n * 4 + 4, 90) for n in range(9)] + [(200, 0, 0, 30, 30), (201, 5, 5, 65, 25)]
    areas, dots = spark.createDataFrame(strips, schema), spark.createDataFrame([(n, n * 13 % 990, n * 7 % 160, n * 13 % 990 + n % 3, n * 7 % 160 + n % 2) for n in range(80)], schema)
    levels = {r["id"]: (r["__lx"], r["__ly"]) for r in spatial._placed(areas, 4).collect()}
    assert levels[0] == (9, 0) and levels[100] == (0, 7) and levels[200] == (3, 3) and levels[201] == (4, 4)
    meets = lambda a, b: a[1] <= b[3] and b[1] <= a[3] and a[2] <= b[4] and b[2] <= a[4]
    assert sorted(map(tuple, spatial.area_pairs(dots, areas, 4).select("l.id", F.col("r.id").alias("o")).collect())) == sorted((a[0], b[0]) for a in map(tuple, dots.collect()) for b in strips if meets(a, b))


def test_shapes_are_cut_where_they_stand(spark, monkeypatch):
    """every shape travelled to the areas of interest, and again to be put together and to find its row."""
    from tesserae.functions import polygons as geo
    from tesserae.operators import polygons, spatial

    geo.register(spark)
    sides = lambda k: [F.col("id") * a % 900 + b for a, b in ((k, 0), (53, 0), (k, 40), (53, 40))]
    shapes = polygons.with_bounds(layers._shapes(spark.range(150).select("id", (F.col("id") * 2).alias("twice"), *(c.alias(s) for c, s in zip(sides(37), ("minx", "miny", "maxx", "maxy"))))).select("id", "twice", "geometry"))
    areas = layers._shapes(spark.createDataFrame([(1, "round", 400, 400, 420, 420), (2, "square", 0, 0, 300, 900)], "aid long, canton string, minx long, miny long, maxx long, maxy long"))
    areas = areas.select("aid", "canton", F.when(F.col("aid") == 1, polygons.geo("buffer", "geometry", F.lit(300.0), F.lit(200))).otherwise(F.col("geometry")).alias("geometry"))
    cut = lambda: sorted((r.id, r.twice, r.of, r.canton, round(r.a, 6)) for r in polygons.clipped_to(shapes, areas, "id", "aid", 5).withColumn("a", polygons.area()).collect())
    both = shapes.crossJoin(areas.withColumnRenamed("geometry", "other")).withColumn("a", polygons.geo("area", polygons.geo("intersection", "geometry", "other"))).where("a > 0")
    expected = sorted((r.id, r.twice, r.aid, r.canton, round(r.a, 6)) for r in both.collect())
    assert cut() == expected and len(expected) > 80
    plan = polygons.clipped_to(shapes, areas.where("aid = 2"), "id", "aid", 256)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") <= 4  # two branches, each with its pieces and their names
    monkeypatch.setattr(spatial, "SMALL_AREAS", 1)
    assert cut() == expected


def test_groups_of_one_cell_are_united_at_once(spark):
    """every group's shapes travelled through five levels of unions."""
    from tesserae.functions import polygons as geo
    from tesserae.operators import polygons

    geo.register(spark)
    rows = polygons.with_bounds(layers._shapes(spark.range(60).select((F.col("id") % 4 % 3).alias("k"), *(c.alias(s) for s, c in (("minx", F.col("id") * 70), ("miny", F.lit(0)), ("maxx", F.col("id") * 70 + 100), ("maxy", F.lit(50)))))).select("k", "geometry"))
    areas = lambda cell: sorted((r.k, round(r.a, 6)) for r in polygons.union_by(rows, ["k"], cell).withColumn("a", polygons.area()).collect())
    assert polygons.union_by(rows, ["k"], 10_000)._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
    assert areas(10_000) == areas(64) == [(0, 129000.0), (1, 75000.0), (2, 75000.0)]


def test_shapes_in_rectangles_are_told_by_bounds(spark):
    """grown shapes travelled to their tiles, twice."""
    from tesserae.functions import polygons as geo
    from tesserae.operators import polygons

    geo.register(spark)
    shaped = lambda rows: polygons.with_bounds(layers._shapes(spark.createDataFrame(rows, "id long, minx long, miny long, maxx long, maxy long")).select("id", "geometry"))
    tiles, shapes = shaped([(1, 0, 0, 100, 100), (2, 100, 0, 200, 100)]), shaped([(5, 10, 10, 90, 90), (6, 90, 10, 110, 20), (7, 100, 0, 200, 100), (8, 5, 5, 8, 8)])
    leaning = polygons.with_bounds(layers.leaning(spark.createDataFrame([(3, 90, 0, 190, 100)], "id long, minx long, miny long, maxx long, maxy long")))
    ids = lambda areas: sorted(r.id for r in polygons.held(areas, shapes.withColumnRenamed("id", "own").select(F.col("own").alias("id"), "geometry", *("minx", "miny", "maxx", "maxy")), "id", "id", 100).collect())
    assert ids(tiles) == [5, 7, 8]
    assert ids(tiles.unionByName(leaning)) == [5, 7, 8]
    assert ids(leaning.unionByName(shaped([(4, 88, 8, 112, 22)]))) == [6]
