import json

import pytest
from pyspark.sql import functions as F

from tesserae import config, storage
from tesserae.plans import flows
from tesserae.plans.fixtures import frame

SF = "/root/testdata/sf0.001"


def test_settings(tmp_path):
    assert config.score_threshold("optimal", 75) == 0.2 and config.score_threshold("conservative") == 0.05
    for bad in (("optimal", 680), ("best", 68)):
        with pytest.raises(ValueError):
            config.score_threshold(*bad)
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"fuse": {"iou": 0.3}, "bad": {"x": 1}}))
    assert config.load(config.Fuse, str(path), "fuse").iou == 0.3
    with pytest.raises(ValueError):
        config.load(config.Fuse, str(path), "bad")


def test_preparation(spark):
    cats = flows.categories(spark, '{"7": {"name": "b", "supercategory": "s"}, "3": {"name": "a", "supercategory": "s"}}')
    assert sorted(map(tuple, cats.collect())) == [("a", 1), ("b", 2)]
    raw = spark.createDataFrame([(0, 0, 4, 4, "2001", "x"), (0, 0, 4, 4, "2001", "y"), (0, 0, 4, 4, "2002", "x")], "minx long, miny long, maxx long, maxy long, year string, kind string")
    own = flows.labels(raw, "kind", "topic")
    assert sorted((r["year"], r["CATEGORY"], r["SUPERCATEGORY"]) for r in own.collect()) == [(2001, "x", "topic"), (2002, "x", "topic")]
    assert {r["CATEGORY"] for r in flows.labels(raw.drop("year"), None, "topic").collect()} == {"topic"}
    both = flows.with_false_labels(own, raw.where("year = '2002'").withColumn("maxx", F.lit(9).cast("long")), "kind", "topic")
    assert sorted(r["tag"] for r in both.collect()) == ["FP", "own", "own"]
    with pytest.raises(ValueError):
        flows.check_years(raw, raw.drop("year"), "labels")
    aoi = spark.createDataFrame([(1, 0.0, 0.0, 900.0, 100.0)], "id long, minx double, miny double, maxx double, maxy double")
    tiles = flows.empty_tiles(aoi, "id", 16, (2010, 2012))
    assert tiles.count() == 4 and {r["year"] for r in tiles.collect()} <= {2010, 2011}
    lake = spark.createDataFrame([(-2000, -2000, 1120, 2000)], "minx long, miny long, maxx long, maxy long")
    assert flows.filtered_tiles(tiles, lake, None).count() == 2


def test_detections_to_assessment(spark):
    dets, tiles = frame(spark, SF, "fx_det"), frame(spark, SF, "fx_tile")
    raw = dets.withColumnRenamed("merged_id", "det_id")
    merged = flows.merge_within_year(raw, tiles)
    assert 0 < merged.count() < raw.count() and merged.where("score <= 0.05").isEmpty()
    fused = flows.fuse_models(dets, config.Fuse(small=30_000, most=60_000))
    years = flows.fuse_years(fused).cache()
    kept, gone = flows.without_artifacts(years, tiles, config.Artifacts(20_000, 60_000, 0.2))
    assert kept.count() + gone.count() == years.count()
    layers = {k: frame(spark, SF, "fx_layer").where(F.col("layer_key") == k) for k in ("waters", "forests", "sda")}
    settings = config.Enrich(exclude=("waters",), overlap=("forests",))
    final = flows.filter_and_enrich(kept.withColumnRenamed("group_id", "det_id"), frame(spark, SF, "fx_aoi"), frame(spark, SF, "fx_dem"), layers, settings)
    rows = final.collect()
    assert rows and len({r["det_part_id"] for r in rows}) == len(rows)
    assert all(r["valid_area"] > 100 and 0 <= r["forests"] and r["distance_sda"] >= 0 for r in rows)
    assert set(flows.charts(final)) == {"first_year", "last_year", "lifespan", "count_years", "elevation"}
    classes = spark.createDataFrame([(1,), (2,)], "label_class int")
    got = flows.assess(raw, frame(spark, SF, "fx_label"), None, classes)
    assert got["average"].first()["accuracy"] > 0 and got["calibration"].count() > 5 and got["geometric"].count() == 1
    assert flows.renamed(final, [("forests", "wood"), ("nothing", "x")]).columns.count("wood") == 1


def test_years_on_disk(spark, tmp_path):
    df = spark.createDataFrame([(1, 2001), (2, 2002), (3, 2003)], "id long, year int")
    flows.write(df, str(tmp_path / "y"), by_year="year")
    flows.write(df.limit(0), str(tmp_path / "y"), overwrite=False)
    assert sorted(r["id"] for r in flows.compile_years(spark, str(tmp_path / "y"), [2001, 2003, 1999]).collect()) == [1, 3]


def test_assessment_by_dataset_and_its_tables(spark, tmp_path):
    dets = frame(spark, SF, "fx_det").withColumnRenamed("merged_id", "det_id")
    classes = spark.createDataFrame([(1,), (2,)], "label_class int")
    got = flows.assess(dets, frame(spark, SF, "fx_label"), None, classes)
    assert sorted(r["dataset"] for r in got["by_dataset"].collect()) == ["trn", "tst", "val"]
    flows.write_assessment({k: got[k] for k in ("tagged", "by_dataset")}, str(tmp_path))
    back = spark.read.option("header", "true").csv(str(tmp_path / "by_dataset"))
    assert back.count() == 3 and spark.read.parquet(str(tmp_path / "tagged")).columns == ["tag", "det_id", "label_id", "iou", "det_class", "label_class"]


def test_projected_area_and_tiles_that_no_filter_leaves(spark):
    box = "minx double, miny double, maxx double, maxy double"
    region, footprint = spark.createDataFrame([(7.0, 46.0, 8.0, 47.0)], box), spark.createDataFrame([(7.5, 46.5, 9.0, 48.0)], box)
    (got,) = flows.area_of_interest(region, footprint, "vaud", 2001, 50_000, "swiss").collect()
    assert got["canton"] == "vaud" and 2_600_000 < got["minx"] < 2_610_000 and 1_145_000 < got["miny"] < 1_155_000
    tiles = frame(spark, SF, "fx_tile").limit(5)
    dem = tiles.select("tx", "ty").withColumn("elevation", F.lit(5000.0))
    assert flows.filtered_tiles(tiles, None, dem).count() == 0
    assert flows.filtered_tiles(tiles, None, dem, or_all=True).count() == 5
    low = dem.withColumn("elevation", F.lit(10.0))
    assert sorted(r["tile_id"] for r in flows.filtered_tiles(tiles, None, low).collect()) == sorted(r["tile_id"] for r in tiles.collect())


def test_missing_years_are_named(spark, tmp_path):
    for year in (2001, 2003):
        spark.range(2).withColumn("year", F.lit(year)).write.mode("append").partitionBy("year").parquet(str(tmp_path))
    with pytest.warns(UserWarning, match="2002, 2004"):
        got = flows.compile_years(spark, str(tmp_path), [2001, 2002, 2004])
    assert {r["year"] for r in got.collect()} == {2001}


def test_derived_inputs_are_made_once(spark, tmp_path):
    made = []
    make = lambda: made.append(1) or spark.range(3)
    path = str(tmp_path / "d")
    assert storage.derived(spark, path, make).count() == 3 and storage.derived(spark, path, make).count() == 3 and made == [1]
    (tmp_path / "d" / "_SUCCESS").unlink()  # as a write that broke off
    assert storage.derived(spark, path, make).count() == 3 and made == [1, 1]
