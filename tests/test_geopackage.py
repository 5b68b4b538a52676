import sqlite3

import pytest
from pyspark.sql import functions as F

from tesserae.functions import wkb
from tesserae.sources import geopackage, vector


def frame(spark, n=60):
    rows = [(bytearray(wkb.rectangle(i, 0, i + 1, 1)), float(i), 0.0, i + 1.0, 1.0, {"name": f"r{i}", "year": str(2000 + i % 3), "note": "x" * 50}, "f") for i in range(n)]
    return spark.createDataFrame([*rows, (None, None, None, None, None, {"name": "none", "year": "2001"}, "f")], vector.SCHEMA)


def names(rows):
    return sorted(r["properties"]["name"] for r in rows)


def test_layers_in_one_file(spark, tmp_path):
    vector.register(spark)
    path = str(tmp_path / "years")
    write = lambda mode: frame(spark).repartition(4).write.format("gpkg").mode(mode).options(layer_by="year", single="all.gpkg", srid="2056").option("path", path).save()
    write("append")
    assert [f.name for f in (tmp_path / "years").iterdir()] == ["all.gpkg"]
    with sqlite3.connect(tmp_path / "years" / "all.gpkg") as db:
        assert [r[0] for r in db.execute("SELECT table_name FROM gpkg_geometry_columns ORDER BY 1")] == ["2000", "2001", "2002"]
        assert db.execute('SELECT count(*), count(DISTINCT fid), count(geom) FROM "2001"').fetchone() == (21, 21, 20)
        assert db.execute('SELECT count(*) FROM "rtree_2001_geom"').fetchone() == (20,)
        got = db.execute('SELECT name FROM "2000" WHERE fid IN (SELECT id FROM "rtree_2000_geom" WHERE minx <= 3 AND maxx >= 3)').fetchall()
        assert got == [("r3",)]
    layer = spark.read.format("gpkg").option("layer", "2002").load(path)
    assert {r["properties"]["layer"] for r in layer.collect()} == {"2002"} and layer.count() == 20
    write("append")
    assert spark.read.format("gpkg").load(path).count() == 122
    write("overwrite")
    assert names(spark.read.format("gpkg").load(path).collect()) == names(frame(spark).collect())


def test_box_and_columns_read_less(spark, tmp_path, monkeypatch):
    vector.register(spark)
    path = str(tmp_path / "g")
    frame(spark).coalesce(1).write.format("gpkg").mode("append").option("path", path).save()
    seen = []
    monkeypatch.setattr(geopackage, "from_gpkg", lambda blob, real=geopackage.from_gpkg: seen.append(1) or real(blob))
    reader = geopackage.GeoPackageReader({"path": path, "bbox": "9.5,0,12.5,5", "columns": "name"}, ".gpkg")
    got = [r for p in reader.partitions() for r in reader.read(p)]
    assert sorted(r[5]["name"] for r in got) == ["r10", "r11", "r12", "r9"] and set(got[0][5]) == {"name", "layer"}
    assert len(seen) == 4  # the R-tree left the others alone
    pushed = geopackage.GeoPackageReader({"path": path}, ".gpkg")
    assert len(list(pushed.pushFilters([geopackage.GreaterThan(("minx",), 50.0), geopackage.LessThan(("maxx",), 55.0)]))) == 2
    assert len([r for p in pushed.partitions() for r in pushed.read(p)]) == 5 and len(seen) < 12
    assert names(spark.read.format("gpkg").load(path).where(F.col("minx") > 56).collect()) == ["r57", "r58", "r59"]


def test_large_files_are_split(spark, tmp_path, monkeypatch):
    vector.register(spark)
    path = str(tmp_path / "s")
    frame(spark, 500).coalesce(1).write.format("gpkg").mode("append").option("path", path).save()
    monkeypatch.setattr(geopackage, "SPLIT", 20_000)
    reader = geopackage.GeoPackageReader({"path": path}, ".gpkg")
    parts = reader.partitions()
    each = [[r[5]["name"] for r in reader.read(p)] for p in parts]
    assert len(parts) > 3 and max(map(len, each)) < 400 and sorted(sum(each, [])) == names(frame(spark, 500).collect())


def test_tables_of_others(tmp_path):
    """A layer without an R-tree, its geometry under another name, no features at all."""
    with sqlite3.connect(tmp_path / "o.gpkg") as db:
        db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
        db.executemany("INSERT INTO gpkg_geometry_columns VALUES (?, ?)", [("a b", "shape"), ("empty", "shape")])
        db.execute('CREATE TABLE "a b" (n INTEGER, shape BLOB, raw BLOB)')
        db.execute("CREATE TABLE empty (shape BLOB)")
        db.executemany('INSERT INTO "a b" VALUES (?, ?, ?)', [(k, geopackage.to_gpkg(wkb.rectangle(k, 0, k + 1, 1), 1), b"x") for k in range(5)])
    reader = geopackage.GeoPackageReader({"path": str(tmp_path / "o.gpkg"), "bbox": "0,0,1.5,1"}, ".gpkg")
    assert [r[5] for p in reader.partitions() for r in reader.read(p)] == [{"n": "0", "layer": "a b"}, {"n": "1", "layer": "a b"}]


def test_what_is_there_is_left(spark, tmp_path):
    vector.register(spark)
    path = str(tmp_path / "once")
    assert vector.write_once(frame(spark, 3), "gpkg", path, layer="a") and not vector.write_once(frame(spark, 9), "gpkg", path)
    assert spark.read.format("gpkg").load(path).count() == 4
    (tmp_path / "nothing").mkdir()
    with pytest.raises(Exception, match="gpkg"):
        spark.read.format("gpkg").load(str(tmp_path / "nothing")).collect()
