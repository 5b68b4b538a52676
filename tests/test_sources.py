import struct
import zipfile

import numpy as np
import pytest

from pyspark.sql import functions as F

from tesserae.functions import wkb
from tesserae import storage
from tesserae.sources import raster, vector
from tesserae.streaming.years import compile_years


def rows():
    return [(bytearray(wkb.rectangle(i, 0, i + 2, 1)), float(i), 0.0, i + 2.0, 1.0, {"name": f"r{i}", "class": "1"}, "f") for i in range(5)] + [(None, None, None, None, None, {"name": "none"}, "f")]


def test_geojson_and_geopackage_round_trip(spark, tmp_path):
    vector.register(spark)
    df = spark.createDataFrame(rows(), vector.SCHEMA)
    for kind in ("geojson", "gpkg"):
        path = str(tmp_path / kind)
        df.repartition(2).write.format(kind).mode("append").option("path", path).save()
        got = spark.read.format(kind).load(path)
        own = sorted((bytes(r["geometry"] or b""), r["minx"] or 0, r["properties"]["name"]) for r in got.collect())
        assert own == sorted((bytes(r[0] or b""), r[1] or 0, r[5]["name"]) for r in rows())


def test_shapefile(spark, tmp_path):
    vector.register(spark)
    outer, hole = [(0, 0), (0, 9), (9, 9), (9, 0), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]
    points = outer + hole
    body = struct.pack("<i4d2i2i", 5, 0, 0, 9, 9, 2, 10, 0, 5) + b"".join(struct.pack("<2d", *p) for p in points)
    (tmp_path / "a.shp").write_bytes(b"\0" * 100 + struct.pack(">2i", 1, len(body) // 2) + body + struct.pack(">2i", 2, 2) + struct.pack("<i", 0))
    head = struct.pack("<4BIHH20x", 3, 0, 0, 0, 2, 65, 6) + b"NAME".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([5]) + b"\0" * 15 + b"\r"
    (tmp_path / "a.dbf").write_bytes(head + b" one  " + b" two  ")
    got = spark.read.format("shapefile").load(str(tmp_path)).collect()
    assert [r["properties"]["NAME"] for r in got] == ["one", "two"]
    assert wkb.loads(bytes(got[0]["geometry"]))["coordinates"] == [[list(map(float, p)) for p in ring] for ring in (outer, hole)]
    assert got[1]["geometry"] is None


def test_provenance_and_names(spark, tmp_path):
    for m in ("model68", "model72"):
        spark.range(3).write.parquet(str(tmp_path / "runs" / m))
    got = vector.with_provenance(spark, str(tmp_path / "runs")).groupBy("model").count().collect()
    assert sorted(map(tuple, got)) == [("model68", 3), ("model72", 3)]
    assert vector.output_name("merged", score=0.25) == "merged_score_0dot25"
    assert vector.year_folders("/x", [1, 2], exists=lambda p: p.endswith("2")) == ["/x/year=2"]


def test_years_arrive_one_by_one(spark, tmp_path):
    source, sink, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    for year in (2001, 2002):
        spark.range(4).withColumn("year", F.lit(year)).write.mode("append").partitionBy("year").parquet(source)
        schema = spark.read.parquet(source).schema
        compile_years(spark, source, schema, sink, checkpoint=mark).awaitTermination()
    got = spark.read.parquet(sink)
    assert got.count() == 8


@pytest.mark.parametrize("kind", ["geojson", "gpkg"])
def test_writers_append_and_overwrite(spark, tmp_path, kind):
    vector.register(spark)
    path = str(tmp_path / kind)
    df = spark.createDataFrame(rows(), vector.SCHEMA)
    names = lambda: sorted(r["properties"]["name"] for r in spark.read.format(kind).load(path).collect())
    for mode, times in (("append", 1), ("append", 2), ("overwrite", 1)):
        df.repartition(3).write.format(kind).mode(mode).option("path", path).save()
        assert names() == sorted(["none", *(f"r{i}" for i in range(5))] * times)
    df.where("minx < 0").write.format(kind).mode("overwrite").option("path", path).save()
    assert not [f for f in (tmp_path / kind).iterdir() if f.name.startswith("_drafts")]
    assert names() == []


def test_no_file_is_an_error(spark, tmp_path):
    vector.register(spark)
    with pytest.raises(Exception, match="geojson"):
        spark.read.format("geojson").load(str(tmp_path)).collect()


def test_names_from_tables(spark, tmp_path):
    (tmp_path / "names.csv").write_text("argument,name\na,Alpha\nb,Beta\n")
    assert sorted(vector.names_from(spark, str(tmp_path / "names.csv"))) == [("a", "Alpha"), ("b", "Beta")]
    space = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    sheet = lambda pairs: f"<worksheet {space}><sheetData>" + "".join(f'<row><c r="A{k}" t="s"><v>{a}</v></c><c r="B{k}" t="inlineStr"><is><t>{b}</t></is></c></row>' for k, (a, b) in enumerate(pairs, 1)) + "</sheetData></worksheet>"
    with zipfile.ZipFile(tmp_path / "names.xlsx", "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook {space}><sheets><sheet name="vaud"/><sheet name="ticino"/></sheets></workbook>')
        book.writestr("xl/sharedStrings.xml", f"<sst {space}><si><t>argument</t></si><si><t>a</t></si><si><t>c</t></si></sst>")
        book.writestr("xl/worksheets/sheet1.xml", sheet([(0, "name"), (1, "Eins")]))
        book.writestr("xl/worksheets/sheet2.xml", sheet([(0, "name"), (2, "Drei")]))
    assert vector.names_from(spark, str(tmp_path / "names.xlsx")) == [("a", "Eins")]
    assert vector.names_from(spark, str(tmp_path / "names.xlsx"), "ticino") == [("c", "Drei")]


def test_years_in_names_and_thresholds(spark, tmp_path):
    got = spark.createDataFrame([(x,) for x in ("/a/1999/b_2003.shp", "x2011y.gpkg", "12003.tif", "none")], "file string").select(vector.year_in_name(F.col("file")))
    assert [r[0] for r in got.collect()] == [2003, 2011, None, None]
    for t in (0.05, 0.5):
        spark.range(3).coalesce(1).write.parquet(str(tmp_path / "t" / str(t)))
        (part,) = (tmp_path / "t" / str(t)).glob("*.parquet")
        part.rename(tmp_path / f"{vector.output_name('m', score=t)}.parquet")
    df = spark.read.option("pathGlobFilter", "*.parquet").parquet(str(tmp_path))
    assert vector.with_threshold_in_name(df, "conservative").count() == 3 == vector.with_threshold_in_name(df, "optimal").count()
    with pytest.raises(ValueError):
        vector.with_threshold_in_name(df, "other")
    assert tuple(vector.rows_per_file(df).first()) == (2, 6, 3.0)


def test_rasters_there_and_back(spark, tmp_path):
    raster.register(spark)
    rng = np.random.default_rng(0)
    bands = rng.integers(0, 256, (3, 4 * 5)).astype(float)
    one = [("img.tif", 4, 5, 100.0, 200.0, 2.0, 3.0, bands.tolist())]
    frame = spark.createDataFrame(one, "source string, h int, w int, x0 double, y0 double, dx double, dy double, bands array<array<double>>")
    frame.write.format("geotiff").mode("append").option("path", str(tmp_path)).save()
    assert [r["path"].split("/")[-1] for r in raster.listing(spark, str(tmp_path)).collect()] == ["img.tif"]
    got = {(r["band"], r["row"], r["col"]): (r["x"], r["y"], r["value"]) for r in raster.pixels(raster.read(spark, str(tmp_path))).collect()}
    assert got == {(b + 1, r, c): (101.0 + 2 * c, 198.5 - 3 * r, bands[b][5 * r + c]) for b in range(3) for r in range(4) for c in range(5)}
    other = raster.read(spark, str(tmp_path), [2]).withColumns({"source": F.lit("/x/img.png"), "x0": F.lit(0.0), "y0": F.lit(0.0), "dx": F.lit(1.0), "dy": F.lit(1.0)})
    placed = raster.with_georeference(other, raster.read(spark, str(tmp_path)))
    assert [(r["x0"], r["y0"], r["dx"], r["dy"]) for r in placed.collect()] == [(100.0, 200.0, 2.0, 3.0)]


@pytest.mark.parametrize(("order", "tiled", "planar", "deflated"), [("<", False, 1, False), (">", False, 2, True), ("<", True, 1, True), (">", True, 2, False)])
def test_raster_layouts(order, tiled, planar, deflated):
    """Strips and tiles, chunky and planar, both byte orders, with and without deflate and differencing."""
    import zlib

    rng = np.random.default_rng(1)
    image = rng.integers(0, 1000, (5, 7, 2)).astype(f"{order}u2")
    h, w = (4, 4) if tiled else (2, 7)
    blocks = []
    for plane in range(2 if planar == 2 else 1):
        part = image[:, :, plane : plane + 1] if planar == 2 else image
        for r in range(0, 5, h):
            for c in range(0, 7, w):
                block = part[r : r + h, c : c + w]
                if tiled:
                    block = np.pad(block, ((0, h - block.shape[0]), (0, w - block.shape[1]), (0, 0)))
                if deflated:
                    block = np.concatenate((block[:, :1], np.diff(block, axis=1)), 1)
                data = block.astype(f"{order}u2").tobytes()
                blocks.append(zlib.compress(data) if deflated else data)
    T = raster.TAGS
    names = ("tile_offsets", "tile_counts") if tiled else ("strip_offsets", "strip_counts")
    fields = {T["width"]: (3, [7]), T["height"]: (3, [5]), T["bits"]: (3, [16, 16]), T["compression"]: (3, [8 if deflated else 1]), T["samples"]: (3, [2]), T["planar"]: (3, [planar]), T["predictor"]: (3, [2 if deflated else 1])}
    fields |= {T["tile_width"]: (3, [w]), T["tile_height"]: (3, [h])} if tiled else {T["rows_per_strip"]: (3, [h])}
    at, body, offsets = 8, b"", []
    for b in blocks:
        offsets.append(at + len(body))
        body += b
    fields |= {T[names[0]]: (4, offsets), T[names[1]]: (4, [len(b) for b in blocks])}
    end, extra, entries = at + len(body), b"", b""
    for tag, (kind, values) in sorted(fields.items()):
        packed = struct.pack(f"{order}{len(values)}{raster.TYPES[kind]}", *values)
        entries += struct.pack(f"{order}HHI", tag, kind, len(values))
        if len(packed) > 4:
            entries += struct.pack(f"{order}I", end + len(extra))
            extra += packed
        else:
            entries += packed.ljust(4, b"\0")
    data = (b"II*\0" if order == "<" else b"MM\0*") + struct.pack(f"{order}I", end + len(extra)) + body + extra + struct.pack(f"{order}H", len(fields)) + entries + b"\0" * 4
    got = np.zeros((5, 7, 2))
    for band, r, c, block, _ in raster.chunks_of(data):
        got[r : r + block.shape[0], c : c + block.shape[1], band - 1] = block
    assert (got == image).all()


def test_resampling(spark):
    """A plane is kept by cubic convolution; pixels themselves too."""
    cells = spark.createDataFrame([(r, c, 2.0 * r + 3.0 * c) for r in range(8) for c in range(8)], "row int, col int, value double")
    points = spark.createDataFrame([(2.5, 3.25), (4.0, 5.0), (3.1, 2.9), (90.0, 90.0), (2.5, 3.25)], "x double, y double")
    got = sorted(((r["x"], r["y"], r["value"]) for r in raster.resampled(points, cells).collect()), key=str)
    assert len(got) == 5
    for x, y, v in got:
        assert v is None if x > 8 else v == pytest.approx(2 * y + 3 * x)


def test_shared_root_off_local_sessions():
    class Context:
        master = "spark://host"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {"spark.checkpoint.dir": None}

    with pytest.raises(RuntimeError):
        storage.shared_root(Session())
