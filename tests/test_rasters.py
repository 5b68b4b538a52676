"""Raster files by ranges: codecs against hand-made files, splitting and pushdown, sampling, names of written files."""

import os
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.operators import raster as operators
from tesserae.sources import raster, tiff


def lzw(data: bytes) -> bytes:
    """An encoder by the format's description, for the tests alone."""
    bits, n, out = 0, 0, bytearray()

    def put(code, width):
        nonlocal bits, n
        bits, n = bits << width | code, n + width
        while n >= 8:
            n -= 8
            out.append(bits >> n & 255)

    width, table = 9, {bytes([k]): k for k in range(256)}
    put(256, width)
    now, free = b"", 258
    for k in range(len(data)):
        byte = data[k : k + 1]
        if now + byte in table:
            now += byte
            continue
        put(table[now], width)
        table[now + byte] = free
        if free in (511, 1023, 2047):
            width += 1
        free += 1
        now = byte
        if free == 4095:
            put(table[now], width)
            put(256, width)
            width, table, free, now = 9, {bytes([k]): k for k in range(256)}, 258, b""
    if now:
        put(table[now], width)
    put(257, width)
    put(0, 7)
    return bytes(out)


def packbits(data: bytes) -> bytes:
    out, k = bytearray(), 0
    while k < len(data):
        run = next((j for j in range(1, 128) if k + j >= len(data) or data[k + j] != data[k]), 128)
        if run > 2:
            out += bytes([257 - run, data[k]])
            k += run
        else:
            out += bytes([0, data[k]])
            k += 1
    return bytes(out)


PACKERS = {1: bytes, 5: lzw, 8: zlib.compress, 32773: packbits}


def made(image: np.ndarray, compression=1, predictor=1, tile=None, rows=4, big=False, order="<", place=(100.0, 200.0, 2.0, 2.0), gap=0) -> bytes:
    """A file of an image (h, w, samples), in strips or tiles; `gap` bytes lie before the chunks."""
    h, w, n = image.shape
    th, tw = tile or (rows, w)
    chunks = []
    for r in range(0, h, th):
        for c in range(0, w, tw):
            block = np.zeros((th if tile else min(th, h - r), tw, n), image.dtype)
            part = image[r : r + th, c : c + tw]
            block[: part.shape[0], : part.shape[1]] = part
            if predictor == 2:
                block = np.concatenate((block[:, :1], np.diff(block, axis=1)), 1)
            if predictor == 3:
                size = image.dtype.itemsize
                flat = block.astype(image.dtype.newbyteorder(">")).reshape(len(block), -1).view(np.uint8).reshape(len(block), tw * n, size)
                planes = flat.transpose(0, 2, 1).reshape(len(block), size * tw, n)
                raw = np.concatenate((planes[:, :1], np.diff(planes, axis=1)), 1).tobytes()
            else:
                raw = block.astype(image.dtype.newbyteorder(order)).tobytes()
            chunks.append(PACKERS[compression](raw))
    T, word = tiff.TAGS, "Q" if big else "I"
    start = (16 if big else 8) + gap
    offsets = [start + sum(map(len, chunks[:k])) for k in range(len(chunks))]
    kind, wide = {"u": 1, "i": 2, "f": 3}[image.dtype.kind], 16 if big else 4
    fields = [("width", 4, [w]), ("height", 4, [h]), ("bits", 3, [8 * image.dtype.itemsize] * n), ("compression", 3, [compression]), ("samples", 3, [n]), ("predictor", 3, [predictor]), ("format", 3, [kind] * n), ("scale", 12, [place[2], place[3], 0.0]), ("tie", 12, [0.0, 0.0, 0.0, place[0], place[1], 0.0])]
    names = ("tile_offsets", "tile_counts") if tile else ("strip_offsets", "strip_counts")
    fields += [(names[0], wide, offsets), (names[1], wide, [len(c) for c in chunks])]
    fields += [("tile_width", 4, [tw]), ("tile_height", 4, [th])] if tile else [("rows_per_strip", 4, [th])]
    fields.sort(key=lambda f: T[f[0]])
    at, room = start + sum(map(len, chunks)), 8 if big else 4
    entry = 20 if big else 12
    extra_at, extra, entries = at + (8 if big else 2) + entry * len(fields) + room, b"", b""
    for name, form, values in fields:
        raw = struct.pack(f"{order}{len(values)}{tiff.TYPES[form]}", *values)
        head = struct.pack(f"{order}HH{word}", T[name], form, len(values))
        if len(raw) <= room:
            entries += head + raw.ljust(room, b"\0")
        else:
            entries += head + struct.pack(order + word, extra_at + len(extra))
            extra += raw
    mark = b"II" if order == "<" else b"MM"
    head = mark + (struct.pack(order + "HHHQ", 43, 8, 0, at) if big else struct.pack(order + "HI", 42, at))
    return head, b"".join(chunks) + struct.pack(order + ("Q" if big else "H"), len(fields)) + entries + struct.pack(order + word, 0) + extra


def whole(head_and_body) -> bytes:
    return b"".join(head_and_body)


def image(h, w, n, dtype, seed=0):
    rng = np.random.default_rng(seed)
    smooth = np.cumsum(rng.integers(-3, 4, (h, w, n)), axis=1)
    return (smooth / 3).astype(dtype) if np.dtype(dtype).kind == "f" else (smooth % 200).astype(dtype)


def assembled(data: bytes, n):
    parts = list(raster.chunks_of(data))
    h, w = max(p[1] + p[3].shape[0] for p in parts), max(p[2] + p[3].shape[1] for p in parts)
    out = np.zeros((h, w, n))
    for band, r, c, block, _ in parts:
        out[r : r + block.shape[0], c : c + block.shape[1], band - 1] = block
    return out


@pytest.mark.parametrize("compression", sorted(PACKERS))
@pytest.mark.parametrize("big", [False, True])
@pytest.mark.parametrize("order", ["<", ">"])
def test_codecs(compression, big, order):
    for dtype, predictor in (("u1", 1), ("u1", 2), ("i2", 2), ("f4", 1), ("f4", 3), ("f8", 3)):
        for tile in (None, (16, 16)):
            for n in (1, 3):
                pixels = image(37, 29, n, dtype)
                data = whole(made(pixels, compression, predictor, tile, 7, big, order))
                assert np.array_equal(assembled(data, n), pixels), (dtype, predictor, tile, n)


def test_lzw_fills_and_clears_its_table():
    data = np.random.default_rng(1).integers(0, 7, 60_000).astype(np.uint8).tobytes() + b"\0" * 30_000 + np.random.default_rng(2).integers(0, 256, 20_000).astype(np.uint8).tobytes()
    assert tiff.unlzw(lzw(data)) == data
    with pytest.raises(ValueError):
        tiff.unlzw(b"\x00\x01\x02")


def test_what_is_not_read_is_named():
    head, body = made(image(4, 4, 1, "u1"))
    for code, name in ((7, "jpeg"), (34712, "jpeg 2000"), (99, "unknown")):
        data = (head + body).replace(struct.pack("<HHII", 259, 3, 1, 1), struct.pack("<HHII", 259, 3, 1, code))
        with pytest.raises(ValueError, match=name):
            list(raster.chunks_of(data))
    with pytest.raises(ValueError, match="not a TIFF"):
        list(raster.chunks_of(b"PNG and so on, not a raster"))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Two neighbours of 64 x 64 pixels of 2 m, tiled, of different codecs, and one elsewhere."""
    path = tmp_path_factory.mktemp("rasters")
    for name, x, y, how in (("a.tif", 0.0, 128.0, (5, 2)), ("b.tif", 128.0, 128.0, (8, 1)), ("sub/c.TIF", 10_000.0, 128.0, (32773, 1))):
        (path / name).parent.mkdir(exist_ok=True)
        (path / name).write_bytes(whole(made(image(64, 64, 2, "u2", len(name)), *how, tile=(16, 16), place=(x, y, 2.0, 2.0))))
    return path


def test_ranges_splits_and_pushdown(spark, folder, monkeypatch):
    raster.register(spark)
    every = spark.read.format("geotiff").load(str(folder))
    assert every.count() == 3 * 16 * 2
    assert every.agg(F.sum("stored")).first()[0] < sum(os.path.getsize(f) for f in folder.rglob("*") if f.is_file()) * 2
    same = {(r["source"].split("/")[-1], r["band"], r["row0"], r["col0"]): list(r["values"]) for r in raster.read(spark, str(folder)).collect()}
    assert {(r["source"].split("/")[-1], r["band"], r["row0"], r["col0"]): list(r["values"]) for r in every.collect()} == same
    monkeypatch.setattr(raster, "SPLIT", 1000)
    reader = raster.RangeReader({"path": str(folder)})
    parts = reader.partitions()
    assert len(parts) > 6 and sum(1 for p in parts for _ in reader.read(p)) == 96
    box = raster.RangeReader({"path": str(folder), "bbox": "100,90,140,100", "bands": "2"})
    found = [r for p in box.partitions() for r in box.read(p)]
    assert len(found) == 4 and {r[1] for r in found} == {2}  # two tiles of either neighbour
    pushed = raster.RangeReader({"path": str(folder)})
    assert len(list(pushed.pushFilters([raster.EqualTo(("band",), 1), raster.GreaterThan(("x1",), 9_000.0), raster.LessThan(("x0",), 10_040.0)]))) == 3
    assert len([r for p in pushed.partitions() for r in pushed.read(p)]) == 8
    assert every.where("band = 1 AND x1 > 9000 AND x0 < 10040").count() == 8


def test_a_file_beyond_two_gigabytes(spark, tmp_path):
    """Its chunks lie behind a hole: whole files of that size can't be rows."""
    gap = 3 << 30
    head, body = made(image(64, 64, 1, "f4"), 5, 3, (16, 16), big=True, place=(0.0, 128.0, 2.0, 2.0), gap=gap)
    with open(tmp_path / "big.tif", "wb") as f:
        f.write(head)
        f.seek(gap, 1)
        f.write(body)
    raster.register(spark)
    rows = spark.read.format("geotiff").option("bbox", "0,0,10,10").load(str(tmp_path)).collect()
    assert len(rows) == 1 and rows[0]["row0"] == 48 and rows[0]["stored"] < 2000
    pts = spark.createDataFrame([(1, 5.0, 5.0)], "id long, x double, y double")
    got = raster.sample_files(pts, spark, str(tmp_path), "id").first()
    assert got["value"] == pytest.approx(float(image(64, 64, 1, "f4")[61, 2, 0])) and got["read"] < 2000


def test_samples_equal_the_pixels(spark, folder):
    rng = np.random.default_rng(5)
    pts = [(k, float(x), float(y)) for k, (x, y) in enumerate(rng.uniform(-20, 300, (200, 2)))] + [(900, 10_001.0, 127.0), (901, 0.0, 128.0), (902, None, 3.0), (903, 128.0, 64.0)]
    got = {r["id"]: r for r in raster.sample_files(spark.createDataFrame(pts, "id int, x double, y double"), spark, str(folder), "id", band=2, value="z", cell=64).collect()}
    assert len(got) == len(pts)
    images = [(0.0, image(64, 64, 2, "u2", 5)), (128.0, image(64, 64, 2, "u2", 5)), (10_000.0, image(64, 64, 2, "u2", 9))]
    for k, x, y in pts:
        want = next((float(im[int((128 - y) // 2), int((x - left) // 2), 1]) for left, im in images if x is not None and left <= x < left + 128 and 0 < y <= 128), None)
        assert got[k]["z"] == want, (k, x, y)
    chunks = {(x // 32, y // 32) for k, x, y in pts if got[k]["z"] is not None}
    assert sum(1 for r in got.values() if r["read"]) < 3 * len(chunks) and sum(r["read"] for r in got.values()) > 0


def test_every_written_row_has_a_file(spark, tmp_path):
    """Without names, in several tasks; names in folders; names that clash."""
    raster.register(spark)
    columns = {"bands": F.expr("array(array(1D, 2D))"), "h": F.lit(1), "w": F.lit(2), "x0": F.lit(0.0), "y0": F.lit(1.0), "dx": F.lit(1.0), "dy": F.lit(1.0)}
    write = lambda df, to, mode="append", **o: df.write.format("geotiff").mode(mode).options(**o).option("path", str(tmp_path / to)).save()
    files = lambda to: sorted(str(f.relative_to(tmp_path / to)) for f in (tmp_path / to).rglob("*") if f.is_file())
    df = spark.range(8).repartition(4).withColumns(columns).drop("id")
    write(df, "none")
    assert len(files("none")) == 8
    write(df, "none")
    assert len(files("none")) == 16
    named = spark.createDataFrame([("/in/2019/x.tif",), ("/in/2020/x.tif",)], "source string").repartition(2).withColumns(columns)
    write(named, "root", root="/in")
    assert files("root") == ["2019/x.tif", "2020/x.tif"]
    with pytest.raises(Exception, match="two rasters are named x"):
        write(named, "clash")
    with pytest.raises(Exception, match="there already"):
        write(named, "root", root="/in")
    assert files("root") == ["2019/x.tif", "2020/x.tif"]
    with pytest.raises(Exception, match="out of the folder"):
        write(named.withColumn("source", F.lit("../y")), "out")


def test_a_virtual_raster_has_no_seams(spark, tmp_path):
    """Points at, near and across the border of two files equal the cubic over the whole image."""
    pixels = image(32, 64, 1, "f4", 7)
    for name, left in (("west.tif", 0), ("east.tif", 32)):
        (tmp_path / name).write_bytes(whole(made(pixels[:, left : left + 32], 5, 3, (16, 16), place=(1000.0 + 2 * left, 500.0, 2.0, 2.0))))
    pts = [(1, 1064.0, 470.0), (2, 1063.3, 468.9), (3, 1066.1, 471.7), (4, 1001.0, 499.0), (5, 1031.9, 450.2), (6, 5000.0, 470.0)]
    got = {r["id"]: r["value"] for r in raster.resample_files(spark.createDataFrame(pts, "id long, x double, y double"), spark, str(tmp_path), "id", (2.0, 2.0), (1000.0, 500.0), cell=64).collect()}

    def weight(t):
        t = abs(t)
        return 1.5 * t**3 - 2.5 * t * t + 1 if t <= 1 else -0.5 * t**3 + 2.5 * t * t - 4 * t + 2 if t < 2 else 0.0

    for k, x, y in pts[:5]:
        u, v = (x - 1000) / 2 - 0.5, (500 - y) / 2 - 0.5
        near = [(weight(u - c) * weight(v - r), float(pixels[r, c, 0])) for c in range(64) for r in range(32)]
        assert got[k] == pytest.approx(sum(w * z for w, z in near) / sum(w for w, _ in near), rel=1e-9), k
    assert got[6] is None
    raster.register(spark)
    index = {r["source"].split("/")[-1]: (r["minx"], r["miny"], r["maxx"], r["maxy"]) for r in operators.catalogue(spark.read.format("geotiff").load(str(tmp_path))).collect()}
    assert index == {"west.tif": (1000.0, 436.0, 1064.0, 500.0), "east.tif": (1064.0, 436.0, 1128.0, 500.0)}
    assert operators.mosaic(spark.read.format("geotiff").load(str(tmp_path))).count() == 8  # different places, though rows and columns are the same
