"""GeoTIFF files as tables of chunks, and back.

A chunk is a strip or tile of one band: source, band (from 1), row0, col0, h, w, the place of its upper left
corner (x0, y0), the pixel's size (dx, dy) and values in row order. `tesserae.sources.tiff` has what is read of the
format. A file without georeference lies at (0, 0) with pixels of size 1, rows running downwards.

Three ways in. The data source "geotiff" reads chunks by ranges: large files are split, small ones share a
task, and chunks outside `bands` or `bbox` (options, or filters on band, x0, y0, x1, y1) aren't touched.
`sample_files` reads only the chunks that hold points. `read` takes files whole through Spark's binary source, for
stores that only Spark reaches, up to 2 GB each.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from tesserae.operators.raster import cubic_weight
from tesserae.sources import tiff
from tesserae.sources.tiff import TAGS, TYPES
from tesserae.sources.vector import _fs, _Writer

SCHEMA = "source string, band int, row0 int, col0 int, h int, w int, x0 double, y0 double, dx double, dy double, values array<double>"
#: What ranges give besides: the lower right corner, and the bytes that the chunk takes in its file.
RANGE_SCHEMA = SCHEMA + ", x1 double, y1 double, stored long"
SUFFIXES = (".tif", ".tiff")
#: Stored bytes of a task, and files of one at most.
SPLIT, FILES = 32 << 20, 1000


def listing(spark: SparkSession, path: str) -> DataFrame:
    """path, length and modificationTime of the rasters below a path; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{tif,tiff,TIF,TIFF}").load(path)
    return files.select("path", "length", "modificationTime")


def chunks_of(data: bytes):
    """band, row0, col0, (h, w) values, and the georeference (x0, y0, dx, dy) of each chunk of a file."""
    head = tiff.header(lambda at, n: data[at : at + n])
    for k, (at, n) in enumerate(zip(head.offsets, head.counts)):
        plane, row0, col0, _, _ = head.at(k)
        values = tiff.block(head, k, data[at : at + n])
        for s in range(values.shape[2]):
            yield (plane if head.planar == 2 else s) + 1, row0, col0, values[:, :, s], (*head.corner(row0, col0), *head.place[2:])


def read(spark: SparkSession, path: str, bands: list[int] | None = None) -> DataFrame:
    """The chunks of all rasters below a path, of the given bands or all. Files are taken whole."""
    wanted = None if bands is None else set(bands)

    def run(batches):
        for b in batches:
            for source, data in zip(b.column("path").to_pylist(), b.column("content")):
                for band, row0, col0, block, place in chunks_of(data.as_py()):
                    if wanted is None or band in wanted:
                        one = lambda v, t: pa.array([v], t)
                        yield pa.record_batch(
                            [one(source, pa.string()), *(one(v, pa.int32()) for v in (band, row0, col0, *block.shape)), *(one(float(v), pa.float64()) for v in place), one(block.ravel().astype(float), pa.list_(pa.float64()))],
                            ["source", "band", "row0", "col0", "h", "w", "x0", "y0", "dx", "dy", "values"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{tif,tiff,TIF,TIFF}").load(path)
    return files.select("path", "content").mapInArrow(run, SCHEMA)


def _files(path: str) -> list[tuple[str, int]]:
    """Rasters below a path and their lengths."""
    from pyarrow.fs import FileSelector, FileType

    fs, p = _fs(path)
    info = fs.get_file_info(p)
    found = [info] if info.type == FileType.File else [f for f in fs.get_file_info(FileSelector(p, recursive=True)) if f.type == FileType.File and f.path.lower().endswith(SUFFIXES) and "/_drafts-" not in f.path]
    if not found:
        raise FileNotFoundError(f"no raster below {path}")
    scheme = path.split("://")[0] + "://" if "://" in path else ""
    return sorted((scheme + f.path, f.size) for f in found)


class _Open:
    """A file that is read by ranges, with its header."""

    def __init__(self, path: str):
        fs, p = _fs(path)
        self.file = fs.open_input_file(p)
        self.head = tiff.header(self.range)

    def range(self, at: int, n: int) -> bytes:
        return self.file.read_at(n, at)

    def block(self, k: int) -> np.ndarray:
        return tiff.block(self.head, k, self.range(self.head.offsets[k], self.head.counts[k]))


class _Part(InputPartition):
    """Whole files, or the k-th of n equal parts of one file's chunks."""

    def __init__(self, files: list[str], k: int = 0, n: int = 1):
        self.files, self.k, self.n = files, k, n


class RangeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.bands = {int(b) for b in options["bands"].split(",")} if options.get("bands") else None
        box = [float(v) for v in options["bbox"].split(",")] if options.get("bbox") else [-np.inf, -np.inf, np.inf, np.inf]
        self.tests = [("x1", ">=", box[0]), ("y0", ">=", box[1]), ("x0", "<=", box[2]), ("y1", "<=", box[3])]

    def pushFilters(self, filters):
        """Takes note of filters on band and corners; Spark applies them again."""
        signs = {GreaterThan: ">=", GreaterThanOrEqual: ">=", LessThan: "<=", LessThanOrEqual: "<="}
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("band",):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.bands = values if self.bands is None else self.bands & values
            elif type(f) in signs and f.attribute in (("x0",), ("y0",), ("x1",), ("y1",)):
                self.tests.append((f.attribute[0], signs[type(f)], float(f.value)))
            yield f

    def partitions(self):
        parts, held, size = [], [], 0
        for path, length in _files(self.path):
            if length > SPLIT:
                n = -(-length // SPLIT)
                parts += [_Part([path], k, n) for k in range(n)]
                continue
            if held and (size + length > SPLIT or len(held) == FILES):
                parts.append(_Part(held))
                held, size = [], 0
            held, size = [*held, path], size + length
        return [*parts, _Part(held)] if held else parts

    def read(self, partition):
        for path in partition.files:
            f = _Open(path)
            head, n = f.head, len(f.head.offsets)
            for k in range(n * partition.k // partition.n, n * (partition.k + 1) // partition.n):
                plane, row0, col0, h, w = head.at(k)
                (x0, y0), (dx, dy) = head.corner(row0, col0), head.place[2:]
                at = {"x0": x0, "y0": y0, "x1": x0 + w * dx, "y1": y0 - h * dy}
                inside = [s for s in range(head.samples if head.planar == 1 else 1) if self.bands is None or (plane if head.planar == 2 else s) + 1 in self.bands]
                if not inside or not all(at[c] >= v if sign == ">=" else at[c] <= v for c, sign, v in self.tests):
                    continue
                block = f.block(k)
                for s in inside:
                    yield (path, (plane if head.planar == 2 else s) + 1, row0, col0, h, w, x0, y0, dx, dy, block[:, :, s].ravel().astype(float).tolist(), at["x1"], at["y1"], head.counts[k])


def headers(spark: SparkSession, path: str) -> DataFrame:
    """source, bands, and the extent of each raster below a path (minx, miny, maxx, maxy), with the size of its pixels and
    chunks; pixels aren't read."""
    names = [f for f, _ in _files(path)]
    found = spark.createDataFrame(pa.table({"source": names})).repartition(-(-len(names) // 50))

    def run(batches):
        for b in batches:
            rows = []
            for source in b.column("source").to_pylist():
                h = _Open(source).head
                left, top, dx, dy = h.place
                rows.append((source, h.samples, left, top - h.height * dy, left + h.width * dx, top, dx, dy, h.w, h.h))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), [pa.string(), pa.int32(), *[pa.float64()] * 6, pa.int32(), pa.int32()])], ["source", "bands", "minx", "miny", "maxx", "maxy", "dx", "dy", "chunk_w", "chunk_h"])

    return found.mapInArrow(run, "source string, bands int, minx double, miny double, maxx double, maxy double, dx double, dy double, chunk_w int, chunk_h int")


def sample_files(points: DataFrame, spark: SparkSession, path: str, id_col: str, band: int = 1, value: str = "value", cell: float = 1024) -> DataFrame:
    """id, value, read: the pixel under each point (x, y) of the rasters below a path; where rasters overlap, the one
    whose name comes first; null outside them all. Points are matched with the files' extents, then
    range-partitioned by file and pixel, so a task reads the chunks that its points lie in, once each; `read` has the bytes that it took
    for a row. Identifiers are unique."""
    from tesserae.operators import spatial
    from tesserae.storage import store

    known, _ = store(headers(spark, path).where(F.col("bands") >= band), "headers")
    dots = points.select(id_col, *(F.col(a).cast("double").alias(b) for a, b in (("x", "minx"), ("y", "miny"), ("x", "maxx"), ("y", "maxy"))))
    met = spatial.area_pairs(dots, known, cell)
    x, y = F.col("l.minx"), F.col("l.miny")
    col, row = F.floor((x - F.col("r.minx")) / F.col("r.dx")), F.floor((F.col("r.maxy") - y) / F.col("r.dy"))
    inside = met.where((x < F.col("r.maxx")) & (y > F.col("r.miny")))
    first = inside.select(F.col(f"l.{id_col}").alias(id_col), F.struct("r.source", row.cast("long").alias("row"), col.cast("long").alias("col"), "r.chunk_w", "r.chunk_h").alias("at")).groupBy(id_col).agg(F.min("at").alias("at"))
    placed = first.select(id_col, "at.source", F.floor(F.col("at.row") / F.col("at.chunk_h")).alias("down"), F.floor(F.col("at.col") / F.col("at.chunk_w")).alias("across"), "at.row", "at.col")
    order = ["source", "down", "across", "row", "col"]

    def run(batches):
        path_, f, k, block = None, None, None, None
        for b in batches:
            n, names = len(b), b.column("source").dictionary_encode()
            down, across, row, col = (b.column(c).to_numpy(zero_copy_only=False) for c in order[1:])
            of, values, cost = names.indices.to_numpy(zero_copy_only=False), np.empty(n), np.zeros(n, np.int64)
            new = np.flatnonzero((of[1:] != of[:-1]) | (down[1:] != down[:-1]) | (across[1:] != across[:-1])) + 1
            for start, end in zip([0, *new], [*new, n]) if n else ():  # the points of one chunk
                source = names.dictionary[int(of[start])].as_py()
                if source != path_:
                    path_, f, k = source, _Open(source), None
                at = int(down[start]) * f.head.across + int(across[start]) + (band - 1) * f.head.across * f.head.down * (f.head.planar == 2)
                if at != k:
                    k, block, cost[start] = at, f.block(at), f.head.counts[at]
                values[start:end] = block[row[start:end] % f.head.h, col[start:end] % f.head.w, band - 1 if f.head.planar == 1 else 0]
            yield pa.record_batch([b.column(id_col), pa.array(values), pa.array(cost)], [id_col, value, "read"])

    kind = dict(points.dtypes)[id_col]
    got = placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, f"`{id_col}` {kind}, `{value}` double, read long")
    return points.select(id_col).join(got, id_col, "left").withColumn("read", F.coalesce("read", F.lit(0)))


def resample_files(points: DataFrame, spark: SparkSession, path: str, id_col: str, size: tuple[float, float], origin: tuple[float, float] = (0.0, 0.0), band: int = 1, value: str = "value", cell: float = 1024) -> DataFrame:
    """id, value: the rasters below a path as one virtual raster, at each point (x, y) by cubic convolution over the 4 x 4
    pixels around it, whichever files they lie in. All rasters share one grid of pixels of `size` through
    `origin`. Weights are divided by their sum where the virtual raster's edge leaves some out; null where it leaves
    out all."""
    (dx, dy), (left, top) = size, origin
    u, v = (F.col("x") - left) / dx - 0.5, (top - F.col("y")) / dy - 0.5
    at = points.select(id_col, u.alias("__u"), v.alias("__v"))
    around = at.select("*", F.explode(F.sequence(F.floor("__u") - 1, F.floor("__u") + 2)).alias("__c")).select("*", F.explode(F.sequence(F.floor("__v") - 1, F.floor("__v") + 2)).alias("__r"))
    weighed = around.withColumn("__w", cubic_weight(F.col("__u") - F.col("__c")) * cubic_weight(F.col("__v") - F.col("__r"))).where("__w <> 0")
    # pixels are asked for once, however many points need them
    wanted = weighed.select("__c", "__r").distinct().select(F.struct("__c", "__r").alias("__p"), (left + (F.col("__c") + 0.5) * dx).alias("x"), (top - (F.col("__r") + 0.5) * dy).alias("y"))
    got = sample_files(wanted, spark, path, "__p", band, "__z", cell).where("__z IS NOT NULL").select("__p.*", "__z")
    sums = weighed.join(got, ["__c", "__r"]).groupBy(id_col).agg((F.sum(F.col("__w") * F.col("__z")) / F.sum("__w")).alias(value))
    return points.select(id_col).join(sums, id_col, "left")


def pixels(chunks: DataFrame) -> DataFrame:
    """source, band, row, col, x, y (the pixel's centre), value of every pixel."""
    each = chunks.select("source", "band", "row0", "col0", "w", "x0", "y0", "dx", "dy", F.posexplode("values").alias("k", "value"))
    r, c = F.floor(F.col("k") / F.col("w")).cast("int"), (F.col("k") % F.col("w")).cast("int")
    return each.select("source", "band", (F.col("row0") + r).alias("row"), (F.col("col0") + c).alias("col"), (F.col("x0") + (c + 0.5) * F.col("dx")).alias("x"), (F.col("y0") - (r + 0.5) * F.col("dy")).alias("y"), "value")


def encoded(block: np.ndarray, place: tuple[float, float, float, float]) -> bytes:
    """A file of one strip: (h, w, bands) values of an 8 to 64-bit type, at (x0, y0) with pixels of (dx, dy)."""
    h, w, n = block.shape
    body = np.ascontiguousarray(block.astype(block.dtype.newbyteorder("<"))).tobytes()
    kind = {"u": 1, "i": 2, "f": 3}[block.dtype.kind]
    x0, y0, dx, dy = place
    fields = [
        ("width", 4, (w,)), ("height", 4, (h,)), ("bits", 3, (8 * block.dtype.itemsize,) * n), ("compression", 3, (1,)), ("photometric", 3, (2 if n == 3 else 1,)), ("strip_offsets", 4, (8,)), ("samples", 3, (n,)),
        ("rows_per_strip", 4, (h,)), ("strip_counts", 4, (len(body),)), ("planar", 3, (1,)), ("format", 3, (kind,) * n), ("scale", 12, (dx, dy, 0.0)), ("tie", 12, (0.0, 0.0, 0.0, x0, y0, 0.0)),
    ]
    body += b"\0" * (len(body) % 2)
    extra, at, entries = b"", 8 + len(body), []
    for name, kind_, values in fields:
        packed = struct.pack(f"<{len(values)}{TYPES[kind_]}", *values)
        if len(packed) > 4:
            entries.append(struct.pack("<HHII", TAGS[name], kind_, len(values), at + len(extra)))
            extra += packed + b"\0" * (len(packed) % 2)
        else:
            entries.append(struct.pack("<HHI", TAGS[name], kind_, len(values)) + packed.ljust(4, b"\0"))
    return b"II*\0" + struct.pack("<I", at + len(extra)) + body + extra + struct.pack("<H", len(entries)) + b"".join(entries) + b"\0" * 4


class _TiffWriter(_Writer):
    """A file for each row of h, w, x0, y0, dx, dy and bands (an array of bands, each its values in row order). A
    row's `source` is its name: a relative path as it is, an absolute one below option `root`, or else its last part.
    Rows without one are named by job, task and number. Two rows of one name, or a name that is there
    already, are an error, and nothing is put in place then. Option `dtype`: the samples' type, uint8 if it isn't given."""

    def __init__(self, options: dict, overwrite: bool):
        super().__init__(options, overwrite, ".tif")
        self.dtype, self.root = options.get("dtype", "uint8"), options.get("root", "").rstrip("/")

    def _named(self, source: str) -> str:
        if self.root and source.startswith(self.root + "/"):
            source = source[len(self.root) + 1 :]
        elif source.startswith("/") or ":" in source.split("/")[0]:
            source = source.split("/")[-1]
        if ".." in source.split("/"):
            raise ValueError(f"{source} leads out of the folder")
        low = source.lower()
        return source[: -len(next(x for x in SUFFIXES if low.endswith(x)))] if low.endswith(SUFFIXES) else source

    def write(self, rows):
        from pyspark import TaskContext

        from tesserae.sources.vector import _Written

        fs, _ = _fs(self.path)
        task = TaskContext.get()
        folder = f"{self._drafts()}/{task.partitionId()}-{task.taskAttemptId()}"
        fs.create_dir(folder, recursive=True)
        names = set()
        for k, r in enumerate(rows):
            name = self._named(r["source"]) if "source" in r and r["source"] else f"{self.job}-{task.partitionId():05d}-{k:05d}"
            if name in names:
                raise ValueError(f"two rasters are named {name}")
            names.add(name)
            block = np.stack([np.array(b, float).reshape(r["h"], r["w"]) for b in r["bands"]], 2).astype(self.dtype)
            if "/" in name:
                fs.create_dir(f"{folder}/{name.rpartition('/')[0]}", recursive=True)
            with fs.open_output_stream(f"{folder}/{name}.tif") as out:
                out.write(encoded(block, (r["x0"], r["y0"], r["dx"], r["dy"])))
        return _Written(folder)

    def commit(self, messages):
        from pyarrow.fs import FileSelector, FileType

        fs, p = _fs(self.path)
        moves: dict[str, str] = {}
        for m in (m for m in messages if m):
            for f in fs.get_file_info(FileSelector(m.draft, recursive=True)):
                if f.type == FileType.File:
                    name = f.path[len(m.draft) + 1 :]
                    if name in moves:
                        raise ValueError(f"two rasters are named {name}")
                    if not self.overwrite and fs.get_file_info(f"{p}/{name}").type == FileType.File:
                        raise ValueError(f"{name} is there already")
                    moves[name] = f.path
        fs.create_dir(p, recursive=True)
        if self.overwrite:
            for f in fs.get_file_info(FileSelector(p)):
                if f.type == FileType.File:
                    fs.delete_file(f.path)
        for name, draft in moves.items():
            if "/" in name:
                fs.create_dir(f"{p}/{name.rpartition('/')[0]}", recursive=True)
            fs.move(draft, f"{p}/{name}")
        if fs.get_file_info(self._drafts()).type == FileType.Directory:
            fs.delete_dir(self._drafts())


class GeoTiff(DataSource):
    @classmethod
    def name(cls):
        return "geotiff"

    def schema(self):
        return RANGE_SCHEMA

    def reader(self, schema):
        return RangeReader(dict(self.options))

    def writer(self, schema, overwrite):
        return _TiffWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """spark.read.format("geotiff") and df.write.format("geotiff") from now on. Filters reach the reader where the
    session lets Python sources take them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(GeoTiff)


def with_georeference(chunks: DataFrame, reference: DataFrame) -> DataFrame:
    """chunks with the georeference of the reference raster of the same file name, whatever its folder or
    suffix; chunks without one keep theirs."""
    stem = lambda c: F.regexp_replace(F.element_at(F.split(c, "/"), -1), r"\.[^.]*$", "")
    left = F.min(F.col("x0") - F.col("col0") * F.col("dx")).alias("__x")
    places = reference.groupBy(stem(F.col("source")).alias("__stem")).agg(left, F.max(F.col("y0") + F.col("row0") * F.col("dy")).alias("__y"), F.first("dx").alias("__dx"), F.first("dy").alias("__dy"))
    found = chunks.withColumn("__stem", stem(F.col("source"))).join(places, "__stem", "left")
    new = {"x0": F.col("__x") + F.col("col0") * F.col("__dx"), "y0": F.col("__y") - F.col("row0") * F.col("__dy"), "dx": F.col("__dx"), "dy": F.col("__dy")}
    return found.select(*(F.coalesce(new[c], F.col(c)).alias(c) if c in new else c for c in chunks.columns))


def resampled(points: DataFrame, cells: DataFrame, value: str = "value") -> DataFrame:
    """points (x, y in pixels, centres at whole numbers) with the value by cubic convolution over the 4 x 4 pixels
    (row, col, value) around them: 16 equi-joined neighbours a point, weights from a cubic with a = -1/2, which
    are divided by their sum where the raster's edge leaves some out. Points far from any pixel have null."""
    places = points.select("x", "y").distinct()
    around = places.select("x", "y", F.explode(F.sequence(F.floor("x") - 1, F.floor("x") + 2)).alias("col")).select("*", F.explode(F.sequence(F.floor("y") - 1, F.floor("y") + 2)).alias("row"))
    weighed = around.withColumn("__w", cubic_weight(F.col("x") - F.col("col")) * cubic_weight(F.col("y") - F.col("row"))).where("__w <> 0")
    met = weighed.join(cells.select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), value), ["row", "col"])
    sums = met.groupBy("x", "y").agg((F.sum(F.col("__w") * F.col(value)) / F.sum("__w")).alias(value))
    return points.join(sums, ["x", "y"], "left")
