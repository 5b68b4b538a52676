"""Vector files as Spark data sources: GeoJSON, GeoPackage, Shapefile.

Rows carry the file's attributes as strings in a map, the geometry as well-known binary and its bounds as
columns, so that grid joins need no decoding. Parquet with the same columns is the working format; these
are for coming and going. GeoJSON and Shapefiles are read whole by one task each and opened through
pyarrow's file systems; GeoPackage is in `tesserae.sources.geopackage`.
"""

from __future__ import annotations

import json
import os
import struct
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from tesserae.functions import wkb

SCHEMA = "geometry binary, minx double, miny double, maxx double, maxy double, properties map<string,string>, file string"


def _fs(path: str):
    from pyarrow.fs import FileSystem, LocalFileSystem

    return FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (LocalFileSystem(), path)


def _read(path: str) -> bytes:
    fs, p = _fs(path)
    with fs.open_input_stream(p) as f:
        return f.read()


def _row(geometry: bytes | None, properties: dict, file: str):
    text = {k: v if isinstance(v, str) else json.dumps(v) for k, v in properties.items() if v is not None}
    return (geometry, *((geometry and wkb.bounds(geometry)) or (None,) * 4), text, file)


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict, suffix: str):
        self.options_, self.suffix = options, suffix

    def partitions(self):
        from pyarrow.fs import FileSelector, FileType

        path = self.options_["path"]
        fs, p = _fs(path)
        if fs.get_file_info(p).type == FileType.File:
            return [_File(path)]
        found = [f.path for f in fs.get_file_info(FileSelector(p, recursive=True)) if f.type == FileType.File and f.path.lower().endswith(self.suffix) and "/_drafts-" not in f.path]
        if not found:
            raise FileNotFoundError(f"no {self.suffix} file below {path}")
        scheme = path.split("://")[0] + "://" if "://" in path else ""
        return [_File(scheme + f) for f in sorted(found)]


class GeoJsonReader(_Reader):
    def read(self, partition):
        for f in json.loads(_read(partition.path)).get("features", []):
            yield _row(wkb.dumps(f["geometry"]) if f.get("geometry") else None, f.get("properties") or {}, partition.path)


class ShapefileReader(_Reader):
    def read(self, partition):
        shapes = list(read_shp(_read(partition.path)))
        records = read_dbf(_read(partition.path[:-4] + ".dbf"))
        for shape, record in zip(shapes, records):
            yield _row(wkb.dumps(shape) if shape else None, record, partition.path)


def read_shp(data: bytes):
    """GeoJSON geometries of points and polygons (rings by orientation), None for null shapes."""
    at = 100
    while at < len(data):
        size = struct.unpack_from(">i", data, at + 4)[0] * 2
        body = data[at + 8 : at + 8 + size]
        kind = struct.unpack_from("<i", body)[0] % 10
        if kind == 0:
            yield None
        elif kind == 1:
            yield {"type": "Point", "coordinates": list(struct.unpack_from("<2d", body, 4))}
        elif kind == 5:
            parts, n = struct.unpack_from("<2i", body, 36)
            starts = [*struct.unpack_from(f"<{parts}i", body, 44), n]
            xy = struct.unpack_from(f"<{2 * n}d", body, 44 + 4 * parts)
            rings = [[[xy[2 * k], xy[2 * k + 1]] for k in range(a, b)] for a, b in zip(starts, starts[1:])]
            polygons: list = []
            for ring in rings:
                turn = sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:]))
                if turn <= 0 or not polygons:
                    polygons.append([ring])
                else:
                    polygons[-1].append(ring)
            yield {"type": "Polygon", "coordinates": polygons[0]} if len(polygons) == 1 else {"type": "MultiPolygon", "coordinates": polygons}
        else:
            raise ValueError(f"shape type {kind} is not read")
        at += 8 + size


def read_dbf(data: bytes):
    n, head, size = struct.unpack_from("<IHH", data, 4)
    fields, at = [], 32
    while data[at] != 13:
        fields.append((data[at : at + 11].split(b"\0")[0].decode(), data[at + 16]))
        at += 32
    for k in range(n):
        at, row = head + k * size + 1, {}
        for name, width in fields:
            row[name] = data[at : at + width].decode("utf-8", "replace").strip() or None
            at += width
        yield row


class _Written(WriterCommitMessage):
    def __init__(self, draft: str):
        self.draft = draft


class _Writer(DataSourceWriter):
    """Tasks write drafts below the path under names of their own; the driver moves those of the tasks that
    counted into place once all have ended. `append` leaves what is there, `overwrite` removes it first."""

    def __init__(self, options: dict, overwrite: bool, suffix: str):
        self.path, self.overwrite, self.suffix, self.job = options["path"], overwrite, suffix, uuid.uuid4().hex[:12]

    def _drafts(self) -> str:
        return f"{_fs(self.path)[1]}/_drafts-{self.job}"

    def write(self, rows):
        fs, _ = _fs(self.path)
        fs.create_dir(self._drafts(), recursive=True)
        draft = f"{self._drafts()}/{uuid.uuid4().hex}{self.suffix}"
        self.fill(fs, draft, rows)
        return _Written(draft)

    def commit(self, messages):
        from pyarrow.fs import FileSelector, FileType

        fs, p = _fs(self.path)
        fs.create_dir(p, recursive=True)
        if self.overwrite:
            for f in fs.get_file_info(FileSelector(p)):
                if f.type == FileType.File:
                    fs.delete_file(f.path)
        for k, m in enumerate(m for m in messages if m):
            fs.move(m.draft, f"{p}/part-{self.job}-{k:05d}{self.suffix}")
        fs.delete_dir(self._drafts()) if fs.get_file_info(self._drafts()).type == FileType.Directory else None

    def abort(self, messages):
        from pyarrow.fs import FileType

        fs, _ = _fs(self.path)
        if fs.get_file_info(self._drafts()).type == FileType.Directory:
            fs.delete_dir(self._drafts())


class GeoJsonWriter(_Writer):
    """One FeatureCollection per task, written feature by feature."""

    def fill(self, fs, draft, rows):
        with fs.open_output_stream(draft) as out:
            out.write(b'{"type": "FeatureCollection", "features": [')
            for k, r in enumerate(rows):
                feature = {"type": "Feature", "geometry": wkb.loads(bytes(r["geometry"])) if r["geometry"] else None, "properties": dict(r["properties"] or {})}
                out.write((", " if k else "").encode() + json.dumps(feature).encode())
            out.write(b"]}")


def _source(label: str, suffix: str, reader_class, writer_class=None):
    class Source(DataSource):
        @classmethod
        def name(cls):
            return label

        def schema(self):
            return SCHEMA

        def reader(self, schema):
            return reader_class(dict(self.options), suffix)

        def writer(self, schema, overwrite):
            if writer_class is None:
                raise ValueError(f"{label} is read only")
            return writer_class(dict(self.options), overwrite, suffix[0] if isinstance(suffix, tuple) else suffix)

    return Source


SOURCES = [_source("geojson", (".geojson", ".json"), GeoJsonReader, GeoJsonWriter), _source("shapefile", ".shp", ShapefileReader)]


def register(spark: SparkSession) -> None:
    """spark.read.format("geojson" | "gpkg" | "shapefile") from now on. Filters reach the readers that take them."""
    from tesserae.sources.geopackage import GeoPackage

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in [*SOURCES, GeoPackage]:
        spark.dataSource.register(source)


def write_once(df: DataFrame, kind: str, path: str, **options: str) -> bool:
    """Writes df with the data source `kind` unless the path holds files already: what is there is used again."""
    from pyarrow.fs import FileSelector, FileType

    fs, p = _fs(path)
    if fs.get_file_info(p).type != FileType.NotFound and any(f.type == FileType.File for f in fs.get_file_info(FileSelector(p))):
        return False
    df.write.format(kind).mode("append").options(**options).option("path", path).save()
    return True


def with_provenance(spark: SparkSession, pattern: str, column: str = "model") -> DataFrame:
    """Parquet files of a recursive pattern, with the name of their folder as a column."""
    from pyspark.sql import functions as F

    df = spark.read.option("recursiveFileLookup", "true").parquet(pattern)
    return df.withColumn(column, F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))


def output_name(stem: str, **numbers: float) -> str:
    """File names with thresholds in them: 0.25 becomes 0dot25."""
    return stem + "".join(f"_{k}_{str(v).replace('.', 'dot')}" for k, v in numbers.items())


def with_threshold_in_name(df: DataFrame, kind: str) -> DataFrame:
    """Rows of a file scan whose files were written for that kind of score threshold: 'conservative' names hold
    0dot05, 'optimal' ones don't. The condition is on the file alone, so that other files aren't opened."""
    from pyspark.sql import functions as F

    if kind not in ("conservative", "optimal"):
        raise ValueError(f"unknown score type {kind!r}")
    low = F.col("_metadata.file_name").contains("0dot05")
    return df.where(low if kind == "conservative" else ~low)


def rows_per_file(df: DataFrame, in_parts: bool = False) -> DataFrame:
    """files, rows and the average number of rows of a file scan. Files without rows aren't seen. With `in_parts` a file is
    a folder, in which tasks have written a part each."""
    from pyspark.sql import functions as F

    path = F.col("_metadata.file_path")
    each = df.groupBy((F.regexp_replace(path, "/[^/]*$", "") if in_parts else path).alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return each.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.avg("n").alias("average"))


def year_in_name(name):
    """The first number of four digits between 1900 and 2099 in a file's name, as a column; null without one."""
    from pyspark.sql import functions as F

    found = F.regexp_extract(F.element_at(F.split(name, "/"), -1), r"(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)", 1)
    return F.when(found != "", found.cast("int"))


def names_from(spark: SparkSession, path: str, sheet: str | None = None) -> list[tuple[str, str]]:
    """(argument, name) rows of a mapping table: CSV with a header, or one sheet of a workbook (.xlsx)."""
    if not path.endswith(".xlsx"):
        rows = spark.read.option("header", "true").csv(path).select("argument", "name").where("argument IS NOT NULL")
        return [(r["argument"], r["name"]) for r in rows.collect()]  # a row for each attribute
    import io
    import zipfile
    from xml.etree import ElementTree as X

    with zipfile.ZipFile(io.BytesIO(_read(path))) as book:
        parse = lambda name: X.fromstring(book.read(name)) if name in book.namelist() else None
        text = lambda node: "".join(t.text or "" for t in node.iter() if t.tag.endswith("}t"))
        shared = parse("xl/sharedStrings.xml")
        strings = [text(n) for n in shared] if shared is not None else []
        sheets = [n.get("name") for n in parse("xl/workbook.xml").iter() if n.tag.endswith("}sheet")]
        place = sheets.index(sheet) + 1 if sheet else 1
        lines = []
        for row in (n for n in parse(f"xl/worksheets/sheet{place}.xml").iter() if n.tag.endswith("}row")):
            cells = {}
            for c in row:
                value = next((n.text for n in c if n.tag.endswith("}v")), None)
                cells["".join(ch for ch in c.get("r") if ch.isalpha())] = strings[int(value)] if c.get("t") == "s" else text(c) if c.get("t") == "inlineStr" else value
            lines.append(cells)
    head = {v: k for k, v in lines[0].items()}
    return [(r[head["argument"]], r.get(head["name"])) for r in lines[1:] if r.get(head["argument"])]


def year_folders(root: str, years: list[int], exists=os.path.isdir) -> list[str]:
    """Paths of the years that are there."""
    return [p for y in years if exists(p := f"{root}/year={y}")]
