"""GeoPackage files: read by ranges of features and by box, written with several layers.

A local file is opened in place, and a large one is read by several tasks, each a range of features; a file elsewhere
is copied by the task that reads it. Options of the reader: `layer` (one or several, by comma), `columns` (attributes, by
comma; the others aren't read) and `bbox` (minx,miny,maxx,maxy: shapes whose bounds meet it); filters on
the bounds are taken too. Where a layer has an R-tree, the box goes through it.

Options of the writer: `layer` (features), `layer_by` (a property whose values name the layers), `srid`, and `single`, the
name of one file that the tasks' drafts are joined into when all have ended; otherwise each task's draft becomes a
file. Every layer gets an R-tree. One file is written by one process, so `single` is for results of a
size that one file should have.
"""

from __future__ import annotations

import contextlib
import shutil
import sqlite3
import struct
import tempfile

from pyspark.sql.datasource import DataSource, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from tesserae.functions import wkb
from tesserae.sources.vector import SCHEMA, _fs, _Reader, _row, _Writer

#: Bytes of a file that one task reads.
SPLIT = 64 << 20


def quoted(name: str) -> str:
    return '"{}"'.format(name.replace('"', '""'))


def from_gpkg(blob: bytes) -> bytes | None:
    """The binary geometry after a GeoPackage header; None if it is empty."""
    flags = blob[3]
    envelope = (0, 32, 48, 48, 64)[flags >> 1 & 7]
    return None if flags & 16 else bytes(blob[8 + envelope :])


def to_gpkg(geometry: bytes, srid: int) -> bytes:
    return b"GP\0\1" + struct.pack("<i", srid) + geometry


class _Part(InputPartition):
    def __init__(self, path: str, k: int = 0, n: int = 1):
        self.path, self.k, self.n = path, k, n


@contextlib.contextmanager
def _opened(path: str):
    """A connection that reads the file, in place if it is local."""
    from pyarrow.fs import LocalFileSystem

    fs, p = _fs(path)
    with contextlib.ExitStack() as stack:
        if not isinstance(fs, LocalFileSystem):
            copy = stack.enter_context(tempfile.NamedTemporaryFile(suffix=".gpkg"))
            with fs.open_input_stream(p) as f:
                shutil.copyfileobj(f, copy)
            copy.flush()
            p = copy.name
        yield stack.enter_context(contextlib.closing(sqlite3.connect(f"file:{p}?mode=ro", uri=True)))


class GeoPackageReader(_Reader):
    def __init__(self, options: dict, suffix: str):
        super().__init__(options, suffix)
        names = lambda o: set(options[o].split(",")) if options.get(o) else None
        self.layers, self.columns = names("layer"), names("columns")
        box = options.get("bbox")
        self.tests = [(c, s, float(v)) for (c, s), v in zip((("maxx", ">="), ("maxy", ">="), ("minx", "<="), ("miny", "<=")), box.split(","))] if box else []

    def pushFilters(self, filters):
        """Takes note of filters on the bounds; Spark applies them again."""
        signs = {GreaterThan: ">=", GreaterThanOrEqual: ">=", LessThan: "<=", LessThanOrEqual: "<="}
        for f in filters:
            if type(f) in signs and f.attribute[0] in ("minx", "miny", "maxx", "maxy"):
                self.tests.append((f.attribute[0], signs[type(f)], float(f.value)))
            yield f

    def partitions(self):
        from pyarrow.fs import LocalFileSystem

        out = []
        for f in super().partitions():
            fs, p = _fs(f.path)
            n = -(-fs.get_file_info(p).size // SPLIT) if isinstance(fs, LocalFileSystem) else 1
            out += [_Part(f.path, k, max(n, 1)) for k in range(max(n, 1))]
        return out

    def read(self, partition):
        with _opened(partition.path) as db:
            trees = {r[0] for r in db.execute("SELECT name FROM sqlite_master WHERE type = 'table'")}
            for table, column in db.execute("SELECT table_name, column_name FROM gpkg_geometry_columns").fetchall():
                if self.layers and table not in self.layers:
                    continue
                low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {quoted(table)}").fetchone()
                if low is None:
                    continue
                a, b = (low + (high + 1 - low) * k // partition.n for k in (partition.k, partition.k + 1))
                kept = [r[1] for r in db.execute(f"PRAGMA table_info({quoted(table)})") if r[1] != column and (self.columns is None or r[1] in self.columns)]
                where, values = "rowid >= ? AND rowid < ?", [a, b]
                if self.tests and f"rtree_{table}_{column}" in trees:
                    where += f" AND rowid IN (SELECT id FROM {quoted(f'rtree_{table}_{column}')} WHERE " + " AND ".join(f"{c} {s} ?" for c, s, _ in self.tests) + ")"
                    values += [v for *_, v in self.tests]
                for blob, *attributes in db.execute(f"SELECT {', '.join(quoted(c) for c in [column, *kept])} FROM {quoted(table)} WHERE {where}", values):
                    row = _row(from_gpkg(blob) if blob else None, {k: v for k, v in zip(kept, attributes) if not isinstance(v, bytes)} | {"layer": table}, partition.path)
                    at = dict(zip(("minx", "miny", "maxx", "maxy"), row[1:5]))
                    if all(at[c] is not None and (at[c] >= v if s == ">=" else at[c] <= v) for c, s, v in self.tests):
                        yield row


class _Package:
    """A GeoPackage that is being written, in a local file."""

    def __init__(self, path: str, srid: int):
        self.db, self.srid, self.known = sqlite3.connect(path), srid, {}
        self.db.execute("PRAGMA application_id = 1196444487")
        for table in (
            "gpkg_spatial_ref_sys (srs_name TEXT, srs_id INTEGER PRIMARY KEY, organization TEXT, organization_coordsys_id INTEGER, definition TEXT)",
            "gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT, identifier TEXT, srs_id INTEGER)",
            "gpkg_geometry_columns (table_name TEXT PRIMARY KEY, column_name TEXT, geometry_type_name TEXT, srs_id INTEGER, z TINYINT, m TINYINT)",
            "gpkg_extensions (table_name TEXT, column_name TEXT, extension_name TEXT, definition TEXT, scope TEXT)",
        ):
            self.db.execute(f"CREATE TABLE IF NOT EXISTS {table}")
        self.db.execute("INSERT OR IGNORE INTO gpkg_spatial_ref_sys VALUES (?, ?, 'EPSG', ?, 'undefined')", (f"EPSG:{srid}", srid, srid))
        for (layer,) in self.db.execute("SELECT table_name FROM gpkg_geometry_columns").fetchall():
            self.known[layer] = {r[1] for r in self.db.execute(f"PRAGMA table_info({quoted(layer)})")}

    def table(self, layer: str, columns) -> None:
        """The layer's table with at least these columns."""
        if layer not in self.known:
            self.db.execute("INSERT INTO gpkg_contents VALUES (?, 'features', ?, ?)", (layer, layer, self.srid))
            self.db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'GEOMETRY', ?, 0, 0)", (layer, self.srid))
            self.db.execute("INSERT INTO gpkg_extensions VALUES (?, 'geom', 'gpkg_rtree_index', 'http://www.geopackage.org/spec120/#extension_rtree', 'write-only')", (layer,))
            self.db.execute(f"CREATE TABLE {quoted(layer)} (fid INTEGER PRIMARY KEY, geom BLOB)")
            self.db.execute(f"CREATE VIRTUAL TABLE {quoted(f'rtree_{layer}_geom')} USING rtree(id, minx, maxx, miny, maxy)")
            self.known[layer] = {"fid", "geom"}
        for c in columns:
            if c not in self.known[layer]:
                self.db.execute(f"ALTER TABLE {quoted(layer)} ADD COLUMN {quoted(c)} TEXT")
                self.known[layer].add(c)

    def add(self, layer: str, geometry: bytes | None, properties: dict) -> None:
        self.table(layer, properties)
        names, marks = "".join(", " + quoted(k) for k in properties), ", ".join("?" * (1 + len(properties)))
        made = self.db.execute(f"INSERT INTO {quoted(layer)} (geom{names}) VALUES ({marks})", (to_gpkg(geometry, self.srid) if geometry else None, *properties.values()))
        if geometry and (box := wkb.bounds(geometry)):
            self.db.execute(f"INSERT INTO {quoted(f'rtree_{layer}_geom')} VALUES (?, ?, ?, ?, ?)", (made.lastrowid, box[0], box[2], box[1], box[3]))

    def join(self, path: str) -> None:
        """All layers of another package of this writer: features are numbered on."""
        self.db.commit()
        self.db.execute("ATTACH ? AS other", (path,))
        for (layer,) in self.db.execute("SELECT table_name FROM other.gpkg_geometry_columns").fetchall():
            columns = [r[1] for r in self.db.execute(f"PRAGMA other.table_info({quoted(layer)})") if r[1] != "fid"]
            self.table(layer, columns)
            last = self.db.execute(f"SELECT coalesce(max(fid), 0) FROM main.{quoted(layer)}").fetchone()[0]
            names = ", ".join(quoted(c) for c in columns)
            self.db.execute(f"INSERT INTO main.{quoted(layer)} (fid, {names}) SELECT fid + ?, {names} FROM other.{quoted(layer)}", (last,))
            tree = quoted(f"rtree_{layer}_geom")
            self.db.execute(f"INSERT INTO main.{tree} SELECT id + ?, minx, maxx, miny, maxy FROM other.{tree}", (last,))
        self.db.commit()
        self.db.execute("DETACH other")

    def close(self) -> None:
        self.db.commit()
        self.db.close()


class GeoPackageWriter(_Writer):
    def __init__(self, options: dict, overwrite: bool, suffix: str):
        super().__init__(options, overwrite, suffix)
        self.layer, self.layer_by, self.srid = options.get("layer", "features"), options.get("layer_by"), int(options.get("srid", "2056"))
        self.single = options.get("single")

    def fill(self, fs, draft, rows):
        with tempfile.TemporaryDirectory() as folder:
            package = _Package(f"{folder}/x.gpkg", self.srid)
            if not self.layer_by:
                package.table(self.layer, ())
            for r in rows:
                properties = dict(r["properties"] or {})
                layer = properties.get(self.layer_by) or self.layer if self.layer_by else self.layer
                package.add(layer, bytes(r["geometry"]) if r["geometry"] else None, {k: v for k, v in properties.items() if k not in ("fid", "geom", "layer", self.layer_by)})
            package.close()
            with fs.open_output_stream(draft) as out, open(f"{folder}/x.gpkg", "rb") as f:
                shutil.copyfileobj(f, out)

    def commit(self, messages):
        if not self.single:
            return super().commit(messages)
        from pyarrow.fs import FileType

        fs, p = _fs(self.path)
        fs.create_dir(p, recursive=True)
        target = f"{p}/{self.single}"
        with tempfile.TemporaryDirectory() as folder:
            whole, part = f"{folder}/whole.gpkg", f"{folder}/part.gpkg"

            def fetch(source, to):
                with fs.open_input_stream(source) as f, open(to, "wb") as out:
                    shutil.copyfileobj(f, out)

            if not self.overwrite and fs.get_file_info(target).type == FileType.File:
                fetch(target, whole)
            package = _Package(whole, self.srid)
            for m in (m for m in messages if m):
                fetch(m.draft, part)
                package.join(part)
            package.close()
            fs.create_dir(self._drafts(), recursive=True)
            with fs.open_output_stream(f"{self._drafts()}/whole") as out, open(whole, "rb") as f:
                shutil.copyfileobj(f, out)
        fs.move(f"{self._drafts()}/whole", target)
        fs.delete_dir(self._drafts())


class GeoPackage(DataSource):
    @classmethod
    def name(cls):
        return "gpkg"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return GeoPackageReader(dict(self.options), ".gpkg")

    def writer(self, schema, overwrite):
        return GeoPackageWriter(dict(self.options), overwrite, ".gpkg")
