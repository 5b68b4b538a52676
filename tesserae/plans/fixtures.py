"""Deterministic geometry over the driver's tables: integer rectangles, so that SQL can be the judge.

The same text runs in Spark and in DuckDB. In Spark a fixture is built once for each session and folder. It reads the
tables that it needs as views which stay: Spark forgets what is held of a table when a view of it is dropped. A
detection's number comes from its order, so that no task sees all of them.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.functions import rect
from tesserae.storage import store

SQL = {
    "fx_det": """
SELECT CAST(l_orderkey * 1000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
         l_shipdate, l_extendedprice, l_quantity, l_discount, l_tax) - 1 AS BIGINT) AS merged_id,
       CAST(l_partkey AS BIGINT) AS site,
       CAST(extract(year FROM l_shipdate) AS INT) AS year_det,
       CAST(CASE l_suppkey % 5 WHEN 0 THEN 68 WHEN 1 THEN 72 WHEN 2 THEN 75 WHEN 3 THEN 92 ELSE 102 END AS INT) AS model,
       CASE WHEN l_partkey % 10 < 7 THEN 'trn' WHEN l_partkey % 10 = 7 THEN 'val' ELSE 'tst' END AS dataset,
       (CAST(round(l_extendedprice * 100) AS BIGINT) % 1000) / CAST(1000 AS DOUBLE) AS score,
       CAST(l_partkey % 2 AS INT) AS det_class,
       CAST((l_partkey % 200) * 1000 + l_quantity * 2 AS BIGINT) AS minx,
       CAST(floor(l_partkey / 200) * 1000 + l_linenumber * 10 AS BIGINT) AS miny,
       CAST((l_partkey % 200) * 1000 + l_quantity * 2 + 150 + (l_orderkey % 5) * 20 AS BIGINT) AS maxx,
       CAST(floor(l_partkey / 200) * 1000 + l_linenumber * 10 + 150 + (l_orderkey % 3) * 40 AS BIGINT) AS maxy
FROM lineitem""",
    "fx_label": """
SELECT CAST(p_partkey * 10 + (y - 1990) % 10 AS BIGINT) AS label_id,
       CAST(p_partkey AS BIGINT) AS site, CAST(y AS INT) AS year_label,
       CAST(CASE WHEN p_size % 10 = 0 THEN 2 - p_partkey % 2 ELSE 1 + p_partkey % 2 END AS INT) AS label_class,
       CASE WHEN p_partkey % 10 < 7 THEN 'trn' WHEN p_partkey % 10 = 7 THEN 'val' ELSE 'tst' END AS dataset,
       CAST((p_partkey % 200) * 1000 + 40 + p_size * 5 AS BIGINT) AS minx,
       CAST(floor(p_partkey / 200) * 1000 + 30 AS BIGINT) AS miny,
       CAST((p_partkey % 200) * 1000 + 210 + p_size * 5 AS BIGINT) AS maxx,
       CAST(floor(p_partkey / 200) * 1000 + 200 AS BIGINT) AS maxy
FROM part CROSS JOIN (SELECT DISTINCT CAST(extract(year FROM l_shipdate) AS INT) AS y FROM lineitem) yy
WHERE (p_partkey + y) % 3 <> 0""",
    "fx_tile": """
SELECT DISTINCT tx, ty, concat('(', CAST(tx AS STRING), ', ', CAST(ty AS STRING), ', 16)') AS tile_id,
       tx * 400 AS minx, ty * 400 AS miny, tx * 400 + 400 AS maxx, ty * 400 + 400 AS maxy
FROM (SELECT CAST(floor(minx / 400) AS BIGINT) AS tx, CAST(floor(miny / 400) AS BIGINT) AS ty FROM fx_det
      UNION ALL SELECT CAST(floor(maxx / 400) AS BIGINT), CAST(floor(miny / 400) AS BIGINT) FROM fx_det
      UNION ALL SELECT CAST(floor(minx / 400) AS BIGINT), CAST(floor(maxy / 400) AS BIGINT) FROM fx_det
      UNION ALL SELECT CAST(floor(maxx / 400) AS BIGINT), CAST(floor(maxy / 400) AS BIGINT) FROM fx_det) c""",
    "fx_aoi": """
SELECT 'vaud' AS canton, CAST(0 AS BIGINT) AS minx, CAST(0 AS BIGINT) AS miny,
       CAST(99100 AS BIGINT) AS maxx, CAST(10000000 AS BIGINT) AS maxy
UNION ALL SELECT 'ticino', CAST(100050 AS BIGINT), CAST(0 AS BIGINT), CAST(10000000 AS BIGINT), CAST(10000000 AS BIGINT)""",
    "fx_layer": """
SELECT CAST(p_partkey * 2 AS BIGINT) AS layer_id,
       CASE p_size % 4 WHEN 0 THEN 'waters' WHEN 1 THEN 'forests' WHEN 2 THEN 'building_areas' ELSE 'sda' END AS layer_key,
       CAST((p_partkey % 200) * 1000 + 100 AS BIGINT) AS minx, CAST(floor(p_partkey / 200) * 1000 + 100 AS BIGINT) AS miny,
       CAST((p_partkey % 200) * 1000 + 220 AS BIGINT) AS maxx, CAST(floor(p_partkey / 200) * 1000 + 220 AS BIGINT) AS maxy
FROM part
UNION ALL
SELECT CAST(p_partkey * 2 + 1 AS BIGINT),
       CASE p_size % 4 WHEN 0 THEN 'waters' WHEN 1 THEN 'forests' WHEN 2 THEN 'building_areas' ELSE 'sda' END,
       CAST((p_partkey % 200) * 1000 + 160 AS BIGINT), CAST(floor(p_partkey / 200) * 1000 + 60 AS BIGINT),
       CAST((p_partkey % 200) * 1000 + 300 AS BIGINT), CAST(floor(p_partkey / 200) * 1000 + 160 AS BIGINT)
FROM part WHERE p_partkey % 3 = 0""",
    "fx_dem": "SELECT tx, ty, CAST((tx * 7 + ty * 13) % 1200 AS DOUBLE) AS elevation FROM fx_tile",
    "fx_pixel": """
SELECT CAST(l_orderkey % 100 AS INT) AS image_id,
       CAST(row_number() OVER (PARTITION BY l_orderkey % 100 ORDER BY l_orderkey, l_linenumber, l_partkey,
         l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_discount, l_tax) - 1 AS BIGINT) AS pixel,
       CAST(l_quantity * 5 AS INT) AS r, CAST(l_partkey % 256 AS INT) AS g, CAST(l_suppkey % 256 AS INT) AS b
FROM lineitem""",
}
NEEDS = {"fx_det": ("lineitem",), "fx_label": ("part", "lineitem"), "fx_tile": ("fx_det",), "fx_aoi": (), "fx_layer": ("part",), "fx_dem": ("fx_tile",), "fx_pixel": ("lineitem",)}


def _corners(det: DataFrame) -> DataFrame:
    """The distinct quadruples of 400 m lines at or below the sides of detections: all that tiles depend on, so that not
    every detection takes four rows to them."""
    return det.select(*((F.floor(F.col(s) / 400) * 400).cast("long").alias(s) for s in rect.SIDES)).distinct()


#: Fixtures that are stored and then held, from so many rows of their table: the shuffle that they are made by goes, and what
#: memory can't hold is read again.
STORED = {"fx_det": 1_000_000}
#: What a fixture reads of another one, where that is less than all of it.
SLIM: dict[tuple[str, str], Callable[[DataFrame], DataFrame]] = {("fx_tile", "fx_det"): _corners}
_built: dict[tuple[str, str, str], DataFrame] = {}


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture or table as a DataFrame."""
    if name not in SQL:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        for old in [k for k in _built if k[:2] != key[:2]]:  # one folder's fixtures are held at a time
            _built.pop(old).unpersist()
        text = SQL[name]
        for need in NEEDS[name]:
            view, rows = f"tesserae_{need}", frame(spark, sf_dir, need)
            if (name, need) in SLIM:
                view = f"{view}_for_{name}"
                rows = _built[(*key[:2], view)] = SLIM[name, need](rows).persist()
            rows.createOrReplaceTempView(view)
            text = re.sub(rf"FROM {need}\b", f"FROM {view}", text)
        many = name in STORED and frame(spark, sf_dir, NEEDS[name][0]).count() >= STORED[name]
        _built[key] = store(spark.sql(text), name)[0].persist(StorageLevel.MEMORY_ONLY) if many else spark.sql(text).persist()
    return _built[key]


def with_clause(*names: str, more: str = "") -> str:
    """A WITH clause for DuckDB that defines the fixtures, and then the expressions in `more`."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in NEEDS[name]:
            if n in SQL:
                add(n)
        if name not in order:
            order.append(name)

    for n in names:
        add(n)
    parts = [f"{n} AS MATERIALIZED ({SQL[n]})" for n in order] + [more] * bool(more)
    return "WITH RECURSIVE " + ",\n".join(parts)
