"""Spatial joins over rectangles.

A range predicate alone would be a nested loop. Both sides are therefore laid over a grid and joined by
cell (and any equal keys); a pair is kept only in the cell of the lower left corner of its common part,
so that it appears once without a distinct. Cells come from `sequence`, everything stays in generated
code, and adaptive execution can split a crowded cell. Only the columns that are used later travel, and the rows of a
table that is joined with itself travel once, to where their cell is gathered.

Where shapes crowd, `dense_cells` finds the cells that hold too many and splits them, each by its own count; given to
`pairs`, such a cell becomes up to SPLIT x SPLIT smaller ones, and the others stay as they are.

Shapes far wider than a cell would cover too many cells: `area_pairs` gives each of them a grid of its own
size instead. Rows without bounds meet nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.functions import rect
from tesserae.storage import drop, store

#: Rows of an area table up to which it is sent to every task, and parts that a wider table's cells are dealt to.
SMALL_AREAS, SALTS = 10_000, 64
#: Doublings by which an area is longer than wide from which its grid's cells are too.
THIN = 3
#: Parts of a crowded cell's side at most, and shapes of a cell from which it is crowded.
SPLIT, CROWD = 64, 4096
#: How much wider than asked for the cells are by which rows travel: each row travels once for every cell it lies in.
SPREAD = 4


def cell_size(df: DataFrame, share: float = 0.95) -> int:
    """The side that the given share of rectangles does not exceed, as a whole number."""
    got = df.agg(F.percentile_approx(F.greatest(rect.width(), rect.height()), share)).first()[0]
    return max(1, int(got or 1))


def _on_grid(df: DataFrame, cell: float, keys: list[str]) -> DataFrame:
    at = lambda c: F.floor(F.col(c) / F.lit(cell)).cast("long")
    laid = df.select("*", *(F.col(x).alias(f"__k{k}") for k, x in enumerate(keys)), F.explode(F.sequence(at("minx"), at("maxx"))).alias("__cx"))
    return laid.select("*", F.explode(F.sequence(at("miny"), at("maxy"))).alias("__cy"))


def dense_cells(left: DataFrame, right: DataFrame, cell: float, most: int = CROWD) -> DataFrame:
    """__cx, __cy, __split of the cells that more than `most` shapes of either table lie in: the side's parts, a power of
    two that would bring the cell's parts below that if shapes were spread evenly and small. A stored table, as long as
    there are crowded cells."""
    count = lambda d: _on_grid(d.select(*rect.SIDES), cell, []).groupBy("__cx", "__cy").agg(F.count(F.lit(1)).alias("n"))
    both = count(left).unionByName(count(right)).groupBy("__cx", "__cy").agg(F.max("n").alias("n")).where(F.col("n") > most)
    parts = F.least(F.pow(F.lit(2.0), F.ceil(F.log2(F.sqrt(F.col("n") / most)))), F.lit(float(SPLIT))).cast("long")
    return store(both.select("__cx", "__cy", F.greatest(parts, F.lit(2)).alias("__split")), "dense")[0]


def _part(value: Column, corner: Column, cell: float) -> Column:
    """The part of a split cell that a coordinate lies in, kept within the cell."""
    return F.greatest(F.least(F.floor((value - corner * F.lit(cell)) * F.col("__split") / F.lit(cell)), F.col("__split") - 1), F.lit(0))


def _parts(laid: DataFrame, dense: DataFrame, cell: float) -> DataFrame:
    """laid with the parts __px, __py of its cells that each row's bounds meet: one where a cell isn't split."""
    met = laid.join(dense, ["__cx", "__cy"], "left").withColumn("__split", F.coalesce("__split", F.lit(1)))
    span = lambda c, low, high: F.sequence(_part(F.col(low), F.col(c), cell), _part(F.col(high), F.col(c), cell))
    return met.select("*", F.explode(span("__cx", "minx", "maxx")).alias("__px")).select("*", F.explode(span("__cy", "miny", "maxy")).alias("__py"))


def _sides(left: DataFrame, right: DataFrame) -> tuple[Column, Column]:
    return F.struct(*(F.col(f"l.{c}") for c in left.columns)).alias("l"), F.struct(*(F.col(f"r.{c}") for c in right.columns)).alias("r")


def pairs(left: DataFrame, right: DataFrame, cell: float, keys: list[tuple[str, str]] = (), predicate: Callable[[str, str], Column] = rect.intersects, where: Column | None = None, dense: DataFrame | None = None) -> DataFrame:
    """Structs l and r of all pairs that meet the predicate (which implies that they intersect), agree in
    keys (left and right column) and meet `where` (over l.* and r.*). `dense` splits crowded cells (`dense_cells`); without
    it rows travel by cells SPREAD times as wide, which few of them lie across. Neither side is sent to all tasks: what
    the planner takes a laid out table's size for is too small by far."""
    cell = cell if dense is not None else SPREAD * cell
    a, b = _on_grid(left, cell, [x for x, _ in keys]), _on_grid(right, cell, [y for _, y in keys])
    if dense is not None:
        a, b = _parts(a, dense, cell), _parts(b, dense, cell).drop("__split")
    a, b = a.alias("l"), b.alias("r")
    on = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("__cx", "__cy", *(("__px", "__py") if dense is not None else ()), *(f"__k{k}" for k in range(len(keys))))]
    common = rect.intersection("l.", "r.")
    once = (F.floor(common["minx"] / F.lit(cell)) == F.col("l.__cx")) & (F.floor(common["miny"] / F.lit(cell)) == F.col("l.__cy"))
    if dense is not None:
        once &= (_part(common["minx"], F.col("l.__cx"), cell) == F.col("l.__px")) & (_part(common["miny"], F.col("l.__cy"), cell) == F.col("l.__py"))
    kept = a.join(b.hint("merge"), on).where(rect.intersects("l.", "r.") & once & predicate("l.", "r."))
    return (kept if where is None else kept.where(where)).select(*_sides(left, right))


def _placed(areas: DataFrame, cell: float) -> DataFrame:
    """areas with __lx, __ly, the doublings of `cell` that are as wide and as high as each: the greater for both, unless an area
    is far longer than wide (THIN doublings), as a cell as long on both sides would hold very many of its like."""
    level = lambda side: F.coalesce(F.greatest(F.ceil(F.log2(side.cast("double") / F.lit(float(cell)))), F.lit(0)).cast("int"), F.lit(0))
    both = areas.where(rect.width().isNotNull() & rect.height().isNotNull()).withColumns({"__lx": level(rect.width()), "__ly": level(rect.height())})
    most = F.greatest("__lx", "__ly")
    return both.withColumns({c: F.when(most - F.col(c) >= THIN, F.col(c)).otherwise(most) for c in ("__lx", "__ly")})


def area_pairs(left: DataFrame, areas: DataFrame, cell: float) -> DataFrame:
    """Structs l and r of all pairs that intersect, where areas may be of any size.

    An area lies on the grid whose cells are the least doublings of `cell` that are as wide and as high as the area, where
    it covers four cells at most; left rows lie on each of the grids that occur. A table of up to
    SMALL_AREAS areas is sent to every task; beyond, a cell is dealt to SALTS parts by left rows."""
    side = lambda axis, of="": F.lit(float(cell)) * F.pow(F.lit(2.0), F.col(f"{of}__l{axis}"))
    at = lambda c: F.floor(F.col(c) / side(c[-1])).cast("long")
    placed = _placed(areas, cell)
    found = placed.groupBy("__lx", "__ly").agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each grid
    small = sum(r["n"] for r in found) <= SMALL_AREAS
    cells = lambda d: d.select("*", F.explode(F.sequence(at("minx"), at("maxx"))).alias("__cx")).select("*", F.explode(F.sequence(at("miny"), at("maxy"))).alias("__cy"))
    salt = F.lit(0) if small else F.pmod(F.xxhash64("minx", "miny", "maxx", "maxy"), F.lit(SALTS)).cast("int")
    grids = F.array(*(F.struct(F.lit(r["__lx"]).alias("__lx"), F.lit(r["__ly"]).alias("__ly")) for r in found)).cast("array<struct<__lx:int,__ly:int>>")
    a = cells(left.select("*", F.inline(grids)).select("*", salt.alias("__salt"))).alias("l")
    b = cells(placed.select("*", F.explode(F.array(F.lit(0)) if small else F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt")))
    b = (F.broadcast(b) if small else b.hint("merge")).alias("r")  # the planner doesn't see what salts make of a table's size
    on = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("__lx", "__ly", "__salt", "__cx", "__cy")]
    common = rect.intersection("l.", "r.")
    once = (F.floor(common["minx"] / side("x", "l.")) == F.col("l.__cx")) & (F.floor(common["miny"] / side("y", "l.")) == F.col("l.__cy"))
    return a.join(b, on).where(rect.intersects("l.", "r.") & once).select(*_sides(left, areas))


def _crowds(df: DataFrame, cell: float) -> DataFrame:
    """__ox, __oy of the cells that more than CROWD shapes lie in."""
    return _on_grid(df.select(*rect.SIDES), cell, []).groupBy(F.col("__cx").alias("__ox"), F.col("__cy").alias("__oy")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWD).drop("n")


def self_pairs(df: DataFrame, id_col: str, cell: float, same: list[str] = (), strict: bool = False, columns: list[str] | None = None) -> DataFrame:
    """Pairs of one table with l.id >= r.id (or >, if strict) that agree in the columns `same`; structs of the given columns
    (all, if none are given) and the bounds.

    A row travels once for every wide cell that it lies in and meets the others where they are gathered. Cells about
    which shapes crowd, found by counts over cells SPREAD times as wide again, are joined instead: no array is longer than CROWD."""
    order = F.col(f"l.{id_col}") > F.col(f"r.{id_col}") if strict else F.col(f"l.{id_col}") >= F.col(f"r.{id_col}")
    wide = SPREAD * cell
    crowded, path = store(_crowds(df, SPREAD * wide), "crowds")
    town = not crowded.isEmpty()
    kept = list(dict.fromkeys([id_col, *(df.columns if columns is None else columns), *rect.SIDES]))
    keys = [f"__k{n}" for n in range(len(same))]
    group = ["__cx", "__cy", *keys]
    laid = _on_grid(df, wide, list(same)).select(*kept, *group).where(" AND ".join(f"{c} IS NOT NULL" for c in (id_col, *group)))
    over = [F.floor(F.col(c) / SPREAD).cast("long") == F.col(o) for c, o in (("__cx", "__ox"), ("__cy", "__oy"))]
    quiet = laid.join(crowded, over, "left_anti") if town else laid
    gathered = quiet.repartition(*group).groupBy(*group).agg(F.collect_list(F.struct(*kept)).alias("__all"))
    met = gathered.select("__cx", "__cy", "__all", F.explode("__all").alias("l")).select("__cx", "__cy", "l", F.explode("__all").alias("r"))
    common = rect.intersection("l.", "r.")
    once = lambda x, y: (F.floor(common["minx"] / F.lit(wide)) == x) & (F.floor(common["miny"] / F.lit(wide)) == y)
    out = met.where(order & rect.intersects("l.", "r.") & once(F.col("__cx"), F.col("__cy"))).select("l", "r")
    if not town:
        drop(df.sparkSession, path)
        return out
    there = laid.join(crowded, over, "left_semi")
    both = there.alias("l").join(there.alias("r").hint("merge"), [F.col(f"l.{c}") == F.col(f"r.{c}") for c in group])
    near = both.where(order & rect.intersects("l.", "r.") & once(F.col("l.__cx"), F.col("l.__cy")))
    return out.unionByName(near.select(*(F.struct(*(F.col(f"{s}.{c}") for c in kept)).alias(s) for s in ("l", "r"))))


def left_pairs(left: DataFrame, right: DataFrame, id_col: str, cell: float, **how) -> DataFrame:
    """pairs(), plus a row with null r for each left row that has none."""
    found = pairs(left, right, cell, **how)
    alone = left.join(found.select(F.col(f"l.{id_col}").alias(id_col)).distinct(), id_col, "left_anti").select(*left.columns)
    return found.unionByName(alone.select(F.struct(*left.columns).alias("l"), F.lit(None).cast(found.schema["r"].dataType).alias("r")))


def nearest(left: DataFrame, right: DataFrame, id_col: str, right_id: str, start: float, distance: Column | None = None) -> DataFrame:
    """l, r, distance of the nearest right rows of each left row; ties give several rows.

    The reach doubles until every left row has a neighbour within it: those who have one are done, since
    nothing nearer can lie outside. The number of rounds is the logarithm of the longest distance, and no
    round goes beyond the extent of both tables. Rows without bounds, on either side, have no nearest row;
    neither has any row if the other side is empty. `distance`, over l.* and r.*, is the rectangles' if none is given; it
    is never less than theirs."""
    away = rect.distance("l.", "r.") if distance is None else distance
    sound = " AND ".join(f"{s} IS NOT NULL" for s in rect.SIDES)
    left, right = left.where(sound), right.where(sound)
    ends = lambda d: d.agg(F.min("minx"), F.min("miny"), F.max("maxx"), F.max("maxy")).first()
    a, b = ends(left), ends(right)
    if a[0] is None or b[0] is None:
        return pairs(left, right, start).withColumn("distance", F.lit(0.0)).limit(0)
    longest = math.hypot(*(float(max(a[k + 2], b[k + 2]) - min(a[k], b[k])) for k in (0, 1)))
    waiting, waiting_path, reach, parts = left, None, float(start), []
    while True:
        grown = waiting.select(F.struct(*left.columns).alias("own"), *(c.alias(s) for s, c in rect.grown(reach).items()))
        met = pairs(grown, right, reach).select(F.col("l.own").alias("l"), "r").withColumn("distance", away).where(F.col("distance") <= reach)
        best = met.groupBy(F.col(f"l.{id_col}").alias("__id")).agg(F.min("distance").alias("__d"))
        done, _ = store(met.join(best, (F.col(f"l.{id_col}") == F.col("__id")) & (F.col("distance") == F.col("__d"))).drop("__id", "__d"), "nearest")
        parts.append(done)
        if reach > longest:
            break
        still, path = store(waiting.join(done.select(F.col(f"l.{id_col}").alias(id_col)).distinct(), id_col, "left_anti").select(*left.columns), "waiting")
        if waiting_path:
            drop(left.sparkSession, waiting_path)
        waiting, waiting_path = still, path
        if waiting.isEmpty():
            break
        reach *= 2
    if waiting_path:
        drop(left.sparkSession, waiting_path)
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out
