"""Selections by value, coalesced columns, fallbacks, and checks that stop a flow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.functions import rect
from tesserae.operators import overlay


def without_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose value isn't listed. A null is no value, so that such rows stay."""
    return df.where(~F.coalesce(F.col(column).isin(list(values)), F.lit(False)))


def without_class(layer: DataFrame, column: str, value) -> DataFrame:
    """The layer without one class of an attribute; rows without the attribute stay."""
    return without_values(layer, column, [value])


def coalesced(df: DataFrame, columns: dict[str, tuple[str, str]], drop: bool = True) -> DataFrame:
    """df with each named column made of the first, and where that is null of the second, of two others,
    which go unless they are kept."""
    out = df.withColumns({name: F.coalesce(a, b) for name, (a, b) in columns.items()})
    used = {c for pair in columns.values() for c in pair} - set(columns)
    return out.drop(*used) if drop else out


def final(df: DataFrame, columns: list[str], renamed: dict[str, str] | None = None) -> DataFrame:
    """The listed columns in order, after renaming; columns that aren't there are left out."""
    named = df.withColumnsRenamed({a: b for a, b in (renamed or {}).items() if a in df.columns})
    return named.select(*(c for c in columns if c in named.columns))


def or_else(df: DataFrame, fallback: DataFrame) -> DataFrame:
    """df, or the fallback where df has no row (no tile passed the filters, say)."""
    return fallback if df.isEmpty() else df


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def require_same_crs(**crs: str | int) -> None:
    """All layers, given by name, are in one reference system."""
    if len({str(c).upper().removeprefix("EPSG:") for c in crs.values()}) > 1:
        raise ValueError("reference systems differ: " + ", ".join(f"{k} {v}" for k, v in crs.items()))


def require_same_count(before: DataFrame, after: list[DataFrame], what: str) -> None:
    """The parts together have as many rows as what they were made of."""
    had, have = before.count(), sum(d.count() for d in after)
    if had != have:
        raise ValueError(f"{what}: {had} rows became {have}")


def require_all_joined(df: DataFrame, column: str, what: str) -> None:
    missing = df.where(F.col(column).isNull()).count()
    if missing:
        raise ValueError(f"{what}: {missing} rows found no partner")


def clipped(layer: DataFrame, mask: DataFrame, cell: float) -> DataFrame:
    """The layer's rows cut to a mask's rectangles, which don't overlap each other; parts without area go."""
    from tesserae.operators import spatial

    met = spatial.area_pairs(layer, mask.select(*rect.SIDES), cell)
    cut = rect.intersection("l.", "r.")
    return met.select(*((cut[c].alias(c) if c in cut else F.col(f"l.{c}").alias(c)) for c in layer.columns)).where(rect.area() > 0)


def clipped_by_year(layer: DataFrame, mask: DataFrame, cell: float, file: str = "file") -> DataFrame:
    """clipped(), with year from the name of the file that a row came from; rows of files without a year go."""
    from tesserae.sources.vector import year_in_name

    return clipped(layer.withColumn("year", year_in_name(F.col(file))).where("year IS NOT NULL"), mask, cell)


def outside(layer: DataFrame, areas: DataFrame, id_col: str, cell: float) -> DataFrame:
    """id, area and left_area of the layer's rows after the areas are taken away."""
    return overlay.difference_area(layer, areas, id_col, int(cell))
