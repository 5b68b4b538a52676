"""The tables behind the charts: gap-filled histograms, pivots, medians, box statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesserae.storage import store


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Nulls don't count."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def gap_filled(df: DataFrame, column: str, step: int = 1) -> DataFrame:
    """Counts per value, with 0 for each step between the least and the greatest that doesn't occur."""
    counts = value_counts(df, column)
    ends = counts.agg(F.min(column).alias("a"), F.max(column).alias("b")).where("a IS NOT NULL")
    series = ends.select(F.explode(F.sequence("a", "b", F.lit(step).cast(dict(counts.dtypes)[column]))).alias(column))
    return series.join(counts, column, "full_outer").select(column, F.coalesce("n", F.lit(0)).alias("n"))


def over_years(counts: DataFrame, year: str, columns: list[str], first: int, end: int) -> DataFrame:
    """A row for each year from first to before end; missing counts are 0."""
    years = counts.sparkSession.range(first, end).select(F.col("id").cast("int").alias(year))
    return years.join(counts, year, "left").select(year, *(F.coalesce(c, F.lit(0)).alias(c) for c in columns))


def pivot_counts(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    got = df.groupBy(row).pivot(column, values).agg(F.count(F.lit(1)))
    return got.select(row, *(F.coalesce(F.col(f"`{v}`"), F.lit(0)).alias(v) for v in values))


def quantiles(df: DataFrame, by: str | list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """by, n and a column for each share: exact quantiles, interpolated between neighbours; nulls don't count.

    Values are counted before they travel and sorted by range, so that a group of any number of distinct values
    spreads over many tasks. The stored ranges (files) are counted, and only the range that holds a wanted rank is read
    for it. The first row of a group, and the first row of a range, tell where in the order they stand."""
    by = [by] if isinstance(by, str) else list(by)
    counts = df.where(F.col(value).isNotNull()).groupBy(*(F.col(c).alias(f"__g{k}") for k, c in enumerate(by)), F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    group = [f"__g{k}" for k in range(len(by))]
    held, _ = store(counts.orderBy(*group, "__v"), "values")
    named = held.select("*", F.col("_metadata.file_path").alias("__file"))
    own = Window.partitionBy(*group)
    parts = named.groupBy(*group, "__file").agg(F.sum("__c").alias("__n"), F.min("__v").alias("__first"))
    placed = parts.select("*", F.coalesce(F.sum("__n").over(own.orderBy("__first").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"), F.sum("__n").over(own).alias("n"))
    ranks = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(up).alias("up"), (F.ceil if up else F.floor)((F.col("n") - 1) * F.lit(float(q))).alias("rank")) for k, q in shares.items() for up in (False, True)))
    wanted = placed.select(*group, "__file", "__before", "__n", "n", F.explode(ranks).alias("r")).where((F.col("r.rank") >= F.col("__before")) & (F.col("r.rank") < F.col("__before") + F.col("__n")))
    in_range = wanted.groupBy(*group, "__file", "__before", "n").agg(F.collect_list("r").alias("rs"))  # two ranks a share at most
    same = lambda a, b: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in group]
    rows = named.alias("v").join(in_range.alias("w"), [*same("v", "w"), F.col("v.__file") == F.col("w.__file")]).select(*(f"v.{c}" for c in group), "v.__file", "__v", "__c", "__before", "n", "rs")
    upto = F.col("__before") + F.sum("__c").over(Window.partitionBy(*group, "__file").orderBy("__v"))
    met = rows.withColumn("__upto", upto).select(*group, "n", "__v", "__upto", "__c", F.explode("rs").alias("r")).where((F.col("r.rank") < F.col("__upto")) & (F.col("r.rank") >= F.col("__upto") - F.col("__c")))
    at = lambda k, up: F.max(F.when((F.col("r.k") == k) & (F.col("r.up") == up), F.col("__v"))).cast("double")
    ends = met.groupBy(*group, "n").agg(*(at(k, up).alias(f"__{'b' if up else 'a'}_{k}") for k in shares for up in (False, True)))
    part = lambda q: (F.col("n") - 1) * F.lit(float(q)) - F.floor((F.col("n") - 1) * F.lit(float(q)))
    return ends.select(*(F.col(g).alias(c) for g, c in zip(group, by)), "n", *((F.col(f"__a_{k}") + (F.col(f"__b_{k}") - F.col(f"__a_{k}")) * part(q)).alias(k) for k, q in shares.items()))


def yearly_medians(df: DataFrame, year: str, columns: list[str]) -> DataFrame:
    """The median of each column by year; null where a year has no value. All columns are sorted at once."""
    stacked = df.select(year, F.explode(F.array(*(F.struct(F.lit(c).alias("__column"), F.col(c).cast("double").alias("__value")) for c in columns))).alias("x")).select(year, "x.*")
    medians = quantiles(stacked, [year, "__column"], "__value", {"median": 0.5})
    wide = medians.groupBy(year).agg(*(F.max(F.when(F.col("__column") == c, F.col("median"))).alias(f"median_{c}") for c in columns))
    return df.select(year).distinct().join(wide, year, "left")


def box_statistics(df: DataFrame, by: str, value: str) -> DataFrame:
    """Quartiles, and whiskers at the last values within 1.5 interquartile ranges."""
    q = quantiles(df, by, value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    ends = df.join(q, by).where((F.col(value) >= F.col("q1") - reach) & (F.col(value) <= F.col("q3") + reach)).groupBy(by).agg(F.min(value).alias("low"), F.max(value).alias("high"))
    return q.join(ends, by)


def lifespans(df: DataFrame) -> DataFrame:
    """first_year, lifespan, n."""
    return df.groupBy("first_year", (F.col("last_year") - F.col("first_year")).alias("lifespan")).agg(F.count(F.lit(1)).alias("n"))


def elevation_bins(df: DataFrame, column: str, step: int = 25) -> DataFrame:
    """Counts by elevation rounded to the step, half to even."""
    return df.where(F.col(column).isNotNull()).groupBy((step * F.rint(F.col(column) / step)).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
