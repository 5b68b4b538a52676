"""Projections against the survey's published point, histograms against numpy, quantiles that spread."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.operators import raster, reports, tiling


def test_published_point_of_the_grid(spark):
    """Rigi: published latitude and longitude on the grid's ellipsoid, and grid coordinates."""
    lat, lon = 47 + 3 / 60 + 28.95659233 / 3600, 8 + 29 / 60 + 11.11127154 / 3600
    p = spark.createDataFrame([(math.radians(lon), math.radians(lat))], "lon double, lat double")
    e, n = p.select(*tiling.oblique(F.col("lon"), F.col("lat"))).first()
    assert abs(e - 2_679_520.05) < 0.001 and abs(n - 1_212_273.44) < 0.001
    back = p.select(*tiling.from_oblique(F.lit(2_679_520.05), F.lit(1_212_273.44))).first()
    assert back[0] == pytest.approx(math.radians(lon), abs=1e-10) and back[1] == pytest.approx(math.radians(lat), abs=1e-10)


def test_there_and_back_across_the_country(spark):
    places = [(6.0, 46.1), (7.4386, 46.951), (8.7305, 46.0441), (10.45, 46.9), (9.1, 47.8)]
    df = spark.createDataFrame(places, "lon double, lat double").select("lon", "lat", *(c.alias(k) for k, c in zip("en", tiling.swiss(F.col("lon"), F.col("lat")))))
    rows = df.select("*", *(c.alias(k) for k, c in zip(("lon2", "lat2"), tiling.from_swiss(F.col("e"), F.col("n"))))).collect()
    assert all(abs(r["lon"] - r["lon2"]) < 2e-8 and abs(r["lat"] - r["lat2"]) < 2e-8 for r in rows)  # about a millimetre; heights are taken as 0 both ways
    assert all(2_480_000 < r["e"] < 2_840_000 and 1_070_000 < r["n"] < 1_300_000 for r in rows)
    approximate = {(lon, lat): (2600072.37 + 211455.93 * q - 10938.51 * q * p - 0.36 * q * p * p - 44.54 * q**3, 1200147.07 + 308807.95 * p + 3745.25 * q * q + 76.63 * p * p - 194.56 * q * q * p + 119.79 * p**3) for lon, lat in places for p, q in [((lat * 3600 - 169028.66) / 10000, (lon * 3600 - 26782.5) / 10000)]}
    assert all(math.dist(approximate[r["lon"], r["lat"]], (r["e"], r["n"])) < 2.5 for r in rows)  # the survey's short formulas are good for metres


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_matched_histograms_equal_interpolation(spark, seed):
    rng = np.random.default_rng(seed)
    images = {k: np.clip(rng.normal(90 + 20 * k, 25, 900), 0, 255).astype(int) for k in range(3)}
    target = np.clip(rng.normal(140, 12 + seed, 700), 0, 255).astype(int)
    a = spark.createDataFrame([(k, "r", int(v)) for k, im in images.items() for v in im], "image int, band string, v int")
    b = spark.createDataFrame([("r", int(v)) for v in target], "band string, v int")
    got = {(r["image"], r["v"]): r["matched"] for r in raster.match_histogram(a, b, ["band"], "v", ["image"]).collect()}
    values, counts = np.unique(target, return_counts=True)
    for k, im in images.items():
        own, n = np.unique(im, return_counts=True)
        want = np.interp(np.cumsum(n) / n.sum(), np.cumsum(counts) / counts.sum(), values)
        assert [got[k, int(v)] for v in own] == pytest.approx(want.tolist(), abs=1e-9)
    assert raster.match_histogram(a, b.where("false"), ["band"], "v", ["image"]).count() == 0


def test_quantiles_of_a_group_in_many_ranges(spark):
    """Real-valued scores: a group's ranges lie in several files, a rank is found in one of them."""
    rng = random.Random(4)
    rows = [(1, rng.gauss(0, 1)) for _ in range(6000)] + [(2, rng.choice([0.5, 0.5, 1.5])) for _ in range(300)] + [(3, 7.0), (None, 1.0), (None, 2.0), (4, None)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["g"]: r for r in reports.quantiles(spark.createDataFrame(rows, "g int, v double").repartition(5), "g", "v", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.999, "e": 1.0}).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert set(got) == {1, 2, 3, None}
    for g in got:
        own = [v for k, v in rows if k == g and v is not None]
        assert got[g]["n"] == len(own)
        assert [got[g][c] for c in "abcde"] == pytest.approx(np.quantile(own, [0, 0.25, 0.5, 0.999, 1]).tolist(), abs=1e-12)


def test_yearly_medians_of_several_columns(spark):
    df = spark.createDataFrame([(2000, 1.0, None), (2000, 3.0, None), (2001, 5.0, 2.0), (2002, None, None)], "year int, a double, b double")
    assert sorted(map(tuple, reports.yearly_medians(df, "year", ["a", "b"]).collect())) == [(2000, 2.0, None), (2001, 5.0, 2.0), (2002, None, None)]
