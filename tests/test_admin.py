"""Units by cells against clipping every cell, and their areas against the shoelace formula."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gridclim.functions import grid
from gridclim.operators import admin, spatial

SQUARE = "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))"
UNITS = {
    "slanted": "POLYGON ((10.13 50.02, 13.77 51.4, 12.9 54.31, 9.2 52.6, 10.13 50.02))",
    "hole": "polygon((-60.1 -10.2, -57.03 -11.1, -57.4 -7.7, -60.9 -8.05), (-59.3 -9.6, -58.1 -9.9, -58.4 -8.6))",
    "hole, other way": "POLYGON ((-60.1 -10.2, -60.9 -8.05, -57.4 -7.7, -57.03 -11.1, -60.1 -10.2), (-59.3 -9.6, -58.1 -9.9, -58.4 -8.6, -59.3 -9.6))",
    "several": "MULTIPOLYGON (((5 5, 6.1 5.2, 5.7 6.6, 5 5), (5.4 5.4, 5.7 5.5, 5.6 5.9, 5.4 5.4)), ((7.05 5.1, 7.9 5.15, 7.4 5.9)), ((8 5, 8 5.3, 8.3 5.3, 8.3 5)))",
    "on the edges": "POLYGON ((0.125 0.125, 1.125 0.125, 1.125 1.125, 0.125 1.125, 0.125 0.125))",
    "tiny": "POLYGON ((30.01 30.01, 30.02 30.01, 30.015 30.03))",
    "comb": "POLYGON ((0 40, 3 40, 3 42, 2.5 40.1, 2 42, 1.5 40.1, 1 42, 0.5 40.1, 0 42))",
    "high": "POLYGON ((-20 87.3, 10 88.1, 0 89.9, -15 89.2))",
    "z": "MULTIPOLYGON Z (((1e1 -2.5E0 7, 12. -2.6 7, 11.5 -.5 8)))",
}


def parsed(wkt):
    return spatial.parse_polygon(wkt.replace(" Z", "").replace("Z", ""))


def brute(wkt):
    """Share of every cell of the box, each ring clipped by itself."""
    rings = parsed(wkt)
    signs = spatial._depths(rings)
    xs, ys = [p[0] for r in rings for p in r], [p[1] for r in rings for p in r]
    out = defaultdict(float)
    for i in range(math.floor((90.125 - max(ys)) / 0.25), math.floor((90.125 - min(ys)) / 0.25) + 1):
        for j in range(math.floor((min(xs) + 0.125) / 0.25), math.floor((max(xs) + 0.125) / 0.25) + 1):
            n, w = 90.125 - i * 0.25, j * 0.25 - 0.125
            share = sum(s * spatial.clip_area(r, w, n - 0.25, w + 0.25, n) for r, s in zip(rings, signs, strict=True)) / 0.0625
            out[i, j % 1440] += share
    return {k: v for k, v in out.items() if v > 1e-8}


def cells_of(spark, units):
    df = spark.createDataFrame(list(units.items()), "admin_id string, wkt string")
    out = defaultdict(dict)
    for r in admin.admin_cells(df).select("*", grid.base36_decode("child_id").alias("n"), grid.parent_of("child_id").alias("p")).collect():
        assert r.p == r.parent_id
        out[r.admin_id][divmod(r.n, 1440)] = r.area_fraction
    return out


def test_shares_equal_clipping_every_cell(spark):
    got = cells_of(spark, UNITS)
    for name, wkt in UNITS.items():
        want = brute(wkt)
        mine = {k: v for k, v in got[name].items() if v > 1e-8}
        assert mine.keys() == want.keys(), name
        assert all(mine[k] == pytest.approx(want[k], abs=1e-9) for k in want), name
    assert got["on the edges"] == {k: pytest.approx(1.0) for k in got["on the edges"]} and len(got["on the edges"]) == 16


def test_many_random_polygons_in_one_job(spark):
    rng = random.Random(10)
    units = {}
    for k in range(60):
        lat, lon, n = rng.uniform(-80, 80), rng.uniform(-179, 175), rng.randint(5, 12)
        angles = [2 * math.pi * (k + rng.uniform(0, 0.9)) / n for k in range(n)]
        star = [(round(lon + r * math.cos(a), 4), round(lat + 0.7 * r * math.sin(a), 4)) for a in angles for r in [rng.uniform(0.2, 3)]]
        units[f"u{k}"] = "POLYGON ((" + ", ".join(f"{x} {y}" for x, y in star) + "))"
    got = cells_of(spark, units)
    for name, wkt in units.items():
        ring = parsed(wkt)[0]
        area = abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True))) / 2
        assert sum(got[name].values()) * 0.0625 == pytest.approx(area, abs=1e-9)
        want = brute(wkt)
        assert all(got[name].get(k, 0.0) == pytest.approx(v, abs=1e-8) for k, v in want.items())


def test_across_the_antimeridian(spark):
    got = cells_of(spark, {"seam": "POLYGON ((179.3 -17.2, 180.9 -16.8, 180.4 -15.1, 179.1 -15.9))", "sides": "MULTIPOLYGON (((179.8 0, 180 0, 180 1, 179.8 1)), ((-180 0, -179.8 0, -179.8 1, -180 1)))", "whole": "POLYGON ((179.8 0, 180.2 0, 180.2 1, 179.8 1))"})
    assert got["seam"] == {k: pytest.approx(v, abs=1e-9) for k, v in brute("POLYGON ((179.3 -17.2, 180.9 -16.8, 180.4 -15.1, 179.1 -15.9))").items()}
    assert got["sides"] == {k: pytest.approx(v, abs=1e-9) for k, v in got["whole"].items()}


def test_nulls_empties_repeats_and_other_texts(spark):
    rows = [("a", SQUARE), ("a", SQUARE.replace("0", "7").replace("1", "8")), ("none", None), ("empty", "POLYGON EMPTY"), ("empties", "MULTIPOLYGON EMPTY"), ("flat", "POLYGON ((0 0, 1 1, 0 0))"), (None, SQUARE)]
    got = admin.admin_cells(spark.createDataFrame(rows, "admin_id string, wkt string")).groupBy("admin_id").agg(F.sum("area_fraction").alias("s")).collect()
    assert {r.admin_id: r.s * 0.0625 for r in got} == {"a": pytest.approx(2.0), None: pytest.approx(1.0)}
    assert admin.admin_cells(spark.createDataFrame([], "admin_id string, wkt string")).count() == 0
    for text in ("POINT (1 2)", "POLYGON ((0 0, 1 x, 1 1))", "MULTIPOLYGON ((0 0, 1 0, 1 1))", "POLYGON ((0 0, 1 0"):
        with pytest.raises(Exception, match="not a polygon|CAST_INVALID"):
            admin.admin_cells(spark.createDataFrame([("x", text)], "admin_id string, wkt string")).collect()


def test_a_polygon_of_very_many_points(spark):
    n = 60_000
    points = ", ".join(f"{20 + 5 * math.cos(2 * math.pi * k / n):.9f} {10 + 5 * math.sin(2 * math.pi * k / n):.9f}" for k in range(n))
    got = admin.admin_cells(spark.createDataFrame([("round", f"POLYGON (({points}))")], "admin_id string, wkt string")).agg(F.sum("area_fraction").alias("s"), F.max("area_fraction").alias("m")).first()
    assert got.s * 0.0625 == pytest.approx(math.pi * 25, rel=1e-6) and got.m == 1.0


def test_unit_means(spark):
    shares = spark.createDataFrame([("u", "P", "A", 1.0), ("u", "P", "B", 0.5), ("v", "P", "B", 0.5)], "admin_id string, parent_id string, child_id string, area_fraction double")
    rows = spark.createDataFrame([("P", "A", "2020-01-01", 10.0, None), ("P", "B", "2020-01-01", 40.0, 4.0), ("Q", "B", "2020-01-01", 99.0, 9.0)], "parent_id string, child_id string, date string, tmax double, rh double")
    got = {r.admin_id: (r.n_cells, r.tmax, r.rh) for r in admin.unit_means(rows, shares, ["tmax", "rh"]).collect()}
    assert got == {"u": (2, 20.0, 4.0), "v": (1, 40.0, 4.0)}
