"""Grids against grids, points and polygons, without a geometry engine: every stored box follows from its code."""

from __future__ import annotations

import math
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridclim.functions import grid


def area_weights(fine: DataFrame) -> DataFrame:
    """fine_id, child_id, weight: the share of the coarse cell's area (in degrees) that the fine cell covers.

    A fine box meets at most four coarse boxes; their indices follow from its edges, so this is no spatial join.
    """
    n = grid.fine_number("fine_id")
    north = F.lit(grid.FINE_NORTH) - F.floor(n / grid.FINE_COLS) * 0.05
    west = n % grid.FINE_COLS * 0.05
    box = fine.select("fine_id", north.alias("n"), (north - 0.05).alias("s"), west.alias("w"), (west + 0.05).alias("e"))
    rows = F.sequence(F.floor((90.125 - F.col("n")) / 0.25 + 1e-9), F.floor((90.125 - F.col("s")) / 0.25 - 1e-9))
    cols = F.sequence(F.floor((F.col("w") + 0.125) / 0.25 + 1e-9), F.floor((F.col("e") + 0.125) / 0.25 - 1e-9))
    met = box.withColumn("i", F.explode(rows)).withColumn("j", F.explode(cols))
    dy = F.least("n", 90.125 - F.col("i") * 0.25) - F.greatest("s", 90.125 - (F.col("i") + 1) * 0.25)
    dx = F.least("e", (F.col("j") + 1) * 0.25 - 0.125) - F.greatest("w", F.col("j") * 0.25 - 0.125)
    return met.select(grid.fine_parent_of("fine_id").alias("fparent_id"), "fine_id", grid.coarse_code(F.col("i"), F.col("j") % grid.COARSE_COLS).alias("child_id"), (dx * dy / 0.0625).alias("weight")).where("weight > 1e-9")


def coverage_report(weights: DataFrame) -> DataFrame:
    """How much of each coarse cell its fine cells cover, least first."""
    return weights.groupBy("child_id").agg(F.sum("weight").alias("covered"), F.count("*").alias("n_fine")).orderBy("covered")


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0))
    return F.asin(F.sqrt(F.least(F.lit(1.0), a))) * 2 * 6371.0088


def _cells_within(max_km: float) -> int:
    return math.ceil(max_km / 111.0 * grid.SOIL_PER_DEGREE) + 1


def soil_nearest(sites: DataFrame, soil: DataFrame, max_km: float, order: str = "geodesic") -> DataFrame:
    """For each site (key, lat, lon) its nearest soil point within max_km, with dist_km; sites without one drop out.

    Candidates are the soil cells of the rings around the site's own cell, joined by number; the rings widen with
    latitude, to all columns where the circle reaches a pole. Ties go to the smaller cell number. order='planar' ranks by
    degrees instead of kilometres.
    """
    ring = _cells_within(max_km)
    here = sites.withColumns({"_row": F.floor((90.0 - F.col("lat")) * grid.SOIL_PER_DEGREE), "_col": F.floor(F.pmod(F.col("lon") + 180.0, F.lit(360.0)) * grid.SOIL_PER_DEGREE)})
    edge = F.abs("lat") + ring / grid.SOIL_PER_DEGREE
    half = F.lit(grid.SOIL_COLS // 2)
    wide = F.when(edge >= 90.0, half).otherwise(F.least(half, F.ceil(ring / F.greatest(F.lit(1e-3), F.cos(F.radians(edge)))))).cast("int")
    near = here.withColumn("_dr", F.explode(F.sequence(F.lit(-ring), F.lit(ring)))).withColumn("_dc", F.explode(F.sequence(-wide, wide)))
    near = near.withColumn("cell5m", F.when((F.col("_row") + F.col("_dr")).between(0, grid.SOIL_ROWS - 1), (F.col("_row") + F.col("_dr")) * grid.SOIL_COLS + F.pmod(F.col("_col") + F.col("_dc"), F.lit(grid.SOIL_COLS))))
    points = soil.select("cell5m", "soil_id", F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"))
    turn = F.abs(F.col("lon") - F.col("p_lon"))
    planar = F.sqrt(F.pow(F.col("lat") - F.col("p_lat"), F.lit(2.0)) + F.pow(F.least(turn, 360.0 - turn), F.lit(2.0)))
    met = near.join(points, "cell5m").withColumn("dist_km", haversine_km(F.col("lat"), F.col("lon"), F.col("p_lat"), F.col("p_lon"))).withColumn("_planar", planar).where(F.col("dist_km") <= max_km)
    w = Window.partitionBy("key").orderBy("dist_km" if order == "geodesic" else "_planar", "cell5m")
    return met.withColumn("_n", F.row_number().over(w)).where("_n = 1").select("key", "cell5m", "soil_id", "dist_km")


def soil_at(sites: DataFrame, soil: DataFrame, max_km: float | None = None) -> DataFrame:
    """key, cell5m, soil_id, dist_km: the point of the site's own cell (0 km), else the nearest within max_km, else null."""
    exact = sites.withColumn("cell5m", grid.soil_cell("lat", "lon")).join(soil.select("cell5m", "soil_id"), "cell5m", "left")
    hit = exact.where("soil_id is not null").select("key", "cell5m", "soil_id", F.lit(0.0).alias("dist_km"))
    miss = exact.where("soil_id is null").select("key", "lat", "lon")
    none = miss.select("key", F.lit(None).cast("long").alias("cell5m"), F.lit(None).cast("string").alias("soil_id"), F.lit(None).cast("double").alias("dist_km"))
    if max_km is None:
        return hit.unionByName(none)
    found = soil_nearest(miss, soil, max_km)
    return hit.unionByName(found).unionByName(none.join(found.select("key"), "key", "left_anti"))


def soil_batch(spark, coordinates: list[tuple[float, float]], soil: DataFrame, max_km: float | None = None) -> DataFrame:
    """soil_at for coordinates in a list: a row for each, repeated ones too, in their order (key: the place in the list)."""
    sites = spark.createDataFrame([(k, float(a), float(b)) for k, (a, b) in enumerate(coordinates)], "key long, lat double, lon double")
    return soil_at(sites, soil, max_km).orderBy("key")


def soil_bridge(soil: DataFrame, cells: DataFrame, order: str = "scaled") -> DataFrame:
    """child_id, cell5m, soil_id, dist_deg, is_nearest: soil points of each coarse cell and the one nearest its centre.

    dist_deg has the longitude term scaled by the cosine of the point's latitude; order='planar' leaves that out.
    """
    met = soil.join(cells.select("child_id", F.col("lat").alias("c_lat"), F.col("lon").alias("c_lon")), "child_id")
    turn = F.abs(F.col("lon") - F.col("c_lon"))
    turn = F.least(turn, 360.0 - turn)
    east = turn * F.cos(F.radians("lat")) if order == "scaled" else turn
    met = met.withColumn("dist_deg", F.sqrt(F.pow(F.col("lat") - F.col("c_lat"), F.lit(2.0)) + F.pow(east, F.lit(2.0))))
    first = F.row_number().over(Window.partitionBy("child_id").orderBy("dist_deg", "cell5m")) == 1
    return met.select("child_id", "cell5m", "soil_id", "dist_deg", first.alias("is_nearest"))


def soil_orphans(soil: DataFrame, cells: DataFrame) -> DataFrame:
    return soil.join(cells.select("child_id"), "child_id", "left_anti")


def soil_validation(soil: DataFrame, cells: DataFrame) -> DataFrame:
    """Points, distinct cells, lengths of soil ids and points without a coarse cell."""
    lengths = soil.groupBy(F.length("soil_id").alias("id_length")).agg(F.count("*").alias("n"), F.count_distinct("cell5m").alias("n_cells"))
    lost = soil_orphans(soil, cells).groupBy(F.length("soil_id").alias("id_length")).agg(F.count("*").alias("n_orphans"))
    return lengths.join(lost, "id_length", "left").fillna(0, ["n_orphans"])


def in_bbox(cells: DataFrame, south: float, west: float, north: float, east: float, land: bool = False) -> DataFrame:
    rows = cells.where(F.col("lat").between(south, north) & F.col("lon").between(west, east))
    return rows.where("is_land") if land else rows


def parse_polygon(wkt: str) -> list[list[tuple[float, float]]]:
    """Rings of a POLYGON or MULTIPOLYGON as (lon, lat); holes are rings like others, counted by the even-odd rule."""
    if not re.match(r"\s*(MULTI)?POLYGON\b", wkt, re.I):
        raise ValueError("not a polygon")
    return [[tuple(map(float, p.split()[:2])) for p in ring.split(",")] for ring in re.findall(r"\(([^()]+)\)", wkt)]


def clip_area(ring: list[tuple[float, float]], west: float, south: float, east: float, north: float) -> float:
    """Area of a ring within a box, by cutting it at the box's four sides in turn."""
    points = ring[:-1] if ring and ring[0] == ring[-1] else list(ring)
    for axis, bound, sign in ((0, west, 1), (0, east, -1), (1, south, 1), (1, north, -1)):
        out = []
        for a, b in zip(points, points[1:] + points[:1], strict=True):
            da, db = (a[axis] - bound) * sign, (b[axis] - bound) * sign
            if da >= 0:
                out.append(a)
            if da * db < 0:
                t = da / (da - db)
                out.append((a[0] + (b[0] - a[0]) * t, a[1] + (b[1] - a[1]) * t))
        points = out
        if not points:
            return 0.0
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(points, points[1:] + points[:1], strict=True))) / 2


def _depths(rings: list[list[tuple[float, float]]]) -> list[int]:
    """+1 for outer rings and -1 for holes, by how many other rings hold a ring's first point."""

    def inside(p, ring):
        hit = False
        for a, b in zip(ring, ring[1:] + ring[:1], strict=True):
            if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]) + a[0]:
                hit = not hit
        return hit

    return [-1 if sum(inside(r[0], o) for o in rings if o is not r) % 2 else 1 for r in rings]


def polygon_weights(cells: DataFrame, wkt: str, half: float = 0.125) -> DataFrame:
    """The cells (with lat, lon of their centres) that a polygon overlaps, and the share of each cell's area within it.

    The bounding box prunes the scan; the exact area is taken in Arrow batches.
    """
    rings = parse_polygon(wkt)
    signs = _depths(rings)
    lons, lats = [p[0] for r in rings for p in r], [p[1] for r in rings for p in r]
    near = cells.where(F.col("lat").between(min(lats) - half, max(lats) + half) & F.col("lon").between(min(lons) - half, max(lons) + half))

    def share(lat: pd.Series, lon: pd.Series) -> pd.Series:
        return pd.Series([sum(s * clip_area(r, x - half, y - half, x + half, y + half) for r, s in zip(rings, signs, strict=True)) / (4 * half * half) for y, x in zip(lat, lon, strict=True)], dtype="float64")

    return near.withColumn("weight", F.pandas_udf(share, "double")("lat", "lon")).where("weight > 1e-12")


def _meets(rings: list[list[tuple[float, float]]], west: float, south: float, east: float, north: float) -> bool:
    """Whether a polygon and a box have a point in common, sides and corners included."""
    for ring in rings:
        for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True):
            low, high = 0.0, 1.0
            for start, step, a, b in ((x0, x1 - x0, west, east), (y0, y1 - y0, south, north)):
                if step == 0:
                    low = low if a <= start <= b else 2.0
                else:
                    t = sorted(((a - start) / step, (b - start) / step))
                    low, high = max(low, t[0]), min(high, t[1])
            if low <= high:
                return True
    # no edge reaches the box: it lies wholly inside or outside, as its corner tells by the even-odd rule
    hit = False
    for ring in rings:
        for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (y0 > south) != (y1 > south) and west < (x1 - x0) * (south - y0) / (y1 - y0) + x0:
                hit = not hit
    return hit


def polygon_cells(cells: DataFrame, wkt: str, half: float = 0.125) -> DataFrame:
    """The cells (with lat, lon of their centres) that a polygon meets; touching counts. half: half a cell's side."""
    rings = parse_polygon(wkt)
    lons, lats = [p[0] for r in rings for p in r], [p[1] for r in rings for p in r]
    near = cells.where(F.col("lat").between(min(lats) - half, max(lats) + half) & F.col("lon").between(min(lons) - half, max(lons) + half))

    def meets(lat: pd.Series, lon: pd.Series) -> pd.Series:
        return pd.Series([_meets(rings, x - half, y - half, x + half, y + half) for y, x in zip(lat, lon, strict=True)], dtype="bool")

    return near.where(F.pandas_udf(meets, "boolean")("lat", "lon"))


def region_mean(rows: DataFrame, weights: DataFrame, variables: list[str]) -> DataFrame:
    """Weighted daily means over a region; each variable by the weights of the cells that have it."""
    met = rows.join(weights.select("child_id", "weight"), "child_id")
    mean = lambda v: F.try_divide(F.sum(F.col(v) * F.col("weight")), F.sum(F.when(F.col(v).isNotNull(), F.col("weight"))))
    return met.groupBy("date").agg(*[mean(v).alias(v) for v in variables], F.count("*").alias("n_cells"))


def encoder_check(cells: DataFrame) -> DataFrame:
    """How many cells of a grid table (child_id, parent_id, lat, lon) were checked, and how many codes differ from the encoders'."""
    bad = lambda a, b: F.count_if(~a.eqNullSafe(F.col(b)))
    return cells.agg(F.count("*").alias("checked"), bad(grid.cell_code("lat", "lon"), "child_id").alias("child_bad"), bad(grid.parent_code("lat", "lon"), "parent_id").alias("parent_bad"), bad(grid.parent_of("child_id"), "parent_id").alias("parent_of_bad"))


def land_fraction(pixels: DataFrame, cells: DataFrame, least: float = 0.5) -> DataFrame:
    """cells with land_fraction and is_land, from 0.1-degree pixels (lat, lon, is_land) binned by floor; cells without pixels are sea."""
    row, col = F.floor((90.0 - F.col("lat")) / 0.25).cast("long"), F.floor(grid.wrapped("lon") / 0.25).cast("long")
    share = pixels.groupBy(grid.coarse_code(row, col).alias("child_id")).agg(F.avg(F.col("is_land").cast("double")).alias("land_fraction"))
    found = cells.drop("is_land", "land_fraction").join(share, "child_id", "left").fillna(0.0, ["land_fraction"])
    return found.withColumn("is_land", F.col("land_fraction") >= least)


def fill_timezone(cells: DataFrame, rings: int = 8) -> DataFrame:
    """row, col, t_zone of land cells: their own, else the nearest known within so many rings (ring, then distance, then
    row and column offset), else 15 degrees an hour from lon."""
    known = cells.where("t_zone is not null").select(F.col("row").alias("r"), F.col("col").alias("c"), F.col("t_zone").alias("found"))
    open_ = cells.where("t_zone is null and is_land").select("row", "col", "lon")
    offsets = F.sequence(F.lit(-rings), F.lit(rings))
    near = open_.withColumn("dr", F.explode(offsets)).withColumn("dc", F.explode(offsets)).withColumn("r", F.col("row") + F.col("dr")).withColumn("c", F.pmod(F.col("col") + F.col("dc"), F.lit(grid.COARSE_COLS)))
    order = Window.partitionBy("row", "col").orderBy(F.greatest(F.abs("dr"), F.abs("dc")), F.col("dr") * F.col("dr") + F.col("dc") * F.col("dc"), "dr", "dc")
    best = near.join(known, ["r", "c"]).withColumn("_n", F.row_number().over(order)).where("_n = 1").select("row", "col", "found")
    by_lon = (F.rint(F.col("lon") / 15.0) * 60).cast("int")
    return cells.join(best, ["row", "col"], "left").withColumn("t_zone", F.coalesce("t_zone", "found", F.when(F.col("is_land"), by_lon))).drop("found")
