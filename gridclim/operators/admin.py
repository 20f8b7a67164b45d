"""Administrative units by cells: how much of each coarse cell lies in each polygon of a table.

A sum over edges, in columns throughout. Each edge is cut at the grid's rows and columns; a piece tells how much of its cell lies to
the east of it, and that all cells further east in the row do. Added up along a row from the west, pieces give the exact share
of the cells that edges cross, and one share for the run of cells between two of them. Outer rings count positively and
holes negatively, so any number of either needs nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridclim.functions import grid
from gridclim.functions.special import let
from gridclim.operators.dealing import dealt

_INSIDE = r"[-+0-9.eE,()\s]*"
_WKT = rf"(?i)^\s*(POLYGON\s*(Z\s*)?(EMPTY|\(\s*\({_INSIDE}\)\s*\))|MULTIPOLYGON\s*(Z\s*)?(EMPTY|\(\s*\(\s*\({_INSIDE}\)\s*\)\s*\)))\s*$"
#: A share below this is none.
LEAST = 1e-9
#: Units of a task.
UNITS = 4000


def rings(units: DataFrame, unit: str = "admin_id", wkt: str = "wkt") -> DataFrame:
    """unit, part, ring (0: the outer one) and points (array of lon, lat) of each ring of each unit's POLYGON or MULTIPOLYGON; null and
    EMPTY have none, other texts are an error."""
    sound = F.when(F.col(wkt).rlike(_WKT), F.col(wkt)).otherwise(F.raise_error(F.concat(F.lit("not a polygon: "), F.substring(wkt, 1, 40))).cast("string"))
    text = F.when(F.col(wkt).isNotNull(), sound)
    # cut by plain patterns, which take a text of any length: between polygons two brackets close, between rings one
    filled = F.when(~text.rlike(r"(?i)EMPTY"), F.regexp_replace(text, r"(?i)^\s*(MULTI)?POLYGON\s*(Z\s*)?", ""))
    parts = units.select(F.col(unit), F.posexplode(F.split(filled, r"\)\s*\)\s*,\s*\(\s*\(")).alias("part", "_body"))
    each = parts.select(unit, "part", F.posexplode(F.split("_body", r"\)\s*,\s*\(")).alias("ring", "_raw")).withColumn("_ring", F.regexp_replace("_raw", "[()]", ""))
    numbers = lambda p: F.split(F.trim(p), r"\s+")
    points = F.transform(F.split("_ring", ","), lambda p: F.struct(numbers(p)[0].cast("double").alias("lon"), numbers(p)[1].cast("double").alias("lat")))
    return each.select(unit, "part", "ring", points.alias("points"))


def edges(found: DataFrame, unit: str = "admin_id") -> DataFrame:
    """unit, x0, y0, x1, y1 of the edges in columns and rows of the coarse grid, and sign: what the ring counts by the way it turns."""
    x, y = (lambda p: (p["lon"] + grid.COARSE_RES / 2) / grid.COARSE_RES), (lambda p: (90.0 + grid.COARSE_RES / 2 - p["lat"]) / grid.COARSE_RES)
    side = lambda a, b: F.struct(x(a).alias("x0"), y(a).alias("y0"), x(b).alias("x1"), y(b).alias("y1"))
    around = lambda p: F.zip_with(p, F.concat(F.slice(p, 2, F.size(p)), F.slice(p, 1, 1)), side)

    def turn(line: Column) -> Column:
        """Twice the ring's area, about its first point, so that small rings far from the origin keep their digits."""
        twice = lambda o: F.aggregate(line, F.lit(0.0), lambda s, e: s + (e["x0"] - o["x0"]) * (e["y1"] - o["y0"]) - (e["x1"] - o["x0"]) * (e["y0"] - o["y0"]))
        return F.struct(line.alias("line"), let(F.get(line, F.lit(0)), twice).alias("turn"))

    walked = found.select(unit, "ring", let(F.col("points"), lambda p: let(around(p), turn)).alias("w"))
    counted = walked.select(unit, F.col("w.line").alias("line"), (-F.signum("w.turn") * F.when(F.col("ring") == 0, 1).otherwise(-1)).alias("sign"))
    return counted.select(unit, "sign", F.explode("line").alias("e")).select(unit, "sign", "e.*").where("y0 <> y1 AND sign <> 0")


def _between(value: Column, a: Column, b: Column) -> Column:
    return F.greatest(F.least(a, b), F.least(F.greatest(a, b), value))


def admin_cells(units: DataFrame, unit: str = "admin_id", wkt: str = "wkt") -> DataFrame:
    """unit, parent_id, child_id, area_fraction: the coarse cells that each unit's polygon overlaps, and the share of the cell's area (in
    degrees) that lies in it.

    Rings may begin anywhere and turn either way, the last point may repeat the first; the first ring of a polygon is the outer one, and
    polygons of a unit do not overlap. Longitudes go on beyond 180 where a unit crosses the antimeridian; a cell that
    straddles it adds up both sides. Rows that repeat a unit add up too. Cells touched without area are left out.

    Units are dealt to tasks before their texts are cut, UNITS at a time, and all sums are within a unit, whose cells are at most the
    grid's: a task holds the same however many units there are.
    """
    e = edges(rings(dealt(units.select(unit, wkt), UNITS, unit), unit, wkt), unit)
    last = lambda low, high: F.greatest(low, F.ceil(high) - 1)
    by_row = e.withColumn("r", F.explode(F.sequence(F.floor(F.least("y0", "y1")), last(F.floor(F.least("y0", "y1")), F.greatest("y0", "y1")))))
    at = lambda y: F.col("x0") + (F.col("x1") - F.col("x0")) * ((y - F.col("y0")) / (F.col("y1") - F.col("y0")))
    ya, yb = _between(F.col("r"), F.col("y0"), F.col("y1")), _between(F.col("r") + 1, F.col("y0"), F.col("y1"))
    piece = by_row.withColumns({"ya": ya, "yb": yb}).withColumns({"xa": _between(at(F.col("ya")), F.col("x0"), F.col("x1")), "xb": _between(at(F.col("yb")), F.col("x0"), F.col("x1"))})
    piece = piece.select(unit, "r", (F.col("sign") * F.when(F.col("y1") > F.col("y0"), 1).otherwise(-1)).alias("sign"), F.least("xa", "xb").alias("x"), F.greatest("xa", "xb").alias("to"), (F.col("yb") - F.col("ya")).alias("dy")).where("dy > 0")
    # within a row the height of a piece is dealt evenly over its width
    by_cell = piece.withColumn("c", F.explode(F.sequence(F.floor("x"), last(F.floor("x"), F.col("to")))))
    low, high = F.greatest("x", "c"), F.least(F.col("to"), F.col("c") + 1)
    height = F.when(F.col("to") > F.col("x"), F.col("dy") * ((high - low) / (F.col("to") - F.col("x")))).otherwise(F.col("dy")) * F.col("sign")
    sums = by_cell.groupBy(unit, "r", "c").agg(F.sum(height).alias("cover"), F.sum(height * (1 - ((low + high) / 2 - F.col("c")))).alias("east"))
    row = Window.partitionBy(unit, "r").orderBy("c")
    walked = sums.select(unit, "r", "c", "east", "cover", F.sum("cover").over(row).alias("upto"), F.lead("c").over(row).alias("next"))
    own = F.array(F.struct(F.col("c").alias("c"), (F.col("upto") - F.col("cover") + F.col("east")).alias("share")))
    run = F.when((F.col("upto") > LEAST) & (F.col("next") > F.col("c") + 1), F.transform(F.sequence(F.col("c") + 1, F.col("next") - 1), lambda c: F.struct(c.alias("c"), F.col("upto").alias("share"))))
    cells = walked.select(unit, "r", F.explode(F.concat(own, F.coalesce(run, F.array().cast("array<struct<c:bigint,share:double>>")))).alias("s"))
    col = F.pmod(F.col("s.c"), F.lit(grid.COARSE_COLS))
    shares = cells.groupBy(unit, "r", col.alias("c")).agg(F.sum("s.share").alias("area_fraction")).where(F.col("area_fraction") > LEAST)
    return shares.select(unit, grid.coarse_parent(F.col("r"), F.col("c")).alias("parent_id"), grid.coarse_code(F.col("r"), F.col("c")).alias("child_id"), F.least(F.lit(1.0), "area_fraction").alias("area_fraction"))


def unit_means(rows: DataFrame, shares: DataFrame, variables: list[str], unit: str = "admin_id") -> DataFrame:
    """unit, date, n_cells and the variables' means by the cells' shares; each over the cells that have it."""
    met = rows.join(shares.select(unit, "parent_id", "child_id", "area_fraction"), ["parent_id", "child_id"])
    mean = lambda v: F.try_divide(F.sum(F.col(v) * F.col("area_fraction")), F.sum(F.when(F.col(v).isNotNull(), F.col("area_fraction"))))
    return met.groupBy(unit, "date").agg(F.count("*").alias("n_cells"), *[mean(v).alias(v) for v in variables])
