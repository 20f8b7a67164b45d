"""Raster stacks to long rows. A tile is a row (time, lats, lons, values) with values row by row; null or NaN is masked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclim.functions import grid

# fixed values: names of the axes
LAT_NAMES, LON_NAMES = ("latitude", "lat", "y"), ("longitude", "lon", "x")


def _pixels(tiles: DataFrame) -> DataFrame:
    """One row for each pixel of each tile: date, lat, lon, value. Rows of a tile are exploded where it lies."""
    flat = tiles.select("date", "lats", "lons", F.posexplode("values").alias("at", "value"))
    n = F.size("lons")
    return flat.select("date", F.get("lats", F.expr("cast(at div size(lons) as int)")).alias("lat"), F.get("lons", (F.col("at") % n).cast("int")).alias("lon"), F.col("value").cast("double").alias("value"))


def to_latlon(fields: DataFrame) -> DataFrame:
    """Tiles of fields (date, dims, sizes, lats, lons, values) whose axes come in any order and with others besides: the values
    row by row of latitude and longitude, at the first place of every other axis. Axes are known by the usual names."""
    place = lambda names: F.array_position(F.transform("dims", lambda d: F.lower(d).isin(*names)), F.lit(True)).cast("int")
    known = fields.withColumns({"_lat": place(LAT_NAMES), "_lon": place(LON_NAMES)})
    none = F.raise_error(F.lit("a field needs a latitude and a longitude")).cast("int")
    known = known.withColumns({c: F.when((F.col("_lat") < 1) | (F.col("_lon") < 1), none).otherwise(F.col(c)) for c in ("_lat", "_lon")})
    stride = lambda at: F.aggregate(F.slice("sizes", F.col(at) + 1, F.greatest(F.lit(0), F.size("sizes") - F.col(at))), F.lit(1), lambda a, x: a * x)
    known = known.withColumns({"_s": stride("_lat"), "_t": stride("_lon")})
    cells = F.flatten(F.transform(F.sequence(F.lit(0), F.size("lats") - 1), lambda i: F.transform(F.sequence(F.lit(0), F.size("lons") - 1), lambda j: F.get("values", i * F.col("_s") + j * F.col("_t")))))
    return known.select("date", "lats", "lons", cells.alias("values"))


def mosaic(tiles: DataFrame) -> DataFrame:
    """One long field (date, lat, lon, value) of tiles that may overlap: of several values of a pixel the first tile's that is
    known counts, tiles going by their `file` and then their first corner."""
    order = tiles.withColumn("_order", F.struct("file", F.get("lats", F.lit(0)), F.get("lons", F.lit(0))))
    flat = order.select("date", "lats", "lons", "_order", F.posexplode("values").alias("at", "value"))
    pixel = flat.select("date", F.get("lats", F.expr("cast(at div size(lons) as int)")).alias("lat"), F.get("lons", (F.col("at") % F.size("lons")).cast("int")).alias("lon"), "_order", F.col("value").cast("double").alias("value"))
    known = pixel.where("value is not null and not isnan(value)")
    return known.groupBy("date", "lat", "lon").agg(F.min_by("value", "_order").alias("value"))


def encode_grid(tiles: DataFrame) -> DataFrame:
    """Coarse long rows (child_id, parent_id, date, value); an error if a cell has two values on a date."""
    rows = _pixels(tiles).where("value is not null and not isnan(value)")
    row, col = F.greatest(F.lit(0), F.least(F.lit(grid.COARSE_ROWS - 1), grid.lat_index("lat"))), grid.lon_index("lon", "clip")
    coded = rows.select(grid.coarse_code(row, col).alias("child_id"), grid.coarse_parent(row, col).alias("parent_id"), "date", "value")
    once = coded.groupBy("child_id", "parent_id", "date").agg(F.first("value").alias("value"), F.count("*").alias("n"))
    fine = F.when(F.col("n") > 1, F.raise_error(F.lit("a cell has several values on a date")).cast("double")).otherwise(F.col("value"))
    return once.select("child_id", "parent_id", "date", fine.alias("value"))


def encode_fine_grid(tiles: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Fine long rows; an error if an axis is off the grid's cell centres by more than the tolerance."""
    rows = _pixels(tiles).where("value is not null and not isnan(value)")
    row, col = grid.fine_lat_index("lat"), grid.fine_lon_index("lon")
    off = F.greatest(F.abs(F.lit(grid.FINE_NORTH) - (row + 0.5) * 0.05 - F.col("lat")), F.abs((col + 0.5) * 0.05 - grid.wrapped("lon")))
    value = F.when(off > tolerance, F.raise_error(F.lit("the raster is off the fine grid")).cast("double")).otherwise(F.col("value"))
    return rows.select(grid.fine_cell(row, col).alias("fine_id"), grid.fine_parent(row, col).alias("fparent_id"), "date", value.alias("value"))


def pixel_counts(tiles: DataFrame) -> DataFrame:
    """Valid and all pixels over the tiles."""
    value = F.col("value")
    return _pixels(tiles).agg(F.count("*").alias("n_pixels"), F.count_if(value.isNotNull() & ~F.isnan(value)).alias("n_valid"))
