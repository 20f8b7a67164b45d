"""Grid tables and export chunks."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclim.functions import grid

# fixed value: the most land cells times time zones that one export takes
EXPORT_CEILING = 58_554


def coarse_grid(spark: SparkSession) -> DataFrame:
    """Every cell of the coarse grid: row, col, child_id, parent_id, lat, lon. Generated in parallel, nothing collected."""
    n = F.col("id")
    row, col = F.floor(n / grid.COARSE_COLS), n % grid.COARSE_COLS
    center = col * grid.COARSE_RES
    return spark.range(grid.COARSE_ROWS * grid.COARSE_COLS).select(row.alias("row"), col.alias("col"), grid.coarse_code(row, col).alias("child_id"), grid.coarse_parent(row, col).alias("parent_id"), (F.lit(90.0) - row * grid.COARSE_RES).alias("lat"), F.when(center > 180, center - 360).otherwise(center).alias("lon"))


def fine_extent(south: float, west: float, north: float, east: float) -> tuple[int, int, int, int]:
    """Rows and signed columns (first and last) of the fine cells that an extent touches."""
    if north <= south or east <= west:
        raise ValueError("north must exceed south and east must exceed west")
    first_row, last_row = math.floor((60.0 - north) * 20 + 1e-9), math.ceil((60.0 - south) * 20 - 1e-9) - 1
    return max(first_row, 0), min(last_row, grid.FINE_ROWS - 1), math.floor(west * 20 + 1e-9), math.ceil(east * 20 - 1e-9) - 1


def fine_grid(spark: SparkSession, south: float, west: float, north: float, east: float) -> DataFrame:
    """The fine cells of an extent: fine_id, fparent_id, lat, lon."""
    r0, r1, c0, c1 = fine_extent(south, west, north, east)
    width = c1 - c0 + 1
    n = F.col("id")
    row, signed = F.floor(n / width) + r0, n % width + c0
    col = F.pmod(signed, F.lit(grid.FINE_COLS))
    lon = (col + 0.5) * 0.05
    return spark.range((r1 - r0 + 1) * width).select(grid.fine_cell(row, col).alias("fine_id"), grid.fine_parent(row, col).alias("fparent_id"), (F.lit(60.0) - (row + 0.5) * 0.05).alias("lat"), F.when(lon > 180, lon - 360).otherwise(lon).alias("lon"))


def land_parents(cells: DataFrame) -> DataFrame:
    """parent_id, land_cells, zones of the parents with land: one aggregation of the land cells."""
    return cells.where("is_land").groupBy("parent_id").agg(F.count("*").alias("land_cells"), F.array_sort(F.collect_set("t_zone")).alias("zones"))


def tile_extent(spark: SparkSession, south: float, west: float, north: float, east: float, k: int, block: int = grid.COARSE_BLOCK) -> DataFrame:
    """Chunks of k x k parents, aligned to the whole grid, that an extent touches: chunk_id, box, n_parents, parent_ids."""
    if k < 1 or north <= south:
        raise ValueError("k must be positive and north must exceed south")
    if east <= west or west < -180 or east > 180:
        raise ValueError("an extent across the antimeridian must be split")
    res, side = grid.COARSE_RES, k * block
    lat0, lat1 = max(math.ceil((90.0 - north) / res - 1e-9), 0), min(math.floor((90.0 - south) / res + 1e-9), grid.COARSE_ROWS - 1)
    lon0, lon1 = math.ceil(west / res - 1e-9), math.floor(east / res + 1e-9)
    lon1 = min(lon1, lon0 + grid.COARSE_COLS - 1)
    if lat1 < lat0 or lon1 < lon0:
        raise ValueError("the extent holds no cell centre")
    r0, r1, c0, c1 = lat0 // side, lat1 // side, lon0 // side, lon1 // side
    width, last_row, parents = c1 - c0 + 1, (grid.COARSE_ROWS - 1) // block, -(-grid.COARSE_COLS // block)
    row, col = F.floor(F.col("id") / width) + r0, F.col("id") % width + c0
    tiles = spark.range((r1 - r0 + 1) * width).select(row.cast("int").alias("row"), col.cast("int").alias("col"))
    p_rows = F.sequence(F.col("row") * k, F.least(F.col("row") * k + k - 1, F.lit(last_row)))
    p_cols = F.sequence(F.col("col") * k, F.col("col") * k + k - 1)
    ids = F.flatten(F.transform(p_rows, lambda r: F.transform(p_cols, lambda c: grid.base36(r.cast("long") * parents + F.pmod(c, F.lit(parents)), 4))))
    south_edge = F.lit(90.0) - (F.least((F.col("row") + 1) * side, F.lit(grid.COARSE_ROWS)) - 1) * res - res / 2
    return tiles.select(
        grid.chunk_code(F.lit(k), "row", "col").alias("chunk_id"),
        F.greatest(south_edge, F.lit(-90.0)).alias("south"),
        F.greatest(F.col("col") * side * res - res / 2, F.lit(-180.0)).alias("west"),
        F.least(F.lit(90.0) - F.col("row") * side * res + res / 2, F.lit(90.0)).alias("north"),
        F.least((F.col("col") * side + side - 1) * res + res / 2, F.lit(180.0)).alias("east"),
        F.size(ids).alias("n_parents"),
        ids.alias("parent_ids"),
    )


def chunk_land_stats(chunks: DataFrame, parents: DataFrame) -> DataFrame:
    """chunk_id, n_land_parents, land_cells, n_zones, cell_zones of every chunk, those without land too."""
    met = chunks.select("chunk_id", F.explode("parent_ids").alias("parent_id")).join(parents, "parent_id", "left")
    zones = F.array_distinct(F.flatten(F.collect_list("zones")))
    found = met.groupBy("chunk_id").agg(F.count("land_cells").alias("n_land_parents"), F.coalesce(F.sum("land_cells"), F.lit(0)).alias("land_cells"), F.size(zones).cast("long").alias("n_zones"))
    return found.withColumn("cell_zones", F.col("land_cells") * F.col("n_zones"))


def plan_chunks(chunks: DataFrame, parents: DataFrame, ceiling: int = EXPORT_CEILING) -> DataFrame:
    """Chunks with land; an error if one is beyond the export ceiling."""
    stats = chunk_land_stats(chunks, parents).where("land_cells > 0")
    ok = F.when(F.col("cell_zones") > ceiling, F.raise_error(F.lit("a chunk is beyond the export ceiling; take fewer parents a side")).cast("long")).otherwise(F.col("cell_zones"))
    return chunks.join(stats.withColumn("cell_zones", ok), "chunk_id")


def side_of(parents: int) -> int:
    k = math.isqrt(parents)
    if k * k != parents:
        raise ValueError(f"{parents} is not a square number of parents")
    return k
