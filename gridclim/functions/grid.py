"""Deterministic grid codes as column arithmetic, with scalar mirrors for literals.

Three grids: coarse 0.25 degrees (cell centres on the lattice), fine 0.05 degrees (cell edges on it, 60S..60N) and
soil 5 arc minutes. A cell's code is its row-major number in base 36, of 4 characters (coarse) or 5 (fine); a parent
block's code likewise. Scalar mirrors give the literals that static partition pruning needs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# fixed values: sizes and origins of the grids
COARSE_RES, COARSE_ROWS, COARSE_COLS, COARSE_BLOCK = 0.25, 721, 1440, 4
FINE_PER_DEGREE, FINE_ROWS, FINE_COLS, FINE_BLOCK, FINE_NORTH = 20, 2400, 7200, 20, 60.0
SOIL_PER_DEGREE, SOIL_ROWS, SOIL_COLS = 12, 2160, 4320
EDGE = 1e-9


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


def guarded(ok: Column, value: Column, message: str) -> Column:
    """value where ok holds or is null, else an error."""
    return F.when(~ok, F.raise_error(F.lit(message)).cast("string")).otherwise(value)


def base36(n, width: int) -> Column:
    """Fixed-width base 36; an error where the number does not fit or is negative."""
    n = _col(n).cast("long")
    return guarded((n >= 0) & (n < 36**width), F.lpad(F.conv(n.cast("string"), 10, 36), width, "0"), f"not a {width}-digit base-36 number")


def base36_decode(code) -> Column:
    """The number of a code; an error on other characters."""
    code = _col(code)
    return guarded(code.rlike("^[0-9A-Z]+$"), F.conv(code, 36, 10), "not a base-36 code").cast("long")


def round_half_even(x) -> Column:
    return F.rint(_col(x))


def wrapped(lon) -> Column:
    """Longitude in [0, 360)."""
    return F.pmod(_col(lon), F.lit(360.0))


def lat_index(lat) -> Column:
    return F.rint((F.lit(90.0) - _col(lat)) / COARSE_RES).cast("long")


def lon_index(lon, seam: str = "spill") -> Column:
    """Column number. Just west of Greenwich it rounds to 1440: `spill` keeps that (codes run into the next row),
    `clip` makes it 1439, `wrap` 0."""
    index = F.rint(wrapped(lon) / COARSE_RES).cast("long")
    if seam == "clip":
        return F.when(index.isNotNull(), F.least(index, F.lit(COARSE_COLS - 1)))
    return index % COARSE_COLS if seam == "wrap" else index


def coarse_code(row: Column, col: Column) -> Column:
    return base36(row * COARSE_COLS + col, 4)


def cell_code(lat, lon, seam: str = "spill") -> Column:
    return coarse_code(lat_index(lat), lon_index(lon, seam))


def coarse_parent(row: Column, col: Column, block: int = COARSE_BLOCK) -> Column:
    return base36(F.floor(row / block) * -(-COARSE_COLS // block) + F.floor(col / block), 4)


def parent_code(lat, lon, block: int = COARSE_BLOCK, seam: str = "spill") -> Column:
    return coarse_parent(lat_index(lat), lon_index(lon, seam), block)


def parent_of(code, block: int = COARSE_BLOCK) -> Column:
    n = base36_decode(code)
    return coarse_parent(F.floor(n / COARSE_COLS), n % COARSE_COLS, block)


def _signed(lon: Column) -> Column:
    return F.when(lon > 180, lon - 360).otherwise(lon)


def code_center(code) -> Column:
    """struct(lat, lon) of a coarse cell's centre."""
    n = base36_decode(code)
    return F.struct((F.lit(90.0) - F.floor(n / COARSE_COLS) * COARSE_RES).alias("lat"), _signed(n % COARSE_COLS * COARSE_RES).alias("lon"))


def cell_center(lat, lon) -> Column:
    """struct(lat, lon): the coordinate snapped to the centre of its coarse cell."""
    return F.struct((F.lit(90.0) - lat_index(lat) * COARSE_RES).alias("lat"), _signed(lon_index(lon) * COARSE_RES).alias("lon"))


def _box(south: Column, west: Column, north: Column, east: Column, ok: Column) -> Column:
    shift = F.when(west >= 180, F.lit(360.0)).otherwise(F.lit(0.0))
    east = F.when(ok & ((west >= 180) | (east <= 180)), east - shift).otherwise(F.raise_error(F.lit("the block is outside the grid or straddles the antimeridian")).cast("double"))
    return F.struct(south.alias("south"), (west - shift).alias("west"), north.alias("north"), east.alias("east"))


def parent_bbox(row: Column, col: Column, block: int = COARSE_BLOCK) -> Column:
    """struct(south, west, north, east): outer edges of a parent's cells; the last row and column may be short."""
    half, last_row, last_col = COARSE_RES / 2, F.least((row + 1) * block, F.lit(COARSE_ROWS)) - 1, F.least((col + 1) * block, F.lit(COARSE_COLS)) - 1
    inside = (row >= 0) & (col >= 0) & (row * block < COARSE_ROWS) & (col * block < COARSE_COLS)
    return _box(F.lit(90.0) - last_row * COARSE_RES - half, col * block * COARSE_RES - half, F.lit(90.0) - row * block * COARSE_RES + half, last_col * COARSE_RES + half, inside)


def parent_code_bbox(code, block: int = COARSE_BLOCK) -> Column:
    n, columns = base36_decode(code), -(-COARSE_COLS // block)
    return parent_bbox(F.floor(n / columns), n % columns, block)


def _clamped(index: Column, most: int) -> Column:
    return F.when(index.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(most - 1), index))).cast("long")


def fine_lat_index(lat) -> Column:
    return _clamped(F.floor((F.lit(FINE_NORTH) - _col(lat)) * FINE_PER_DEGREE + EDGE), FINE_ROWS)


def fine_lon_index(lon) -> Column:
    return _clamped(F.floor(wrapped(lon) * FINE_PER_DEGREE + EDGE), FINE_COLS)


def fine_cell(row: Column, col: Column) -> Column:
    return base36(row * FINE_COLS + col, 5)


def fine_code(lat, lon) -> Column:
    return fine_cell(fine_lat_index(lat), fine_lon_index(lon))


def fine_parent(row: Column, col: Column, block: int = FINE_BLOCK) -> Column:
    return base36(F.floor(row / block) * -(-FINE_COLS // block) + F.floor(col / block), 5)


def fine_parent_code(lat, lon, block: int = FINE_BLOCK) -> Column:
    return fine_parent(fine_lat_index(lat), fine_lon_index(lon), block)


def fine_number(code) -> Column:
    """The row-major number of a fine code; an error for a code of another width."""
    code = _col(code)
    return guarded(F.length(code) == 5, base36_decode(code).cast("string"), "not a fine code").cast("long")


def fine_parent_of(code, block: int = FINE_BLOCK) -> Column:
    n = fine_number(code)
    return fine_parent(F.floor(n / FINE_COLS), n % FINE_COLS, block)


def fine_code_center(code) -> Column:
    n = fine_number(code)
    return F.struct((F.lit(FINE_NORTH) - (F.floor(n / FINE_COLS) + 0.5) * 0.05).alias("lat"), _signed((n % FINE_COLS + 0.5) * 0.05).alias("lon"))


def fine_cell_center(lat, lon) -> Column:
    return fine_code_center(fine_code(lat, lon))


def fine_parent_bbox(row: Column, col: Column, block: int = FINE_BLOCK) -> Column:
    step = block * 0.05
    inside = (row >= 0) & (col >= 0) & (row < FINE_ROWS // block) & (col < FINE_COLS // block)
    return _box(F.lit(FINE_NORTH) - F.least((row + 1) * block, F.lit(FINE_ROWS)) * 0.05, col * step, F.lit(FINE_NORTH) - row * step, F.least((col + 1) * block, F.lit(FINE_COLS)) * 0.05, inside)


def fine_parent_code_bbox(code, block: int = FINE_BLOCK) -> Column:
    n, columns = fine_number(code), -(-FINE_COLS // block)
    return fine_parent_bbox(F.floor(n / columns), n % columns, block)


def soil_cell(lat, lon) -> Column:
    """Number of the 5-arc-minute cell that contains a coordinate: rows clamped, columns wrapped."""
    row = _clamped(F.floor((F.lit(90.0) - _col(lat)) * SOIL_PER_DEGREE), SOIL_ROWS)
    return row * SOIL_COLS + F.floor(F.pmod(_col(lon) + 180.0, F.lit(360.0)) * SOIL_PER_DEGREE) % SOIL_COLS


def soil_cell_center(cell) -> Column:
    cell = _col(cell)
    return F.struct((F.lit(90.0) - (F.floor(cell / SOIL_COLS) + 0.5) / SOIL_PER_DEGREE).alias("lat"), ((cell % SOIL_COLS + 0.5) / SOIL_PER_DEGREE - 180.0).alias("lon"))


def snap(x, step: float = COARSE_RES) -> Column:
    return F.rint(_col(x) / step) * step


def extent_key(south, west, north, east) -> Column:
    """A stable name of an extent: its sides on the coarse grid, south, west, north and east."""
    return F.concat_ws(",", *[snap(x).cast("string") for x in (south, west, north, east)])


def locate(lat, lon) -> Column:
    """All codes of a coordinate and the centre of its coarse cell."""
    center = cell_center(lat, lon)
    return F.struct(
        cell_code(lat, lon).alias("child_id"), parent_code(lat, lon).alias("parent_id"), fine_code(lat, lon).alias("fine_id"),
        fine_parent_code(lat, lon).alias("fparent_id"), soil_cell(lat, lon).alias("cell5m"), center["lat"].alias("cell_lat"), center["lon"].alias("cell_lon"),
    )


def _digits(n: int, width: int) -> str:
    if not 0 <= n < 36**width:
        raise ValueError(f"{n} is not a {width}-digit base-36 number")
    return "".join(DIGITS[n // 36**k % 36] for k in range(width - 1, -1, -1))


@dataclass(frozen=True)
class Place:
    """Codes of a literal coordinate."""

    child_id: str
    parent_id: str
    fine_id: str
    fparent_id: str
    cell5m: int
    cell_lat: float
    cell_lon: float


def place(lat: float, lon: float) -> Place:
    """The scalar mirror of locate, for literals."""
    if not -90 <= lat <= 90 or not math.isfinite(lon):
        raise ValueError(f"no such place: ({lat}, {lon})")
    row, col = round((90.0 - lat) / COARSE_RES), round(lon % 360.0 / COARSE_RES)
    fine_row = min(max(math.floor((FINE_NORTH - lat) * FINE_PER_DEGREE + EDGE), 0), FINE_ROWS - 1)
    fine_col = min(max(math.floor(lon % 360.0 * FINE_PER_DEGREE + EDGE), 0), FINE_COLS - 1)
    soil_row = min(max(math.floor((90.0 - lat) * SOIL_PER_DEGREE), 0), SOIL_ROWS - 1)
    center = col * COARSE_RES
    return Place(
        _digits(row * COARSE_COLS + col, 4),
        _digits(row // COARSE_BLOCK * (COARSE_COLS // COARSE_BLOCK) + col // COARSE_BLOCK, 4),
        _digits(fine_row * FINE_COLS + fine_col, 5),
        _digits(fine_row // FINE_BLOCK * (FINE_COLS // FINE_BLOCK) + fine_col // FINE_BLOCK, 5),
        soil_row * SOIL_COLS + math.floor((lon + 180.0) % 360.0 * SOIL_PER_DEGREE) % SOIL_COLS,
        90.0 - row * COARSE_RES,
        center - 360.0 if center > 180 else center,
    )


def chunk_code(size, row, col) -> Column:
    """Export chunk name: s<size>r<row>c<signed column>."""
    return F.format_string("s%02dr%03dc%+04d", _col(size), _col(row), _col(col))


def chunk_size(name) -> Column:
    return F.regexp_extract(_col(name), r"^s(\d+)r", 1).cast("int")
