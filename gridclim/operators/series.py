"""Reads of the stored record: point series with a choice of rain, long form, months, completeness and comparisons.

For a literal coordinate the codes are computed on the driver, so parent and cell are literals in the predicates and
prune partitions and row groups. `for_sites` takes coordinates in a table instead.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridclim.functions import grid, text
from gridclim.operators import daily

COLUMNS = ["date", "tmax", "tmin", "precip", "srad", "wind", "tdew", "rh", "et0", "is_preliminary", "imputed"]


def _between(rows: DataFrame, first: str | None, last: str | None) -> DataFrame:
    """Bounds only where given, so that the predicate stays simple enough to push down."""
    if first:
        rows = rows.where(F.col("date") >= F.lit(first).cast("date"))
    return rows.where(F.col("date") <= F.lit(last).cast("date")) if last else rows


def cell_rows(stored: DataFrame, at: grid.Place, first: str | None = None, last: str | None = None) -> DataFrame:
    rows = stored.where((F.col("parent_id") == at.parent_id) & (F.col("child_id") == at.child_id))
    if "bucket" in stored.columns:
        rows = rows.where(F.col("bucket") == at.parent_id[:3])
    return _between(rows, first, last)


def point_rain(alt: DataFrame, at: grid.Place, code: int) -> DataFrame:
    """date, rain of the fine cell that holds the coordinate."""
    return alt.where((F.col("fparent_id") == at.fparent_id) & (F.col("fine_id") == at.fine_id) & (F.col("source") == code)).select("date", F.col("precip").alias("rain"))


def weighted_rain(alt: DataFrame, weights: DataFrame, code: int | None = None, null_aware: bool = False) -> DataFrame:
    """child_id, date, source, rain, coverage, n_fine: area-weighted means over coarse cells, of one source or of each.

    The weight of a null value counts unless null_aware. One shuffle, partial sums first.
    """
    rows = alt if code is None else alt.where(F.col("source") == code)
    # in a stored table the parents take part in the join, so that only their row groups are read
    on = ["fparent_id", "fine_id"] if {"bucket", "fparent_id"} <= set(alt.columns) and "fparent_id" in weights.columns else ["fine_id"]
    weights = weights.select(*on, "child_id", "weight")
    rows = rows.join(F.broadcast(weights) if _small(weights) else weights, on)
    value, weight = F.col("precip").cast("double"), F.col("weight").cast("double")
    counted = F.when(value.isNotNull(), weight) if null_aware else weight
    found = rows.groupBy("child_id", "date", "source").agg(F.sum(value * weight).alias("_p"), F.sum(counted).alias("coverage"), F.count("*").alias("n_fine"))
    return found.select("child_id", "date", "source", F.try_divide("_p", "coverage").alias("rain"), "coverage", "n_fine")


def _small(rows: DataFrame, most: int = 32 << 20) -> bool:
    """Whether Spark's own estimate of the rows is within what may be broadcast."""
    size = rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= most


def climate_series(stored: DataFrame, lat: float, lon: float, first: str | None = None, last: str | None = None, rain: str | None = "era5", mode: str = "point", alt: DataFrame | None = None, weights: DataFrame | None = None, columns: list[str] | None = None) -> DataFrame:
    """The record of the cell at a coordinate, with its own rain or a product's: at the point or area-weighted.

    Days without the product's rain have a null precip. An error for an unknown source, mode or column.
    """
    if mode not in ("point", "weighted"):
        raise ValueError(f"unknown mode {mode!r}; known: point, weighted")
    code, at = text.rain_source(rain), grid.place(lat, lon)
    if unknown := [c for c in columns or [] if c not in COLUMNS]:
        raise ValueError(f"unknown columns: {unknown}")
    rows = cell_rows(stored, at, first, last).select(*COLUMNS)
    if code is not None:
        if alt is None or (mode == "weighted" and weights is None):
            raise ValueError("the product's rain (and, for weighted, the weights) are needed")
        if mode == "point":
            other = point_rain(alt, at, code)
        else:
            mine, cells = weights.where(F.col("child_id") == at.child_id), fine_cells_of(at)
            near = alt.where(F.col("fparent_id").isin(sorted({_fine_parent(c) for c in cells})) & F.col("fine_id").isin(cells))
            other = weighted_rain(near, mine, code).select("date", "rain")
        rows = rows.drop("precip").join(_between(other, first, last).withColumnRenamed("rain", "precip"), "date", "left").select(*COLUMNS)
    rows = rows.withColumn("rain_source", F.lit((rain or "era5").lower()))
    return rows.select(*columns).orderBy("date") if columns and "date" in columns else rows.select(*columns) if columns else rows.orderBy("date")


def climate_series_long(series: DataFrame, variables: list[str] = text.VARIABLES) -> DataFrame:
    return daily.to_long(series, ["date"], variables).orderBy("date", "variable")


def fine_cells_of(at: grid.Place) -> list[str]:
    """The fine cells that a coarse cell's box meets, computed as literals for the scan; none beyond the fine grid's rows."""
    edge = 1e-9
    rows = range(max(0, math.floor((60.0 - at.cell_lat - 0.125) * 20 + edge)), min(grid.FINE_ROWS - 1, math.ceil((60.0 - at.cell_lat + 0.125) * 20 - edge) - 1) + 1)
    west = (at.cell_lon - 0.125) * 20
    cols = {c % grid.FINE_COLS for c in range(math.floor(west + edge), math.ceil(west + 5.0 - edge))}
    return sorted(grid._digits(r * grid.FINE_COLS + c, 5) for r in rows for c in cols)


def with_zone(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows of the record with the time zone of their cell; null for a cell that the grid table lacks."""
    return rows.join(cells.select("parent_id", "child_id", "t_zone"), ["parent_id", "child_id"], "left")


def by_month(rows: DataFrame, other: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Monthly sums of the record's rain beside those of products, for the months that all of them have."""
    total = lambda r, c: r.groupBy(*keys, F.trunc("date", "month").alias("month")).agg(F.sum("precip").alias(c))
    found = total(rows, "era5")
    for name, r in other.items():
        found = found.join(total(r, name), [*keys, "month"])
    return found


def series_info(stored: DataFrame, cells: DataFrame, keys: list[str] = ("parent_id", "child_id")) -> DataFrame:
    """Extent and completeness of each cell of the grid table; cells without rows have zero counts."""
    counts = stored.groupBy(*keys).agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count("*").alias("n_days"), F.count_if(F.coalesce("is_preliminary", F.lit(False))).alias("n_prelim"), F.count_if(F.coalesce(F.col("imputed").cast("int"), F.lit(0)) != 0).alias("n_imputed"))
    found = cells.join(counts, list(keys), "left").fillna(0, ["n_days", "n_prelim", "n_imputed"])
    expected = F.coalesce(F.datediff("last_date", "first_date") + 1, F.lit(0)).cast("long")
    return found.withColumn("n_expected", expected).withColumn("n_missing", F.col("n_expected") - F.col("n_days"))


def series_for_sites(stored: DataFrame, sites: DataFrame) -> DataFrame:
    """The record at each site (key, lat, lon); a site without rows keeps one row of nulls.

    A stored table's partition column takes part in the join, so that only the sites' partitions are read.
    """
    located = sites.withColumns({"child_id": grid.cell_code("lat", "lon"), "parent_id": grid.parent_code("lat", "lon")})
    if "bucket" in stored.columns:
        located = located.withColumn("bucket", F.substring("parent_id", 1, 3))
        mine = stored.join(F.broadcast(located.select("bucket").distinct()) if _small(sites) else located.select("bucket").distinct(), "bucket", "left_semi")
        return located.join(mine, ["bucket", "parent_id", "child_id"], "left").drop("bucket")
    return located.join(stored, ["parent_id", "child_id"], "left")


def of_cells(stored: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows in the partitions that hold the cells (child_id, parent_id); the join prunes a table that is partitioned by bucket."""
    if "bucket" not in stored.columns or "parent_id" not in cells.columns:
        return stored
    held = cells.select(F.substring("parent_id", 1, 3).alias("bucket")).distinct()
    return stored.join(F.broadcast(held), "bucket", "left_semi")


def nearest_of(rows: DataFrame, keys: list[str], distance: str, tie: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(distance, tie)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def fine_series(alt: DataFrame, cells: list[str] | None = None, sources: list[str] | None = None, first: str | None = None, last: str | None = None) -> DataFrame:
    """Product rain of fine cells; their parents are derived from the codes and prune the scan."""
    rows = alt
    if cells is not None:
        if bad := [c for c in cells if len(c) != 5]:
            raise ValueError(f"not fine codes: {bad}")
        parents = sorted({_fine_parent(c) for c in cells})
        rows = rows.where(F.col("fparent_id").isin(parents) & F.col("fine_id").isin(list(cells)))
    if sources is not None:
        rows = rows.where(F.col("source").isin([text.rain_source(s) for s in sources]))
    return _between(rows, first, last).orderBy("fine_id", "date", "source")


def _fine_parent(code: str) -> str:
    row, col = divmod(int(code, 36), grid.FINE_COLS)
    return grid._digits(row // grid.FINE_BLOCK * (grid.FINE_COLS // grid.FINE_BLOCK) + col // grid.FINE_BLOCK, 5)


def compare_rain(rows: DataFrame, keys: list[str], period: str = "date") -> DataFrame:
    """A column of totals for each source: rows of (keys, date, rain_source, precip), by day or month; the union of all days."""
    when = F.trunc("date", "month") if period == "month" else F.col("date")
    return rows.groupBy(*keys, when.alias(period)).pivot("rain_source", ["era5", *text.RAIN_SOURCES]).agg(F.sum("precip"))


def source_totals(rain: DataFrame, stored: DataFrame) -> DataFrame:
    """One row: the sum of each product's rain, by its name, and how many rows of the record are preliminary and repaired."""
    names = list(text.RAIN_SOURCES)
    sums = rain.agg(*[F.sum(F.when(F.col("source") == text.RAIN_SOURCES[n], F.col("precip"))).alias(n) for n in names])
    counts = stored.agg(F.count_if("is_preliminary").alias("n_prelim"), F.count_if(F.coalesce("imputed", F.lit(0)) != 0).alias("n_repaired"))
    return sums.withColumn("_one", F.lit(1)).join(counts.withColumn("_one", F.lit(1)), "_one").drop("_one")


def precip_compare(stored: DataFrame, alt: DataFrame, weights: DataFrame) -> DataFrame:
    """The record's rain beside each product's area-weighted rain: child_id, date, source, own, other, coverage, n."""
    other = weighted_rain(alt, weights).withColumnRenamed("rain", "alt_precip")
    own = stored.select("child_id", "date", F.col("precip").alias("own_precip"))
    return other.join(own, ["child_id", "date"]).select("child_id", "date", "source", "own_precip", "alt_precip", "coverage", "n_fine")
