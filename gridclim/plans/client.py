"""The read API over a stored record: one object, DataFrames out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclim.functions import grid, text
from gridclim.operators import daily, series, spatial, station


@dataclass(frozen=True)
class Climate:
    """stored: the record; cells: the grid table (child_id, parent_id, lat, lon, elevation, t_zone, is_land); the rest where there is any."""

    stored: DataFrame
    cells: DataFrame
    failures: DataFrame | None = None
    alt: DataFrame | None = None
    weights: DataFrame | None = None
    soil: DataFrame | None = None

    def _cell(self, lat: float, lon: float) -> DataFrame:
        return self.cells.where(F.col("child_id") == grid.place(lat, lon).child_id)

    def cell_series(self, lat: float, lon: float, first: str | None = None, last: str | None = None) -> DataFrame:
        """The cell's own rows with its time zone."""
        return series.with_zone(series.cell_rows(self.stored, grid.place(lat, lon), first, last), self.cells).orderBy("date")

    def info(self, lat: float, lon: float) -> DataFrame:
        """Extent and completeness of the cell's record; no row for a coordinate without a cell."""
        at = grid.place(lat, lon)
        return series.series_info(series.cell_rows(self.stored, at), self._cell(lat, lon)).withColumn("fine_id", F.lit(at.fine_id))

    def series(self, lat: float, lon: float, first: str | None = None, last: str | None = None, rain: str | None = "era5", mode: str = "point", columns: list[str] | None = None) -> DataFrame:
        return series.climate_series(self.stored, lat, lon, first, last, rain, mode, self.alt, self.weights, columns)

    def series_long(self, lat: float, lon: float, first: str | None = None, last: str | None = None, variables: list[str] = text.VARIABLES, rain: str | None = "era5", mode: str = "point") -> DataFrame:
        return series.climate_series_long(self.series(lat, lon, first, last, rain, mode), variables)

    def monthly(self, lat: float, lon: float, first: str | None = None, last: str | None = None, rain: str | None = "era5", mode: str = "point") -> DataFrame:
        return daily.monthly(self.series(lat, lon, first, last, rain, mode), []).orderBy("month")

    def missing_days(self, lat: float, lon: float, first: str | None = None, last: str | None = None) -> DataFrame:
        """Days without a row between the given bounds or the record's own; none for a cell without a record."""
        rows = series.cell_rows(self.stored, grid.place(lat, lon))
        return daily.missing_days(rows, ["child_id"], first, last).select("missing_date").orderBy("missing_date")

    def quality(self, lat: float, lon: float, year: int) -> DataFrame:
        at, bounds = grid.place(lat, lon), (f"{year}-01-01", f"{year}-12-31")
        none = self.stored.where("false").select(*daily.KEYS)
        bad = series.cell_rows(self.failures, at, *bounds) if self.failures is not None else none
        days = F.lit(366 if year % 4 == 0 and (year % 100 or year % 400 == 0) else 365)
        return daily.quality_summary(series.cell_rows(self.stored, at, *bounds), bad).withColumn("days_expected", days)

    def compare_rain(self, lat: float, lon: float, sources: list[str], first: str | None = None, last: str | None = None, mode: str = "point", period: str = "month") -> DataFrame:
        """A column for each source; days or months that any of them has."""
        parts = [self.series(lat, lon, first, last, s, mode).select("date", "precip", "rain_source") for s in sources]
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        return series.compare_rain(rows, [], period).orderBy(period)

    def header(self, lat: float, lon: float, first_year: int = 1991, last_year: int = 2020) -> DataFrame:
        rows = series.cell_rows(self.stored, grid.place(lat, lon))
        return station.header(self._cell(lat, lon), station.climatology(rows, ["child_id"], first_year, last_year))

    def station_lines(self, lat: float, lon: float, year: int, rain: str = "era5", mode: str = "point", first_year: int = 1991, last_year: int = 2020) -> DataFrame:
        """ord, line of the station file; an error for a coordinate without a cell."""
        cell = self._cell(lat, lon)
        if not cell.limit(1).count():
            raise ValueError(f"no grid cell for ({lat}, {lon})")
        at = grid.place(lat, lon)
        climate = station.climatology(series.cell_rows(self.stored, at), ["child_id"], first_year, last_year)
        head = station.header_lines(station.header(cell, climate), year, rain)
        days = self.series(lat, lon, f"{year}-01-01", f"{year}-12-31", rain, mode).withColumn("child_id", F.lit(at.child_id))
        named = head.where("ord = 3").select("child_id", F.lit(5).alias("ord"), F.lit(text.BODY_LINE).alias("line"))
        return head.unionByName(named).unionByName(station.body_lines(station.body(days))).select("ord", "line").orderBy("ord")

    def station_text(self, lat: float, lon: float, year: int, **options) -> str:
        """The station file of one cell and year: at most 371 lines."""
        return "".join(r.line + "\n" for r in self.station_lines(lat, lon, year, **options).collect())

    def region(self, wkt: str, variables: list[str], first: str | None = None, last: str | None = None) -> DataFrame:
        """Area-weighted daily means over a polygon."""
        weights = spatial.polygon_weights(self.cells, wkt)
        return spatial.region_mean(series.of_cells(series._between(self.stored, first, last), weights), weights, variables).orderBy("date")

    def fine_region(self, fine_cells: DataFrame, wkt: str, sources: list[str] | None = None, first: str | None = None, last: str | None = None) -> DataFrame:
        """Product rain of every fine cell (fine_id, fparent_id, lat, lon) that a polygon meets."""
        inside = spatial.polygon_cells(fine_cells, wkt, 0.025).select("fparent_id", "fine_id")
        return series.fine_series(self.alt.join(inside, ["fparent_id", "fine_id"], "left_semi"), None, sources, first, last)

    def export_region(self, wkt: str, year: int, rain: str = "era5", first_year: int = 1991, last_year: int = 2020) -> DataFrame:
        """filename, content of the station file of every cell that a polygon meets and that has days."""
        inside = spatial.polygon_cells(self.cells, wkt)
        rows = series.of_cells(self.stored, inside).join(inside.select("child_id"), "child_id", "left_semi")
        return station.station_files(station.station_lines(rows, inside, year, rain, first_year, last_year), year)

    def soil_profile(self, sites: DataFrame, max_km: float | None = None) -> DataFrame:
        """key, cell5m, soil_id, dist_km of sites (key, lat, lon)."""
        return spatial.soil_at(sites, self.soil, max_km)
